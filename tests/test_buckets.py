"""Tables of orders in buckets: rows are dealt once, for their ranking, and the rows are those without buckets."""

import datetime as dt
import re

import pytest

from lakemart.operators.checks import QualityGateError
from lakemart.plans import warehouse
from lakemart.plans.model_suite import declared_tests
from lakemart.plans.staging import MODELS, STAGED, stage
from lakemart.plans.warehouse import current_rows, model_table, staged_rows_of_orders, staged_table
from lakemart.sources import raw_load
from lakemart.sources.lake import WITHIN, Lake

NO_DAY = "cast(null as timestamp_ntz)"


def texts(spark, n, batch, day, **columns):
    """``n`` RAW rows: text columns given as SQL over ``id``."""
    values = [f"cast({value} as string) as {name}" for name, value in columns.items()]
    return spark.range(n).selectExpr(
        *values, f"'{batch}' as batch_id", "timestamp_ntz'2024-01-01 00:00:00' as loaded_at", f"cast({day} as timestamp_ntz) as source_updated_at"
    )


def raws(spark, batch, since=0):
    """Orders with up to three items and two payments each, ids that are null or spelled twice, rows without dates and orphans."""
    day = f"timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id % 90 + {since} as int))"
    order = "case when id % 3 = 0 then concat(' o', id div 3) when id = 100 then null else concat('o', id div 3) end"
    return {
        "orders": texts(
            spark, 400, batch, day, order_id="if(id = 7, null, concat('o', id % 350))", customer_id="concat('c', id % 60)",
            order_status=f"if(id % 5 = {since}, 'canceled', 'delivered')", order_purchase_timestamp=f"if(id % 41 = 0, '', cast({day} as string))",
            order_approved_at="''", order_delivered_carrier_date="null", order_delivered_customer_date=f"if(id % 2 = 0, cast({day} as string), null)",
            order_estimated_delivery_date="'2020-02-01 00:00:00'",
        ),
        "order_items": texts(
            spark, 1200, batch, f"if(id % 11 = 0, null, {day})", order_id=order, order_item_id="id % 3 + 1", product_id="concat('p', id % 20)",
            seller_id="concat('s', id % 4)", shipping_limit_date=f"if(id % 37 = 0, '', cast({day} as string))", price=f"id + {since}.25", freight_value="1",
        ),
        "payments": texts(
            spark, 800, batch, day, order_id="concat('o', id div 2)", payment_sequential="id % 2", payment_type="'card'", payment_installments="1",
            payment_value=f"id + {since}.5",
        ),
        "customers": texts(spark, 50, batch, NO_DAY, customer_id="concat('c', id)", customer_unique_id="id", customer_zip_code_prefix="id", customer_city="'x'", customer_state="'y'"),
        "products": texts(spark, 18, batch, NO_DAY, product_id="concat('p', id)", product_category_name="id % 3", product_name_lenght="1", product_description_lenght="1",
            product_photos_qty="1", product_weight_g="1", product_length_cm="1", product_height_cm="1", product_width_cm="1"),
        "sellers": texts(spark, 3, batch, NO_DAY, seller_id="concat('s', id)", seller_zip_code_prefix="id", seller_city="'x'", seller_state="'y'"),
    }


def lookups(spark):
    return {
        "reviews": texts(spark, 2, "b0", NO_DAY, **{raw: "null" for raw in MODELS["reviews"].raw_columns}),
        "category_translation": texts(spark, 2, "b0", NO_DAY, product_category_name="id", product_category_name_english="concat('e', id)"),
        "geolocation": texts(spark, 9, "b0", NO_DAY, geolocation_zip_code_prefix="id", geolocation_lat="1", geolocation_lng="2", geolocation_city="'x'", geolocation_state="'y'"),
    }


def built(spark, root):
    """A lake after a full build and an increment that changes orders, items and payments of all kinds."""
    lake, now = Lake(spark, str(root)), dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
    with lake.transaction() as tx:
        for name, rows in (raws(spark, "b0") | lookups(spark)).items():
            tx.append(raw_load.raw_table(name), rows)
    warehouse.build_full(lake)
    with lake.transaction() as tx:
        for name, rows in raws(spark, "b1", 2).items():
            tx.append(raw_load.raw_table(name), rows.sample(False, 0.3, 5) if name in warehouse.BY_ORDER else rows)
            raw_load.append_history(tx, [("b1", name, "source", raw_load.NO_FILE_HASH, None, "SUCCESS", now)])
    warehouse.build_increment(lake, repair_unknown=True)
    return lake


def values(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def bucketed(monkeypatch):
    monkeypatch.setattr(warehouse, "ROWS_PER_BUCKET", 100)


@pytest.fixture
def large(spark):
    """As if no table were small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_builds_in_buckets_give_the_same_tables(spark, tmp_path, monkeypatch):
    plain = built(spark, tmp_path / "plain")
    monkeypatch.setattr(warehouse, "ROWS_PER_BUCKET", 100)
    lake = built(spark, tmp_path / "buckets")
    states = lake.state()[1]
    of_orders = [staged_table(n) for n in warehouse.BY_ORDER] + [model_table(n) for n in warehouse.FACT_DAY]
    assert {t for t, s in states.items() if s.buckets} == set(of_orders)
    assert {states[t].buckets for t in of_orders} == {12}
    for table in states:
        if table.startswith(("staging", "warehouse", "analytics")):
            assert values(lake.read(table)) == values(plain.read(table)) != [], table
    # Rows without a day have a folder, and one who opens the lake anew reads the same.
    assert any(value is not None and not value.isdigit() for _, value in states[staged_table("order_items")].folders)
    again = Lake(spark, str(tmp_path / "buckets"))
    assert values(again.read(model_table("fact_order_items"))) == values(lake.read(model_table("fact_order_items")))
    # A task has rows of one bucket: a folder holds a file of a bucket for each time it was written, no more.
    files = [p for p in (tmp_path / "buckets" / model_table("fact_order_items")).rglob("*.parquet")]
    one = {(p.parent, re.search(r"_(\d{5})\.c", p.name)[1]) for p in files}
    assert len(one) == len(files) > 12


def test_model_tests_over_buckets_find_the_same(spark, tmp_path, monkeypatch):
    got = []
    for folder, rows in (("plain", warehouse.ROWS_PER_BUCKET), ("buckets", 100)):
        monkeypatch.setattr(warehouse, "ROWS_PER_BUCKET", rows)
        lake = Lake(spark, str(tmp_path / folder))
        with lake.transaction() as tx:
            for name, raw in (raws(spark, "b0") | lookups(spark)).items():
                tx.append(raw_load.raw_table(name), raw)
        with pytest.raises(QualityGateError):
            warehouse.build_full(lake, tests=declared_tests(), run_id="r")
        got.append((values(warehouse.test_results(lake, "r")), values(warehouse.test_failures(lake, "r"))))
        assert lake.tables() == [raw_load.raw_table(n) for n in sorted(STAGED)]
    assert got[0] == got[1]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_rows_in_buckets_are_shuffled_for_their_ranking_only(spark, lake, bucketed, large):
    rows = raws(spark, "b0")
    buckets = warehouse.order_buckets([rows[n] for n in warehouse.BY_ORDER])
    assert buckets == 12
    items = stage("order_items", rows["order_items"], buckets=buckets)
    assert exchanges(items) == 1
    with lake.transaction() as tx:
        for name in warehouse.BY_ORDER:
            tx.overwrite(staged_table(name), stage(name, rows[name], buckets=buckets), **warehouse.staged_layout(name, 0, buckets))
        items, orders, payments = (tx.read(staged_table(n)) for n in ("order_items", "orders", "payments"))
        fresh = rows["order_items"].filter("source_updated_at is null")
        mark = warehouse._literal(items, None)
        assert exchanges(current_rows("order_items", rows["order_items"], fresh, mark, buckets)) == 2  # RAW rows and the fresh keys
        ids = rows["orders"].filter("order_status = 'canceled'").select("order_id")
        assert exchanges(staged_rows_of_orders(items, ids, buckets)) == 1  # the ids
        grain = ["order_id", "order_item_id"]
        assert exchanges(items.join(items.filter("price > 3").select(*grain).hint("merge"), grain, "left_anti")) == 0
        totals = warehouse.facts.with_order_totals(orders, items, payments, dealt=True)
        assert exchanges(totals) == 0 and totals.count() == orders.count()
    assert {name: spark.conf.get(name) for name in WITHIN} != WITHIN


def test_rows_that_are_not_dealt_are_dealt_for_the_write(spark, lake):
    rows = spark.range(4000).selectExpr("concat('o', id) as order_id", "cast(id % 3 as int) as month")
    layout = {"partition": "layout_month", "by": "month", "bucket": "order_id", "buckets": 4}
    with lake.transaction() as tx:
        tx.overwrite("t", rows, **layout)
        tx.upsert("t", spark.createDataFrame([("o1", 7), ("new", None)], rows.schema), ["order_id"])
    files = lake.files.matches("t/*/*/part-*.parquet")
    assert len(files) == 12 + 4 + 2  # months by buckets, the month of o1 again, and the changes
    assert values(lake.read("t")) == values(rows.filter("order_id <> 'o1'").unionByName(spark.createDataFrame([("o1", 7), ("new", None)], rows.schema)))
    found = lake.read("t", layout=True)
    assert found.filter("layout_month is null").count() == 1 and found.filter("layout_month = 7").count() == 1


def test_few_rows_or_a_hot_order_are_not_cut_into_buckets(spark, bucketed, monkeypatch):
    even = texts(spark, 1000, "b0", NO_DAY, order_id="id")
    hot = texts(spark, 1000, "b0", NO_DAY, order_id="if(id < 400, if(id < 200, null, ' '), cast(id as string))")
    assert warehouse.order_buckets([even, even.limit(10)]) == 10
    assert warehouse.order_buckets([even, hot]) == 0
    monkeypatch.setattr(warehouse, "ROWS_PER_BUCKET", 1000)
    assert warehouse.order_buckets([even]) == 0
