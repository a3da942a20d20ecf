"""Full refresh, increments and replay through every layer."""

import datetime as dt
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.plans import warehouse
from lakemart.plans.staging import register_views
from lakemart.plans.warehouse import MODEL_KEYS, mart_table, model_table, staged_table
from lakemart.sources import extracts
from lakemart.sources.lake import Lake
from lakemart.sources.raw_load import load_raw, raw_frames
from tests.conftest import FILES

UTC = dt.timezone.utc
FAR = dt.datetime(2100, 1, 1, tzinfo=UTC)


def rows(df, *drop):
    columns = sorted(c for c in df.columns if c not in drop)
    return sorted((tuple(map(str, r)) for r in df.select(*columns).collect()))


def source_rows(spark, lake, dataset, updated_at, **changes):
    """Source-side rows in the shape of the data set's contract, all columns as text."""
    columns = extracts.COMMERCE_CONTRACT.datasets[dataset].required_columns
    schema = ", ".join(f"{c} string" for c in columns) + ", updated_at timestamp"
    values = [tuple(changes.get(c) for c in columns) + (updated_at,)]
    return spark.createDataFrame(values, schema)


def changes_at(spark, lake, t):
    """One new customer and order with an item and a payment, a product and a customer touched."""
    day = t.strftime("%Y-%m-%d %H:%M:%S")
    new_customer = source_rows(
        spark, lake, "customers", t, customer_id="c9", customer_unique_id="u9",
        customer_zip_code_prefix="1002", customer_city="niteroi", customer_state="RJ",
    )
    touched = source_rows(
        spark, lake, "customers", t, customer_id="c1", customer_unique_id="u1",
        customer_zip_code_prefix="1001", customer_city="campinas", customer_state="SP",
    )
    return {
        "customers": new_customer.unionByName(touched),
        "products": source_rows(
            spark, lake, "products", t, product_id="p1", product_category_name="beleza",
            product_description_lenght="101",
        ),
        "sellers": source_rows(spark, lake, "sellers", t, seller_id="s1").limit(0),
        "orders": source_rows(
            spark, lake, "orders", t, order_id="o9", customer_id="c9", order_status="approved",
            order_purchase_timestamp=day, order_approved_at=day,
            order_estimated_delivery_date=day,
        ),
        "order_items": source_rows(
            spark, lake, "order_items", t, order_id="o9", order_item_id="1", product_id="p1",
            seller_id="s1", shipping_limit_date=day, price="42.40", freight_value="7.60",
        ),
        "payments": source_rows(
            spark, lake, "payments", t, order_id="o9", payment_sequential="1",
            payment_type="voucher", payment_installments="3", payment_value="50.00",
        ),
    }


@pytest.fixture(scope="module")
def template(spark, tmp_path_factory):
    """A lake after the first full refresh; its paths are relative, so tests work on copies."""
    folder = tmp_path_factory.mktemp("template")
    (folder / "csv").mkdir()
    for name, text in FILES.items():
        (folder / "csv" / name).write_text(text, encoding="utf-8")
    lake = Lake(spark, str(folder / "lake"))
    load_raw(lake, str(folder / "csv"))
    warehouse.build_full(lake)
    return folder / "lake"


@pytest.fixture
def built(spark, template, tmp_path):
    shutil.copytree(template, tmp_path / "copy")
    return Lake(spark, str(tmp_path / "copy"))


def test_full_build(spark, built):
    lifecycle = {r["order_id"]: r for r in built.read(model_table("fact_order_lifecycle")).collect()}
    o1 = lifecycle["o1"]
    assert (o1["item_count"], o1["payment_value"], o1["merchandise_value"]) == (2, Decimal("34.00"), Decimal("30.00"))
    assert o1["approval_duration_minutes"] == Decimal("30.000000")
    assert o1["delivery_delay_days"] == Decimal("1.416667")
    assert o1["is_delivered_late"] is True
    assert lifecycle["o3"]["customer_key"] == -1 and lifecycle["o3"]["is_cancelled"] is True
    kpis = built.read(mart_table("mart_executive_kpis")).first()
    assert (kpis["total_orders"], kpis["total_revenue"]) == (3, Decimal("40.00"))
    assert kpis["late_delivery_rate"] == Decimal("1.0000")
    customer = built.read(model_table("dim_customer")).filter("customer_id = 'c1'").first()
    assert customer["latitude"] == pytest.approx(-23.55)
    categories = {r["product_id"]: r["category_name_english"] for r in built.read(model_table("dim_product")).collect()}
    assert categories == {"p1": "beauty", "p2": "moveis", "p3": None, "UNKNOWN": "Unknown"}
    dates = built.read(model_table("dim_date"))
    assert dates.count() == (dt.date(2019, 6, 1) - dt.date(2018, 1, 5)).days + 1


def test_checks_are_stored(spark, built):
    results = {r["test_name"]: r["status"] for r in warehouse.validate(built).collect()}
    assert results == {
        "fact_order_items_grain_unique": "PASS",
        "fact_order_items_row_reconciliation": "PASS",
        "fact_payments_row_reconciliation": "PASS",
        "order_delivery_after_purchase": "PASS",
        "unknown_dimension_rate": "PASS",
        "shipping_limit_reasonable": "WARN",
    }
    assert warehouse.validate_and_gate(built)["warnings"] == 1
    history = built.read(warehouse.QUALITY_RESULTS)
    assert history.count() == 12
    latest = warehouse.latest_results(built).collect()
    assert len(latest) == 6 and latest[0]["status"] == "WARN"


def test_increment_trace_and_replay(spark, built):
    t = dt.datetime.now(UTC) + dt.timedelta(minutes=5)
    sources = changes_at(spark, built, t)
    with pytest.raises(RuntimeError, match="no watermark"):
        extracts.require_watermarks(built)
    results = extracts.ingest_all(built, sources, upper=t + dt.timedelta(minutes=1))
    assert {r["dataset"]: r["rows_extracted"] for r in results} == {
        "customers": 2,
        "products": 1,
        "sellers": 0,
        "orders": 1,
        "order_items": 1,
        "payments": 1,
    }
    assert extracts.require_watermarks(built) == 6
    assert built.read("raw.order_items").filter("order_id = 'o9'").first()["price"] == "42.40"
    counts = {m: built.read(model_table(m)).count() for m in MODEL_KEYS}
    warehouse.build_increment(built)
    grown = {m: built.read(model_table(m)).count() for m in MODEL_KEYS}
    assert {m: grown[m] - counts[m] for m in MODEL_KEYS} == {
        "dim_customer": 1,
        "dim_product": 0,
        "dim_seller": 0,
        "fact_order_items": 1,
        "fact_payments": 1,
        "fact_order_lifecycle": 1,
    }
    product = built.read(model_table("dim_product")).filter("product_id = 'p1'").first()
    assert product["product_description_length"] == 101
    assert warehouse.validate_and_gate(built)["errors"] == 0

    # replay: nothing new at the source
    again = extracts.ingest_all(built, sources, upper=t + dt.timedelta(minutes=2))
    assert {r["rows_extracted"] for r in again} == {0}
    before = {m: rows(built.read(model_table(m))) for m in MODEL_KEYS}
    warehouse.build_increment(built)
    assert {m: rows(built.read(model_table(m))) for m in MODEL_KEYS} == before


def test_increments_equal_a_full_build(spark, built):
    t = dt.datetime.now(UTC) + dt.timedelta(minutes=5)
    extracts.ingest_all(built, changes_at(spark, built, t), upper=t)
    warehouse.build_increment(built)
    later = t + dt.timedelta(minutes=5)
    update = source_rows(
        spark, built, "orders", later, order_id="o2", customer_id="c2", order_status="Delivered",
        order_purchase_timestamp="2018-02-01 08:00:00", order_approved_at="2018-02-01 09:00:00",
        order_delivered_customer_date="2018-02-10 08:00:00",
        order_estimated_delivery_date="2018-02-20 00:00:00",
    )
    extracts.ingest(built, "orders", update, upper=later)
    warehouse.build_increment(built, repair_unknown=True)
    tables = [*map(model_table, MODEL_KEYS), *map(staged_table, ("orders", "order_items", "payments"))]
    tables += [mart_table("mart_executive_kpis"), mart_table("mart_state_performance")]
    step_by_step = {name: rows(built.read(name)) for name in tables}
    warehouse.build_full(built)
    assert {name: rows(built.read(name)) for name in tables} == step_by_step


def test_a_lost_unknown_member_comes_back(spark, built):
    table = model_table("dim_seller")
    with built.transaction() as tx:
        tx.overwrite(table, built.read(table).filter("seller_key <> -1"))
    warehouse.build_increment(built)
    assert built.read(table).filter("seller_key = -1").count() == 1


def test_rows_that_arrive_late_are_built(spark, built):
    """A payment changed before, and loaded after, the youngest order; a customer below a late point."""
    t = dt.datetime.now(UTC) + dt.timedelta(days=10)
    early = t - dt.timedelta(days=5)
    sources = changes_at(spark, built, t)
    extracts.ingest(built, "orders", sources["orders"], upper=t)
    warehouse.build_increment(built)
    late = changes_at(spark, built, early)
    for name in ("payments", "customers", "order_items"):
        extracts.ingest(built, name, late[name], upper=t)
    # an older version of an order that staging holds must not come back
    older = source_rows(spark, built, "orders", early, order_id="o9", order_status="created", customer_id="c9")
    extracts.ingest(built, "orders", older, upper=t, lookback=dt.timedelta(days=20))
    warehouse.build_increment(built, repair_unknown=True)
    order = built.read(model_table("fact_order_lifecycle")).filter("order_id = 'o9'").first()
    assert (order["payment_value"], order["item_count"], order["order_status"]) == (Decimal("50.00"), 1, "approved")
    tables = [*map(model_table, MODEL_KEYS), *map(staged_table, ("orders", "order_items", "payments", "customers"))]
    step_by_step = {name: rows(built.read(name)) for name in tables}
    warehouse.build_full(built)
    assert {name: rows(built.read(name)) for name in tables} == step_by_step


def test_late_dimension_is_repaired_on_request(spark, built):
    t = dt.datetime.now(UTC) + dt.timedelta(minutes=5)
    extracts.ingest(built, "customers", changes_at(spark, built, t)["customers"], upper=t)

    def key_of(order):
        fact = built.read(model_table("fact_order_lifecycle"))
        return fact.filter(F.col("order_id") == order).first()["customer_key"]

    warehouse.build_increment(built)
    assert key_of("o3") == -1
    warehouse.build_increment(built, repair_unknown=True)
    assert key_of("o3") != -1


def test_changed_lookups_reach_the_dimension_on_request(spark, built):
    point = built.read("raw.geolocation").limit(1).withColumns(
        {
            "geolocation_zip_code_prefix": F.lit("1002"),
            "geolocation_lat": F.lit("-20.0"),
            "loaded_at": F.lit(dt.datetime.now(UTC) + dt.timedelta(hours=1)),
        }
    )
    with built.transaction() as tx:
        tx.append("raw.geolocation", point)

    def latitude():
        dim = built.read(model_table("dim_customer"))
        return dim.filter("customer_id = 'c2'").first()["latitude"]

    warehouse.build_increment(built)
    assert latitude() == pytest.approx(-22.9)
    warehouse.build_increment(built, propagate_lookups=True)
    assert latitude() == pytest.approx(-21.45)


def test_failed_extract_leaves_nothing(spark, built):
    t = dt.datetime.now(UTC)
    source = changes_at(spark, built, t)["orders"]
    broken = source.withColumn("order_status", F.expr("cast(raise_error('lost') as string)"))
    version = built.state()[0]
    with pytest.raises(Exception, match="lost"):
        extracts.ingest(built, "orders", broken, upper=t)
    assert built.state()[0] == version
    assert extracts.ingest(built, "orders", source, upper=t)["rows_extracted"] == 1
    with pytest.raises(ValueError, match="no incremental extract"):
        extracts.ingest(built, "reviews", source)


def test_watermarks(spark, built):
    t = dt.datetime(2024, 1, 1, 12, tzinfo=UTC)
    sources = changes_at(spark, built, t)
    sources.pop("sellers")
    extracts.seed_watermarks(built, sources)
    marks = extracts.watermarks(built).collect()
    assert [m["dataset_name"] for m in marks] == ["customers", "order_items", "orders", "payments", "products"]
    assert extracts.ingest(built, "orders", sources["orders"], upper=FAR)["rows_extracted"] == 0
    late = extracts.ingest(
        built, "orders", sources["orders"], upper=FAR, lookback=dt.timedelta(days=40000)
    )
    assert late["rows_extracted"] == 1


def test_file_reload_does_not_outrank_source_rows(spark, built):
    t = dt.datetime.now(UTC) - dt.timedelta(minutes=1)
    known = source_rows(spark, built, "sellers", t, seller_id="s1", seller_city="from source")
    extracts.ingest(built, "sellers", known, upper=t)
    raw = raw_frames(built)["sellers"]
    mark = F.lit(dt.datetime(2000, 1, 1, tzinfo=UTC))
    changed = {r["seller_id"]: r["seller_city"] for r in warehouse.changed_rows("sellers", raw, mark).collect()}
    assert changed == {"s1": "from source", "s2": "santos"}
    between = F.lit(t + dt.timedelta(seconds=1))
    reloaded = raw.withColumn(
        "loaded_at", F.when(F.col("source_updated_at").isNull(), F.lit(FAR)).otherwise(F.col("loaded_at"))
    )
    changed = {r["seller_id"] for r in warehouse.changed_rows("sellers", reloaded, between).collect()}
    assert changed == {"s2"}


def test_views(spark, built):
    staged = {"orders": built.read(staged_table("orders"))}
    assert register_views(staged) == ["stg_orders"]
    assert spark.sql("select count(*) from stg_orders").first()[0] == 3
