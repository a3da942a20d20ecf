"""What an increment shuffles: RAW rows once for their ranking, and staged rows once for their order."""

import pytest

from lakemart.plans import facts
from lakemart.plans.staging import MODELS, UPDATED, stage
from lakemart.plans.warehouse import current_rows, staged_rows_of_orders
from lakemart.sources import lake as lakes

ITEMS = (
    "order_id string, order_item_id string, product_id string, seller_id string, shipping_limit_date string,"
    " price string, freight_value string, batch_id string, loaded_at timestamp_ntz, source_updated_at timestamp_ntz"
)


@pytest.fixture
def large(spark):
    """As if no table were small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def item(order, number, price, batch, day, spelled="{}"):
    return (spelled.format(order), str(number), "p", "s", "2020-01-01 00:00:00", price, "1", batch, "2024-01-01 00:00:00", day)


def raw_items(spark, rows):
    text = ITEMS.replace("timestamp_ntz", "string")
    typed = [f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in ITEMS.split(", ")]
    return spark.createDataFrame(rows, text).selectExpr(*typed)


def test_versions_of_fresh_keys_are_shuffled_once(spark, large):
    raw = raw_items(spark, [
        item("a", 1, "1", "b0", "2020-01-01"), item("a", 1, "2", "b1", "2019-01-01", " {} "),  # late, loses
        item("b", 1, "3", "b0", "2020-01-01"), item("b", 1, "4", "b1", "2020-01-01"),  # a tie, the later batch wins
        item("c", 1, "not a price", "b0", "2020-01-01"),  # not fresh, so never cast
        item("d", 1, "5", "b0", "2020-01-01"), item("d", 2, "6", "b1", None),
        (None, *item("e", 1, "7", "b1", "2020-01-01")[1:]),
    ])
    fresh = raw.filter("batch_id = 'b1'")
    mark = raw.selectExpr("max(source_updated_at) as m").first()["m"]
    got = current_rows("order_items", raw, fresh, mark)
    assert exchanges(got) == 2  # RAW rows for their ranking, and the fresh keys
    assert sorted((r["order_id"], r["order_item_id"], str(r["price"])) for r in got.collect()) == [
        ("a", 1, "1.00"), ("b", 1, "4.00"), ("d", 2, "6.00"),
    ]
    assert got.columns == [*MODELS["order_items"].columns, UPDATED]


def test_staged_rows_of_orders_meet_their_order_without_another_exchange(spark, large):
    raw = raw_items(spark, [item(o, n, "1", "b0", "2020-01-01") for o in "abc" for n in (1, 2)])
    items = stage("order_items", raw).localCheckpoint()
    touched = spark.createDataFrame([("a",), ("c",), (None,)], "order_id string").distinct()
    orders = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "order_id string, n int")
    rows = staged_rows_of_orders(items, touched)
    assert rows.columns == items.columns
    joined = orders.join(facts.item_totals(rows), "order_id")
    assert exchanges(joined) == 3  # items, the ids and orders: neither the sums nor the join add one
    assert sorted((r["order_id"], r["n"], r["item_count"]) for r in joined.collect()) == [("a", 1, 2), ("c", 3, 2)]


def test_tables_are_written_with_the_smaller_codec(spark, lake, tmp_path):
    with lake.transaction() as tx:
        tx.overwrite("t", spark.range(10).selectExpr("id", "id % 2 as p"), "layout", "cast(p as int)")
        tx.append("u", spark.range(10))
    files = [p.name for p in (tmp_path / "lake").rglob("*.parquet")]
    assert files and all(f".{lakes.CODEC}." in f for f in files)


def test_derived_columns_are_those_of_the_facts(spark, lake):
    """What is computed after the exchange equals what the fact builders state."""
    raw = raw_items(spark, [item(o, n, p, "b0", "2020-01-01") for o, p in (("a", "1.25"), ("b", None)) for n in (1, 2)])
    times = ["order_purchase_timestamp", "order_approved_at", "order_delivered_customer_date", "order_estimated_delivery_date"]
    orders = spark.createDataFrame(
        [("a", "c1", "canceled", "2020-01-01 01:02:03", None, "2020-03-01 00:00:07", "2020-02-01 00:00:00"), ("b", None, None, "2020-02-01 00:00:00", "2020-02-02 00:00:00", None, None)],
        ", ".join(f"{c} string" for c in ("order_id", "customer_id", "order_status", *times)),
    ).selectExpr("order_id", "customer_id", "order_status", *[f"cast({t} as timestamp_ntz) as {t}" for t in times], f"timestamp_ntz'2020-01-01 00:00:00' as {UPDATED}")
    payments = spark.createDataFrame([("a", 1, "x", 1, UPDATED)], f"order_id string, payment_sequential int, payment_type string, payment_installments int, {UPDATED} string").selectExpr(
        "order_id", "payment_sequential", "payment_type", "payment_installments", "cast(2.5 as decimal(12,2)) as payment_value", f"timestamp_ntz'2020-01-01 00:00:00' as {UPDATED}"
    )
    ids = {n: spark.createDataFrame([(v,)], f"{n}_id string") for n, v in (("customer", "c1"), ("product", "p"), ("seller", "q"))}
    items = stage("order_items", raw)
    built = {
        "fact_order_items": facts.fact_order_items(items, orders, ids["customer"], ids["product"], ids["seller"]),
        "fact_payments": facts.fact_payments(payments, orders, ids["customer"]),
        "fact_order_lifecycle": facts.fact_order_lifecycle(orders, items, payments, ids["customer"], 2),
    }
    for name, fact in built.items():
        with lake.transaction() as tx:
            written = tx.overwrite(name, fact, "layout", "cast(pmod(hash(order_id), 2) as int)", facts.derived_columns(name, 2))
        assert written.dtypes == fact.dtypes
        assert sorted(map(str, written.collect())) == sorted(map(str, fact.collect())) != []
