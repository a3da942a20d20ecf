"""One query per operator, over whole test tables. Names match ``oracles.py``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart import functions as fn
from lakemart.bindings.context import Context
from lakemart.operators import checks, profiles
from lakemart.operators.checks import QualityGateError
from lakemart.operators.lookups import lookup_join, lookup_key
from lakemart.operators.upserts import changed_since, extract_delta, high_watermark, upsert
from lakemart.operators.versions import latest_version
from lakemart.plans import dashboard, dims, facts, marts, warehouse, warehouse_checks
from lakemart.plans.model_suite import declared_tests
from lakemart.plans.staging import UPDATED, stage
from lakemart.session import work_path
from lakemart.sources import csv_files, extracts, raw_load
from lakemart.sources.contract import COMMERCE_CONTRACT, INCREMENTAL_DATASETS, ForeignKey
from lakemart.sources.csv_files import na_to_null
from lakemart.sources.folders import FolderTable, bucket_count, folder_count, folder_of, write_bucketed

Query = Callable[[Context], DataFrame]
REGISTRY: dict[str, Query] = {}

CUT_OFF = dt.date(2000, 1, 1)
DELTA_MARK = "2001-01-01 00:00:00"


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _money(c: str):
    return F.col(c).cast("string").cast(fn.MONEY)


# ---- sources and scalar functions ----------------------------------------------------------


@query
def raw_stamp_batch(c: Context) -> DataFrame:
    orders = c.table("orders")
    text = orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderstatus").cast("string").alias("order_status"),
        "o_orderdate",
        "_metadata.file_name",
    )
    stamped = raw_load.stamp(
        text, "batch-1", _ntz("2024-02-01 06:00:00"), F.col("file_name"), F.col("o_orderdate")
    )
    return stamped.drop("o_orderdate", "file_name")


@query
def clean_blank_to_null(c: Context) -> DataFrame:
    return c.raw("products").select(
        fn.identifier("product_id").alias("product_id"),
        fn.blank_to_null("product_category_name").alias("category"),
        fn.is_blank("product_description_lenght").alias("description_is_blank"),
    )


@query
def cast_strict(c: Context) -> DataFrame:
    return c.raw("order_items").select(
        fn.strict_cast("order_id", "bigint").alias("order_number"),
        fn.strict_cast("order_item_id", "smallint").alias("item_number"),
        fn.strict_cast("shipping_limit_date", "timestamp_ntz").alias("shipping_limit"),
        fn.strict_cast("price", fn.MONEY).alias("price"),
        fn.strict_cast("freight_value", "double").alias("freight"),
    )


@query
def stable_key(c: Context) -> DataFrame:
    unless_cancelled = "case when order_status <> 'canceled' then customer_id end"
    return c.staged("orders").select(
        "order_id",
        fn.stable_key("order_id").alias("order_key"),
        fn.stable_key("order_id", "customer_id").alias("pair_key"),
        fn.stable_key(unless_cancelled).alias("nullable_key"),
    )


@query
def date_key(c: Context) -> DataFrame:
    return c.staged("orders").select(
        "order_id",
        fn.date_key("order_purchase_timestamp").alias("purchase_date_key"),
        fn.date_key("order_approved_at").alias("approved_date_key"),
        fn.date_key("order_delivered_customer_date").alias("delivered_date_key"),
    )


@query
def duration_metrics(c: Context) -> DataFrame:
    return c.staged("orders").select("order_id", *facts.duration_columns())


@query
def duration_metrics_rounded(c: Context) -> DataFrame:
    return c.staged("orders").select("order_id", *facts.duration_columns(round_scale=2))


@query
def late_flag(c: Context) -> DataFrame:
    flag = fn.late_flag("order_delivered_customer_date", "order_estimated_delivery_date")
    return c.staged("orders").select("order_id", flag.alias("is_delivered_late"))


@query
def record_updated_at_greatest(c: Context) -> DataFrame:
    items = c.staged("order_items").select("order_id", "order_item_id", UPDATED)
    orders = c.staged("orders").select("order_id", F.col(UPDATED).alias("order_updated_at"))
    joined = facts.join_order(items, orders, c.seen("order_items"))
    newest = fn.newest(UPDATED, "order_updated_at").alias(UPDATED)
    return joined.select("order_id", "order_item_id", newest)


@query
def safe_ratio(c: Context) -> DataFrame:
    day = F.to_date("order_purchase_timestamp").alias("purchase_day")
    cancelled, delivered = (f"count_if(order_status = '{s}')" for s in ("canceled", "delivered"))
    return c.staged("orders").groupBy(day).agg(fn.rate(cancelled, delivered).alias("ratio"))


# ---- joins -----------------------------------------------------------------------------------


@query
def join_items_orders(c: Context) -> DataFrame:
    orders = c.staged("orders").select("order_id", "customer_id", "order_status")
    items = c.staged("order_items").select("order_id", "order_item_id", "product_id", "price")
    return facts.join_order(items, orders, c.seen("order_items"))


@query
def fk_lookup_unknown(c: Context) -> DataFrame:
    orders = c.staged("orders").select("order_id", "customer_id")
    seen = c.seen("orders")
    return lookup_key(orders, c.ids("customers"), "customer_id", "customer_key", seen=seen)


@query
def fk_lookup_late_dimensions(c: Context) -> DataFrame:
    """Items whose product or seller is not in its dimension yet: small parts and sellers in debt arrive later."""
    items = c.staged("order_items").select("order_id", "order_item_id", "product_id", "seller_id")
    products = c.staged("products").filter("product_length_cm > 10").select("product_id")
    sellers = c.table("supplier").filter("s_acctbal >= 0").select(F.col("s_suppkey").cast("string").alias("seller_id"))
    keyed = lookup_key(items, products, "product_id", "product_key", seen=c.seen("order_items"))
    return lookup_key(keyed, sellers, "seller_id", "seller_key", seen=c.seen("order_items"))


@query
def enrich_geo(c: Context) -> DataFrame:
    points = c.staged("geolocation").select(
        F.col("geolocation_zip_code_prefix").alias("customer_zip_code_prefix"), "latitude", "city"
    )
    customers = c.staged("customers").select("customer_id", "customer_zip_code_prefix")
    return lookup_join(customers, points, "customer_zip_code_prefix")


@query
def translate_category(c: Context) -> DataFrame:
    return c.dim("product").select("product_id", "category_name", "category_name_english")


@query
def join_preaggregated(c: Context) -> DataFrame:
    orders = c.staged("orders").select("order_id")
    joined = facts.with_order_totals(orders, c.staged("order_items"), c.staged("payments"))
    return joined.select(
        "order_id", "item_count", "merchandise_value", "freight_value", "payment_value"
    )


@query
def role_playing_dates(c: Context) -> DataFrame:
    c.keep("orders", "order_items")
    lifecycle = c.fact("order_lifecycle").select(
        "order_id", "purchase_date_key", "approved_date_key", "delivered_date_key"
    )
    days = c.dim("date").select("date_key", "day_name", "week_of_year")
    roles = {role: f"{role}_date_key" for role in ("purchase", "approved", "delivered")}
    return dims.role_playing(lifecycle, days, roles)


@query
def fk_anti_join(c: Context) -> DataFrame:
    orders, customers = c.raw("orders"), c.raw("customers")
    missing = checks.missing_parents(orders, "customer_id", customers, "customer_id")
    return missing.select(F.col("key").alias("customer_id"), F.col("n").alias("order_count"))


@query
def join_residual_interval(c: Context) -> DataFrame:
    items, seen = c.staged("order_items"), c.seen("order_items")
    return warehouse_checks.late_shipping_limit(items, c.staged("orders"), seen)


# ---- aggregates and windows ------------------------------------------------------------------


@query
def order_item_totals(c: Context) -> DataFrame:
    return facts.item_totals(c.staged("order_items")).withColumnRenamed(
        "_items_updated_at", UPDATED
    )


@query
def payment_totals(c: Context) -> DataFrame:
    return facts.payment_totals(c.staged("payments")).withColumnRenamed(
        "_payments_updated_at", UPDATED
    )


@query
def geo_representative(c: Context) -> DataFrame:
    return c.staged("geolocation")


@query
def filtered_counts(c: Context) -> DataFrame:
    return (
        c.fact("order_lifecycle")
        .groupBy("purchase_date_key")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if("is_delivered_late").alias("late_orders"),
            F.count_if("is_cancelled").alias("cancelled_orders"),
            F.count("order_delivered_customer_date").alias("delivered_orders"),
        )
    )


@query
def decimal_avg(c: Context) -> DataFrame:
    return c.staged("order_items").groupBy("order_id").agg(fn.mean_money("price").alias("average"))


@query
def latest_version_rows(c: Context) -> DataFrame:
    items = c.table("lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    others = [x for x in items.columns if x not in (*keys, "l_shipdate")]
    return latest_version(items, keys, ["l_shipdate"], others)


@query
def status_share(c: Context) -> DataFrame:
    counts = c.staged("orders").groupBy("order_status").agg(F.count(F.lit(1)).alias("order_count"))
    return marts.with_share(counts, "order_count", "order_share")


@query
def grain_duplicates(c: Context) -> DataFrame:
    return warehouse_checks.grain_duplicates(c.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def duplicate_rows_all(c: Context) -> DataFrame:
    counted = checks.duplicate_rows(c.table("lineitem"), ["l_orderkey", "l_linenumber"])
    return counted.select(
        F.col("failed").alias("rows_in_duplicate_groups"), F.col("total").alias("total_rows")
    )


@query
def duplicate_full_rows(c: Context) -> DataFrame:
    pairs = c.table("lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    return profiles.profile_table(pairs).select("row_count", "duplicate_rows")


@query
def source_dates_union(c: Context) -> DataFrame:
    dates = dims.source_dates(c.staged("orders"), c.staged("order_items"))
    return dates.groupBy("source_date").agg(F.count(F.lit(1)).alias("occurrences"))


@query
def date_bounds(c: Context) -> DataFrame:
    return dims.date_bounds(c.staged("orders"), c.staged("order_items"))


@query
def dim_with_unknown(c: Context) -> DataFrame:
    known = dims.dim_seller(c.staged("sellers"), c.staged("geolocation"), unknown=False)
    return dims.with_unknown("dim_seller", known).select("seller_key", "seller_id", "city", "state")


# ---- increments and upserts ------------------------------------------------------------------


def _order_versions(c: Context) -> tuple[DataFrame, DataFrame]:
    """Orders known before mid 1999 and a delta that changes some of them and adds others."""
    orders = c.table("orders").select(
        "o_orderkey", "o_orderstatus", _money("o_totalprice").alias("total_price"), "o_orderdate"
    )
    target = orders.filter(F.col("o_orderdate") < _ntz("1999-07-01 00:00:00"))
    delta = orders.filter(F.col("o_orderdate") >= _ntz("1999-01-01 00:00:00"))
    raised = (F.col("total_price") + 1).cast(fn.MONEY)
    return target, delta.withColumn("total_price", raised)


@query
def upsert_delete_insert(c: Context) -> DataFrame:
    target, delta = _order_versions(c)
    return upsert(target, delta, ["o_orderkey"])


@query
def idempotent_replay(c: Context) -> DataFrame:
    target, delta = _order_versions(c)
    once = upsert(target, delta, ["o_orderkey"])
    return upsert(once, delta, ["o_orderkey"])


@query
def schema_sync_upsert(c: Context) -> DataFrame:
    target, delta = _order_versions(c)
    widened = delta.drop("o_orderstatus").withColumn("order_year", F.year("o_orderdate"))
    return upsert(target, widened, ["o_orderkey"])


@query
def high_watermark_rows(c: Context) -> DataFrame:
    events = c.table("events")
    nothing = events.filter(F.col("event_type") == "no such type")
    current = high_watermark(events, "ts").select(F.lit("events").alias("dataset"), "watermark")
    initial = high_watermark(nothing, "ts").select(F.lit("empty").alias("dataset"), "watermark")
    return current.unionAll(initial)


@query
def incremental_extract(c: Context) -> DataFrame:
    previous, upper = _ntz("2024-01-10 00:00:00"), _ntz("2024-01-20 00:00:00")
    delta = extract_delta(c.table("events"), "ts", previous, upper)
    changed = delta.withColumnRenamed("ts", extracts.UPDATED_AT)
    return extracts.as_raw_text(changed, ["event_id", "user_id", "event_type"])


def _marks(c: Context) -> DataFrame:
    sources = {
        "orders": c.raw("orders").withColumnRenamed("source_updated_at", "updated_at"),
        "order_items": c.raw("order_items").withColumnRenamed("source_updated_at", "updated_at"),
        "payments": c.raw("payments").withColumnRenamed("source_updated_at", "updated_at"),
    }
    return extracts.high_marks(sources)


@query
def seed_watermarks(c: Context) -> DataFrame:
    return _marks(c)


@query
def watermark_upsert(c: Context) -> DataFrame:
    stored = _marks(c).withColumn("rows_extracted", F.lit(0).cast("bigint"))
    recent = c.table("events").filter(F.col("ts") > _ntz("2024-01-20 00:00:00"))
    moved = recent.agg(
        F.lit("payments").alias("dataset_name"),
        F.max("ts").alias("watermark_value"),
        F.count(F.lit(1)).alias("rows_extracted"),
    )
    return upsert(stored, moved, ["dataset_name"])


@query
def readiness_gate(c: Context) -> DataFrame:
    wanted = c.table("events").select(F.col("event_type").alias("dataset_name")).distinct()
    expensive = c.table("events").filter(F.col("event_type").rlike("^[cp]"))
    marks = expensive.groupBy(F.col("event_type").alias("dataset_name")).agg(
        F.max("ts").alias("watermark_value")
    )
    return extracts.without_watermark(marks, wanted)


@query
def changed_current_rows(c: Context) -> DataFrame:
    mark = _ntz(DELTA_MARK)
    return warehouse.changed_rows("order_items", c.raw("order_items"), mark)


def _changed(c: Context, mark, *names: str) -> list[DataFrame]:
    """Staged rows of the orders that changed in any of the named RAW tables."""
    ids = warehouse.fresh_order_ids([c.raw(name) for name in names], mark)
    return [stage(name, warehouse.rows_of_orders(c.raw(name), ids)) for name in names]


@query
def incremental_model_delta(c: Context) -> DataFrame:
    mark = _ntz(DELTA_MARK)
    items, orders = _changed(c, mark, "order_items", "orders")
    ids = (c.ids("customers"), c.ids("products"), c.ids("sellers"))
    return warehouse.item_delta(items, orders, mark, *ids)


@query
def incremental_lifecycle_delta(c: Context) -> DataFrame:
    mark = _ntz(DELTA_MARK)
    orders, items, payments = _changed(c, mark, "orders", "order_items", "payments")
    delta = warehouse.lifecycle_delta(orders, items, payments, mark, c.ids("customers"))
    return delta.drop("order_key")


@query
def incremental_payment_delta(c: Context) -> DataFrame:
    mark = _ntz("2024-01-20 00:00:00")
    payments, orders = _changed(c, mark, "payments", "orders")
    return warehouse.payment_delta(payments, orders, mark, c.ids("customers"))


BATCH_MARK = "timestamp_ntz'1999-01-01 00:00:00'"


def _incremented(c: Context) -> warehouse.Lake:
    """A lake built from the older rows, and then from a batch of the younger ones.

    The batches overlap: the second brings rows of the first again, and versions of orders and
    items that the first build holds in an older form.
    """
    old = {name: f"source_updated_at < {BATCH_MARK}" for name in ("orders", "order_items")}
    lake = c.lake(old | {"payments": "source_updated_at < timestamp_ntz'2024-01-20 00:00:00'"})
    warehouse.build_full(lake)
    now, batch = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc), "batch-1"
    with lake.transaction() as tx:
        for name in INCREMENTAL_DATASETS:
            since = "2024-01-15" if name == "payments" else "1998-07-01"
            late = c.raw(name).filter(f"source_updated_at >= timestamp_ntz'{since} 00:00:00'").withColumn("batch_id", F.lit(batch))
            tx.append(raw_load.raw_table(name), late)
            raw_load.append_history(tx, [(batch, name, "source", raw_load.NO_FILE_HASH, None, "SUCCESS", now)])
    warehouse.build_increment(lake)
    return lake


@query
def increment_order_items(c: Context) -> DataFrame:
    return _incremented(c).read(warehouse.model_table("fact_order_items"))


@query
def increment_order_lifecycle(c: Context) -> DataFrame:
    return _incremented(c).read(warehouse.model_table("fact_order_lifecycle"))


@query
def stored_upsert(c: Context) -> DataFrame:
    """Orders kept in folders by their key, then changed in place."""
    target, delta = _order_versions(c)
    keys = ["o_orderkey"]
    by = folder_of(keys, folder_count(target.count(), rows_per_folder=4096))
    table = FolderTable(c.spark, work_path(c.spark, "orders"), target.schema, keys, by)
    table.overwrite(target)
    table.upsert(delta)
    return table.read()


@query
def category_orders_bucketed(c: Context) -> DataFrame:
    """The category mart over facts bucketed by order: items are not shuffled again."""
    path = work_path(c.spark, "fact_order_items")
    # Parquet footers tell the number of line items, which is at least that of facts.
    buckets = bucket_count(c.table("lineitem").count())
    facts_of = write_bucketed(c.fact("order_items"), path.rsplit("/", 1)[-1].replace("-", "_"), path, "order_id", buckets)
    return marts.mart_category_performance(facts_of, c.dim("product"))


@query
def incremental_fact_upsert(c: Context) -> DataFrame:
    everything = c.fact("payments")
    mark = _ntz("2024-01-15 00:00:00")
    built = everything.filter(F.col(UPDATED) <= mark)
    delta = changed_since(everything, UPDATED, mark)
    return upsert(built, delta, warehouse.MODEL_KEYS["fact_payments"])


# ---- staging, dimensions, facts, marts -------------------------------------------------------


def _register(prefix: str, names: list[str], pick: Callable[[Context, str], DataFrame]) -> None:
    for name in names:
        REGISTRY[f"{prefix}_{name}"] = lambda c, n=name: pick(c, n)


_register(
    "stg",
    [
        "customers",
        "orders",
        "order_items",
        "payments",
        "reviews",
        "products",
        "sellers",
        "category_translation",
    ],
    lambda c, n: c.staged(n),
)
_register("dim", ["date", "customer", "product", "seller"], lambda c, n: c.dim(n))
_register("fact", ["order_items", "payments", "order_lifecycle"], lambda c, n: c.fact(n))
_register(
    "mart",
    [
        "executive_kpis",
        "sales_daily",
        "category_performance",
        "state_performance",
        "order_status",
    ],
    lambda c, n: c.mart(n),
)


@query
def mart_sales_daily(c: Context) -> DataFrame:
    c.keep("orders", "order_items")  # facts and calendar read both
    return c.mart("sales_daily")


# ---- dashboard -------------------------------------------------------------------------------


@query
def bi_kpi_cards(c: Context) -> DataFrame:
    return dashboard.kpi_cards(c.mart("executive_kpis"))


@query
def bi_daily_trend(c: Context) -> DataFrame:
    return dashboard.daily_trend(c.mart("sales_daily"))


@query
def bi_monthly_revenue(c: Context) -> DataFrame:
    return dashboard.monthly_revenue(c.mart("sales_daily"))


@query
def top_categories(c: Context) -> DataFrame:
    return dashboard.top_categories(c.mart("category_performance"))


@query
def bi_top_states_revenue(c: Context) -> DataFrame:
    return dashboard.revenue_by_state(c.mart("state_performance"))


@query
def bi_status_distribution(c: Context) -> DataFrame:
    return dashboard.status_distribution(c.mart("order_status"))


@query
def top_late_states(c: Context) -> DataFrame:
    return dashboard.top_late_states(c.mart("state_performance"))


@query
def bi_historical_cutoff(c: Context) -> DataFrame:
    return dashboard.historical(c.mart("sales_daily"), CUT_OFF)


@query
def bi_date_state_filters(c: Context) -> DataFrame:
    period = dashboard.in_period(c.mart("sales_daily"), dt.date(1998, 1, 1), dt.date(1998, 6, 30))
    days = period.agg(F.sum("order_count").alias("n")).select(F.lit("period").alias("filter"), "n")
    some = dashboard.in_states(c.mart("state_performance"), ["NATION_1", "NATION_2"])
    states = some.agg(F.sum("order_count").alias("n")).select(F.lit("states").alias("filter"), "n")
    return days.unionAll(states)


# ---- quality ---------------------------------------------------------------------------------


def _contract_frame(c: Context, name: str) -> DataFrame:
    columns = COMMERCE_CONTRACT.datasets[name].required_columns
    return na_to_null(c.raw(name).select(*columns))


def _checks_of(c: Context, name: str, pattern: str) -> DataFrame:
    spec = COMMERCE_CONTRACT.datasets[name]
    found = checks.check_rows(_contract_frame(c, name), name, spec)
    return found.filter(F.col("test_name").rlike(pattern)).drop("message")


def _checks_with(c: Context, field: str | None, pattern: str) -> DataFrame:
    """Row checks of all data sets whose contract has rules of a kind."""
    specs = COMMERCE_CONTRACT.datasets.items()
    return checks.union_all([_checks_of(c, name, pattern) for name, spec in specs if field is None or getattr(spec, field)])


@query
def dq_not_empty(c: Context) -> DataFrame:
    return _checks_with(c, None, "^file_not_empty$")


@query
def dq_required_columns(c: Context) -> DataFrame:
    """Columns that CSV files of all data sets have; those of payments lack one."""
    found = []
    for name, spec in COMMERCE_CONTRACT.datasets.items():
        path = work_path(c.spark, f"csv_{name}")
        rows = c.raw(name).select(*spec.required_columns)
        held = rows.drop("payment_installments") if name == "payments" else rows
        held.write.options(header=True, quote='"', escape='"').csv(path)
        read = csv_files.read_by_name(c.spark, csv_files.require_files(c.spark, path, "part-*"), spec.multi_line)
        found.append(checks.check_columns(read, name, spec)[0].drop("message"))
    return checks.union_all(found)


@query
def dq_not_null(c: Context) -> DataFrame:
    return _checks_with(c, "not_null", "_not_null$")


@query
def dq_unique(c: Context) -> DataFrame:
    keys = [(name, k) for name, spec in COMMERCE_CONTRACT.datasets.items() for k in spec.unique]
    return checks.union_all([checks.check_unique(_contract_frame(c, name), name, k) for name, k in keys]).drop("message")


@query
def dq_accepted_values(c: Context) -> DataFrame:
    return _checks_with(c, "accepted_values", "_accepted_values$")


@query
def dq_non_negative(c: Context) -> DataFrame:
    return _checks_with(c, "non_negative", "_non_negative$")


@query
def dq_range(c: Context) -> DataFrame:
    return _checks_with(c, "ranges", "_range$")


@query
def dq_foreign_key(c: Context) -> DataFrame:
    rules = COMMERCE_CONTRACT.foreign_keys
    found = [checks.check_foreign_key(c.raw(r.child_dataset), c.raw(r.parent_dataset), r) for r in rules]
    labelled = ForeignKey("documents_label_exists", "documents", "doc_id", "labels", "doc_id", "WARN")
    found.append(checks.check_foreign_key(c.table("documents"), c.table("labels"), labelled))
    return checks.union_all(found).drop("message")


# CSV files written from test tables: texts of documents have line breaks and quotes.
CSV_TABLES = {"documents": "documents", "order_items": "lineitem", "payments": "events"}


def _csv_files(c: Context, name: str) -> list[str]:
    path = work_path(c.spark, f"csv_{name}")
    quoted = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    c.table(CSV_TABLES[name]).write.options(**quoted).csv(path)
    return csv_files.require_files(c.spark, path, "part-*")


@query
def reconcile_files(c: Context) -> DataFrame:
    """Rows of CSV files, by their quotes and line breaks alone, against RAW rows read from them; payments lack some."""
    loaded = []
    for name, table in CSV_TABLES.items():
        paths, columns = _csv_files(c, name), c.table(table).columns
        counted = csv_files.quick_row_counts(c.spark, paths).agg(F.sum("n").alias("source_count"))
        rows = csv_files.read_by_position(c.spark, paths, columns, multi_line=True)
        if name == "payments":
            rows = rows.filter("event_type <> 'click'")
        target = rows.agg(F.count(F.lit(1)).alias("target_count"))
        both = counted.select(F.lit(name).alias("dataset"), "source_count", F.lit(None).cast("bigint").alias("target_count"))
        loaded += [both, target.select(F.lit(name).alias("dataset"), F.lit(None).cast("bigint").alias("source_count"), "target_count")]
    paired = checks.union_all(loaded).groupBy("dataset").agg(F.max("source_count").alias("source_count"), F.max("target_count").alias("target_count"))
    return paired.selectExpr("*", "if(source_count = target_count, 'PASS', 'ERROR') as status")


@query
def read_quoted_csv(c: Context) -> DataFrame:
    """Documents through CSV files, read split by split."""
    read = csv_files.read_by_name(c.spark, _csv_files(c, "documents"), multi_line=True, na_words=None)
    return read.select("doc_id", "text", "lang", "source", "n_chars")


def _contract_results(c: Context) -> DataFrame:
    frames = {name: _contract_frame(c, name) for name in COMMERCE_CONTRACT.datasets}
    return checks.run_contract(c.spark, frames, COMMERCE_CONTRACT)


@query
def dq_contract(c: Context) -> DataFrame:
    return _contract_results(c).drop("message")


@query
def check_summary(c: Context) -> DataFrame:
    return checks.summary(_contract_results(c))


@query
def quality_report(c: Context) -> DataFrame:
    """The report document written as JSON, read back, its results as rows beside its summary."""
    path = work_path(c.spark, "report")
    csv_files.write_report(checks.report_document(_contract_results(c), dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)), path)
    document = c.spark.read.json(path)
    return document.select("generated_at_utc", "summary.*", F.explode("results").alias("r")).select(
        "generated_at_utc", "total_checks", "passed", "warnings", "errors", "r.test_name", "r.dataset", "r.status", "r.failed_rows", "r.total_rows"
    )


@query
def test_not_null(c: Context) -> DataFrame:
    return checks.failing_not_null(c.staged("reviews"), "review_score").select("review_id")


@query
def test_unique(c: Context) -> DataFrame:
    return checks.failing_unique(c.table("lineitem"), ["l_partkey"])


@query
def test_relationships(c: Context) -> DataFrame:
    return checks.failing_relationships(
        c.staged("orders"), "customer_id", c.ids("customers"), "customer_id"
    )


@query
def test_accepted_values(c: Context) -> DataFrame:
    accepted = ("delivered", "shipped")
    return checks.failing_accepted_values(c.staged("orders"), "order_status", accepted)


def _suite(c: Context, results: bool) -> DataFrame:
    """A full build with all declared tests, which the test tables do not pass."""
    lake, run_id = c.lake(), "suite"
    try:
        warehouse.build_full(lake, tests=declared_tests(), run_id=run_id)
    except QualityGateError:
        pass  # nothing is published; results and failing rows are stored
    return (warehouse.test_results if results else warehouse.test_failures)(lake, run_id)


@query
def model_tests(c: Context) -> DataFrame:
    return _suite(c, results=True)


@query
def test_failures(c: Context) -> DataFrame:
    field = lambda name: F.get_json_object("failure", f"$.{name}")
    keys = [field(name) for name in ("from_field", "value_field", "unique_field", "order_id", "unknown_rows")]
    return _suite(c, results=False).select(
        "test_name", "failed_rows", F.coalesce(*keys).alias("failing_key"), field("n_records").cast("bigint").alias("n_records")
    )


@query
def unknown_rate_check(c: Context) -> DataFrame:
    return warehouse_checks.unknown_rate_exceeded(c.fact("order_items"))


@query
def check_delivery_after_purchase(c: Context) -> DataFrame:
    return warehouse_checks.delivered_before_purchase(c.fact("order_lifecycle"))


@query
def reconcile_items(c: Context) -> DataFrame:
    return warehouse_checks.reconciliation(c.staged("order_items"), c.fact("order_items"))


@query
def reconcile_payments(c: Context) -> DataFrame:
    return warehouse_checks.reconciliation(c.staged("payments"), c.fact("payments"))


@query
def reconcile_raw(c: Context) -> DataFrame:
    names = ("orders", "payments", "order_items")
    left = {"orders": c.table("orders"), "payments": c.table("events")}
    left["order_items"] = c.table("lineitem").filter("l_quantity < 50")
    return checks.reconcile_counts(left, {name: c.raw(name) for name in names})


def _warehouse_results(c: Context) -> DataFrame:
    star = {f"fact_{n}": c.fact(n) for n in ("order_items", "payments", "order_lifecycle")}
    return warehouse_checks.run_checks(
        c.staged("order_items"),
        c.staged("payments"),
        c.staged("orders"),
        star,
        c.seen("order_items"),
    )


@query
def warehouse_check_rows(c: Context) -> DataFrame:
    c.keep("orders", "order_items", "payments")
    return _warehouse_results(c).drop("error_message")


@query
def payment_grain_check(c: Context) -> DataFrame:
    grain = ["order_id", "payment_sequential"]
    return warehouse_checks.grain_check(c.staged("payments"), "stg_payments", grain).drop("error_message")


@query
def latest_run_results(c: Context) -> DataFrame:
    first = warehouse_checks.grain_check(c.raw("payments"), "payments", ["order_id"])
    second = warehouse_checks.grain_check(
        c.raw("order_items"), "order_items", ["order_id", "order_item_id"]
    ).unionByName(warehouse_checks.grain_check(c.raw("orders"), "orders", ["order_id"]))
    history = warehouse_checks.stamp_run(
        first, dt.datetime(2024, 1, 1, 8), "run-1"
    ).unionByName(warehouse_checks.stamp_run(second, dt.datetime(2024, 1, 2, 8), "run-2"))
    return warehouse_checks.latest_run(history).drop("executed_at")


# ---- profiles --------------------------------------------------------------------------------


@query
def profile_table(c: Context) -> DataFrame:
    return profiles.profile_table(c.table("lineitem"))


@query
def profile_columns(c: Context) -> DataFrame:
    return profiles.profile_columns(c.table("lineitem").drop("l_shipdate"))


@query
def profile_text_columns(c: Context) -> DataFrame:
    frame = _contract_frame(c, "products")
    return profiles.profile_columns(profiles.infer_types(frame))


@query
def profile_samples(c: Context) -> DataFrame:
    return profiles.sample_values(c.table("orders"), ["o_orderkey"])


@query
def profile_duplicates(c: Context) -> DataFrame:
    """Later copies of whole rows of a table in which many rows occur twice."""
    items = c.table("lineitem")
    return profiles.profile_table(items.unionByName(items.filter("l_linenumber = 1")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, sf_dir, build=build: build(Context(spark, sf_dir)))
        for name, build in REGISTRY.items()
    }
