"""Building the star and the marts from RAW, in full or from the rows that changed.

Staging of the current state is written once per build and read by every model after it. That
saves re-ranking the RAW history for each of them, and puts plain scans under the joins, whose
sizes Catalyst knows and whose skewed partitions it can split.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import UNKNOWN_KEY, identifier
from lakemart.operators.checks import gate, union_all
from lakemart.operators.lookups import HOT_SHARE, hot_keys
from lakemart.operators.model_tests import FAILURE_COLUMNS, ModelTest, failures, observed, outcome
from lakemart.operators.upserts import high_watermark, time_literal
from lakemart.plans import dims, facts, marts
from lakemart.plans.model_suite import tested_models
from lakemart.plans.staging import MODELS, STAGED, UPDATED, stage, staged_keys
from lakemart.plans.warehouse_checks import latest_run, run_checks, stamp_run
from lakemart.sources.contract import INCREMENTAL_DATASETS
from lakemart.sources.folders import bucket_count, folder_count, folder_of
from lakemart.sources.lake import Lake, Transaction
from lakemart.sources.raw_load import LOAD_HISTORY, raw_table

QUALITY_RESULTS = "audit.data_quality_results"
# Plain folders beside the tables, so that they outlive a build that is not published.
TEST_FAILURES, TEST_RESULTS = "audit/test_failures", "audit/test_results"
RESULT_COLUMNS = "test_name string, model string, kind string, severity string, status string, failed_rows bigint"
# Ids of the RAW batches that the models already hold.
BUILT_BATCHES = "audit.built_batches"
MONTH, BUCKET = "layout_month", "layout_bucket"
# Most folders of a table that is cut by a hash of its key, so that a listing stays short.
MOST_BUCKETS = 4096

# Key columns of the incremental models (fixed by their grain).
MODEL_KEYS = {
    "dim_customer": ("customer_key",),
    "dim_product": ("product_key",),
    "dim_seller": ("seller_key",),
    "fact_order_items": ("order_id", "order_item_id"),
    "fact_payments": ("order_id", "payment_sequential"),
    "fact_order_lifecycle": ("order_id",),
}
# Facts are laid out by purchase month: increments touch few months, and scans skip the rest.
FACT_DAY = {
    "fact_order_items": "order_date_key",
    "fact_payments": "payment_date_key",
    "fact_order_lifecycle": "purchase_date_key",
}
FACT_INPUT = {
    "fact_order_items": ("order_items", "orders"),
    "fact_payments": ("payments", "orders"),
    "fact_order_lifecycle": ("orders", "order_items", "payments"),
}
DIM_INPUT = {
    "dim_customer": ("customers", "geolocation"),
    "dim_product": ("products", "category_translation"),
    "dim_seller": ("sellers", "geolocation"),
}
DIM_BUILDERS = {
    "dim_customer": dims.dim_customer,
    "dim_product": dims.dim_product,
    "dim_seller": dims.dim_seller,
}


def model_table(name: str) -> str:
    return f"warehouse.{name}"


def staged_table(name: str) -> str:
    return f"staging.{name}"


def mart_table(name: str) -> str:
    return f"analytics.{name}"


# Tables with a business day are laid out by its month: a delta touches few, recent months, and
# scans can skip the rest. The others are cut by a hash of their key, so that a small delta
# rewrites a part of them only.
STAGED_DAY = {"orders": "order_purchase_timestamp", "order_items": "shipping_limit_date"}
# Staged rows of orders and the facts meet by order. Where they are many, their files are also cut into the
# same buckets of the order's id, so that rows are dealt once, for the ranking, and joins, sums, upserts
# and writes after it need no exchange.
BY_ORDER = ("orders", "order_items", "payments")
# Rows of a bucket, about: a task sorts one in memory, and cuts it into a file for each month.
ROWS_PER_BUCKET = 2_000_000


def order_buckets(raws: Sequence[DataFrame]) -> int:
    """Buckets for the RAW tables of orders: about ROWS_PER_BUCKET rows of the largest table in each.

    0, for tables as they are dealt without buckets, if that is one bucket, or if one order has so many
    rows that its bucket would stand out. Null and blank ids count as one order here.
    """
    most = max(raw.count() for raw in raws)
    if most <= ROWS_PER_BUCKET:
        return 0
    buckets = bucket_count(most, ROWS_PER_BUCKET)
    for raw in raws:
        ids = raw.select(F.coalesce(identifier("order_id"), F.lit("")).alias("order_id"))
        if hot_keys(ids, "order_id", max(HOT_SHARE, 0.25 / buckets)):
            return 0
    return buckets


def model_layout(name: str, rows: int = 0, buckets: int = 0) -> dict[str, str | int]:
    """Layout of a model of about ``rows`` rows; a table keeps the layout it was made with."""
    if name in FACT_DAY:
        return {"partition": MONTH, "by": f"cast({FACT_DAY[name]} div 100 as int)"} | _buckets_by_order(buckets)
    return _bucket_layout(MODEL_KEYS[name], rows)


def staged_layout(name: str, rows: int = 0, buckets: int = 0) -> dict[str, str | int]:
    if name in STAGED_DAY:
        day = STAGED_DAY[name]
        return {"partition": MONTH, "by": f"cast(year({day}) * 100 + month({day}) as int)"} | _buckets_by_order(buckets)
    if name in BY_ORDER and buckets:
        # Without a day, the folders are the buckets: ``hash`` is what Spark deals rows by.
        return {"partition": BUCKET, "by": f"cast(pmod(hash(order_id), {buckets}) as int)"} | _buckets_by_order(buckets)
    keys = MODELS[name].keys if name in MODELS else ()
    return _bucket_layout(keys, rows) if keys else {}


def _buckets_by_order(buckets: int) -> dict[str, str | int]:
    return {"bucket": "order_id", "buckets": buckets} if buckets else {}


def _bucket_layout(keys: Sequence[str], rows: int) -> dict[str, str]:
    """Folders of about ROWS_PER_FOLDER rows each, whatever the size of the table."""
    return {"partition": BUCKET, "by": folder_of(keys, min(MOST_BUCKETS, folder_count(rows)))}


def _side_by_side(jobs: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Submit independent writes from driver threads, so small ones do not wait for large ones."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: future.result() for name, future in running.items()}


# ---- model tests -----------------------------------------------------------------------


class Watch:
    """Counts the failures of row tests while models are written."""

    def __init__(self, tests: Sequence[ModelTest] = ()):
        self.tests = tests
        self._seen: list = []

    def __call__(self, model: str, df: DataFrame) -> DataFrame:
        df, seen = observed(df, model, self.tests)
        if seen:
            self._seen.append(seen)
        return df

    def counts(self) -> dict[str, int]:
        """Failures by test, of the models written through this watch."""
        return {name: n for seen in self._seen for name, n in seen.get.items()}


def model_frames(tx: Lake | Transaction, models: Sequence[str]) -> dict[str, DataFrame]:
    def table(name: str) -> str:
        kind = name.split("_", 1)[0]
        return staged_table(name.removeprefix("stg_")) if kind == "stg" else mart_table(name) if kind == "mart" else model_table(name)

    return {name: tx.read(table(name)) for name in models}


def run_model_tests(
    tx: Lake | Transaction, tests: Sequence[ModelTest], counted: dict[str, int] | None = None, run_id: str | None = None,
    shown: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Store all failing rows, one folder for each test, and one result row for each test.

    Returns the stored results. ``counted``: see ``operators.model_tests.failures``.
    """
    lake = tx if isinstance(tx, Lake) else tx.lake
    run_id = run_id or str(uuid.uuid4())
    failed = failures(model_frames(tx, tested_models(tests)), tests, counted, shown)
    stamped = failed.withColumn("test_run_id", F.lit(run_id))
    stamped.write.mode("append").partitionBy("test_run_id", "test_name").parquet(f"{lake.root}/{TEST_FAILURES}")
    results = outcome(lake.spark, test_failures(lake, run_id), tests)
    results.withColumn("test_run_id", F.lit(run_id)).coalesce(1).write.mode("append").partitionBy("test_run_id").parquet(
        f"{lake.root}/{TEST_RESULTS}"
    )
    return test_results(lake, run_id)


def _of_run(lake: Lake, folder: str, columns: str, run_id: str) -> DataFrame:
    stored = lake.spark.read.schema(f"{columns}, test_run_id string").parquet(f"{lake.root}/{folder}")
    return stored.filter(F.col("test_run_id") == run_id).drop("test_run_id")


def test_failures(lake: Lake, run_id: str) -> DataFrame:
    """(test_name, failed_rows, failure) of one run; a test's rows are one folder."""
    return _of_run(lake, TEST_FAILURES, FAILURE_COLUMNS, run_id)


def test_results(lake: Lake, run_id: str) -> DataFrame:
    return _of_run(lake, TEST_RESULTS, RESULT_COLUMNS, run_id)


# ---- full refresh ----------------------------------------------------------------------


def stage_into(
    tx: Transaction, names: Sequence[str] = STAGED, watch: Watch | None = None, buckets: int = 0
) -> dict[str, DataFrame]:
    watch = watch or Watch()

    def write(name: str) -> DataFrame:
        raw = tx.read(raw_table(name))
        staged = watch(f"stg_{name}", stage(name, raw, buckets=buckets if name in BY_ORDER else 0))
        # Parquet footers tell the number of RAW rows, which is at least that of staged ones.
        return tx.overwrite(staged_table(name), staged, **staged_layout(name, raw.count(), buckets))

    return _side_by_side({name: partial(write, name) for name in names})


def build_full(lake: Lake, round_scale: int | None = None, tests: Sequence[ModelTest] = (), run_id: str | None = None) -> int:
    """Rebuild staging, dimensions, facts and marts; published in one commit.

    With ``tests``, they run before the commit, and an ERROR raises, so nothing is published; the
    failing rows and the results are stored all the same. Rows are counted while they are written,
    so only models with a failing row are read again for tests of rows.
    """
    with lake.transaction() as tx:
        watch = Watch(tests)
        buckets = order_buckets([tx.read(raw_table(name)) for name in BY_ORDER])
        staged = stage_into(tx, watch=watch, buckets=buckets)
        dealt = buckets > 0

        def write_dim(name: str) -> DataFrame:
            main, extra = (staged[n] for n in DIM_INPUT[name])
            dim = watch(name, DIM_BUILDERS[name](main, extra))
            return tx.overwrite(model_table(name), dim, **model_layout(name, main.count()))

        _side_by_side({name: partial(write_dim, name) for name in DIM_BUILDERS})
        ids = dimension_ids(tx)
        items, payments, orders = (staged[n] for n in ("order_items", "payments", "orders"))
        built = {
            "fact_order_items": facts.fact_order_items(
                items, orders, ids["customer_id"], ids["product_id"], ids["seller_id"], dealt=dealt
            ),
            "fact_payments": facts.fact_payments(payments, orders, ids["customer_id"], dealt=dealt),
            "fact_order_lifecycle": facts.fact_order_lifecycle(
                orders, items, payments, ids["customer_id"], round_scale, dealt=dealt
            ),
        }
        _side_by_side(
            {
                name: partial(
                    tx.overwrite, model_table(name), watch(name, df), **model_layout(name, buckets=buckets), late=facts.derived_columns(name, round_scale)
                )
                for name, df in built.items()
            }
        )
        build_marts(tx, watch)
        if tx.has(LOAD_HISTORY):
            tx.overwrite(BUILT_BATCHES, tx.read(LOAD_HISTORY).select("batch_id").distinct().coalesce(1))
        if tests:
            gate(run_model_tests(tx, tests, watch.counts(), run_id))
    return lake.state()[0]


def dimension_ids(tx: Transaction) -> dict[str, DataFrame]:
    """Natural ids of the three dimensions, without their unknown member."""
    ids = {}
    for name, key, natural in (
        ("dim_customer", "customer_key", "customer_id"),
        ("dim_product", "product_key", "product_id"),
        ("dim_seller", "seller_key", "seller_id"),
    ):
        dim = tx.read(model_table(name))
        ids[natural] = dim.filter(F.col(key) != UNKNOWN_KEY).select(natural)
    return ids


def build_marts(tx: Transaction, watch: Watch | None = None) -> None:
    """The calendar and the five marts are always rebuilt."""
    watch = watch or Watch()
    orders, items = tx.read(staged_table("orders")), tx.read(staged_table("order_items"))
    dates = tx.overwrite(model_table("dim_date"), watch("dim_date", dims.dim_date(orders, items)).coalesce(1))
    lifecycle = tx.read(model_table("fact_order_lifecycle"))
    fact_items = tx.read(model_table("fact_order_items"))
    products = tx.read(model_table("dim_product"))
    customers = tx.read(model_table("dim_customer"))
    built = {
        "mart_executive_kpis": marts.mart_executive_kpis(lifecycle),
        "mart_sales_daily": marts.mart_sales_daily(lifecycle, dates),
        "mart_category_performance": marts.mart_category_performance(fact_items, products),
        "mart_state_performance": marts.mart_state_performance(lifecycle, customers),
        "mart_order_status": marts.mart_order_status(lifecycle),
    }
    _side_by_side(
        {name: partial(tx.overwrite, mart_table(name), watch(name, df)) for name, df in built.items()}
    )


# ---- increments ------------------------------------------------------------------------


def _literal(df: DataFrame, lookback: dt.timedelta | None) -> Column:
    """The watermark as a literal, so that scans can skip row groups by it."""
    value = high_watermark(df, UPDATED).first()[0]
    return time_literal(value - lookback if lookback else value, df.schema[UPDATED].dataType)


def fresh_rows(raw: DataFrame, watermark: Column) -> DataFrame:
    """RAW rows newer than the watermark, of any version.

    Written as plain comparisons per column, which Parquet can skip row groups by.
    """
    timed = F.col("source_updated_at") > watermark
    untimed = F.col("source_updated_at").isNull() & (F.col("loaded_at") > watermark)
    return raw.filter(timed | untimed)


def changed_rows(dataset: str, raw: DataFrame, watermark: Column) -> DataFrame:
    """Staged current rows newer than the watermark, without ranking the RAW history.

    A fresh row with a source time outranks every older version of its key, so ranking the
    fresh rows is enough. A fresh row without one (a file reload) ranks below any version that
    has one, so only for those the older keys are looked at.
    """
    model = MODELS[dataset]
    fresh = fresh_rows(raw, watermark)
    timed = stage(dataset, fresh.filter(F.col("source_updated_at").isNotNull()))
    untimed = fresh.filter(F.col("source_updated_at").isNull())
    if not model.keys:
        return stage(dataset, fresh)
    if untimed.isEmpty():
        return timed
    outranking = staged_keys(dataset, raw.filter(F.col("source_updated_at").isNotNull()))
    reloaded = stage(dataset, untimed).join(outranking, list(model.keys), "left_anti")
    return timed.unionByName(reloaded)


def rows_of_orders(rows: DataFrame, order_ids: DataFrame) -> DataFrame:
    """The RAW rows that belong to the given orders."""
    tagged = rows.withColumn("_order", identifier("order_id"))
    wanted = order_ids.select(F.col("order_id").alias("_order"))
    return tagged.join(wanted, "_order", "left_semi").drop("_order")


def staged_rows_of_orders(rows: DataFrame, order_ids: DataFrame, buckets: int = 0) -> DataFrame:
    """The staged rows that belong to the given orders.

    Staged ids are clean, so the rows meet on ``order_id`` itself, and the joins and sums by order
    that follow need no exchange of their own. Where ``rows`` lie in ``buckets``, only the ids are dealt.
    """
    ids = order_ids.select("order_id")
    # Spark leaves the exchange out where the ids are dealt already.
    ids = ids.repartition(buckets, "order_id").hint("merge") if buckets else ids
    return rows.join(ids, "order_id", "left_semi").select(*rows.columns)


def fresh_order_ids(raws: Sequence[DataFrame], watermark: Column) -> DataFrame:
    """Ids of the orders with a fresh row in any of the RAW tables.

    The change time of a fact row is the later of two or three tables, which no scan can
    filter on. So changed orders are found per table first, and then all tables are cut to
    them before they are joined.
    """
    return order_ids_of([fresh_rows(raw, watermark) for raw in raws])


def order_ids_of(raws: Sequence[DataFrame], buckets: int = 0) -> DataFrame:
    order_id = identifier("order_id").alias("order_id")
    ids = union_all([raw.select(order_id) for raw in raws])
    return (ids.repartition(buckets, "order_id") if buckets else ids).distinct()


def unbuilt_batches(tx: Transaction) -> list[str]:
    """Ids of the loaded batches that no build has read yet: one for each load since then.

    What is new is decided by batch and not by change time, so a row that arrives after younger
    rows of its own or of another table is not missed.
    """
    if not tx.has(LOAD_HISTORY):
        return []
    loaded = tx.read(LOAD_HISTORY).select("batch_id").distinct()
    if tx.has(BUILT_BATCHES):
        loaded = loaded.join(tx.read(BUILT_BATCHES), "batch_id", "left_anti")
    return sorted(row["batch_id"] for row in loaded.collect())


def current_rows(dataset: str, raw: DataFrame, fresh: DataFrame, watermark: Column, buckets: int = 0) -> DataFrame:
    """Staged current rows of all keys with a fresh RAW row, whenever that row was changed.

    Fresh rows younger than everything staged (``watermark``) outrank all older versions, so
    ranking them alone is enough. As soon as one is not, or has no source time, all versions of
    the fresh keys are ranked. Keys that are not fresh drop out after the ranking: each task sends one
    version of a key at most, and the fresh keys are dealt as the ranked rows are, so that RAW rows
    are shuffled once. ``buckets``: see ``stage``.
    """
    model = MODELS[dataset]
    late = F.col("source_updated_at").isNull() | (F.col("source_updated_at") <= watermark)
    if not model.keys or fresh.filter(late).isEmpty():
        return stage(dataset, fresh, buckets=buckets)
    wanted = staged_keys(dataset, fresh, buckets)
    return stage(dataset, raw, of=wanted.hint("merge") if buckets else wanted, buckets=buckets)


def item_delta(
    items: DataFrame,
    orders: DataFrame,
    watermark: Column,
    customer_ids: DataFrame,
    product_ids: DataFrame,
    seller_ids: DataFrame,
) -> DataFrame:
    """Item fact rows whose item or order changed, from staged rows of the changed orders."""
    rows = facts.fact_order_items(items, orders, customer_ids, product_ids, seller_ids)
    return rows.filter(F.col(UPDATED) > watermark)


def payment_delta(
    payments: DataFrame, orders: DataFrame, watermark: Column, customer_ids: DataFrame
) -> DataFrame:
    rows = facts.fact_payments(payments, orders, customer_ids)
    return rows.filter(F.col(UPDATED) > watermark)


def lifecycle_delta(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    watermark: Column,
    customer_ids: DataFrame,
    round_scale: int | None = None,
) -> DataFrame:
    rows = facts.fact_order_lifecycle(orders, items, payments, customer_ids, round_scale)
    return rows.filter(F.col(UPDATED) > watermark)


def unresolved(fact: DataFrame, keys: Sequence[str] = ("customer_key",)) -> DataFrame:
    """Orders of fact rows that still point to an unknown member."""
    condition = F.lit(False)
    for key in keys:
        condition = condition | (F.col(key) == UNKNOWN_KEY)
    return fact.filter(condition).select("order_id").distinct()


def build_increment(
    lake: Lake,
    lookback: dt.timedelta | None = None,
    propagate_lookups: bool = False,
    repair_unknown: bool = False,
    round_scale: int | None = None,
    tests: Sequence[ModelTest] = (),
    run_id: str | None = None,
) -> int:
    """Upsert what the RAW batches loaded since the last build changed; one commit.

    ``tests`` run over the whole models before the commit, as in ``build_full``; only models that
    are written whole are not read again for tests of rows.

    ``lookback`` also takes rows up to that much older than the youngest staged row, for RAW
    rows that were appended without a batch of their own. ``propagate_lookups`` also rebuilds
    dimension rows whose geolocation or label changed. ``repair_unknown`` re-keys fact rows
    whose dimension member arrived after them. Upserts are idempotent, so none can add rows.
    """
    with lake.transaction() as tx:
        batches = unbuilt_batches(tx)
        raw = {name: tx.read(raw_table(name)) for name in STAGED}
        # Taken before staging is updated, so that dimensions and facts see the same fresh rows.
        marks = {name: _literal(tx.read(staged_table(name)), None) for name in INCREMENTAL_DATASETS}
        fresh = {}
        for name, mark in marks.items():
            unbuilt = F.col("batch_id").isin(batches)
            if lookback:
                since = mark - F.lit(lookback)
                unbuilt = unbuilt | (F.col("source_updated_at") > since) | (
                    F.col("source_updated_at").isNull() & (F.col("loaded_at") > since)
                )
            fresh[name] = raw[name].filter(unbuilt)
        watch = Watch(tests)
        extras = stage_into(tx, ("geolocation", "category_translation"), watch)

        def upsert_staged(name: str) -> DataFrame:
            changes = current_rows(name, raw[name], fresh[name], marks[name], tx.buckets(staged_table(name)))
            keys = MODELS[name].keys
            return tx.upsert(staged_table(name), changes, keys, **staged_layout(name))

        changed = _side_by_side({n: partial(upsert_staged, n) for n in INCREMENTAL_DATASETS})

        def upsert_dim(name: str) -> DataFrame:
            main, extra = DIM_INPUT[name]
            builder = DIM_BUILDERS[name]
            held = tx.read(model_table(name))
            lacks_unknown = held.filter(F.col(MODEL_KEYS[name][0]) == UNKNOWN_KEY).isEmpty()
            if propagate_lookups:
                delta = builder(tx.read(staged_table(main)), extras[extra], unknown=lacks_unknown)
                delta = delta.subtract(held)
            else:
                delta = builder(changed[main], extras[extra], unknown=lacks_unknown)
            return tx.upsert(model_table(name), delta, MODEL_KEYS[name], **model_layout(name))

        _side_by_side({name: partial(upsert_dim, name) for name in DIM_BUILDERS})
        ids = dimension_ids(tx)
        customers, products, sellers = (ids[n] for n in ("customer_id", "product_id", "seller_id"))

        def upsert_fact(name: str) -> DataFrame:
            inputs = FACT_INPUT[name]
            buckets = {n: tx.buckets(staged_table(n)) for n in inputs}
            touched = order_ids_of([fresh[n] for n in inputs], min(buckets.values()))
            staged = {n: staged_rows_of_orders(tx.read(staged_table(n)), touched, buckets[n]) for n in inputs}
            dealt = min(buckets.values()) > 0
            items, orders, payments = (
                staged.get(n) for n in ("order_items", "orders", "payments")
            )
            if name == "fact_order_items":
                delta = facts.fact_order_items(items, orders, customers, products, sellers, dealt=dealt)
            elif name == "fact_payments":
                delta = facts.fact_payments(payments, orders, customers, dealt=dealt)
            else:
                delta = facts.fact_order_lifecycle(orders, items, payments, customers, round_scale, dealt=dealt)
            return tx.upsert(model_table(name), delta, MODEL_KEYS[name], **model_layout(name), late=facts.derived_columns(name, round_scale))

        _side_by_side({name: partial(upsert_fact, name) for name in FACT_DAY})
        if repair_unknown:
            _repair(tx, ids, round_scale)
        build_marts(tx, watch)
        if batches:
            built = lake.spark.createDataFrame([(b,) for b in batches], "batch_id string")
            tx.append(BUILT_BATCHES, built)
        if tests:
            gate(run_model_tests(tx, tests, watch.counts(), run_id))
    return lake.state()[0]


def _repair(tx: Transaction, ids: dict[str, DataFrame], round_scale: int | None) -> None:
    """Recompute the fact rows of orders that hold an unknown key."""
    customers = ids["customer_id"]

    def pick(fact: str, keys: Sequence[str] = ("customer_key",)) -> dict[str, DataFrame]:
        open_orders = unresolved(tx.read(model_table(fact)), keys)
        return {
            name: staged_rows_of_orders(tx.read(staged_table(name)), open_orders, tx.buckets(staged_table(name)))
            for name in BY_ORDER
        }

    dealt = min(tx.buckets(staged_table(name)) for name in BY_ORDER) > 0
    rows = pick("fact_order_items", ("customer_key", "product_key", "seller_key"))
    fixed = {
        "fact_order_items": facts.fact_order_items(
            rows["order_items"], rows["orders"], customers, ids["product_id"], ids["seller_id"], dealt=dealt
        )
    }
    rows = pick("fact_payments")
    fixed["fact_payments"] = facts.fact_payments(rows["payments"], rows["orders"], customers, dealt=dealt)
    rows = pick("fact_order_lifecycle")
    fixed["fact_order_lifecycle"] = facts.fact_order_lifecycle(
        rows["orders"], rows["order_items"], rows["payments"], customers, round_scale, dealt=dealt
    )
    _side_by_side(
        {
            name: partial(
                tx.upsert, model_table(name), df, MODEL_KEYS[name], **model_layout(name)
            )
            for name, df in fixed.items()
        }
    )


# ---- checks ----------------------------------------------------------------------------


def validate(lake: Lake) -> DataFrame:
    """Run the business checks, append them to the audit table and return this run's rows."""
    star = {name: lake.read(model_table(name)) for name in FACT_DAY}
    staged = {n: lake.read(staged_table(n)) for n in ("order_items", "payments", "orders")}
    results = run_checks(staged["order_items"], staged["payments"], staged["orders"], star)
    with lake.transaction() as tx:
        return tx.append(QUALITY_RESULTS, stamp_run(results))


def validate_and_gate(lake: Lake) -> dict[str, int]:
    return gate(validate(lake))


def latest_results(lake: Lake) -> DataFrame:
    """Result rows of the newest validation run."""
    return latest_run(lake.read(QUALITY_RESULTS))
