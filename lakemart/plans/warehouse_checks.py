"""Business checks over the built star, stored as audit rows with a failure rate."""

from __future__ import annotations

import datetime as dt
import uuid
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import UNKNOWN_KEY, literal, rate
from lakemart.operators.checks import union_all
from lakemart.operators.lookups import lookup_join

FAILURE_RATE = "decimal(12,6)"
UNKNOWN_LIMIT = Decimal("0.01")
SHIPPING_LIMIT = "interval 365 days"


def audit_row(
    test_name: str,
    table_name: str,
    dimension: str,
    severity: str,
    failed: str,
    total: str,
    message: str,
    passed: str | None = None,
) -> list[str]:
    """One result with its failure rate; an empty table has rate 0 and passes.

    ``failed``, ``total`` and ``passed`` are SQL expressions over the counts.
    """
    level = literal(severity)
    return [
        f"{literal(test_name)} as test_name",
        f"{literal(table_name)} as table_name",
        f"{literal(dimension)} as quality_dimension",
        f"{level} as severity",
        f"if({passed or f'{failed} = 0'}, 'PASS', {level}) as status",
        f"cast({failed} as bigint) as failed_rows",
        f"cast({total} as bigint) as total_rows",
        f"cast(coalesce({rate.sql(failed, total, FAILURE_RATE)}, 0) as {FAILURE_RATE}) as failure_rate",
        f"{literal(message)} as error_message",
    ]


def late_shipping_limit(
    items: DataFrame, orders: DataFrame, seen_items: DataFrame | None = None
) -> DataFrame:
    """Items whose shipping limit is over a year after the purchase (``seen``: see ``facts``)."""
    joined = _items_with_purchase(items, orders, seen_items)
    return joined.filter(_limit_too_late()).select(
        "order_id", "order_item_id", "shipping_limit_date", "order_purchase_timestamp"
    )


def _items_with_purchase(
    items: DataFrame, orders: DataFrame, seen_items: DataFrame | None
) -> DataFrame:
    slim_items = items.select("order_id", "order_item_id", "shipping_limit_date")
    slim_orders = orders.select("order_id", "order_purchase_timestamp")
    return lookup_join(slim_items, slim_orders, "order_id", "inner", seen=seen_items)


def _limit_too_late() -> Column:
    return F.col("shipping_limit_date") > F.col("order_purchase_timestamp") + F.expr(SHIPPING_LIMIT)


def delivered_before_purchase(lifecycle: DataFrame) -> DataFrame:
    return lifecycle.filter(
        F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp")
    ).select("order_id", "order_purchase_timestamp", "order_delivered_customer_date")


def has_unknown_key() -> Column:
    keys = ("customer_key", "product_key", "seller_key")
    conditions = [F.col(k) == UNKNOWN_KEY for k in keys]
    return conditions[0] | conditions[1] | conditions[2]


def unknown_rows(items: DataFrame) -> DataFrame:
    return items.agg(
        F.count_if(has_unknown_key()).alias("unknown_rows"), F.count(F.lit(1)).alias("total_rows")
    )


def unknown_rate_exceeded(items: DataFrame, limit: Decimal = UNKNOWN_LIMIT) -> DataFrame:
    """The counts if more than ``limit`` of the rows point to an unknown member, else no row."""
    return unknown_rows(items).filter(F.col("unknown_rows") > F.col("total_rows") * F.lit(limit))


def grain_duplicates(df: DataFrame, grain: list[str]) -> DataFrame:
    """Grain values that occur more than once."""
    return (
        df.groupBy(*grain)
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .filter("duplicate_count > 1")
    )


def grain_check(fact: DataFrame, table: str, grain: list[str]) -> DataFrame:
    groups = fact.groupBy(*grain).agg(F.count(F.lit(1)).alias("n"))
    counts = groups.agg(
        F.count_if(F.col("n") > 1).alias("failed"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")
    )
    return counts.selectExpr(
        *audit_row(
            f"{table}_grain_unique",
            table,
            "uniqueness",
            "ERROR",
            "failed",
            "total",
            "more than one row per " + " + ".join(grain),
        )
    )


def reconciliation(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """One row with both row counts."""
    sides = staged.select(F.lit(1).alias("s"), F.lit(0).alias("f")).unionAll(
        fact.select(F.lit(0).alias("s"), F.lit(1).alias("f"))
    )
    return sides.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("staging_rows"),
        F.coalesce(F.sum("f"), F.lit(0)).alias("fact_rows"),
    )


def reconciliation_mismatch(staged: DataFrame, fact: DataFrame) -> DataFrame:
    """Both counts if they differ, else no row."""
    return reconciliation(staged, fact).filter("staging_rows <> fact_rows")


def _numbers(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """``(metric, value)`` rows of a one-row frame."""
    cells = ", ".join(f"struct('{n}' as metric, cast({n} as bigint) as value)" for n in names)
    return df.selectExpr(f"inline(array({cells}))")


def _item_fact_numbers(fact_items: DataFrame) -> DataFrame:
    """Rows, duplicated grain values and rows with an unknown key, from one aggregation."""
    grain = fact_items.groupBy("order_id", "order_item_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(has_unknown_key()).alias("unknown")
    )
    counts = grain.selectExpr(
        "count_if(n > 1) as item_duplicates",
        "coalesce(sum(n), 0) as item_facts",
        "coalesce(sum(unknown), 0) as item_unknowns",
    )
    return _numbers(counts, ("item_duplicates", "item_facts", "item_unknowns"))


def _staged_item_numbers(
    items: DataFrame, orders: DataFrame, seen_items: DataFrame | None
) -> DataFrame:
    """Staged items, those with an order, and those shipped too late, from one join."""
    bought = orders.selectExpr("order_id", "order_purchase_timestamp", "true as has_order")
    limits = items.select("order_id", "shipping_limit_date")
    joined = lookup_join(limits, bought, "order_id", seen=seen_items)
    counts = joined.agg(
        F.count(F.lit(1)).alias("items"),
        F.count("has_order").alias("ordered_items"),
        F.count_if(_limit_too_late()).alias("late_limits"),
    )
    return _numbers(counts, ("items", "ordered_items", "late_limits"))


def run_checks(
    items: DataFrame,
    payments: DataFrame,
    orders: DataFrame,
    star: dict[str, DataFrame],
    seen_items: DataFrame | None = None,
) -> DataFrame:
    """All six checks. ``items``, ``payments`` and ``orders`` are the staged tables.

    Every table is read once; the checks are then formulas over the collected numbers.
    """
    lifecycle, fact_payments = star["fact_order_lifecycle"], star["fact_payments"]
    early = F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp")
    delivery = lifecycle.agg(F.count(F.lit(1)).alias("orders"), F.count_if(early).alias("early"))
    numbers = union_all(
        [
            _item_fact_numbers(star["fact_order_items"]),
            _staged_item_numbers(items, orders, seen_items),
            _numbers(payments.selectExpr("count(1) as payments"), ("payments",)),
            _numbers(fact_payments.selectExpr("count(1) as payment_facts"), ("payment_facts",)),
            _numbers(delivery, ("orders", "early")),
        ]
    )
    names = (
        "item_duplicates",
        "item_facts",
        "item_unknowns",
        "items",
        "ordered_items",
        "late_limits",
        "payments",
        "payment_facts",
        "orders",
        "early",
    )
    wide = numbers.selectExpr(
        *[f"max(value) filter (where metric = '{n}') as {n}" for n in names]
    )
    rows = [
        audit_row(
            "fact_order_items_grain_unique",
            "fact_order_items",
            "uniqueness",
            "ERROR",
            "item_duplicates",
            "item_facts",
            "more than one row per order_id + order_item_id",
        ),
        audit_row(
            "fact_order_items_row_reconciliation",
            "fact_order_items",
            "consistency",
            "ERROR",
            "abs(items - item_facts)",
            "items",
            "the fact must have one row per current staged row",
        ),
        audit_row(
            "fact_payments_row_reconciliation",
            "fact_payments",
            "consistency",
            "ERROR",
            "abs(payments - payment_facts)",
            "payments",
            "the fact must have one row per current staged row",
        ),
        audit_row(
            "order_delivery_after_purchase",
            "fact_order_lifecycle",
            "validity",
            "ERROR",
            "early",
            "orders",
            "delivered before it was purchased",
        ),
        audit_row(
            "unknown_dimension_rate",
            "fact_order_items",
            "integrity",
            "WARN",
            "item_unknowns",
            "item_facts",
            "over 1% of the rows have an unknown customer, product or seller",
            passed=f"item_unknowns <= item_facts * {UNKNOWN_LIMIT}",
        ),
        audit_row(
            "shipping_limit_reasonable",
            "stg_order_items",
            "validity",
            "WARN",
            "late_limits",
            "ordered_items",
            "shipping limit over 365 days after the purchase",
        ),
    ]
    structs = ", ".join(f"struct({', '.join(row)})" for row in rows)
    return wide.selectExpr(f"inline(array({structs}))")


def stamp_run(
    results: DataFrame, executed_at: dt.datetime | None = None, run_id: str | None = None
) -> DataFrame:
    """Add the run id and time: one driver value for the whole run."""
    executed_at = executed_at or dt.datetime.now(dt.timezone.utc)
    return results.select(
        F.lit(run_id or str(uuid.uuid4())).alias("test_run_id"),
        *results.columns,
        F.lit(executed_at).alias("executed_at"),
    )


def latest_run(history: DataFrame) -> DataFrame:
    """Rows of the newest run, failures first. The newest run is one value, not a sort."""
    newest = history.agg(
        F.max_by("test_run_id", F.struct("executed_at", "test_run_id")).alias("test_run_id")
    )
    return (
        history.join(F.broadcast(newest), "test_run_id", "left_semi")
        .select(
            "test_name",
            "table_name",
            "quality_dimension",
            "status",
            "failed_rows",
            "total_rows",
            "executed_at",
        )
        .orderBy(F.desc("status"), "test_name")
    )
