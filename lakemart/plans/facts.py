"""Fact builders.

Items and payments are never joined to each other: each is summed per order first. Foreign
keys are resolved where the rows are fewest (customers on orders, not on items).

``seen`` arguments hold the ids of a staged table before ranking (``staging.cleaned_ids``).
They are only needed where the staged table is not written yet but computed in the same plan:
large lookups then search them for missing ids and hot keys, instead of ranking twice.

``dealt`` says that staged rows come in the same buckets of ``order_id`` on all sides. They are then merged
bucket by bucket, which needs no exchange, and the fact comes in these buckets too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import (
    DURATION,
    MONEY,
    ORDER_MONEY,
    date_key,
    elapsed,
    late_flag,
    newest,
    stable_key,
    total,
)
from lakemart.operators.lookups import lookup_join, lookup_key
from lakemart.plans.staging import UPDATED


def _order_side(
    orders: DataFrame, customer_ids: DataFrame, seen: DataFrame | None = None
) -> DataFrame:
    """What a child row needs of its order: customer key, purchase day and change time."""
    slim = orders.select(
        "order_id",
        "customer_id",
        date_key("order_purchase_timestamp").alias("_purchase_key"),
        F.col(UPDATED).alias("_order_updated_at"),
    )
    keyed = lookup_key(slim, customer_ids, "customer_id", "customer_key", seen=seen)
    return keyed.drop("customer_id")


def join_order(child: DataFrame, orders: DataFrame, seen: DataFrame | None = None, dealt: bool = False) -> DataFrame:
    """Inner join of item or payment rows to their order; orphans drop out."""
    if dealt:
        return child.join(orders.hint("merge"), "order_id")
    return lookup_join(child, orders, "order_id", "inner", seen=seen)


def derived_columns(fact: str, round_scale: int | None = None) -> dict[str, Column]:
    """Columns of a fact that follow from its other ones, which an exchange of its rows can leave out."""
    if fact == "fact_order_items":
        return {
            "order_item_key": stable_key("order_id", "order_item_id"),
            "quantity": F.lit(1).cast("int"),
            "total_item_value": (F.col("item_price") + F.col("freight_value")).cast(MONEY),
        }
    if fact == "fact_payments":
        return {"payment_key": stable_key("order_id", "payment_sequential")}
    return {
        "order_key": stable_key("order_id"),
        "purchase_date_key": date_key("order_purchase_timestamp"),
        "approved_date_key": date_key("order_approved_at"),
        "delivered_date_key": date_key("order_delivered_customer_date"),
        "estimated_delivery_date_key": date_key("order_estimated_delivery_date"),
        **dict(zip([name for name, *_ in DURATIONS], duration_columns(round_scale), strict=True)),
        "is_delivered_late": late_flag("order_delivered_customer_date", "order_estimated_delivery_date"),
        "is_cancelled": F.col("order_status") == "canceled",
    }


def fact_order_items(
    items: DataFrame,
    orders: DataFrame,
    customer_ids: DataFrame,
    product_ids: DataFrame,
    seller_ids: DataFrame,
    seen_items: DataFrame | None = None,
    seen_orders: DataFrame | None = None,
    dealt: bool = False,
) -> DataFrame:
    rows = lookup_key(items, product_ids, "product_id", "product_key", seen=seen_items)
    rows = lookup_key(rows, seller_ids, "seller_id", "seller_key", seen=seen_items)
    rows = join_order(rows, _order_side(orders, customer_ids, seen_orders), seen_items, dealt)
    return rows.select(
        stable_key("order_id", "order_item_id").alias("order_item_key"),
        "order_id",
        "order_item_id",
        "customer_key",
        "product_key",
        "seller_key",
        F.col("_purchase_key").alias("order_date_key"),
        date_key("shipping_limit_date").alias("shipping_date_key"),
        F.lit(1).cast("int").alias("quantity"),
        F.col("price").alias("item_price"),
        "freight_value",
        (F.col("price") + F.col("freight_value")).cast(MONEY).alias("total_item_value"),
        newest(UPDATED, "_order_updated_at").alias(UPDATED),
    )


def fact_payments(
    payments: DataFrame,
    orders: DataFrame,
    customer_ids: DataFrame,
    seen_payments: DataFrame | None = None,
    seen_orders: DataFrame | None = None,
    dealt: bool = False,
) -> DataFrame:
    rows = join_order(payments, _order_side(orders, customer_ids, seen_orders), seen_payments, dealt)
    return rows.select(
        stable_key("order_id", "payment_sequential").alias("payment_key"),
        "order_id",
        "payment_sequential",
        "customer_key",
        F.col("_purchase_key").alias("payment_date_key"),
        "payment_type",
        F.col("payment_installments").alias("installment_count"),
        "payment_value",
        newest(UPDATED, "_order_updated_at").alias(UPDATED),
    )


def item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).cast("int").alias("item_count"),
        total("price", ORDER_MONEY).alias("merchandise_value"),
        total("freight_value", ORDER_MONEY).alias("freight_value"),
        F.max(UPDATED).alias("_items_updated_at"),
    )


def payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        total("payment_value", ORDER_MONEY).alias("payment_value"),
        F.max(UPDATED).alias("_payments_updated_at"),
    )


def with_order_totals(orders: DataFrame, items: DataFrame, payments: DataFrame, dealt: bool = False) -> DataFrame:
    """Orders with item and payment totals, 0 where an order has none.

    All three sides are unique and hash-partitioned on ``order_id``, so the joins add no
    exchange of their own and no order can fan out.
    """
    joined = orders
    for totals in (item_totals(items), payment_totals(payments)):
        joined = joined.join(totals.hint("merge") if dealt else totals, "order_id", "left")
    zero = F.lit(0).cast(ORDER_MONEY)
    return joined.withColumns(
        {
            "item_count": F.coalesce("item_count", F.lit(0)),
            "merchandise_value": F.coalesce("merchandise_value", zero),
            "freight_value": F.coalesce("freight_value", zero),
            "payment_value": F.coalesce("payment_value", zero),
        }
    )


# (name, start, end, seconds per unit)
DURATIONS = (
    ("approval_duration_minutes", "order_purchase_timestamp", "order_approved_at", 60),
    ("delivery_duration_hours", "order_purchase_timestamp", "order_delivered_customer_date", 3600),
    ("delivery_delay_days", "order_estimated_delivery_date", "order_delivered_customer_date", 86400),
)


def duration_columns(round_scale: int | None = None) -> list[Column]:
    """Approval minutes, delivery hours and delay days; ``round_scale`` rounds them."""
    kind = DURATION if round_scale is None else f"decimal(14,{round_scale})"
    return [elapsed(start, end, unit, kind).alias(name) for name, start, end, unit in DURATIONS]


def fact_order_lifecycle(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    customer_ids: DataFrame,
    round_scale: int | None = None,
    seen_orders: DataFrame | None = None,
    dealt: bool = False,
) -> DataFrame:
    rows = lookup_key(orders, customer_ids, "customer_id", "customer_key", seen=seen_orders)
    rows = with_order_totals(rows, items, payments, dealt)
    return rows.select(
        stable_key("order_id").alias("order_key"),
        "order_id",
        "customer_key",
        date_key("order_purchase_timestamp").alias("purchase_date_key"),
        date_key("order_approved_at").alias("approved_date_key"),
        date_key("order_delivered_customer_date").alias("delivered_date_key"),
        date_key("order_estimated_delivery_date").alias("estimated_delivery_date_key"),
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "item_count",
        "merchandise_value",
        "freight_value",
        "payment_value",
        *duration_columns(round_scale),
        late_flag("order_delivered_customer_date", "order_estimated_delivery_date").alias(
            "is_delivered_late"
        ),
        (F.col("order_status") == "canceled").alias("is_cancelled"),
        newest(UPDATED, "_items_updated_at", "_payments_updated_at").alias(UPDATED),
    )

