"""Presentation marts. Facts are aggregated on the join key before they meet a dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import MART_MONEY, mean_money, quotient, rate, total
from lakemart.operators.lookups import lookup_join

NO_LABEL = "Unknown"


def _count() -> Column:
    return F.count(F.lit(1))


def mart_executive_kpis(lifecycle: DataFrame) -> DataFrame:
    """Headline figures, one row."""
    return lifecycle.agg(
        _count().alias("total_orders"),
        total("payment_value").alias("total_revenue"),
        mean_money("payment_value").alias("average_order_value"),
        F.count_if(F.col("order_status") == "delivered").alias("delivered_orders"),
        F.count_if("is_cancelled").alias("cancelled_orders"),
        rate("count_if(is_cancelled)", "count(1)").alias("cancellation_rate"),
        rate("count_if(is_delivered_late)", "count(order_delivered_customer_date)").alias(
            "late_delivery_rate"
        ),
    ).select(F.lit("all_time").alias("metric_scope"), "*")


def mart_sales_daily(lifecycle: DataFrame, dates: DataFrame) -> DataFrame:
    """Per purchase day that has orders."""
    per_day = lifecycle.groupBy(F.col("purchase_date_key").alias("date_key")).agg(
        _count().alias("order_count"),
        total("payment_value").alias("revenue"),
        mean_money("payment_value").alias("average_order_value"),
        total("merchandise_value").alias("merchandise_value"),
        total("freight_value").alias("freight_value"),
        F.count_if("is_delivered_late").alias("late_order_count"),
        F.count_if("is_cancelled").alias("cancelled_order_count"),
    )
    days = dates.select(
        "date_key",
        "full_date",
        "day_name",
        "month_number",
        "month_name",
        "quarter_number",
        "year_number",
        "is_weekend",
    )
    # Both sides hold at most one row per calendar day.
    measures = [c for c in per_day.columns if c != "date_key"]
    return per_day.join(F.broadcast(days), "date_key").select(*days.columns, *measures)


def mart_category_performance(
    items: DataFrame, products: DataFrame, seen_keys: DataFrame | None = None
) -> DataFrame:
    """Per English category. Orders are counted once per category.

    Grouping by (category, order) first gives the distinct orders and spreads a hot category
    over all tasks; the second step adds up one row per category and task. ``seen_keys`` holds
    the product keys of an item fact that is computed in the same plan (see ``facts``).
    """
    labels = products.select(
        "product_key", F.coalesce("category_name_english", F.lit(NO_LABEL)).alias("category_name")
    )
    per_order = (
        lookup_join(items, labels, "product_key", "inner", seen=seen_keys)
        .groupBy("category_name", "order_id")
        .agg(
            F.sum("quantity").alias("items"),
            F.sum("item_price").alias("price"),
            F.count("item_price").alias("priced"),
            F.sum("freight_value").alias("freight"),
            F.sum("total_item_value").alias("gross"),
        )
    )
    return per_order.groupBy("category_name").agg(
        F.count("order_id").alias("order_count"),
        F.sum("items").alias("item_count"),
        total("price").alias("merchandise_revenue"),
        total("freight").alias("freight_value"),
        total("gross").alias("gross_item_value"),
        quotient("sum(price)", "sum(priced)", MART_MONEY).alias("average_item_price"),
    )


def mart_state_performance(lifecycle: DataFrame, customers: DataFrame) -> DataFrame:
    """Per customer state. Summing per customer first keeps a hot customer out of the join."""
    per_customer = lifecycle.groupBy("customer_key").agg(
        _count().alias("orders"),
        F.sum("payment_value").alias("paid"),
        F.count("payment_value").alias("paid_orders"),
        F.count_if("is_delivered_late").alias("late"),
        F.count("order_delivered_customer_date").alias("delivered"),
    )
    states = customers.select(
        "customer_key", F.coalesce("state", F.lit(NO_LABEL)).alias("customer_state")
    )
    return (
        per_customer.join(states, "customer_key")
        .groupBy("customer_state")
        .agg(
            F.sum("orders").alias("order_count"),
            total("paid").alias("revenue"),
            quotient("sum(paid)", "sum(paid_orders)", MART_MONEY).alias("average_order_value"),
            F.sum("late").alias("late_order_count"),
            rate("sum(late)", "sum(delivered)").alias("late_delivery_rate"),
        )
    )


def with_share(df: DataFrame, count: str, name: str) -> DataFrame:
    """Share of each row's count in the total. For short results: the total is one window."""
    return df.withColumn(name, rate(count, f"sum({count}) over ()"))


def mart_order_status(lifecycle: DataFrame) -> DataFrame:
    per_status = lifecycle.groupBy("order_status").agg(
        _count().alias("order_count"),
        total("payment_value").alias("revenue"),
        mean_money("payment_value").alias("average_order_value"),
    )
    return with_share(per_status, "order_count", "order_share")
