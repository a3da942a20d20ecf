"""The queries behind the dashboard cards, all over the small marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import total


def kpi_cards(kpis: DataFrame) -> DataFrame:
    return kpis.select("total_revenue", "total_orders", "average_order_value", "late_delivery_rate")


def historical(daily: DataFrame, before: dt.date) -> DataFrame:
    """Days before the cut-off, so that synthetic test orders do not stretch the time axis."""
    return daily.filter(F.col("full_date") < F.lit(before))


def in_period(daily: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    return daily.filter(F.col("full_date").between(F.lit(first), F.lit(last)))


def in_states(states: DataFrame, wanted: list[str]) -> DataFrame:
    return states.filter(F.col("customer_state").isin(*wanted))


def daily_trend(daily: DataFrame) -> DataFrame:
    return daily.select("full_date", "revenue", "order_count").orderBy("full_date")


def monthly_revenue(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("year_number", "month_number")
        .agg(total("revenue").alias("revenue"), F.sum("order_count").alias("order_count"))
        .orderBy("year_number", "month_number")
    )


def top_categories(categories: DataFrame, n: int = 10) -> DataFrame:
    ranked = categories.orderBy(F.desc("merchandise_revenue"), "category_name").limit(n)
    return ranked.select("category_name", "merchandise_revenue")


def revenue_by_state(states: DataFrame) -> DataFrame:
    return states.select("customer_state", "revenue").orderBy(F.desc("revenue"), "customer_state")


def status_distribution(statuses: DataFrame) -> DataFrame:
    return statuses.select("order_status", "order_count", "order_share").orderBy(
        F.desc("order_count"), "order_status"
    )


def top_late_states(states: DataFrame, min_orders: int = 100, n: int = 10) -> DataFrame:
    enough = states.filter(F.col("order_count") >= min_orders)
    ranked = enough.orderBy(F.desc_nulls_last("late_delivery_rate"), "customer_state").limit(n)
    return ranked.select("customer_state", "order_count", "late_delivery_rate")
