"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions import UNKNOWN_KEY, calendar_columns, newest, stable_key
from lakemart.operators.lookups import lookup_join
from lakemart.operators.upserts import epoch_like
from lakemart.plans.staging import UPDATED

# Fixed values of the unknown members; every column not named here is null.
UNKNOWN_MEMBERS = {
    "dim_customer": {
        "customer_key": UNKNOWN_KEY,
        "customer_id": "UNKNOWN",
        "customer_unique_id": "UNKNOWN",
        "city": "Unknown",
        "state": "Unknown",
    },
    "dim_product": {
        "product_key": UNKNOWN_KEY,
        "product_id": "UNKNOWN",
        "category_name": "Unknown",
        "category_name_english": "Unknown",
    },
    "dim_seller": {
        "seller_key": UNKNOWN_KEY,
        "seller_id": "UNKNOWN",
        "city": "Unknown",
        "state": "Unknown",
    },
}

ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def unknown_member(dim_name: str, like: DataFrame) -> DataFrame:
    """The one-row default member, in the schema of the dimension."""
    values = UNKNOWN_MEMBERS[dim_name]
    time_type = like.schema[UPDATED].dataType.simpleString()
    row = [
        (epoch_like(time_type) if f.name == UPDATED else F.lit(values.get(f.name)))
        .cast(f.dataType)
        .alias(f.name)
        for f in like.schema.fields
    ]
    return like.sparkSession.range(1).select(*row)


def with_unknown(dim_name: str, dim: DataFrame) -> DataFrame:
    return dim.unionByName(unknown_member(dim_name, dim))


def source_dates(orders: DataFrame, items: DataFrame) -> DataFrame:
    """All operational dates, one pass per table."""
    order_dates = orders.select(
        F.explode(F.array(*[F.to_date(c) for c in ORDER_TIMES])).alias("source_date")
    )
    shipping = items.select(F.to_date("shipping_limit_date").alias("source_date"))
    return order_dates.unionAll(shipping)


def date_bounds(orders: DataFrame, items: DataFrame) -> DataFrame:
    """First and last operational date: row-wise extremes first, then one aggregate per table."""
    days = [F.to_date(c) for c in ORDER_TIMES]
    per_order = orders.agg(
        F.min(F.least(*days)).alias("first_day"), F.max(F.greatest(*days)).alias("last_day")
    )
    shipping = F.to_date("shipping_limit_date")
    per_item = items.agg(F.min(shipping).alias("first_day"), F.max(shipping).alias("last_day"))
    return per_order.unionAll(per_item).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")
    )


def calendar(bounds: DataFrame) -> DataFrame:
    days = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("full_date")).selectExpr(
        *calendar_columns("full_date")
    )


def dim_date(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Every day from the first to the last operational date."""
    return calendar(date_bounds(orders, items))


def _located(staged: DataFrame, zip_column: str, geolocation: DataFrame) -> DataFrame:
    """Add the representative point of the zip prefix; without one the columns are null."""
    points = geolocation.select(
        F.col("geolocation_zip_code_prefix").alias(zip_column),
        "latitude",
        "longitude",
        F.col(UPDATED).alias("_geo_updated_at"),
    )
    return lookup_join(staged, points, zip_column, "left")


def dim_customer(
    customers: DataFrame, geolocation: DataFrame, unknown: bool = True
) -> DataFrame:
    dim = _located(customers, "customer_zip_code_prefix", geolocation).select(
        stable_key("customer_id").alias("customer_key"),
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
        "latitude",
        "longitude",
        newest(UPDATED, "_geo_updated_at").alias(UPDATED),
    )
    return with_unknown("dim_customer", dim) if unknown else dim


def dim_seller(sellers: DataFrame, geolocation: DataFrame, unknown: bool = True) -> DataFrame:
    dim = _located(sellers, "seller_zip_code_prefix", geolocation).select(
        stable_key("seller_id").alias("seller_key"),
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
        "latitude",
        "longitude",
        newest(UPDATED, "_geo_updated_at").alias(UPDATED),
    )
    return with_unknown("dim_seller", dim) if unknown else dim


def dim_product(products: DataFrame, translation: DataFrame, unknown: bool = True) -> DataFrame:
    labels = translation.select(
        "product_category_name",
        F.col("product_category_name_english").alias("_english"),
        F.col(UPDATED).alias("_label_updated_at"),
    )
    labelled = lookup_join(products, labels, "product_category_name", "left")
    dim = labelled.select(
        stable_key("product_id").alias("product_key"),
        "product_id",
        F.col("product_category_name").alias("category_name"),
        F.coalesce("_english", "product_category_name").alias("category_name_english"),
        "product_name_length",
        "product_description_length",
        "product_photos_quantity",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        newest(UPDATED, "_label_updated_at").alias(UPDATED),
    )
    return with_unknown("dim_product", dim) if unknown else dim


def date_role(dates: DataFrame, role: str) -> DataFrame:
    """The calendar under the names of one role, e.g. ``purchase_date_key``."""
    return dates.select([F.col(c).alias(f"{role}_{c}") for c in dates.columns])


def role_playing(fact: DataFrame, dates: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Join the calendar once per role (role name -> date-key column of the fact).

    The calendar has at most one row per day of the years 1 to 9999, so it is broadcast.
    """
    for role, column in roles.items():
        day = date_role(dates, role)
        on = F.col(column) == F.col(f"{role}_calendar_key")
        day = day.withColumnRenamed(f"{role}_date_key", f"{role}_calendar_key")
        fact = fact.join(F.broadcast(day), on, "left").drop(f"{role}_calendar_key")
    return fact


def empty_like(spark: SparkSession, df: DataFrame) -> DataFrame:
    return spark.createDataFrame([], df.schema)
