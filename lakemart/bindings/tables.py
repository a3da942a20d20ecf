"""RAW-shaped views of the driver's test tables: text columns plus the batch columns.

Nothing is loaded or computed here; each function is a projection over a Parquet scan (with
at most a join to the 25 nations), so staging prunes and reads only what it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch-0"
LOADED_AT = "2024-01-31 00:00:00"
NO_TIME = "cast(null as timestamp_ntz)"


# Stated schemas spare the job that would read them from the file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _raw(df: DataFrame, columns: dict[str, str], updated: str = NO_TIME) -> DataFrame:
    """``columns`` maps a RAW name to the SQL expression whose text it holds."""
    return df.selectExpr(
        *[f"cast({value} as string) as {name}" for name, value in columns.items()],
        f"'{BATCH}' as batch_id",
        f"timestamp_ntz'{LOADED_AT}' as loaded_at",
        f"{updated} as source_updated_at",
    )


def _with_nation(spark: SparkSession, sf_dir: str, df: DataFrame, key: str) -> DataFrame:
    """Add the nation name; the nation table has 25 rows at every scale."""
    nation = table(spark, sf_dir, "nation").selectExpr(f"n_nationkey as {key}", "n_name")
    return df.join(F.broadcast(nation), key, "left")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; those in debt are known under another id, so that their orders hit the unknown member."""
    return _raw(
        _with_nation(spark, sf_dir, table(spark, sf_dir, "customer"), "c_nationkey"),
        {
            "customer_id": "if(c_acctbal >= 0, cast(c_custkey as string), concat('x', c_custkey))",
            "customer_unique_id": "c_name",
            "customer_zip_code_prefix": "c_nationkey",
            "customer_city": "c_mktsegment",
            "customer_state": "n_name",
        },
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; deliveries, approvals and estimates are offsets computed from the keys.

    The status words are not yet clean, approvals of cancelled orders are blank, and one
    estimate in 97 is missing.
    """
    words = {"F": " Delivered", "O": "shipped ", "P": "CANCELED"}
    status = " ".join(f"when '{flag}' then '{word}'" for flag, word in words.items())
    days = "make_dt_interval(cast(o_orderkey % 130 - 10 as int), cast(o_custkey % 24 as int))"
    approved = "o_orderdate + make_dt_interval(0, cast(o_orderkey % 72 as int))"
    carried = "o_orderdate + make_dt_interval(cast(o_orderkey % 9 as int))"
    estimated = "cast(o_orderdate + interval 90 days as string)"
    return _raw(
        table(spark, sf_dir, "orders"),
        {
            "order_id": "o_orderkey",
            "customer_id": "o_custkey",
            "order_status": f"case o_orderstatus {status} end",
            "order_purchase_timestamp": "o_orderdate",
            "order_approved_at": f"if(o_orderstatus = 'P', '', cast({approved} as string))",
            "order_delivered_carrier_date": f"if(o_orderstatus <> 'P', {carried}, null)",
            "order_delivered_customer_date": f"if(o_orderstatus = 'F', o_orderdate + {days}, null)",
            "order_estimated_delivery_date": f"if(o_orderkey % 97 = 0, '', {estimated})",
        },
        "o_orderdate",
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items: several versions per (order, line), told apart by ship date."""
    return _raw(
        table(spark, sf_dir, "lineitem"),
        {
            "order_id": "l_orderkey",
            "order_item_id": "l_linenumber",
            "product_id": "l_partkey",
            "seller_id": "l_suppkey",
            "shipping_limit_date": "l_shipdate",
            "price": "l_extendedprice",
            "freight_value": "l_quantity",
        },
        "l_shipdate",
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events: four consecutive events are the payments of one order."""
    return _raw(
        table(spark, sf_dir, "events"),
        {
            "order_id": "event_id div 4",
            "payment_sequential": "event_id % 4 + 1",
            "payment_type": "concat(' ', upper(event_type))",
            "payment_installments": "user_id % 12 + 1",
            "payment_value": "value",
        },
        "ts",
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the score of their label; unlabelled documents have an empty score."""
    scores = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return _raw(
        table(spark, sf_dir, "documents").join(scores, "doc_id", "left"),
        {
            "review_id": "concat(' r', doc_id)",
            "order_id": "doc_id",
            "review_score": "coalesce(cast(quality + 4 as string), '')",
            "review_comment_title": "if(lang = 'en', '  ', lang)",
            "review_comment_message": "text",
            "review_creation_date": "''",
            "review_answer_timestamp": "null",
        },
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts; the category is blank for every tenth size, and some sizes are known under another id."""
    return _raw(
        table(spark, sf_dir, "part"),
        {
            "product_id": "if(p_size % 25 = 0, concat('x', p_partkey), cast(p_partkey as string))",
            "product_category_name": "if(p_size % 10 = 0, '  ', p_brand)",
            "product_name_lenght": "length(p_name)",
            "product_description_lenght": "if(p_size % 7 = 0, '', cast(p_size as string))",
            "product_photos_qty": "p_size % 5",
            "product_weight_g": "p_retailprice",
            "product_length_cm": "p_size",
            "product_height_cm": "'12.5'",
            "product_width_cm": "null",
        },
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers; those in debt are known under another id."""
    return _raw(
        _with_nation(spark, sf_dir, table(spark, sf_dir, "supplier"), "s_nationkey"),
        {
            "seller_id": "if(s_acctbal >= 0, cast(s_suppkey as string), concat('x', s_suppkey))",
            "seller_zip_code_prefix": "s_nationkey",
            "seller_city": "s_name",
            "seller_state": "n_name",
        },
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many points per zip prefix: one per customer of the nation (nation 3 lies under another prefix)."""
    return _raw(
        _with_nation(spark, sf_dir, table(spark, sf_dir, "customer"), "c_nationkey"),
        {
            "geolocation_zip_code_prefix": "if(c_nationkey = 3, 99, c_nationkey)",
            "geolocation_lat": "c_acctbal",
            "geolocation_lng": "c_custkey",
            "geolocation_city": "c_mktsegment",
            "geolocation_state": "n_name",
        },
    )


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English labels for all brands; those without a two-digit number are spelled otherwise, and fall back."""
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    return _raw(
        brands,
        {
            "product_category_name": "if(length(p_brand) = 8, p_brand, lower(p_brand))",
            "product_category_name_english": "concat('Label ', substring(p_brand, 7, 2))",
        },
    )
