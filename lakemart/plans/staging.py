"""RAW text tables to typed current-state staging tables, declared as data.

A staged table is a lazy DataFrame. Keys are cleaned before the newest version is picked, so
``'a'`` and ``' a'`` are one key; all other columns are cast afterwards, so a bad value in a
superseded version does not stop the run while one in the current version does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.functions import (
    MONEY,
    blank_to_null,
    code,
    exact_mean,
    identifier,
    strict_cast,
)
from lakemart.operators.versions import latest_version

UPDATED = "record_updated_at"
POINT = "decimal(28,15)"


def _cast(data_type: str) -> Callable[[str], str]:
    return lambda name: strict_cast.sql(name, data_type)


# SQL text of a staged value, by kind of column.
KINDS: dict[str, Callable[[str], str]] = {
    "id": identifier.sql,
    "code": code.sql,
    "text": blank_to_null.sql,
    "int": _cast("int"),
    "small": _cast("smallint"),
    "money": _cast(MONEY),
    "time": _cast("timestamp_ntz"),
    "double": _cast("double"),
}


@dataclass(frozen=True)
class StagingModel:
    """``columns`` maps a staged name to (RAW name, kind); no ``keys`` means no dedup."""

    keys: tuple[str, ...]
    columns: dict[str, tuple[str, str]]

    def expression(self, name: str) -> str:
        raw_name, kind = self.columns[name]
        return KINDS[kind](raw_name)

    @property
    def raw_columns(self) -> list[str]:
        return [raw_name for raw_name, _ in self.columns.values()]


# Staged name -> (RAW name, kind). Some RAW names are misspelt at the source.
MODELS: dict[str, StagingModel] = {
    "customers": StagingModel(
        ("customer_id",),
        {
            "customer_id": ("customer_id", "id"),
            "customer_unique_id": ("customer_unique_id", "id"),
            "customer_zip_code_prefix": ("customer_zip_code_prefix", "int"),
            "customer_city": ("customer_city", "text"),
            "customer_state": ("customer_state", "text"),
        },
    ),
    "orders": StagingModel(
        ("order_id",),
        {
            "order_id": ("order_id", "id"),
            "customer_id": ("customer_id", "id"),
            "order_status": ("order_status", "code"),
            "order_purchase_timestamp": ("order_purchase_timestamp", "time"),
            "order_approved_at": ("order_approved_at", "time"),
            "order_delivered_carrier_date": ("order_delivered_carrier_date", "time"),
            "order_delivered_customer_date": ("order_delivered_customer_date", "time"),
            "order_estimated_delivery_date": ("order_estimated_delivery_date", "time"),
        },
    ),
    "order_items": StagingModel(
        ("order_id", "order_item_id"),
        {
            "order_id": ("order_id", "id"),
            "order_item_id": ("order_item_id", "int"),
            "product_id": ("product_id", "id"),
            "seller_id": ("seller_id", "id"),
            "shipping_limit_date": ("shipping_limit_date", "time"),
            "price": ("price", "money"),
            "freight_value": ("freight_value", "money"),
        },
    ),
    "payments": StagingModel(
        ("order_id", "payment_sequential"),
        {
            "order_id": ("order_id", "id"),
            "payment_sequential": ("payment_sequential", "int"),
            "payment_type": ("payment_type", "code"),
            "payment_installments": ("payment_installments", "int"),
            "payment_value": ("payment_value", "money"),
        },
    ),
    "reviews": StagingModel(
        (),
        {
            "review_id": ("review_id", "id"),
            "order_id": ("order_id", "id"),
            "review_score": ("review_score", "small"),
            "review_comment_title": ("review_comment_title", "text"),
            "review_comment_message": ("review_comment_message", "text"),
            "review_creation_date": ("review_creation_date", "time"),
            "review_answer_timestamp": ("review_answer_timestamp", "time"),
        },
    ),
    "products": StagingModel(
        ("product_id",),
        {
            "product_id": ("product_id", "id"),
            "product_category_name": ("product_category_name", "text"),
            "product_name_length": ("product_name_lenght", "int"),
            "product_description_length": ("product_description_lenght", "int"),
            "product_photos_quantity": ("product_photos_qty", "int"),
            "product_weight_g": ("product_weight_g", "money"),
            "product_length_cm": ("product_length_cm", "money"),
            "product_height_cm": ("product_height_cm", "money"),
            "product_width_cm": ("product_width_cm", "money"),
        },
    ),
    "sellers": StagingModel(
        ("seller_id",),
        {
            "seller_id": ("seller_id", "id"),
            "seller_zip_code_prefix": ("seller_zip_code_prefix", "int"),
            "seller_city": ("seller_city", "text"),
            "seller_state": ("seller_state", "text"),
        },
    ),
    "category_translation": StagingModel(
        (),
        {
            "product_category_name": ("product_category_name", "id"),
            "product_category_name_english": ("product_category_name_english", "id"),
        },
    ),
}


CHANGED_AT = "coalesce(source_updated_at, loaded_at)"


def stage(dataset: str, raw: DataFrame, lineage: bool = False, of: DataFrame | None = None, buckets: int = 0) -> DataFrame:
    """Staged form of one RAW data set; ``lineage`` also keeps its batch columns.

    ``of`` holds staged keys: only their rows are cast and returned. They meet the ranked rows by the
    key the ranking dealt them by; rows with a null key are not among them.

    With ``buckets`` the one exchange deals rows into as many buckets of the first key, and the staged
    rows can be written so; all versions of a key travel then, so this is for keys that are not hot.
    """
    if dataset == "geolocation":
        return stg_geolocation(raw)
    model = MODELS[dataset]
    rows = raw
    staged = {name: model.expression(name) for name in model.columns}
    if model.keys:
        # How a key was spelled is not staged, so rows that differ in nothing else are one row.
        spelled = [model.columns[k][0] for k in model.keys]
        others = [c for c in model.raw_columns if c not in spelled]
        cleaned = raw.selectExpr("*", *[f"{staged[k]} as _key_{k}" for k in model.keys])
        rows = latest_version(
            cleaned.repartition(buckets, f"_key_{model.keys[0]}") if buckets else cleaned,
            keys=[f"_key_{k}" for k in model.keys],
            recency=("source_updated_at", "loaded_at"),
            tie_breakers=("batch_id", *others),
        )
        staged.update({k: f"_key_{k}" for k in model.keys})
        if of is not None:
            wanted = of.toDF(*[f"_key_{k}" for k in of.columns])
            rows = rows.join(wanted, wanted.columns, "left_semi")
    extra = ["batch_id", "loaded_at"] if lineage else []
    columns = [f"{text} as {name}" for name, text in staged.items()]
    return rows.selectExpr(*columns, f"{CHANGED_AT} as {UPDATED}", *extra)


def staged_keys(dataset: str, raw: DataFrame, buckets: int = 0) -> DataFrame:
    """Distinct natural keys of a staged table, reading only the key columns; ``buckets``: see ``stage``."""
    model = MODELS[dataset]
    keys = raw.selectExpr(*[f"{model.expression(k)} as {k}" for k in model.keys])
    return (keys.repartition(buckets, model.keys[0]) if buckets else keys).distinct()


def cleaned_ids(dataset: str, raw: DataFrame) -> DataFrame:
    """The id columns of all RAW versions, cleaned but not ranked: a plain scan."""
    columns = MODELS[dataset].columns.items()
    ids = [f"{identifier.sql(c)} as {name}" for name, (c, kind) in columns if kind == "id"]
    return raw.selectExpr(*ids)


def stg_customers(raw: DataFrame) -> DataFrame:
    return stage("customers", raw)


def stg_orders(raw: DataFrame) -> DataFrame:
    return stage("orders", raw)


def stg_order_items(raw: DataFrame) -> DataFrame:
    return stage("order_items", raw)


def stg_payments(raw: DataFrame) -> DataFrame:
    return stage("payments", raw)


def stg_reviews(raw: DataFrame) -> DataFrame:
    return stage("reviews", raw)


def stg_products(raw: DataFrame) -> DataFrame:
    return stage("products", raw)


def stg_sellers(raw: DataFrame) -> DataFrame:
    return stage("sellers", raw)


def stg_category_translation(raw: DataFrame) -> DataFrame:
    return stage("category_translation", raw)


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """One representative point per zip prefix."""
    points = raw.selectExpr(
        f"{strict_cast.sql('geolocation_zip_code_prefix', 'int')} as geolocation_zip_code_prefix",
        f"{strict_cast.sql('geolocation_lat', POINT)} as lat",
        f"{strict_cast.sql('geolocation_lng', POINT)} as lng",
        f"{blank_to_null.sql('geolocation_city')} as city",
        f"{blank_to_null.sql('geolocation_state')} as state",
        f"{CHANGED_AT} as {UPDATED}",
    )
    return points.groupBy("geolocation_zip_code_prefix").agg(
        exact_mean("lat").alias("latitude"),
        exact_mean("lng").alias("longitude"),
        F.min("city").alias("city"),
        F.min("state").alias("state"),
        F.max(UPDATED).alias(UPDATED),
    )


STAGED = (*MODELS, "geolocation")


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: stage(name, raw[name]) for name in STAGED if name in raw}


def register_views(staged: dict[str, DataFrame]) -> list[str]:
    """Expose the staged tables to SQL as ``stg_<data set>``."""
    names = []
    for name, df in staged.items():
        df.createOrReplaceTempView(f"stg_{name}")
        names.append(f"stg_{name}")
    return names
