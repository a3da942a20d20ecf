"""The data contract: which files exist, their columns and the rules their rows must meet."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class DatasetSpec:
    """Rules for one data set. ``file`` may be a glob, so a data set may be many files."""

    file: str
    required_columns: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    accepted_values: dict[str, tuple[str, ...]] = field(default_factory=dict)
    non_negative: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    # A quoted line break makes a file unsplittable, so it has to be asked for.
    multi_line: bool = False


@dataclass(frozen=True)
class ForeignKey:
    name: str
    child_dataset: str
    child_column: str
    parent_dataset: str
    parent_column: str
    severity: str = "ERROR"


@dataclass(frozen=True)
class Contract:
    datasets: dict[str, DatasetSpec]
    foreign_keys: tuple[ForeignKey, ...] = ()


def dataset_spec(spec: dict[str, Any]) -> DatasetSpec:
    return DatasetSpec(
        file=spec["file"],
        required_columns=tuple(spec.get("required_columns", ())),
        not_null=tuple(spec.get("not_null", ())),
        unique=tuple(tuple(columns) for columns in spec.get("unique", ())),
        accepted_values={c: tuple(v) for c, v in spec.get("accepted_values", {}).items()},
        non_negative=tuple(spec.get("non_negative", ())),
        ranges={c: (v[0], v[1]) for c, v in spec.get("ranges", {}).items()},
        multi_line=bool(spec.get("multi_line", False)),
    )


def contract_from(document: dict[str, Any]) -> Contract:
    return Contract(
        datasets={name: dataset_spec(spec) for name, spec in document["datasets"].items()},
        foreign_keys=tuple(ForeignKey(**rule) for rule in document.get("foreign_keys", ())),
    )


def load_contract(path: str) -> Contract:
    """Contract from a JSON document (configuration, read on the driver)."""
    with open(path, encoding="utf-8") as stream:
        return contract_from(json.load(stream))


# The shipped contract for the nine commerce files.
COMMERCE_CONTRACT = Contract(
    datasets={
        "customers": DatasetSpec(
            file="*_customers_dataset.csv",
            required_columns=(
                "customer_id",
                "customer_unique_id",
                "customer_zip_code_prefix",
                "customer_city",
                "customer_state",
            ),
            not_null=("customer_id", "customer_unique_id"),
            unique=(("customer_id",),),
        ),
        "orders": DatasetSpec(
            file="*_orders_dataset.csv",
            required_columns=(
                "order_id",
                "customer_id",
                "order_status",
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
            not_null=("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
            unique=(("order_id",),),
            accepted_values={
                "order_status": (
                    "approved",
                    "canceled",
                    "created",
                    "delivered",
                    "invoiced",
                    "processing",
                    "shipped",
                    "unavailable",
                )
            },
        ),
        "order_items": DatasetSpec(
            file="*_order_items_dataset.csv",
            required_columns=(
                "order_id",
                "order_item_id",
                "product_id",
                "seller_id",
                "shipping_limit_date",
                "price",
                "freight_value",
            ),
            not_null=(
                "order_id",
                "order_item_id",
                "product_id",
                "seller_id",
                "price",
                "freight_value",
            ),
            unique=(("order_id", "order_item_id"),),
            non_negative=("price", "freight_value"),
        ),
        "payments": DatasetSpec(
            file="*_order_payments_dataset.csv",
            required_columns=(
                "order_id",
                "payment_sequential",
                "payment_type",
                "payment_installments",
                "payment_value",
            ),
            not_null=("order_id", "payment_sequential", "payment_type", "payment_value"),
            unique=(("order_id", "payment_sequential"),),
            non_negative=("payment_installments", "payment_value"),
        ),
        "reviews": DatasetSpec(
            file="*_order_reviews_dataset.csv",
            required_columns=(
                "review_id",
                "order_id",
                "review_score",
                "review_comment_title",
                "review_comment_message",
                "review_creation_date",
                "review_answer_timestamp",
            ),
            not_null=("review_id", "order_id", "review_score"),
            ranges={"review_score": (1, 5)},
            multi_line=True,
        ),
        "products": DatasetSpec(
            file="*_products_dataset.csv",
            required_columns=(
                "product_id",
                "product_category_name",
                "product_name_lenght",
                "product_description_lenght",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            ),
            not_null=("product_id",),
            unique=(("product_id",),),
            non_negative=(
                "product_name_lenght",
                "product_description_lenght",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            ),
        ),
        "sellers": DatasetSpec(
            file="*_sellers_dataset.csv",
            required_columns=(
                "seller_id",
                "seller_zip_code_prefix",
                "seller_city",
                "seller_state",
            ),
            not_null=("seller_id",),
            unique=(("seller_id",),),
        ),
        "geolocation": DatasetSpec(
            file="*_geolocation_dataset.csv",
            required_columns=(
                "geolocation_zip_code_prefix",
                "geolocation_lat",
                "geolocation_lng",
                "geolocation_city",
                "geolocation_state",
            ),
            not_null=("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
            ranges={"geolocation_lat": (-90, 90), "geolocation_lng": (-180, 180)},
        ),
        "category_translation": DatasetSpec(
            file="product_category_name_translation.csv",
            required_columns=("product_category_name", "product_category_name_english"),
            not_null=("product_category_name", "product_category_name_english"),
            unique=(("product_category_name",),),
        ),
    },
    foreign_keys=(
        ForeignKey("orders_customer_exists", "orders", "customer_id", "customers", "customer_id"),
        ForeignKey("order_items_order_exists", "order_items", "order_id", "orders", "order_id"),
        ForeignKey(
            "order_items_product_exists", "order_items", "product_id", "products", "product_id"
        ),
        ForeignKey("order_items_seller_exists", "order_items", "seller_id", "sellers", "seller_id"),
        ForeignKey("payments_order_exists", "payments", "order_id", "orders", "order_id"),
        ForeignKey("reviews_order_exists", "reviews", "order_id", "orders", "order_id", "WARN"),
    ),
)

# Data sets with a change time at the source, extracted by watermark.
INCREMENTAL_DATASETS = ("customers", "products", "sellers", "orders", "order_items", "payments")
