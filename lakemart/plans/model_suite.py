"""The declared tests of the commerce models, and the suite over a build."""

from __future__ import annotations

from collections.abc import Sequence

from lakemart.operators.model_tests import (
    Frames,
    ModelTest,
    accepted_values,
    check_names,
    condition,
    not_null,
    query,
    relationships,
    unique,
)
from lakemart.plans import warehouse_checks as checks
from lakemart.sources.contract import COMMERCE_CONTRACT

# Which columns of a model are a key (neither null nor twice), which are only never
# null, and which refer to another model.
KEYS = {
    "stg_customers": ("customer_id",),
    "stg_orders": ("order_id",),
    "stg_products": ("product_id",),
    "stg_sellers": ("seller_id",),
    "stg_geolocation": ("geolocation_zip_code_prefix",),
    "stg_category_translation": ("product_category_name",),
    "dim_date": ("date_key", "full_date"),
    "dim_customer": ("customer_key", "customer_id"),
    "dim_product": ("product_key", "product_id"),
    "dim_seller": ("seller_key", "seller_id"),
    "fact_order_items": ("order_item_key",),
    "fact_payments": ("payment_key",),
    "fact_order_lifecycle": ("order_key", "order_id"),
    "mart_executive_kpis": ("metric_scope",),
    "mart_sales_daily": ("date_key", "full_date"),
    "mart_category_performance": ("category_name",),
    "mart_state_performance": ("customer_state",),
    "mart_order_status": ("order_status",),
}
REQUIRED = {
    "stg_orders": ("customer_id",),
    "stg_order_items": ("order_id", "order_item_id", "price"),
    "stg_payments": ("order_id", "payment_sequential", "payment_value"),
    "fact_order_items": ("customer_key", "product_key", "seller_key", "order_date_key"),
    "fact_payments": ("customer_key", "payment_date_key"),
    "fact_order_lifecycle": ("customer_key", "purchase_date_key"),
    "mart_executive_kpis": ("total_orders", "total_revenue"),
}
REFERENCES = {
    "stg_orders": {"customer_id": ("stg_customers", "customer_id")},
    "stg_order_items": {"order_id": ("stg_orders", "order_id")},
    "stg_payments": {"order_id": ("stg_orders", "order_id")},
    "fact_order_items": {
        "customer_key": ("dim_customer", "customer_key"),
        "product_key": ("dim_product", "product_key"),
        "seller_key": ("dim_seller", "seller_key"),
        "order_date_key": ("dim_date", "date_key"),
        "shipping_date_key": ("dim_date", "date_key"),
    },
    "fact_payments": {
        "customer_key": ("dim_customer", "customer_key"),
        "payment_date_key": ("dim_date", "date_key"),
    },
    "fact_order_lifecycle": {
        "customer_key": ("dim_customer", "customer_key"),
        "purchase_date_key": ("dim_date", "date_key"),
    },
}
GRAINS = {
    "stg_order_items": ("order_id", "order_item_id"),
    "stg_payments": ("order_id", "payment_sequential"),
}


def late_limits(frames: Frames):
    return checks.late_shipping_limit(frames["stg_order_items"], frames["stg_orders"])


def declared_tests() -> list[ModelTest]:
    """All tests of the suite: those of columns, and seven that are written out."""
    tests = []
    for model, columns in KEYS.items():
        for column in columns:
            tests += [not_null(model, column), unique(model, column)]
    for model, columns in REQUIRED.items():
        tests += [not_null(model, column) for column in columns]
    for model, references in REFERENCES.items():
        tests += [relationships(model, column, *parent) for column, parent in references.items()]
    statuses = COMMERCE_CONTRACT.datasets["orders"].accepted_values["order_status"]
    tests.append(accepted_values("stg_orders", "order_status", statuses))
    tests += [unique(model, *grain, title=f"{model}_grain_unique") for model, grain in GRAINS.items()]
    early = "order_delivered_customer_date < order_purchase_timestamp"
    tests += [
        condition("order_delivery_after_purchase", "fact_order_lifecycle", early),
        query("shipping_limit_reasonable", "stg_order_items", late_limits, "WARN"),
        query(
            "unknown_dimension_rate", "fact_order_items", lambda f: checks.unknown_rate_exceeded(f["fact_order_items"]), "WARN"
        ),
    ]
    for staged, fact in (("stg_order_items", "fact_order_items"), ("stg_payments", "fact_payments")):
        tests.append(
            query(f"{fact}_reconciliation", fact, lambda f, s=staged, t=fact: checks.reconciliation_mismatch(f[s], f[t]))
        )
    check_names(tests)
    return tests


def tested_models(tests: Sequence[ModelTest]) -> list[str]:
    """Models that the tests read."""
    return sorted({t.model for t in tests} | {t.parent[0] for t in tests if t.parent} | {"stg_orders"})
