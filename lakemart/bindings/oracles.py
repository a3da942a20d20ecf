"""The same results in SQL over the test tables, written independently of the Spark code.

``TABLES`` holds the pipeline's tables as common table expressions. A query text names the
ones it needs; ``oracle_sql`` puts them (and what they need in turn) in front of it.
"""

from __future__ import annotations

import re

from lakemart.operators.model_tests import ModelTest
from lakemart.plans.model_suite import declared_tests

LOADED = "timestamp '2024-01-31 00:00:00'"
EPOCH = "timestamp '1970-01-01 00:00:00'"


def key(expression: str) -> str:
    text = f"coalesce(({expression})::varchar, '_dbt_null_')"
    return f"concat('0x', substr(md5({text}), 1, 15))::bigint"


def day_key(expression: str) -> str:
    return f"strftime({expression}, '%Y%m%d')::integer"


def mean(expression: str, total: str | None = None, count: str | None = None) -> str:
    """Average of money rounded half up, in integer cents."""
    s = total or f"(sum({expression}) * 100)::bigint"
    n = count or f"count({expression})"
    cents = f"(sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})))"
    return f"({cents}::decimal(18,0) * 0.01::decimal(3,2))::decimal(16,2)"


def rate(part: str, whole: str) -> str:
    """Ratio of counts rounded half up to four digits; null for an empty whole."""
    units = f"((20000 * ({part}) + ({whole})) // nullif(2 * ({whole}), 0))"
    return f"({units}::decimal(18,0) * 0.0001::decimal(5,4))::decimal(8,4)"


def span(start: str, end: str, micros: int, kind: str = "decimal(20,6)", digits: int = 6) -> str:
    gap = f"date_diff('microsecond', {start}, {end})"
    return f"round({gap} / {micros}.0::double, {digits})::{kind}"


TABLES = {
    "stg_customers": f"""
        select case when c_acctbal >= 0 then c_custkey::varchar else 'x' || c_custkey end as customer_id,
               c_name as customer_unique_id,
               c_nationkey::integer as customer_zip_code_prefix,
               c_mktsegment as customer_city, n_name as customer_state,
               {LOADED} as record_updated_at
        from customer left join nation on n_nationkey = c_nationkey""",
    "stg_orders": """
        select o_orderkey::varchar as order_id, o_custkey::varchar as customer_id,
               case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped'
                                  when 'P' then 'canceled' end as order_status,
               o_orderdate as order_purchase_timestamp,
               case when o_orderstatus <> 'P'
                    then o_orderdate + to_hours((o_orderkey % 72)::int) end as order_approved_at,
               case when o_orderstatus <> 'P'
                    then o_orderdate + to_days((o_orderkey % 9)::int)
               end as order_delivered_carrier_date,
               case when o_orderstatus = 'F'
                    then o_orderdate + to_days((o_orderkey % 130 - 10)::int)
                                     + to_hours((o_custkey % 24)::int)
               end as order_delivered_customer_date,
               case when o_orderkey % 97 <> 0
                    then o_orderdate + to_days(90) end as order_estimated_delivery_date,
               o_orderdate as record_updated_at
        from orders""",
    "line_versions": """
        select *, row_number() over (
                   partition by l_orderkey, l_linenumber
                   order by l_shipdate desc, l_partkey::varchar desc, l_suppkey::varchar desc,
                            l_extendedprice::varchar desc, l_quantity::varchar desc) as version
        from lineitem""",
    "stg_order_items": """
        select l_orderkey::varchar as order_id, l_linenumber::integer as order_item_id,
               l_partkey::varchar as product_id, l_suppkey::varchar as seller_id,
               l_shipdate as shipping_limit_date, l_extendedprice::decimal(12,2) as price,
               l_quantity::decimal(12,2) as freight_value, l_shipdate as record_updated_at
        from line_versions where version = 1""",
    "stg_payments": """
        select (event_id // 4)::varchar as order_id,
               (event_id % 4 + 1)::integer as payment_sequential,
               event_type as payment_type, (user_id % 12 + 1)::integer as payment_installments,
               value::decimal(12,2) as payment_value, ts as record_updated_at
        from events""",
    "stg_reviews": f"""
        select 'r' || d.doc_id::varchar as review_id, d.doc_id::varchar as order_id,
               (l.quality + 4)::smallint as review_score,
               case when lang <> 'en' then lang end as review_comment_title,
               nullif(trim(d.text, ' '), '') as review_comment_message,
               null::timestamp as review_creation_date,
               null::timestamp as review_answer_timestamp, {LOADED} as record_updated_at
        from documents d left join labels l on l.doc_id = d.doc_id""",
    "stg_products": f"""
        select case when p_size % 25 = 0 then 'x' || p_partkey else p_partkey::varchar end as product_id,
               case when p_size % 10 <> 0 then p_brand end as product_category_name,
               length(p_name)::integer as product_name_length,
               case when p_size % 7 <> 0 then p_size end::integer as product_description_length,
               (p_size % 5)::integer as product_photos_quantity,
               p_retailprice::decimal(12,2) as product_weight_g,
               p_size::decimal(12,2) as product_length_cm,
               12.50::decimal(12,2) as product_height_cm,
               null::decimal(12,2) as product_width_cm, {LOADED} as record_updated_at
        from part""",
    "stg_sellers": f"""
        select case when s_acctbal >= 0 then s_suppkey::varchar else 'x' || s_suppkey end as seller_id, s_nationkey::integer as seller_zip_code_prefix,
               s_name as seller_city, n_name as seller_state, {LOADED} as record_updated_at
        from supplier left join nation on n_nationkey = s_nationkey""",
    "stg_category_translation": f"""
        select distinct case when length(p_brand) = 8 then p_brand else lower(p_brand) end as product_category_name,
               'Label ' || substr(p_brand, 7, 2) as product_category_name_english,
               {LOADED} as record_updated_at
        from part""",
    "stg_geolocation": f"""
        select case when c_nationkey = 3 then 99 else c_nationkey end::integer as geolocation_zip_code_prefix,
               sum(c_acctbal::decimal(12,2))::double / count(*) as latitude,
               sum(c_custkey)::double / count(*) as longitude,
               min(c_mktsegment) as city, min(n_name) as state, {LOADED} as record_updated_at
        from customer left join nation on n_nationkey = c_nationkey
        group by c_nationkey""",
    "source_dates": """
        select unnest([order_purchase_timestamp::date, order_approved_at::date,
                       order_delivered_carrier_date::date, order_delivered_customer_date::date,
                       order_estimated_delivery_date::date]) as source_date
        from stg_orders
        union all select shipping_limit_date::date from stg_order_items""",
    "dim_date": f"""
        select {day_key("d")} as date_key, d::date as full_date, day(d)::smallint as day_of_month,
               isodow(d)::smallint as day_of_week, dayname(d) as day_name,
               weekofyear(d)::smallint as week_of_year, month(d)::smallint as month_number,
               monthname(d) as month_name, quarter(d)::smallint as quarter_number,
               year(d)::smallint as year_number, isodow(d) in (6, 7) as is_weekend
        from (select unnest(generate_series(min(source_date)::timestamp,
                                            max(source_date)::timestamp, interval 1 day)) as d
              from source_dates)""",
    "dim_customer": f"""
        select {key("customer_id")} as customer_key, customer_id, customer_unique_id,
               customer_zip_code_prefix as zip_code_prefix, customer_city as city,
               customer_state as state, latitude, longitude, c.record_updated_at
        from stg_customers c left join stg_geolocation g
          on geolocation_zip_code_prefix = customer_zip_code_prefix
        union all
        select -1, 'UNKNOWN', 'UNKNOWN', null, 'Unknown', 'Unknown', null, null, {EPOCH}""",
    "dim_seller": f"""
        select {key("seller_id")} as seller_key, seller_id,
               seller_zip_code_prefix as zip_code_prefix, seller_city as city,
               seller_state as state, latitude, longitude, s.record_updated_at
        from stg_sellers s left join stg_geolocation g
          on geolocation_zip_code_prefix = seller_zip_code_prefix
        union all
        select -1, 'UNKNOWN', null, 'Unknown', 'Unknown', null, null, {EPOCH}""",
    "dim_product": f"""
        select {key("product_id")} as product_key, product_id,
               p.product_category_name as category_name,
               coalesce(product_category_name_english, p.product_category_name)
                   as category_name_english,
               product_name_length, product_description_length, product_photos_quantity,
               product_weight_g, product_length_cm, product_height_cm, product_width_cm,
               p.record_updated_at
        from stg_products p left join stg_category_translation t
          on t.product_category_name = p.product_category_name
        union all
        select -1, 'UNKNOWN', 'Unknown', 'Unknown', null, null, null, null, null, null, null,
               {EPOCH}""",
    "customer_keys": f"select customer_id, {key('customer_id')} as customer_key from stg_customers",
    "product_keys": f"select product_id, {key('product_id')} as product_key from stg_products",
    "seller_keys": f"select seller_id, {key('seller_id')} as seller_key from stg_sellers",
    "fact_order_items": f"""
        select {key("i.order_id || '|' || i.order_item_id::varchar")} as order_item_key,
               i.order_id, i.order_item_id, coalesce(c.customer_key, -1) as customer_key,
               coalesce(k.product_key, -1) as product_key, coalesce(s.seller_key, -1) as seller_key,
               {day_key("order_purchase_timestamp")} as order_date_key,
               {day_key("shipping_limit_date")} as shipping_date_key, 1::integer as quantity,
               price as item_price, freight_value,
               (price + freight_value)::decimal(12,2) as total_item_value,
               greatest(i.record_updated_at, o.record_updated_at) as record_updated_at
        from stg_order_items i join stg_orders o on o.order_id = i.order_id
        left join customer_keys c on c.customer_id = o.customer_id
        left join product_keys k on k.product_id = i.product_id
        left join seller_keys s on s.seller_id = i.seller_id""",
    "fact_payments": f"""
        select {key("p.order_id || '|' || p.payment_sequential::varchar")} as payment_key,
               p.order_id, payment_sequential, coalesce(c.customer_key, -1) as customer_key,
               {day_key("order_purchase_timestamp")} as payment_date_key, payment_type,
               payment_installments as installment_count, payment_value,
               greatest(p.record_updated_at, o.record_updated_at) as record_updated_at
        from stg_payments p join stg_orders o on o.order_id = p.order_id
        left join customer_keys c on c.customer_id = o.customer_id""",
    "item_sums": """
        select order_id, count(*)::integer as item_count,
               sum(price)::decimal(14,2) as merchandise_value,
               sum(freight_value)::decimal(14,2) as freight_value,
               max(record_updated_at) as record_updated_at
        from stg_order_items group by order_id""",
    "payment_sums": """
        select order_id, sum(payment_value)::decimal(14,2) as payment_value,
               max(record_updated_at) as record_updated_at
        from stg_payments group by order_id""",
    "order_sums": """
        select o.order_id, coalesce(item_count, 0)::integer as item_count,
               coalesce(merchandise_value, 0)::decimal(14,2) as merchandise_value,
               coalesce(freight_value, 0)::decimal(14,2) as freight_value,
               coalesce(payment_value, 0)::decimal(14,2) as payment_value,
               greatest(o.record_updated_at, i.record_updated_at, p.record_updated_at)
                   as record_updated_at
        from stg_orders o left join item_sums i on i.order_id = o.order_id
        left join payment_sums p on p.order_id = o.order_id""",
    "fact_order_lifecycle": f"""
        select {key("o.order_id")} as order_key, o.order_id,
               coalesce(c.customer_key, -1) as customer_key,
               {day_key("order_purchase_timestamp")} as purchase_date_key,
               {day_key("order_approved_at")} as approved_date_key,
               {day_key("order_delivered_customer_date")} as delivered_date_key,
               {day_key("order_estimated_delivery_date")} as estimated_delivery_date_key,
               order_status, order_purchase_timestamp, order_approved_at,
               order_delivered_customer_date, order_estimated_delivery_date,
               s.item_count, s.merchandise_value, s.freight_value, s.payment_value,
               {span("order_purchase_timestamp", "order_approved_at", 60_000_000)}
                   as approval_duration_minutes,
               {span("order_purchase_timestamp", "order_delivered_customer_date", 3_600_000_000)}
                   as delivery_duration_hours,
               {span("order_estimated_delivery_date", "order_delivered_customer_date",
                     86_400_000_000)} as delivery_delay_days,
               case when order_delivered_customer_date is not null
                    then order_delivered_customer_date > order_estimated_delivery_date
               end as is_delivered_late,
               order_status = 'canceled' as is_cancelled, s.record_updated_at
        from stg_orders o join order_sums s on s.order_id = o.order_id
        left join customer_keys c on c.customer_id = o.customer_id""",
    "mart_executive_kpis": f"""
        select 'all_time' as metric_scope, count(*) as total_orders,
               sum(payment_value)::decimal(16,2) as total_revenue,
               {mean("payment_value")} as average_order_value,
               count(*) filter (order_status = 'delivered') as delivered_orders,
               count(*) filter (is_cancelled) as cancelled_orders,
               {rate("count(*) filter (is_cancelled)", "count(*)")} as cancellation_rate,
               {rate("count(*) filter (is_delivered_late)", "count(order_delivered_customer_date)")}
                   as late_delivery_rate
        from fact_order_lifecycle""",
    "mart_sales_daily": f"""
        select date_key, full_date, day_name, month_number, month_name, quarter_number,
               year_number, is_weekend, count(*) as order_count,
               sum(payment_value)::decimal(16,2) as revenue,
               {mean("payment_value")} as average_order_value,
               sum(merchandise_value)::decimal(16,2) as merchandise_value,
               sum(freight_value)::decimal(16,2) as freight_value,
               count(*) filter (is_delivered_late) as late_order_count,
               count(*) filter (is_cancelled) as cancelled_order_count
        from fact_order_lifecycle join dim_date on date_key = purchase_date_key
        group by all""",
    "mart_category_performance": f"""
        select coalesce(category_name_english, 'Unknown') as category_name,
               count(distinct order_id) as order_count, sum(quantity)::bigint as item_count,
               sum(item_price)::decimal(16,2) as merchandise_revenue,
               sum(freight_value)::decimal(16,2) as freight_value,
               sum(total_item_value)::decimal(16,2) as gross_item_value,
               {mean("item_price")} as average_item_price
        from fact_order_items f join dim_product p on p.product_key = f.product_key
        group by 1""",
    "mart_state_performance": f"""
        select coalesce(state, 'Unknown') as customer_state, count(*) as order_count,
               sum(payment_value)::decimal(16,2) as revenue,
               {mean("payment_value")} as average_order_value,
               count(*) filter (is_delivered_late) as late_order_count,
               {rate("count(*) filter (is_delivered_late)", "count(order_delivered_customer_date)")}
                   as late_delivery_rate
        from fact_order_lifecycle f join dim_customer c on c.customer_key = f.customer_key
        group by 1""",
    "mart_order_status": f"""
        select order_status, count(*) as order_count,
               sum(payment_value)::decimal(16,2) as revenue,
               {mean("payment_value")} as average_order_value,
               {rate("count(*)", "sum(count(*)) over ()")} as order_share
        from fact_order_lifecycle group by order_status""",
    "order_target": """
        select o_orderkey, o_orderstatus, o_totalprice::decimal(12,2) as total_price, o_orderdate
        from orders where o_orderdate < timestamp '1999-07-01 00:00:00'""",
    "order_delta": """
        select o_orderkey, o_orderstatus,
               (o_totalprice::decimal(12,2) + 1)::decimal(12,2) as total_price, o_orderdate
        from orders where o_orderdate >= timestamp '1999-01-01 00:00:00'""",
    "product_text": """
        select case when p_size % 25 = 0 then 'x' || p_partkey else p_partkey::varchar end as product_id,
               case when p_size % 10 = 0 then '  ' else p_brand end as product_category_name,
               length(p_name)::double as product_name_lenght,
               case when p_size % 7 <> 0 then p_size end::double as product_description_lenght,
               (p_size % 5)::double as product_photos_qty,
               p_retailprice as product_weight_g, p_size::double as product_length_cm,
               12.5::double as product_height_cm, null::double as product_width_cm
        from part""",
}

MARKS = """
    select 'orders' as dataset_name, max(o_orderdate) as watermark_value from orders
    union all select 'order_items', max(l_shipdate) from lineitem
    union all select 'payments', max(ts) from events"""

UPSERTED = """
    select * from order_target where o_orderkey not in (select o_orderkey from order_delta)
    union all select * from order_delta"""


def result(
    name: str, dataset: str, dimension: str, failed: str, total: str, source: str, severity="ERROR"
) -> str:
    return f"""select '{name}' as test_name, '{dataset}' as dataset, '{dimension}' as dimension,
        '{severity}' as severity,
        case when failed_rows = 0 then 'PASS' else '{severity}' end as status,
        failed_rows, total_rows
        from (select ({failed})::bigint as failed_rows, ({total})::bigint as total_rows
              from {source})"""


def rows_check(name: str, dataset: str, dimension: str, bad: str, source: str) -> str:
    return result(name, dataset, dimension, f"count(*) filter ({bad})", "count(*)", source)


def fixed(name: str, dataset: str, dimension: str, failed: int, total: int) -> str:
    return result(name, dataset, dimension, str(failed), str(total), "(select 1)")


def unique_check(dataset: str, name: str, keys: str, source: str) -> str:
    groups = f"(select count(*) as n from {source} group by {keys})"
    failed = "coalesce(sum(n) filter (n > 1), 0)"
    return result(f"{name}_unique", dataset, "uniqueness", failed, "sum(n)", groups)


def fk_check(name: str, dataset: str, child: str, column: str, parent: str, severity="ERROR") -> str:
    failed = f"count({column}) filter ({column} not in ({parent}))"
    return result(name, dataset, "integrity", failed, f"count({column})", child, severity)


def union(*parts: str) -> str:
    return "\nunion all\n".join(parts)


KNOWN_CUSTOMERS = "select c_custkey from customer where c_acctbal >= 0"
POINTS = "customer"
REVIEW_ROWS = "documents d left join labels l on l.doc_id = d.doc_id"

NOT_EMPTY = {
    name: rows_check("file_not_empty", name, "availability", "false", table)
    for name, table in (
        ("customers", "customer"),
        ("orders", "orders"),
        ("order_items", "lineitem"),
        ("payments", "events"),
        ("reviews", "documents"),
        ("products", "part"),
        ("sellers", "supplier"),
        ("geolocation", POINTS),
        ("category_translation", "stg_category_translation"),
    )
}
REQUIRED = {
    name: fixed("required_columns", name, "schema", 0, n)
    for name, n in (
        ("customers", 5),
        ("orders", 8),
        ("order_items", 7),
        ("payments", 5),
        ("reviews", 7),
        ("products", 9),
        ("sellers", 4),
        ("geolocation", 5),
        ("category_translation", 2),
    )
}


def not_null(dataset: str, table: str, columns: list[str]) -> str:
    return union(
        *[rows_check(f"{c}_not_null", dataset, "completeness", "false", table) for c in columns]
    )


REVIEW_NOT_NULL = union(
    not_null("reviews", "documents", ["review_id", "order_id"]),
    rows_check("review_score_not_null", "reviews", "completeness", "quality is null", REVIEW_ROWS),
)
ITEM_NOT_NULL = not_null(
    "order_items",
    "lineitem",
    ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
)
PRODUCT_NUMBERS = union(
    *[
        rows_check(f"{c}_non_negative", "products", "validity", f"{c} < 0", "product_text")
        for c in (
            "product_name_lenght",
            "product_description_lenght",
            "product_photos_qty",
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        )
    ]
)
ITEM_NUMBERS = union(
    rows_check("price_non_negative", "order_items", "validity", "l_extendedprice < 0", "lineitem"),
    rows_check("freight_value_non_negative", "order_items", "validity", "l_quantity < 0", "lineitem"),
)
GEO_RANGES = union(
    rows_check(
        "geolocation_lat_range", "geolocation", "validity", "c_acctbal not between -90 and 90", POINTS
    ),
    rows_check(
        "geolocation_lng_range",
        "geolocation",
        "validity",
        "c_custkey not between -180 and 180",
        POINTS,
    ),
)
SCORE_RANGE = rows_check(
    "review_score_range", "reviews", "validity", "quality + 4 not between 1 and 5", REVIEW_ROWS
)
STATUS_VALUES = rows_check(
    "order_status_accepted_values", "orders", "validity", "o_orderstatus is not null", "orders"
)
UNIQUE_ITEMS = unique_check(
    "order_items", "order_id_order_item_id", "l_orderkey, l_linenumber", "lineitem"
)
UNIQUE_ORDERS = unique_check("orders", "order_id", "o_orderkey", "orders")
ORDER_CUSTOMER = fk_check(
    "orders_customer_exists", "orders", "orders", "o_custkey", KNOWN_CUSTOMERS
)
PAYMENT_ORDER = fk_check(
    "payments_order_exists",
    "payments",
    "(select event_id // 4 as order_id from events)",
    "order_id",
    "select o_orderkey from orders",
)
CONTRACT = union(
    *NOT_EMPTY.values(),
    *REQUIRED.values(),
    not_null(
        "customers",
        "customer",
        ["customer_id", "customer_unique_id"],
    ),
    unique_check("customers", "customer_id", "c_custkey", "customer"),
    not_null(
        "orders", "orders", ["order_id", "customer_id", "order_status", "order_purchase_timestamp"]
    ),
    UNIQUE_ORDERS,
    STATUS_VALUES,
    ITEM_NOT_NULL,
    UNIQUE_ITEMS,
    ITEM_NUMBERS,
    not_null(
        "payments", "events", ["order_id", "payment_sequential", "payment_type", "payment_value"]
    ),
    unique_check("payments", "order_id_payment_sequential", "event_id", "events"),
    rows_check("payment_installments_non_negative", "payments", "validity", "user_id < 0", "events"),
    rows_check("payment_value_non_negative", "payments", "validity", "value < 0", "events"),
    REVIEW_NOT_NULL,
    SCORE_RANGE,
    not_null("products", "part", ["product_id"]),
    unique_check("products", "product_id", "p_partkey", "part"),
    PRODUCT_NUMBERS,
    not_null("sellers", "supplier", ["seller_id"]),
    unique_check("sellers", "seller_id", "s_suppkey", "supplier"),
    not_null(
        "geolocation",
        POINTS,
        ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"],
    ),
    GEO_RANGES,
    not_null(
        "category_translation",
        "stg_category_translation",
        ["product_category_name", "product_category_name_english"],
    ),
    unique_check(
        "category_translation",
        "product_category_name",
        "product_category_name",
        "stg_category_translation",
    ),
    ORDER_CUSTOMER,
    fk_check(
        "order_items_order_exists",
        "order_items",
        "lineitem",
        "l_orderkey",
        "select o_orderkey from orders",
    ),
    fk_check(
        "order_items_product_exists",
        "order_items",
        "lineitem",
        "l_partkey",
        "select p_partkey from part where p_size % 25 <> 0",
    ),
    fk_check(
        "order_items_seller_exists",
        "order_items",
        "lineitem",
        "l_suppkey",
        "select s_suppkey from supplier where s_acctbal >= 0",
    ),
    PAYMENT_ORDER,
    fk_check(
        "reviews_order_exists",
        "reviews",
        "documents",
        "doc_id",
        "select o_orderkey from orders",
        "WARN",
    ),
)


def of_contract(names: str) -> str:
    """The contract's results whose name is like ``names``."""
    return f"select * from ({CONTRACT}) where test_name like '{names}' escape '\\' and dimension <> 'availability'"


def audit(
    name: str, table: str, dimension: str, severity: str, failed: str, total: str, source: str,
    passed: str = "failed_rows = 0",
) -> str:
    return f"""select '{name}' as test_name, '{table}' as table_name,
        '{dimension}' as quality_dimension, '{severity}' as severity,
        case when {passed} then 'PASS' else '{severity}' end as status, failed_rows, total_rows,
        case when total_rows = 0 then 0::decimal(12,6) else
            (((2000000::hugeint * failed_rows + total_rows) // (2 * total_rows))::decimal(18,0)
             * 0.000001::decimal(7,6))::decimal(12,6) end as failure_rate
        from (select ({failed})::bigint as failed_rows, ({total})::bigint as total_rows
              from {source})"""


def grain_audit(table: str, keys: str, source: str) -> str:
    groups = f"(select count(*) as n from {source} group by {keys})"
    return audit(
        f"{table}_grain_unique", table, "uniqueness", "ERROR", "count(*) filter (n > 1)", "sum(n)",
        groups,
    )


def counts(staged: str, fact: str) -> str:
    return (
        f"(select (select count(*) from {staged}) as staging_rows,"
        f" (select count(*) from {fact}) as fact_rows)"
    )


def profile_column(table: str, column: str, kind: str, name: str | None = None) -> str:
    return f"""select '{name or column}' as column_name, '{kind}' as inferred_type,
        count(*) - count({column}) as null_count,
        round((count(*) - count({column})) * 100.0::double / count(*), 4) as null_percent,
        count(distinct {column}) as distinct_count from {table}"""


def sample(column: str) -> str:
    return f"""(select '{column}' as column_name, {column}::varchar as sample_value from orders
        where {column} is not null order by o_orderkey limit 3)"""


LATE_ITEMS = """from stg_order_items i join stg_orders o on o.order_id = i.order_id
    where shipping_limit_date > order_purchase_timestamp + to_days(365)"""
ANY_UNKNOWN = "customer_key = -1 or product_key = -1 or seller_key = -1"


def failing(test: ModelTest) -> str:
    """(failed_rows, failing_key, n_records) of one declared test."""
    model, column = test.model, test.columns[0] if test.columns else ""
    order = "order_id" if model.startswith(("stg_o", "stg_pay", "fact_")) else "null::varchar"
    if test.kind == "not_null":
        return f"select 1, {order}, null from {model} where {column} is null"
    if test.kind == "unique":
        keys = ", ".join(test.columns)
        shown = f"{column}::varchar"
        known = f"where {column} is not null" if len(test.columns) == 1 else ""
        return f"select 1, {shown}, count(*) from {model} {known} group by {keys} having count(*) > 1"
    if test.kind == "relationships":
        parent, field = test.parent
        return f"""select count(*), {column}::varchar, count(*) from {model}
            where {column} is not null and {column} not in (select {field} from {parent}) group by {column}"""
    if test.kind == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in test.accepted)
        return f"select 1, {column}, count(*) from {model} where {column} not in ({listed}) group by {column}"
    return {
        "order_delivery_after_purchase": f"select 1, order_id, null from {model} where order_delivered_customer_date < order_purchase_timestamp",
        "shipping_limit_reasonable": f"select 1, i.order_id, null {LATE_ITEMS}",
        "unknown_dimension_rate": f"""select 1, unknown_rows::varchar, null from (select count(*) filter ({ANY_UNKNOWN}) as unknown_rows,
            count(*) as total_rows from fact_order_items) where unknown_rows * 100 > total_rows""",
        "fact_order_items_reconciliation": f"""select 1, null, null from {counts("stg_order_items", "fact_order_items")}
            where staging_rows <> fact_rows""",
        "fact_payments_reconciliation": f"""select 1, null, null from {counts("stg_payments", "fact_payments")}
            where staging_rows <> fact_rows""",
    }[test.name]


FAILURES = "\nunion all\n".join(
    f"""select '{t.name}' as test_name, failed_rows::bigint as failed_rows, failing_key::varchar as failing_key, n_records::bigint as n_records
    from ({failing(t)}) as f(failed_rows, failing_key, n_records)"""
    for t in declared_tests()
)
DECLARED = ", ".join(f"('{t.name}', '{t.model}', '{t.kind}', '{t.severity}')" for t in declared_tests())

QUERIES = {
    "model_tests": f"""
        select d.test_name, model, kind, severity, case when n > 0 then severity else 'PASS' end as status,
               coalesce(n, 0)::bigint as failed_rows
        from (values {DECLARED}) as d(test_name, model, kind, severity)
        left join (select test_name, sum(failed_rows) as n from ({FAILURES}) group by 1) f on f.test_name = d.test_name""",
    "test_failures": FAILURES,
    "reconcile_files": """
        select dataset, source_count, target_count,
               case when source_count = target_count then 'PASS' else 'ERROR' end as status
        from (select 'documents' as dataset, count(*) as source_count, count(*) as target_count from documents
              union all select 'order_items', count(*), count(*) from lineitem
              union all select 'payments', count(*), count(*) filter (event_type <> 'click') from events)""",
    "read_quoted_csv": """
        select doc_id::varchar as doc_id, text, lang, source, n_chars::varchar as n_chars from documents""",
    "quality_report": f"""
        select '2024-01-02T00:00:00+00:00' as generated_at_utc, count(*) over () as total_checks,
               count(*) filter (status = 'PASS') over () as passed, count(*) filter (status = 'WARN') over () as warnings,
               count(*) filter (status = 'ERROR') over () as errors, test_name, dataset, status, failed_rows, total_rows
        from ({CONTRACT})""",
    "increment_order_items": "select * from fact_order_items",
    "increment_order_lifecycle": "select * from fact_order_lifecycle",
    "stored_upsert": UPSERTED,
    "category_orders_bucketed": "select * from mart_category_performance",
    "profile_duplicates": """
        select sum(n)::bigint as row_count, 11::bigint as column_count, sum(n - 1)::bigint as duplicate_rows
        from (select count(*) as n from (select * from lineitem union all select * from lineitem where l_linenumber = 1)
              group by l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                  l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)""",
    "raw_stamp_batch": """
        select o_orderkey::varchar as order_id, o_orderstatus as order_status,
               'orders.parquet' as source_file, 'batch-1' as batch_id,
               timestamp '2024-02-01 06:00:00' as loaded_at, o_orderdate as source_updated_at
        from orders""",
    "clean_blank_to_null": """
        select case when p_size % 25 = 0 then 'x' || p_partkey else p_partkey::varchar end as product_id,
               case when p_size % 10 <> 0 then p_brand end as category,
               p_size % 7 = 0 as description_is_blank
        from part""",
    "cast_strict": """
        select l_orderkey as order_number, l_linenumber::smallint as item_number,
               l_shipdate as shipping_limit, l_extendedprice::decimal(12,2) as price,
               l_quantity as freight
        from lineitem""",
    "stable_key": f"""
        select order_id, {key("order_id")} as order_key,
               {key("order_id || '|' || customer_id")} as pair_key,
               {key("case when order_status <> 'canceled' then customer_id end")} as nullable_key
        from stg_orders""",
    "date_key": f"""
        select order_id, {day_key("order_purchase_timestamp")} as purchase_date_key,
               {day_key("order_approved_at")} as approved_date_key,
               {day_key("order_delivered_customer_date")} as delivered_date_key
        from stg_orders""",
    "duration_metrics": """
        select order_id, approval_duration_minutes, delivery_duration_hours, delivery_delay_days
        from fact_order_lifecycle""",
    "duration_metrics_rounded": f"""
        select order_id,
               {span("order_purchase_timestamp", "order_approved_at", 60_000_000,
                     "decimal(14,2)", 2)} as approval_duration_minutes,
               {span("order_purchase_timestamp", "order_delivered_customer_date", 3_600_000_000,
                     "decimal(14,2)", 2)} as delivery_duration_hours,
               {span("order_estimated_delivery_date", "order_delivered_customer_date",
                     86_400_000_000, "decimal(14,2)", 2)} as delivery_delay_days
        from stg_orders""",
    "late_flag": "select order_id, is_delivered_late from fact_order_lifecycle",
    "record_updated_at_greatest": """
        select order_id, order_item_id, record_updated_at from fact_order_items""",
    "safe_ratio": f"""
        select order_purchase_timestamp::date as purchase_day,
               {rate("count(*) filter (order_status = 'canceled')",
                     "count(*) filter (order_status = 'delivered')")} as ratio
        from stg_orders group by 1""",
    "join_items_orders": """
        select i.order_id, order_item_id, product_id, price, customer_id, order_status
        from stg_order_items i join stg_orders o on o.order_id = i.order_id""",
    "fk_lookup_unknown": """
        select o.order_id, o.customer_id, coalesce(customer_key, -1) as customer_key
        from stg_orders o left join customer_keys c on c.customer_id = o.customer_id""",
    "fk_lookup_late_dimensions": f"""
        select order_id, order_item_id, product_id, seller_id,
               case when p_size > 10 and p_size % 25 <> 0 then {key("product_id")} else -1 end as product_key,
               case when s_acctbal >= 0 then {key("seller_id")} else -1 end as seller_key
        from stg_order_items left join part on p_partkey::varchar = product_id
        left join supplier on s_suppkey::varchar = seller_id""",
    "enrich_geo": """
        select customer_id, customer_zip_code_prefix, latitude, city
        from stg_customers left join stg_geolocation
          on geolocation_zip_code_prefix = customer_zip_code_prefix""",
    "translate_category": """
        select product_id, category_name, category_name_english from dim_product""",
    "join_preaggregated": """
        select order_id, item_count, merchandise_value, freight_value, payment_value
        from order_sums""",
    "role_playing_dates": """
        select f.order_id, f.purchase_date_key, f.approved_date_key, f.delivered_date_key,
               p.day_name as purchase_day_name, p.week_of_year as purchase_week_of_year,
               a.day_name as approved_day_name, a.week_of_year as approved_week_of_year,
               d.day_name as delivered_day_name, d.week_of_year as delivered_week_of_year
        from fact_order_lifecycle f
        left join dim_date p on p.date_key = f.purchase_date_key
        left join dim_date a on a.date_key = f.approved_date_key
        left join dim_date d on d.date_key = f.delivered_date_key""",
    "fk_anti_join": f"""
        select o_custkey::varchar as customer_id, count(*) as order_count from orders
        where o_custkey not in ({KNOWN_CUSTOMERS}) group by 1""",
    "join_residual_interval": f"""
        select i.order_id, order_item_id, shipping_limit_date, order_purchase_timestamp
        {LATE_ITEMS}""",
    "order_item_totals": "select * from item_sums",
    "payment_totals": "select * from payment_sums",
    "geo_representative": "select * from stg_geolocation",
    "filtered_counts": """
        select purchase_date_key, count(*) as orders,
               count(*) filter (is_delivered_late) as late_orders,
               count(*) filter (is_cancelled) as cancelled_orders,
               count(order_delivered_customer_date) as delivered_orders
        from fact_order_lifecycle group by 1""",
    "decimal_avg": f"""
        select order_id, {mean("price")} as average from stg_order_items group by order_id""",
    "latest_version_rows": """
        select * exclude (version) from (
            select *, row_number() over (
                partition by l_orderkey, l_linenumber
                order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_quantity desc,
                         l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc,
                         l_linestatus desc) as version
            from lineitem) where version = 1""",
    "status_share": f"""
        select order_status, count(*) as order_count,
               {rate("count(*)", "sum(count(*)) over ()")} as order_share
        from stg_orders group by 1""",
    "grain_duplicates": """
        select l_orderkey, l_linenumber, count(*) as duplicate_count from lineitem
        group by 1, 2 having count(*) > 1""",
    "duplicate_rows_all": """
        select coalesce(sum(n) filter (n > 1), 0)::bigint as rows_in_duplicate_groups,
               sum(n)::bigint as total_rows
        from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)""",
    "duplicate_full_rows": """
        select sum(n)::bigint as row_count, sum(n - 1)::bigint as duplicate_rows
        from (select count(*) as n from lineitem group by l_partkey, l_suppkey, l_quantity)""",
    "source_dates_union": """
        select source_date, count(*) as occurrences from source_dates group by 1""",
    "date_bounds": """
        select min(source_date) as first_day, max(source_date) as last_day from source_dates""",
    "dim_with_unknown": "select seller_key, seller_id, city, state from dim_seller",
    "upsert_delete_insert": UPSERTED,
    "idempotent_replay": UPSERTED,
    "schema_sync_upsert": """
        select o_orderkey, total_price, o_orderdate, null::integer as order_year from order_target
        where o_orderkey not in (select o_orderkey from order_delta)
        union all
        select o_orderkey, total_price, o_orderdate, year(o_orderdate)::integer from order_delta""",
    "high_watermark_rows": f"""
        select 'events' as dataset, max(ts) as watermark from events
        union all select 'empty', {EPOCH}""",
    "incremental_extract": """
        select event_id::varchar as event_id, user_id::varchar as user_id, event_type,
               ts as updated_at
        from events where ts > timestamp '2024-01-10 00:00:00'
                      and ts <= timestamp '2024-01-20 00:00:00'""",
    "seed_watermarks": MARKS,
    "watermark_upsert": f"""
        select dataset_name, watermark_value, 0::bigint as rows_extracted
        from ({MARKS}) where dataset_name <> 'payments'
        union all
        select 'payments', max(ts), count(*) from events
        where ts > timestamp '2024-01-20 00:00:00'""",
    "readiness_gate": """
        select distinct event_type as dataset_name from events
        where left(event_type, 1) not in ('c', 'p')""",
    "changed_current_rows": """
        select * from stg_order_items where record_updated_at > timestamp '2001-01-01 00:00:00'""",
    "incremental_model_delta": """
        select * from fact_order_items where record_updated_at > timestamp '2001-01-01 00:00:00'""",
    "incremental_lifecycle_delta": """
        select * exclude (order_key) from fact_order_lifecycle
        where record_updated_at > timestamp '2001-01-01 00:00:00'""",
    "incremental_payment_delta": """
        select * from fact_payments where record_updated_at > timestamp '2024-01-20 00:00:00'""",
    "incremental_fact_upsert": "select * from fact_payments",
    "bi_kpi_cards": """
        select total_revenue, total_orders, average_order_value, late_delivery_rate
        from mart_executive_kpis""",
    "bi_daily_trend": "select full_date, revenue, order_count from mart_sales_daily",
    "bi_monthly_revenue": """
        select year_number, month_number, sum(revenue)::decimal(16,2) as revenue,
               sum(order_count)::bigint as order_count
        from mart_sales_daily group by 1, 2""",
    "top_categories": """
        select category_name, merchandise_revenue from mart_category_performance
        order by merchandise_revenue desc, category_name limit 10""",
    "bi_top_states_revenue": "select customer_state, revenue from mart_state_performance",
    "bi_status_distribution": "select order_status, order_count, order_share from mart_order_status",
    "top_late_states": """
        select customer_state, order_count, late_delivery_rate from mart_state_performance
        where order_count >= 100
        order by late_delivery_rate desc nulls last, customer_state limit 10""",
    "bi_historical_cutoff": "select * from mart_sales_daily where full_date < date '2000-01-01'",
    "bi_date_state_filters": """
        select 'period' as filter, sum(order_count)::bigint as n from mart_sales_daily
        where full_date between date '1998-01-01' and date '1998-06-30'
        union all
        select 'states', sum(order_count)::bigint from mart_state_performance
        where customer_state in ('NATION_1', 'NATION_2')""",
    "dq_not_empty": union(*NOT_EMPTY.values()),
    "dq_required_columns": union(
        *[check for name, check in REQUIRED.items() if name != "payments"],
        fixed("required_columns", "payments", "schema", 1, 5),
    ),
    "dq_not_null": of_contract("%\\_not\\_null"),
    "dq_unique": of_contract("%\\_unique"),
    "dq_accepted_values": STATUS_VALUES,
    "dq_non_negative": of_contract("%\\_non\\_negative"),
    "dq_range": union(GEO_RANGES, SCORE_RANGE),
    "dq_foreign_key": union(
        of_contract("%\\_exists"),
        fk_check(
            "documents_label_exists",
            "documents",
            "documents",
            "doc_id",
            "select doc_id from labels",
            "WARN",
        ),
    ),
    "dq_contract": CONTRACT,
    "check_summary": f"""
        select count(*) as total_checks, count(*) filter (status = 'PASS') as passed,
               count(*) filter (status = 'WARN') as warnings,
               count(*) filter (status = 'ERROR') as errors
        from ({CONTRACT})""",
    "test_not_null": "select review_id from stg_reviews where review_score is null",
    "test_unique": """
        select l_partkey, count(*) as duplicate_count from lineitem
        group by 1 having count(*) > 1""",
    "test_relationships": f"""
        select o_custkey::varchar as customer_id, count(*) as row_count from orders
        where o_custkey not in ({KNOWN_CUSTOMERS}) group by 1""",
    "test_accepted_values": """
        select order_status, count(*) as row_count from stg_orders
        where order_status not in ('delivered', 'shipped') group by 1""",
    "unknown_rate_check": f"""
        select * from (select count(*) filter ({ANY_UNKNOWN}) as unknown_rows,
                              count(*) as total_rows from fact_order_items)
        where unknown_rows * 100 > total_rows""",
    "check_delivery_after_purchase": """
        select order_id, order_purchase_timestamp, order_delivered_customer_date
        from fact_order_lifecycle
        where order_delivered_customer_date < order_purchase_timestamp""",
    "reconcile_items": f"select * from {counts('stg_order_items', 'fact_order_items')}",
    "reconcile_payments": f"select * from {counts('stg_payments', 'fact_payments')}",
    "reconcile_raw": """
        select dataset, source_count, target_count,
               case when source_count = target_count then 'PASS' else 'ERROR' end as status
        from (select 'orders' as dataset, count(*) as source_count, count(*) as target_count
              from orders
              union all select 'payments', count(*), count(*) from events
              union all select 'order_items', count(*) filter (l_quantity < 50), count(*)
              from lineitem)""",
    "payment_grain_check": grain_audit("stg_payments", "order_id, payment_sequential", "stg_payments"),
    "warehouse_check_rows": union(
        grain_audit("fact_order_items", "order_id, order_item_id", "fact_order_items"),
        audit(
            "fact_order_items_row_reconciliation",
            "fact_order_items",
            "consistency",
            "ERROR",
            "abs(staging_rows - fact_rows)",
            "staging_rows",
            counts("stg_order_items", "fact_order_items"),
        ),
        audit(
            "fact_payments_row_reconciliation",
            "fact_payments",
            "consistency",
            "ERROR",
            "abs(staging_rows - fact_rows)",
            "staging_rows",
            counts("stg_payments", "fact_payments"),
        ),
        audit(
            "order_delivery_after_purchase",
            "fact_order_lifecycle",
            "validity",
            "ERROR",
            "count(*) filter (order_delivered_customer_date < order_purchase_timestamp)",
            "count(*)",
            "fact_order_lifecycle",
        ),
        audit(
            "unknown_dimension_rate",
            "fact_order_items",
            "integrity",
            "WARN",
            f"count(*) filter ({ANY_UNKNOWN})",
            "count(*)",
            "fact_order_items",
            "failed_rows * 100 <= total_rows",
        ),
        audit(
            "shipping_limit_reasonable",
            "stg_order_items",
            "validity",
            "WARN",
            "count(*) filter (shipping_limit_date > order_purchase_timestamp + to_days(365))",
            "count(*)",
            "stg_order_items i join stg_orders o on o.order_id = i.order_id",
        ),
    ),
    "latest_run_results": f"""
        select test_name, table_name, quality_dimension, status, failed_rows, total_rows from (
            {union(grain_audit("order_items", "l_orderkey, l_linenumber", "lineitem"),
                   grain_audit("orders", "o_orderkey", "orders"))})""",
    "profile_table": """
        select sum(n)::bigint as row_count, 11::bigint as column_count,
               sum(n - 1)::bigint as duplicate_rows
        from (select count(*) as n from lineitem group by all)""".replace(
        "group by all",
        "group by l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,"
        " l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate",
    ),
    "profile_columns": union(
        *[profile_column("lineitem", c, "int64") for c in
          ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
        *[profile_column("lineitem", c, "float64") for c in
          ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        *[profile_column("lineitem", c, "object") for c in ("l_returnflag", "l_linestatus")],
    ),
    "profile_text_columns": union(
        profile_column("product_text", "product_id", "object"),
        profile_column("product_text", "product_category_name", "object"),
        profile_column("product_text", "product_name_lenght", "int64"),
        profile_column("product_text", "product_description_lenght", "float64"),
        profile_column("product_text", "product_photos_qty", "int64"),
        profile_column("product_text", "product_weight_g", "float64"),
        profile_column("product_text", "product_length_cm", "int64"),
        profile_column("product_text", "product_height_cm", "float64"),
        profile_column("product_text", "product_width_cm", "float64"),
    ),
    "profile_samples": union(
        *[
            sample(c)
            for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
        ]
    ),
}
for _name in (
    "stg_customers",
    "stg_orders",
    "stg_order_items",
    "stg_payments",
    "stg_reviews",
    "stg_products",
    "stg_sellers",
    "stg_category_translation",
    "dim_date",
    "dim_customer",
    "dim_product",
    "dim_seller",
    "fact_order_items",
    "fact_payments",
    "fact_order_lifecycle",
    "mart_executive_kpis",
    "mart_sales_daily",
    "mart_category_performance",
    "mart_state_performance",
    "mart_order_status",
):
    QUERIES[_name] = f"select * from {_name}"


def _needed(text: str) -> list[str]:
    """Names of the table expressions a text uses, in dependency order."""
    found: list[str] = []
    for name, body in TABLES.items():
        if re.search(rf"\b{name}\b", text) and name not in found:
            for inner in _needed(body):
                if inner not in found:
                    found.append(inner)
            found.append(name)
    return found


def oracle_sql() -> dict[str, str]:
    texts = {}
    for name, body in QUERIES.items():
        tables = _needed(body)
        # A quoted table name in a check row also matches; an unused expression costs nothing.
        prefix = ",\n".join(f"{t} as ({TABLES[t]})" for t in tables)
        texts[name] = f"with {prefix}\n{body}" if tables else body
    return texts
