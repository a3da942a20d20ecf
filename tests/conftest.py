import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from lakemart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__sql__execution__arrow__pyspark__enabled="true",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


FILES = {
    "x_customers_dataset.csv": (
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,01001,sao paulo,SP\n"
        "c2,u2,01002,  ,RJ\n"
        "c3,u3,,NA,SP\n"
    ),
    "x_orders_dataset.csv": (
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2018-01-05 10:00:00,2018-01-05 10:30:00,2018-01-06 00:00:00,"
        "2018-01-10 10:00:00,2018-01-09 00:00:00\n"
        "o2,c2,shipped,2018-02-01 08:00:00,2018-02-01 09:00:00,2018-02-02 00:00:00,,"
        "2018-02-20 00:00:00\n"
        "o3,c9,canceled,2018-02-03 00:00:00,,,,2018-02-25 00:00:00\n"
    ),
    "x_order_items_dataset.csv": (
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2018-01-08 00:00:00,10.00,1.50\n"
        "o1,2,p2,s1,2018-01-08 00:00:00,20.00,2.50\n"
        "o2,1,p1,s2,2019-06-01 00:00:00,5.55,0.45\n"
    ),
    "x_order_payments_dataset.csv": (
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1,Credit_Card,2,30.00\n"
        "o1,2,voucher,1,4.00\n"
        "o2,1,boleto,1,6.00\n"
    ),
    "x_order_reviews_dataset.csv": (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,ok,"two ""quoted""\nlines, here",2018-01-11 00:00:00,2018-01-12 00:00:00\n'
        "r2,o7,1,,,2018-02-11 00:00:00,2018-02-12 00:00:00\n"
    ),
    "x_products_dataset.csv": (
        "product_id,product_category_name,product_name_lenght,product_description_lenght,"
        "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "p1,beleza,10,100,1,50,1.5,2,3\n"
        "p2,moveis,12,,2,70,1,2,3\n"
        "p3,,,,,,,,\n"
    ),
    "x_sellers_dataset.csv": (
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
        "s1,01001,sao paulo,SP\n"
        "s2,09999,santos,SP\n"
    ),
    "x_geolocation_dataset.csv": (
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,"
        "geolocation_state\n"
        "01001,-23.50,-46.60,sao paulo,SP\n"
        "01001,-23.60,-46.70,osasco,SP\n"
        "01002,-22.90,-43.20,rio,RJ\n"
    ),
    "product_category_name_translation.csv": (
        "product_category_name,product_category_name_english\nbeleza,beauty\n"
    ),
}


@pytest.fixture
def data_dir(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


@pytest.fixture
def lake(spark, tmp_path):
    from lakemart.sources.lake import Lake

    return Lake(spark, str(tmp_path / "lake"))
