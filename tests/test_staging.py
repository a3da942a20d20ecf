import pytest

from lakemart.plans.staging import stage

RAW = (
    "order_id string, order_item_id string, product_id string, seller_id string,"
    " shipping_limit_date string, price string, freight_value string, batch_id string,"
    " loaded_at timestamp_ntz, source_updated_at timestamp_ntz"
)


def raw(spark, rows):
    import datetime as dt

    def time(day):
        return None if day is None else dt.datetime(2020, 1, day)

    full = [
        (o, i, "p", "s", "2020-01-01 00:00:00", price, "1", batch, time(loaded), time(changed))
        for o, i, price, batch, loaded, changed in rows
    ]
    return spark.createDataFrame(full, RAW)


def prices(spark, rows):
    staged = stage("order_items", raw(spark, rows)).collect()
    return {(r["order_id"], r["order_item_id"]): str(r["price"]) for r in staged}


def test_newest_source_time_wins_then_load_time(spark):
    assert prices(
        spark,
        [
            ("a", "1", "1", "b1", 9, 2),
            ("a", "1", "2", "b1", 1, 3),
            ("a", "1", "3", "b1", 20, None),
            ("b", "1", "4", "b1", 5, None),
            ("b", "1", "5", "b2", 6, None),
        ],
    ) == {("a", 1): "2.00", ("b", 1): "5.00"}


def test_ties_are_broken_the_same_way_in_any_order(spark):
    rows = [("a", "1", str(p), "b1", 1, 1) for p in range(5)]
    assert prices(spark, rows) == prices(spark, rows[::-1]) == {("a", 1): "4.00"}


def test_keys_are_cleaned_before_ranking(spark):
    assert prices(spark, [("a", "1", "1", "b", 1, 1), (" a", "01", "2", "b", 1, 2)]) == {("a", 1): "2.00"}


def test_bad_value_matters_only_in_the_current_version(spark):
    assert prices(spark, [("a", "1", "bad", "b", 1, 1), ("a", "1", "2", "b", 1, 2)]) == {("a", 1): "2.00"}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        prices(spark, [("a", "1", "1", "b", 1, 1), ("a", "1", "bad", "b", 1, 2)])


def test_group_limit_runs_before_the_exchange(spark):
    staged = stage("order_items", raw(spark, [("a", "1", "1", "b", 1, 1)]))
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_lineage_columns(spark):
    staged = stage("order_items", raw(spark, [("a", "1", "1", "b", 1, 1)]), lineage=True)
    assert staged.columns[-3:] == ["record_updated_at", "batch_id", "loaded_at"]


def test_geolocation_point(spark):
    columns = (
        "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string,"
        " geolocation_city string, geolocation_state string, source_updated_at timestamp_ntz,"
        " loaded_at timestamp_ntz"
    )
    rows = [("01", "1.5", "", "b ", " ", None, None), ("1", "2.5", "7", " a", "S", None, None)]
    got = stage("geolocation", spark.createDataFrame(rows, columns)).first()
    assert (got[0], got["latitude"], got["longitude"], got["city"], got["state"]) == (1, 2.0, 7.0, "a", "S")


def test_large_coordinates_are_staged(spark):
    columns = "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string, geolocation_city string, geolocation_state string, source_updated_at timestamp_ntz, loaded_at timestamp_ntz"
    points = spark.createDataFrame([("1", "-20.5", "150000", "x", "SP", None, None)], columns)
    assert stage("geolocation", points).first()["longitude"] == 150000.0
