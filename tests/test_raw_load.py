import csv
import datetime as dt
import hashlib
import pathlib

import pytest

from lakemart.sources import csv_files
from lakemart.sources.raw_load import load_raw, raw_frames, reconcile_raw


def test_load_all_files_as_text(spark, lake, data_dir):
    batch = load_raw(lake, data_dir)
    raw = raw_frames(lake)
    assert len(raw) == 9
    orders = raw["orders"]
    assert orders.columns[-4:] == ["source_file", "batch_id", "loaded_at", "source_updated_at"]
    row = orders.filter("order_id = 'o3'").first()
    assert row["order_approved_at"] is None
    assert (row["source_file"], row["batch_id"]) == ("x_orders_dataset.csv", batch)
    assert orders.select("loaded_at").distinct().count() == 1
    review = raw["reviews"].filter("review_id = 'r1'").first()
    assert review["review_comment_message"] == 'two "quoted"\nlines, here'
    # the load keeps the text NA; only contract checks read it as missing
    assert raw["customers"].filter("customer_city = 'NA'").count() == 1


def test_history_and_fingerprints(spark, lake, data_dir):
    load_raw(lake, data_dir)
    history = {r["dataset_name"]: r for r in lake.read("audit.load_history").collect()}
    assert len(history) == 9
    path = pathlib.Path(data_dir) / "x_order_items_dataset.csv"
    assert history["order_items"]["file_sha256"] == hashlib.sha256(path.read_bytes()).hexdigest()
    assert history["order_items"]["row_count"] == 3
    assert {r["load_status"] for r in history.values()} == {"SUCCESS"}


def test_guard_replace_and_missing_file(spark, lake, data_dir):
    first = load_raw(lake, data_dir)
    with pytest.raises(RuntimeError, match="replace=True"):
        load_raw(lake, data_dir)
    second = load_raw(lake, data_dir, replace=True)
    assert first != second
    assert lake.read("raw.orders").count() == 3
    assert lake.read("audit.load_history").count() == 18
    (pathlib.Path(data_dir) / "x_sellers_dataset.csv").rename(pathlib.Path(data_dir) / "gone.txt")
    version = lake.state()[0]
    with pytest.raises(FileNotFoundError):
        load_raw(lake, data_dir, replace=True)
    assert lake.state()[0] == version


def test_columns_by_position_or_by_name(spark, lake, data_dir, tmp_path):
    path = pathlib.Path(data_dir) / "x_sellers_dataset.csv"
    path.write_text("seller_state,seller_id,seller_city,seller_zip_code_prefix\nSP,s1,sp,01\n")
    load_raw(lake, data_dir)
    assert lake.read("raw.sellers").first()["seller_id"] == "SP"
    load_raw(lake, data_dir, replace=True, by_name=True)
    assert lake.read("raw.sellers").first()["seller_id"] == "s1"


def test_reconciliation(spark, lake, data_dir):
    load_raw(lake, data_dir)
    results = reconcile_raw(lake, data_dir).collect()
    assert len(results) == 9
    assert {r["status"] for r in results} == {"PASS"}
    with open(pathlib.Path(data_dir) / "x_sellers_dataset.csv", "a") as stream:
        stream.write("s3,1,x,SP\n")
    bad = {r["dataset"]: r for r in reconcile_raw(lake, data_dir).collect()}["sellers"]
    assert (bad["source_count"], bad["target_count"], bad["status"]) == (3, 2, "ERROR")


def test_many_files_per_dataset(spark, lake, data_dir):
    extra = pathlib.Path(data_dir) / "y_sellers_dataset.csv"
    extra.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns9,1,x,SP\n")
    load_raw(lake, data_dir)
    files = lake.read("raw.sellers").groupBy("source_file").count().collect()
    assert {r[0]: r[1] for r in files} == {"x_sellers_dataset.csv": 2, "y_sellers_dataset.csv": 1}
    assert lake.read("audit.load_history").filter("dataset_name = 'sellers'").count() == 2


def test_row_count_and_sizes(spark, data_dir):
    path = pathlib.Path(data_dir) / "x_order_reviews_dataset.csv"
    with path.open(newline="") as stream:
        expected = sum(1 for _ in csv.reader(stream)) - 1
    assert csv_files.row_count(spark, [str(path)]) == expected == 2
    sizes = csv_files.file_sizes(spark, [str(path)]).collect()
    assert [tuple(r) for r in sizes] == [(path.name, path.stat().st_size)]


def test_fingerprint_of_large_files_keeps_order_and_ignores_splits(spark, tmp_path):
    texts = {"a": "1\n2\n3\n", "copy": "1\n2\n3\n", "moved": "3\n1\n2\n", "changed": "1\n2\n4\n", "open": "1\n2\n3", "blank": "1\n2\n\n3\n"}
    texts |= {"long": "line,with,fields\n" * 4000, "other": "line,with,fields\n" * 3999 + "line,with,Fields\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text)
    paths = [str(tmp_path / f"{name}.csv") for name in texts]

    def found():
        return {r["file"].removesuffix(".csv"): r["sha256"] for r in csv_files.fingerprints(spark, paths, 0).collect()}

    got = found()
    assert got["a"] == got["copy"]
    assert len({v for name, v in got.items() if name != "copy"}) == len(texts) - 1
    assert all(len(v) == 64 for v in got.values())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert found() == got
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_report(spark, data_dir, tmp_path):
    frames = spark.createDataFrame([("a", 1)], "name string, n int")
    csv_files.write_report(frames, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 1
    at = dt.datetime(2026, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)
    assert csv_files.report_name("profile", at) == "profile_20260102T030405Z.json"
    with pytest.raises(FileNotFoundError):
        csv_files.require_files(spark, data_dir, "*.xml")


@pytest.mark.parametrize("body", ["1,x,EXTRA\n", "2\n"])
def test_rows_of_another_width_stop_the_read(spark, tmp_path, body):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n" + body)
    paths = [str(tmp_path / "a.csv")]
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_files.read_by_position(spark, paths, ["id", "name"]).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_files.row_count(spark, paths)


def test_files_with_other_headers_stop_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,id\nz,3\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    with pytest.raises(Exception, match="(?i)header"):
        csv_files.read_by_name(spark, paths).collect()
