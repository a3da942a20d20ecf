"""Upserts into folders, bucketed facts, digests of rows, samples and bounds of extracts."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from lakemart.operators import profiles
from lakemart.plans import marts
from lakemart.sources import extracts
from lakemart.sources.folders import FOLDER, FolderTable, bucket_count, folder_count, folder_of, write_bucketed

UTC = dt.timezone.utc


def stamps(path):
    """Modification times of the files in each folder."""
    return {p.name: sorted(f.stat().st_mtime_ns for f in p.glob("*.parquet")) for p in pathlib.Path(path).glob(f"{FOLDER}=*")}


def test_an_upsert_leaves_most_folders_untouched(spark, tmp_path):
    rows = spark.range(100_000).selectExpr("id as k", "id % 7 as v", "cast(id as string) as s")
    folders = folder_count(100_000, rows_per_folder=50)
    table = FolderTable(spark, str(tmp_path / "t"), rows.schema, ["k"], "cast(k div 1000 as int)")
    table.overwrite(rows)
    before = stamps(tmp_path / "t")
    assert len(before) == 100
    changes = spark.range(42_000, 42_300).selectExpr("id as k", "100 + id as v", "'new' as s").union(
        spark.createDataFrame([(99_999, -1, "x"), (100_001, -2, "y")], "k bigint, v bigint, s string")
    )
    assert table.upsert(changes) == [42, 99, 100]
    after = stamps(tmp_path / "t")
    assert {f for f in before if before[f] == after[f]} == set(before) - {f"{FOLDER}=42", f"{FOLDER}=99"}
    got = {r["k"]: r["v"] for r in table.read().collect()}
    want = {k: k % 7 for k in range(100_000)} | {k: 100 + k for k in range(42_000, 42_300)} | {99_999: -1, 100_001: -2}
    assert got == want
    assert table.upsert(changes) == [42, 99, 100] and {r["k"]: r["v"] for r in table.read().collect()} == want  # replay
    assert table.upsert(changes.limit(0)) == []
    assert folders == 2000 and folder_of(["k"], folders) == "cast(pmod(xxhash64(`k`), 2000) as int)"


def test_a_key_moves_to_another_folder(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, 7)], "k int, month int")
    table = FolderTable(spark, str(tmp_path / "t"), rows.schema, ["k"], "month")
    table.overwrite(rows)
    assert table.upsert(spark.createDataFrame([(1, 6)], "k int, month int")) == [5, 6]
    assert sorted(map(tuple, table.read().collect())) == [(1, 6), (2, 5), (3, 6), (4, 7)]
    with pytest.raises(ValueError, match="last row"):
        table.upsert(spark.createDataFrame([(4, 6)], "k int, month int"))


def test_the_mart_over_bucketed_facts_does_not_shuffle_items(spark, tmp_path):
    items = spark.range(400).selectExpr(
        "cast(id div 3 as string) as order_id", "id % 5 as product_key", "1 as quantity",
        "cast(id as decimal(12,2)) as item_price", "cast(1 as decimal(12,2)) as freight_value", "cast(id + 1 as decimal(12,2)) as total_item_value",
    )
    products = spark.createDataFrame([(i, f"c{i % 2}") for i in range(5)], "product_key bigint, category_name_english string")
    products.write.parquet(str(tmp_path / "p"))
    products = spark.read.parquet(str(tmp_path / "p"))  # of a known size
    held = write_bucketed(items, "bucketed_items", str(tmp_path / "b"), "order_id", 4)
    mart = marts.mart_category_performance(held, products)
    plan = mart._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "category_name" in exchanges[0] and "order_id" not in exchanges[0]
    expected = marts.mart_category_performance(items, products)
    assert sorted(map(tuple, mart.collect())) == sorted(map(tuple, expected.collect()))
    spark.sql("drop table bucketed_items")


def test_buckets_grow_in_number_and_not_in_rows(spark, tmp_path):
    assert (bucket_count(0), bucket_count(8_000_000), bucket_count(216_000_000)) == (8, 8, 216)
    most = {}
    for rows in (2_000, 20_000):
        items = spark.range(rows).selectExpr("cast(id div 3 as string) as order_id", "id as n")
        held = write_bucketed(items, f"bucketed_{rows}", str(tmp_path / str(rows)), "order_id", bucket_count(rows, 200))
        per_file = held.groupBy(F.input_file_name()).count()
        most[rows] = per_file.agg(F.max("count")).first()[0]
        assert held.count() == rows
        spark.sql(f"drop table bucketed_{rows}")
    assert most[20_000] < 2 * most[2_000] < 800


def test_copies_of_whole_rows_are_counted_by_digest(spark):
    rows = [(1, "a", 0.0), (1, "a", -0.0), (1, "a", 0.0), (None, "a", 1.0), ("x", None, None)]
    df = spark.createDataFrame([(str(a) if a else None, b, c) for a, b, c in rows] + [(None, None, None)] * 3, "a string, b string, c double")
    assert tuple(profiles.profile_table(df).first()) == (8, 3, 4)
    assert tuple(profiles.profile_table(df.limit(0)).first()) == (0, 3, 0)
    # Null then 'a', and 'a' then null, have one digest; they are no copies.
    pair = spark.createDataFrame([(None, "a"), ("a", None)], "a string, b string")
    assert profiles.profile_table(pair).first()["duplicate_rows"] == 0


def test_samples_come_from_one_scan_with_the_limit_before_the_exchange(spark, tmp_path):
    spark.range(50).selectExpr("id as k", "if(id < 45, null, id) as late", "'same' as s").write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    samples = profiles.sample_values(df, ["k"])
    plan = samples._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("WindowGroupLimit") == 2
    assert sorted(map(tuple, samples.collect())) == [
        ("k", "0"), ("k", "1"), ("k", "2"), ("late", "45"), ("late", "46"), ("late", "47"), ("s", "same"), ("s", "same"), ("s", "same"),
    ]


def test_a_fast_driver_clock_skips_no_row(spark, lake, monkeypatch):
    """The watermark follows the source's own change times."""
    ahead = dt.datetime(2100, 1, 1, tzinfo=UTC)
    monkeypatch.setattr(extracts, "utc_now", lambda: ahead)
    columns = extracts.COMMERCE_CONTRACT.datasets["sellers"].required_columns

    def source(*times):
        rows = [(*[f"s{i}"] * len(columns), t) for i, t in enumerate(times)]
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns) + ", updated_at timestamp")

    first, second = (dt.datetime(2024, 1, d, 12, tzinfo=UTC) for d in (1, 2))
    assert extracts.ingest(lake, "sellers", source(first))["rows_extracted"] == 1
    assert extracts.ingest(lake, "sellers", source(first))["rows_extracted"] == 0
    result = extracts.ingest(lake, "sellers", source(first, second))
    assert (result["rows_extracted"], result["new_watermark"]) == (1, second)
    assert extracts.ingest(lake, "sellers", source().limit(0))["new_watermark"] == second
    assert lake.read("raw.sellers").agg(F.count("*")).first()[0] == 2
