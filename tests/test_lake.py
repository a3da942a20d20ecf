import time

import pytest

from lakemart.sources.lake import RELEASE, ConcurrentCommitError, Lake


def values(df):
    return sorted(map(tuple, df.collect()))


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, month int, v string")


BY_MONTH = {"partition": "layout_month", "by": "month"}


def test_commit_covers_all_tables_or_none(spark, lake):
    with pytest.raises(RuntimeError, match="stop"):
        with lake.transaction() as tx:
            tx.append("a", frame(spark, [(1, 1, "x")]))
            raise RuntimeError("stop")
    assert lake.tables() == []
    with lake.transaction() as tx:
        tx.append("a", frame(spark, [(1, 1, "x")]))
        tx.overwrite("b", frame(spark, [(2, 1, "y")]))
        assert lake.tables() == []
    assert lake.tables() == ["a", "b"]


def test_second_writer_loses(spark, lake):
    first, second = lake.transaction(), lake.transaction()
    first.append("a", frame(spark, [(1, 1, "x")]))
    second.append("a", frame(spark, [(2, 1, "y")]))
    first.commit()
    with pytest.raises(ConcurrentCommitError):
        second.commit()
    assert values(lake.read("a")) == [(1, 1, "x")]


def test_reader_keeps_its_version(spark, lake):
    with lake.transaction() as tx:
        tx.overwrite("a", frame(spark, [(1, 1, "old")]))
    before = lake.read("a")
    with lake.transaction() as tx:
        tx.overwrite("a", frame(spark, [(1, 1, "new")]))
    assert values(before) == [(1, 1, "old")]
    assert values(lake.read("a")) == [(1, 1, "new")]


def test_upsert_rewrites_only_touched_partitions(spark, lake):
    with lake.transaction() as tx:
        tx.overwrite("f", frame(spark, [(1, 201801, "a"), (2, 201802, "b"), (3, 201803, "c"), (4, 201803, "d")]), **BY_MONTH)
    before = dict(map(reversed, lake.state()[1]["f"].folders))
    with lake.transaction() as tx:
        # key 2 moves to another month, key 3 changes, key 9 is new
        tx.upsert("f", frame(spark, [(2, 201804, "B"), (3, 201803, "C"), (9, 201801, "n")]), ["k"])
    state = lake.state()[1]["f"]
    after = {path for path, _ in state.folders}
    assert before["201801"] in after
    assert before["201802"] not in after and before["201803"] not in after
    assert values(lake.read("f")) == [
        (1, 201801, "a"),
        (2, 201804, "B"),
        (3, 201803, "C"),
        (4, 201803, "d"),
        (9, 201801, "n"),
    ]
    pruned = lake.read("f", layout=True).filter("layout_month = 201801")
    assert values(pruned.select("k")) == [(1,), (9,)]
    assert "PartitionFilters: [isnotnull(layout_month" in pruned._jdf.queryExecution().executedPlan().toString()


def test_upsert_twice_and_empty_delta(spark, lake):
    with lake.transaction() as tx:
        tx.overwrite("d", frame(spark, [(1, 1, "a"), (2, 1, "b")]))
    for _ in range(2):
        with lake.transaction() as tx:
            tx.upsert("d", frame(spark, [(2, 1, "B")]), ["k"])
        assert values(lake.read("d")) == [(1, 1, "a"), (2, 1, "B")]
    folders = lake.state()[1]["d"].folders
    with lake.transaction() as tx:
        tx.upsert("d", frame(spark, []), ["k"])
    assert lake.state()[1]["d"].folders == folders


def test_null_partition_value(spark, lake):
    with lake.transaction() as tx:
        tx.overwrite("f", frame(spark, [(1, None, "a"), (2, 201801, "b")]), **BY_MONTH)
    with lake.transaction() as tx:
        tx.upsert("f", frame(spark, [(1, 201801, "A")]), ["k"])
    assert values(lake.read("f")) == [(1, 201801, "A"), (2, 201801, "b")]


def test_added_and_dropped_columns(spark, lake):
    with lake.transaction() as tx:
        tx.overwrite("d", frame(spark, [(1, 1, "a"), (2, 1, "b")]))
        tx.append("raw", frame(spark, [(1, 1, "a")]))
    wide = spark.createDataFrame([(2, "B", 0.5)], "k int, v string, extra double")
    with lake.transaction() as tx:
        tx.upsert("d", wide, ["k"])
        tx.append("raw", wide)
    assert lake.read("d").columns == ["k", "v", "extra"]
    assert values(lake.read("d")) == [(1, "a", None), (2, "B", 0.5)]
    assert lake.read("raw").columns == ["k", "month", "v", "extra"]
    assert lake.read("raw").filter("extra is null").count() == 1


def test_reopened_lake(spark, lake):
    with lake.transaction() as tx:
        tx.append("a", frame(spark, [(1, 1, "x")]))
    assert values(Lake(spark, lake.root).read("a")) == [(1, 1, "x")]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_statement_leaves_no_shuffle_files(spark, lake):
    before, setting = shuffle_files(spark), spark.conf.get(RELEASE)
    rows = spark.range(1000).selectExpr("id % 7 as k", "cast(id % 3 as int) as month", "cast(id as string) as v")
    with lake.transaction() as tx:
        tx.overwrite("a", rows.groupBy("k", "month").agg({"v": "max"}).toDF("k", "month", "v"), **BY_MONTH)
        tx.upsert("a", rows.filter("v = '3'"), ["k"])
        until = time.time() + 20  # executors are told, not waited for
        while (left := shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.2)
        assert left == set() and len(tx.read("a").filter("v = '3'").collect()) == 1
    assert spark.conf.get(RELEASE) == setting
    with pytest.raises(RuntimeError), lake.transaction():
        raise RuntimeError("stop")
    assert spark.conf.get(RELEASE) == setting
