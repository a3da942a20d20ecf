import pandas as pd
import pytest

from lakemart.functions import UNKNOWN_KEY
from lakemart.operators import lookups

HOT_THIRD = [0] * 400 + [1] * 300 + list(range(2, 502))


@pytest.fixture(scope="module")
def fact(spark):
    keys = [None if k == 77 else f"k{k}" for k in HOT_THIRD]
    return spark.createDataFrame(pd.DataFrame({"key": keys, "row": range(len(keys))}))


@pytest.fixture(scope="module")
def dim(spark):
    keys = [f"k{i}" for i in range(600) if i % 5 != 1 or i == 1]
    return spark.createDataFrame(pd.DataFrame({"key": keys, "label": [f"label {k}" for k in keys]}))


def rows(df):
    return sorted(map(tuple, df.select("key", "row", "label").collect()), key=str)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_keys_do_not_change_the_result(fact, dim, how):
    expected = rows(fact.join(dim, "key", how))
    small = lookups.lookup_join(fact, dim, "key", how)
    split = lookups.lookup_join(fact, dim, "key", how, broadcast_bytes=0, share=0.05)
    plain = lookups.lookup_join(fact, dim, "key", how, broadcast_bytes=0, share=0.9)
    assert rows(small) == rows(split) == rows(plain) == expected
    assert "Union" in split._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_hot_keys_are_found(fact):
    assert set(lookups.hot_keys(fact, "key", 0.05)) == {"k0", "k1"}


def test_rows_without_a_key_are_kept_and_spread(spark):
    fact = spark.range(400).selectExpr("id as n", "if(id % 4 = 0, cast(id as string), null) as k")
    other = spark.range(400).selectExpr("cast(id as string) as k", "id as x")
    got = lookups.lookup_join(fact, other, "k", "left", broadcast_bytes=0, share=0.5)
    assert got.columns == ["k", "n", "x"]
    found = {r["n"]: r["x"] for r in got.collect()}
    assert found == {n: (n if n % 4 == 0 else None) for n in range(400)}


def test_other_join_types_are_refused(fact, dim):
    with pytest.raises(ValueError, match="unsupported"):
        lookups.lookup_join(fact, dim, "key", "full")


@pytest.mark.parametrize(("broadcast_bytes", "missing"), [(10**9, 10), (0, 1000), (0, 0), (0, 3)])
def test_lookup_key_paths_agree(spark, fact, dim, broadcast_bytes, missing):
    got = lookups.lookup_key(
        fact, dim.select("key"), "key", "sk", broadcast_bytes=broadcast_bytes, missing_keys=missing
    )
    known = {r["key"] for r in dim.collect()}
    values = {r["key"]: r["sk"] for r in got.collect()}
    assert got.count() == fact.count()
    assert all((sk == UNKNOWN_KEY) == (k not in known) for k, sk in values.items())
    assert len({v for v in values.values() if v != UNKNOWN_KEY}) == len(known & set(values))


def test_nothing_missing(fact, dim):
    present = fact.join(dim, "key", "left_semi")
    got = lookups.lookup_key(present, dim.select("key"), "key", "sk", broadcast_bytes=0)
    assert got.filter("sk = -1").count() == 0


def test_missing_parents(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("b",), ("b",)], "p string")
    got = lookups.missing_parents(child, "k", parent, "p").collect()
    assert [tuple(r) for r in got] == [("a", 2)]


def test_source_bytes_follow_the_files(spark, tmp_path):
    spark.range(100_000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert 0 < lookups.source_bytes(df) < 10_000_000
    assert lookups.source_bytes(df.union(df)) == 2 * lookups.source_bytes(df)


def test_a_fact_is_not_shuffled_for_many_missing_ids(spark):
    fact = spark.range(200_000).selectExpr("concat('k', id) as key", "id as row")
    got = lookups.lookup_key(fact, fact.filter("row % 5 = 0").select("key"), "key", "sk", broadcast_bytes=0)
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.filter(got["sk"] == UNKNOWN_KEY).count() == 160_000 and got.filter("row % 5 = 0").filter(got["sk"] == UNKNOWN_KEY).count() == 0
