from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakemart.operators.upserts import upsert

pairs = st.dictionaries(st.integers(0, 8), st.integers(0, 99), max_size=8)


def frame(spark, values):
    return spark.createDataFrame(list(values.items()), "k int, v int")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=pairs, delta=pairs)
def test_upsert_equals_dict_update_and_is_idempotent(spark, target, delta):
    once = upsert(frame(spark, target), frame(spark, delta), ["k"])
    assert {r["k"]: r["v"] for r in once.collect()} == target | delta
    assert once.count() == len(target | delta)
    twice = upsert(once, frame(spark, delta), ["k"])
    assert sorted(map(tuple, twice.collect())) == sorted((target | delta).items())


def test_columns_follow_the_changes(spark):
    target = spark.createDataFrame([(1, "x", 2.0)], "k int, gone string, kept double")
    delta = spark.createDataFrame([(2, 3.0, "new")], "k int, kept double, added string")
    result = upsert(target, delta, ["k"])
    assert result.columns == ["k", "kept", "added"]
    assert sorted(map(tuple, result.collect())) == [(1, 2.0, None), (2, 3.0, "new")]
