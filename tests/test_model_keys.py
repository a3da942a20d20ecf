"""Keys of whole numbers in the aggregation that key tests share."""

from lakemart.operators import model_tests as mt


def test_number_keys_travel_as_bytes_and_are_shown_as_digits(spark):
    parent = spark.createDataFrame([(-1, 7, "1"), (-1, 8, "2"), (2**63 - 1, 8, "x"), (None, 9, None)], "k bigint, n int, s string")
    child = spark.createDataFrame([(-1, "7", 1), (-2, "8", 5), (-(2**63), "30", None), (None, None, 2)], "k bigint, n string, s int")
    tests = [
        mt.unique("p", "k"), mt.unique("p", "n", "k", title="grain"), mt.relationships("c", "k", "p", "k"),
        mt.relationships("c", "n", "p", "n"), mt.relationships("c", "s", "p", "s"), mt.unique("p", "n"),
        mt.accepted_values("c", "k", ("-1", "-2")), mt.unique("d", "k", "n", title="twice"),
    ]
    twice = spark.createDataFrame([(-5, 3), (-5, 3), (None, 4), (None, 4), (1, None)], "k smallint, n int")
    found = mt.key_failures({"p": parent, "c": child, "d": twice}, tests)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "unhex(hex(" in plan
    assert sorted(map(tuple, found.collect())) == sorted([
        ("unique_p_k", 1, '{"unique_field":"-1","n_records":2}'),
        ("unique_p_n", 1, '{"unique_field":"8","n_records":2}'),
        ("relationships_c_k_p", 1, '{"from_field":"-2","n_records":1}'),
        ("relationships_c_k_p", 1, '{"from_field":"-9223372036854775808","n_records":1}'),
        ("relationships_c_n_p", 1, '{"from_field":"30","n_records":1}'),
        ("relationships_c_s_p", 1, '{"from_field":"5","n_records":1}'),
        ("accepted_values_c_k", 1, '{"value_field":"-9223372036854775808","n_records":1}'),
        ("twice", 1, '{"k":"-5","n":"3","n_records":2}'), ("twice", 1, '{"k":null,"n":"4","n_records":2}'),
    ])
