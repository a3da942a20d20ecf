"""The declared tests as a suite: every kind, stored failing rows, and the gate of a build."""

import json
from collections import Counter

import pytest

from lakemart.operators import model_tests as mt
from lakemart.operators.checks import QualityGateError
from lakemart.plans import warehouse
from lakemart.plans.model_suite import declared_tests
from lakemart.plans.warehouse import Watch, mart_table, model_frames, run_model_tests
from lakemart.sources.lake import Lake
from lakemart.sources.raw_load import load_raw
from tests.conftest import FILES


def stored(rows):
    return sorted(((r["test_name"], r["failed_rows"], json.loads(r["failure"])) for r in rows.collect()), key=str)


def status(results):
    return {r["test_name"]: (r["status"], r["failed_rows"]) for r in results.collect()}


@pytest.fixture(scope="module")
def frames(spark):
    birds = [("b1", "owl", 3, "n1"), ("b2", "owl", -1, "n9"), ("b2", None, 5, None), (None, "emu", None, "n9"), (None, "", 2, "n2")]
    nests = [("n1", "t1", 1), ("n2", "t1", 1), ("n2", "t2", 2), ("n3", None, 4), ("n3", None, 4), (None, "t3", 5)]
    return {
        "birds": spark.createDataFrame(birds, "bird_id string, kind string, eggs int, nest string"),
        "nests": spark.createDataFrame(nests, "nest string, tree string, twigs int"),
    }


TESTS = [
    mt.not_null("birds", "bird_id"),
    mt.not_null("birds", "kind"),
    mt.unique("birds", "bird_id"),
    mt.unique("nests", "nest"),
    mt.unique("nests", "nest", "tree", title="nest_grain"),
    mt.relationships("birds", "nest", "nests", "nest"),
    mt.relationships("nests", "tree", "nests", "nest"),
    mt.accepted_values("birds", "kind", ["owl", "emu"]),
    mt.condition("eggs_not_negative", "birds", "eggs < 0", "WARN"),
    mt.query("few_twigs", "nests", lambda f: f["nests"].filter("twigs > 9"), "WARN"),
    mt.query("many_eggs", "birds", lambda f: f["birds"].filter("eggs >= 3").select("bird_id", "eggs")),
]


def test_every_kind_of_test_and_its_failing_rows(spark, frames):
    failed = mt.failures(frames, TESTS, shown={"birds": ["bird_id", "eggs"]})
    assert stored(failed) == sorted([
        ("accepted_values_birds_kind", 1, {"value_field": "", "n_records": 1}),
        ("eggs_not_negative", 1, {"bird_id": "b2", "eggs": -1}),
        ("many_eggs", 1, {"bird_id": "b1", "eggs": 3}),
        ("many_eggs", 1, {"bird_id": "b2", "eggs": 5}),
        ("nest_grain", 1, {"nest": "n3", "tree": None, "n_records": 2}),
        ("not_null_birds_bird_id", 1, {"bird_id": None, "eggs": None}),
        ("not_null_birds_bird_id", 1, {"bird_id": None, "eggs": 2}),
        ("not_null_birds_kind", 1, {"bird_id": "b2", "eggs": 5}),
        ("relationships_birds_nest_nests", 2, {"from_field": "n9", "n_records": 2}),
        ("relationships_nests_tree_nests", 2, {"from_field": "t1", "n_records": 2}),
        ("relationships_nests_tree_nests", 1, {"from_field": "t2", "n_records": 1}),
        ("relationships_nests_tree_nests", 1, {"from_field": "t3", "n_records": 1}),
        ("unique_birds_bird_id", 1, {"unique_field": "b2", "n_records": 2}),
        ("unique_nests_nest", 1, {"unique_field": "n2", "n_records": 2}),
        ("unique_nests_nest", 1, {"unique_field": "n3", "n_records": 2}),
    ], key=str)
    results = status(mt.outcome(spark, failed, TESTS))
    assert results["few_twigs"] == ("PASS", 0)
    assert results["eggs_not_negative"] == ("WARN", 1)
    assert results["relationships_nests_tree_nests"] == ("ERROR", 4)
    assert results["unique_nests_nest"] == ("ERROR", 2)
    assert len(results) == len(TESTS)


def test_each_model_is_scanned_once_for_rows_and_once_for_keys(spark, frames, tmp_path):
    for name, df in frames.items():
        df.write.parquet(str(tmp_path / name))
    held = {name: spark.read.parquet(str(tmp_path / name)) for name in frames}
    tests = [t for t in TESTS if not t.failing]
    plan = mt.failures(held, tests)._jdf.queryExecution().optimizedPlan().toString()
    assert Counter(line.split("[")[0].strip(" :+-") for line in plan.splitlines() if "Relation" in line) == {"Relation": 3}
    assert "Join" not in plan


def test_observed_counts_spare_models_without_failures(spark, frames, tmp_path):
    watch = Watch(TESTS)
    for name, df in frames.items():
        watch(name, df).write.parquet(str(tmp_path / name))
    counted = watch.counts()
    assert counted == {"not_null_birds_bird_id": 2, "not_null_birds_kind": 1, "eggs_not_negative": 1}
    assert stored(mt.failures(frames, TESTS, counted)) == stored(mt.failures(frames, TESTS))
    clean = [t for t in TESTS if t.row_condition()]
    assert mt.failures(frames, clean, {t.name: 0 for t in clean}).collect() == []


def test_empty_models_pass(spark, frames):
    empty = {name: df.limit(0) for name, df in frames.items()}
    assert {s for s, _ in status(mt.outcome(spark, mt.failures(empty, TESTS), TESTS)).values()} == {"PASS"}


def test_names_are_told_apart():
    with pytest.raises(ValueError, match="not_null_birds_kind"):
        mt.check_names([mt.not_null("birds", "kind")] * 2)


# ---- the suite over builds -----------------------------------------------------------------

GOOD = dict(FILES)
GOOD["x_customers_dataset.csv"] += "c9,u9,01002,rio,RJ\n"
BROKEN = dict(GOOD)
BROKEN["x_orders_dataset.csv"] += "o7,c7,mislaid,2018-03-01 00:00:00,,,,2018-03-25 00:00:00\n"  # status, and no such customer
BROKEN["x_order_items_dataset.csv"] += "o8,1,p1,s1,2018-03-08 00:00:00,,1.00\n"  # no price, and no such order


def loaded(spark, folder, files):
    (folder / "csv").mkdir()
    for name, text in files.items():
        (folder / "csv" / name).write_text(text, encoding="utf-8")
    lake = Lake(spark, str(folder / "lake"))
    load_raw(lake, str(folder / "csv"))
    return lake


def test_a_good_build_is_published_with_its_results(spark, tmp_path):
    lake = loaded(spark, tmp_path, GOOD)
    warehouse.build_full(lake, tests=declared_tests(), run_id="r1")
    assert lake.has(mart_table("mart_executive_kpis"))
    results = status(warehouse.test_results(lake, "r1"))
    assert len(results) == 85
    assert {s for n, (s, _) in results.items() if n not in ("shipping_limit_reasonable", "unknown_dimension_rate")} == {"PASS"}
    assert results["shipping_limit_reasonable"] == ("WARN", 1)
    failed = {name: row for name, _, row in stored(warehouse.test_failures(lake, "r1"))}
    assert failed["shipping_limit_reasonable"]["order_id"] == "o2"
    # An increment without new rows tests the whole models again.
    warehouse.build_increment(lake, tests=declared_tests(), run_id="r2")
    assert status(warehouse.test_results(lake, "r2")) == results


def test_broken_rows_stop_the_publish_and_are_stored(spark, tmp_path):
    lake = loaded(spark, tmp_path, BROKEN)
    before = lake.state()[0]
    with pytest.raises(QualityGateError):
        warehouse.build_full(lake, tests=declared_tests(), run_id="r1")
    assert lake.state()[0] == before and not lake.has(mart_table("mart_executive_kpis"))
    results = status(warehouse.test_results(lake, "r1"))
    errors = {name: n for name, (s, n) in results.items() if s == "ERROR"}
    assert errors == {
        "not_null_stg_order_items_price": 1,
        "accepted_values_stg_orders_order_status": 1,
        "relationships_stg_orders_customer_id_stg_customers": 1,
        "relationships_stg_order_items_order_id_stg_orders": 1,
        "fact_order_items_reconciliation": 1,
    }
    failed = {name: row for name, _, row in stored(warehouse.test_failures(lake, "r1"))}
    assert failed["not_null_stg_order_items_price"]["order_id"] == "o8"
    assert failed["accepted_values_stg_orders_order_status"] == {"value_field": "mislaid", "n_records": 1}
    assert failed["relationships_stg_orders_customer_id_stg_customers"]["from_field"] == "c7"
    assert failed["fact_order_items_reconciliation"] == {"staging_rows": 4, "fact_rows": 3}
    folders = {p.name for p in (tmp_path / "lake" / "audit" / "test_failures" / "test_run_id=r1").iterdir() if p.is_dir()}
    assert folders >= {f"test_name={name}" for name in errors}


def test_the_suite_runs_over_a_published_build_too(spark, tmp_path):
    lake = loaded(spark, tmp_path, BROKEN)
    warehouse.build_full(lake)
    got = status(run_model_tests(lake, declared_tests(), run_id="r9"))
    assert got["relationships_stg_orders_customer_id_stg_customers"] == ("ERROR", 1)
    assert set(model_frames(lake, ["stg_orders", "dim_date", "mart_order_status"])) == {"stg_orders", "dim_date", "mart_order_status"}
