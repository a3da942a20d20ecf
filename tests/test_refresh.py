"""The full refresh in one call: every gate stops what comes after it."""

import json

import pytest

from lakemart.operators.checks import QualityGateError
from lakemart.plans import refresh
from lakemart.plans.warehouse import mart_table, test_results as results_of
from lakemart.sources.raw_load import LOAD_HISTORY
from tests.conftest import FILES


def folder(path, **more):
    """The files of the fixture, without the order whose customer is unknown, and with more rows."""
    files = dict(FILES)
    files["x_customers_dataset.csv"] += "c9,u9,01002,rio,RJ\n"
    files["x_order_reviews_dataset.csv"] = files["x_order_reviews_dataset.csv"].replace("r2,o7", "r2,o2")
    for name, rows in more.items():
        files[f"x_{name}_dataset.csv"] += rows
    path.mkdir()
    for name, text in files.items():
        (path / name).write_text(text, encoding="utf-8")
    return str(path)


def test_a_good_folder_goes_through_all_steps(spark, lake, tmp_path):
    done = refresh.full_refresh(lake, folder(tmp_path / "in"), str(tmp_path / "out"))
    assert tuple(done) == refresh.STEPS
    assert done["validate"]["errors"] == done["reconcile"]["errors"] == done["check"]["errors"] == 0
    assert done["reconcile"]["total_checks"] == done["profile"]["files"] == 9
    assert results_of(lake, done["build and test"]["run_id"]).count() == 85
    assert lake.has(mart_table("mart_executive_kpis"))
    (report,) = (tmp_path / "out").glob("quality_*.json")
    (part,) = report.glob("part-*")
    document = json.loads(part.read_text())
    assert set(document) == {"generated_at_utc", "summary", "results"}
    assert document["summary"] == done["validate"]
    assert {"test_name", "dataset", "dimension", "severity", "status", "failed_rows", "total_rows", "message"} == set(document["results"][0])


def test_bad_files_are_not_loaded(spark, lake, tmp_path):
    data = folder(tmp_path / "in", order_payments="o1,1,voucher,1,-4.00\n")
    with pytest.raises(QualityGateError):
        refresh.full_refresh(lake, data, str(tmp_path / "out"), profile=False)
    assert lake.tables() == []
    assert len(list((tmp_path / "out").iterdir())) == 1  # the report is written all the same


def test_a_build_that_fails_a_test_is_not_published(spark, lake, tmp_path):
    # Passes the contract; delivered before it was bought.
    late = "o5,c1,delivered,2018-05-05 10:00:00,,,2018-05-01 10:00:00,2018-06-01 00:00:00\n"
    with pytest.raises(QualityGateError):
        refresh.full_refresh(lake, folder(tmp_path / "in", orders=late), str(tmp_path / "out"), profile=False)
    assert lake.has(LOAD_HISTORY) and not lake.has(mart_table("mart_executive_kpis"))
