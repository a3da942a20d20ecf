import pytest

from lakemart.operators import checks
from lakemart.sources.contract import (
    COMMERCE_CONTRACT,
    Contract,
    DatasetSpec,
    ForeignKey,
    contract_from,
)
from lakemart.sources.csv_files import contract_frames, read_dataset

SPEC = DatasetSpec(
    file="tickets.csv",
    required_columns=("ticket", "guest", "class", "fare"),
    not_null=("ticket", "guest"),
    unique=(("ticket",),),
    accepted_values={"class": ("first", "second", "sleeper")},
    non_negative=("fare",),
)
HEADER = "ticket,guest,class,fare\n"


def run(spark, folder, rows, spec=SPEC, header=HEADER):
    (folder / "tickets.csv").write_text(header + rows, encoding="utf-8")
    df = read_dataset(spark, str(folder), spec)
    return {r["test_name"]: r for r in checks.check_dataset(df, "tickets", spec).collect()}


def test_rows_that_keep_the_contract(spark, tmp_path):
    results = run(spark, tmp_path, "t7,ada,first,120\nt8,bo,sleeper,0.0\nt9,ada,second,33.25\n")
    assert len(results) == 7
    assert {r["status"] for r in results.values()} == {"PASS"}


def test_every_rule_counts_its_rows(spark, tmp_path):
    rows = "t1,ada,first,5\nt2,,roof,-1\nt1,bo,second,7\nt3,cy,roof,-0.5\nt1,di,deck,abc\n"
    results = run(spark, tmp_path, rows)
    failed = {n: (r["failed_rows"], r["total_rows"]) for n, r in results.items() if r["status"] == "ERROR"}
    assert failed == {
        "guest_not_null": (1, 5),
        "ticket_unique": (3, 5),
        "class_accepted_values": (3, 5),
        "fare_non_negative": (3, 5),
    }


def test_numbers_and_missing_words(spark, tmp_path):
    rows = "a,c,first,1d\nb,c,first,NA\nc,c,first, 1e3 \nd,c,first,x\ne,NULL,first,.5\nf,\t,first,-0.1\n"
    results = run(spark, tmp_path, rows)
    assert results["fare_non_negative"]["failed_rows"] == 3  # 1d, x, -0.1
    assert results["guest_not_null"]["failed_rows"] == 2


def test_range_bounds_are_inclusive(spark, tmp_path):
    spec = DatasetSpec("tickets.csv", ("a",), ranges={"a": (1, 5)})
    results = run(spark, tmp_path, "1\n5\n0.99\n6\nx\nNaN\n", spec, "a\n")
    assert results["a_range"]["failed_rows"] == 3


def test_missing_column_stops_after_schema(spark, tmp_path):
    results = run(spark, tmp_path, "t,ada,first\n", header="ticket,guest,class\n")
    assert set(results) == {"file_not_empty", "required_columns"}
    assert results["required_columns"]["failed_rows"] == 1


def test_empty_file(spark, tmp_path):
    results = run(spark, tmp_path, "")
    assert results["file_not_empty"]["status"] == "ERROR"
    assert results["ticket_unique"]["status"] == "PASS"


def test_missing_file_and_foreign_keys(spark):
    contract = Contract(
        {"a": DatasetSpec("a.csv", ("k",)), "b": DatasetSpec("b.csv", ("k",)), "c": DatasetSpec("c.csv", ("k",))},
        (
            ForeignKey("a_in_b", "a", "k", "b", "k", "WARN"),
            ForeignKey("a_in_c", "a", "k", "c", "k"),
            ForeignKey("a_x_in_b", "a", "x", "b", "k"),
        ),
    )
    frames = {
        "a": spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "k string"),
        "b": spark.createDataFrame([("1",), ("1",), (None,)], "k string"),
    }
    results = {
        (r["dataset"], r["test_name"]): r for r in checks.run_contract(spark, frames, contract).collect()
    }
    assert results["c", "file_exists"]["status"] == "ERROR"
    fk = results["a", "a_in_b"]
    assert (fk["status"], fk["failed_rows"], fk["total_rows"]) == ("WARN", 1, 3)
    assert ("a", "a_in_c") not in results
    assert results["a", "a_x_in_b"]["status"] == "ERROR"


def test_full_contract_on_files(spark, data_dir):
    frames = contract_frames(spark, data_dir, COMMERCE_CONTRACT)
    assert len(frames) == 9
    results = checks.run_contract(spark, frames, COMMERCE_CONTRACT).cache()
    assert results.count() == 72
    bad = {r["test_name"]: r["status"] for r in results.filter("status <> 'PASS'").collect()}
    assert bad == {"orders_customer_exists": "ERROR", "reviews_order_exists": "WARN"}
    with pytest.raises(checks.QualityGateError):
        checks.gate(results)
    assert checks.gate(results.filter("severity = 'WARN'")) == {
        "total_checks": 1,
        "passed": 0,
        "warnings": 1,
        "errors": 0,
    }


def test_contract_document(tmp_path):
    document = {
        "datasets": {"d": {"file": "d.csv", "required_columns": ["a"], "ranges": {"a": [0, 1]}}},
        "foreign_keys": [
            {
                "name": "n",
                "child_dataset": "d",
                "child_column": "a",
                "parent_dataset": "d",
                "parent_column": "a",
                "severity": "WARN",
            }
        ],
    }
    contract = contract_from(document)
    assert contract.datasets["d"].ranges == {"a": (0, 1)}
    assert contract.foreign_keys[0].severity == "WARN"
