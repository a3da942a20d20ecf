import io

import pandas as pd
import pytest

from lakemart.operators import profiles
from lakemart.sources.csv_files import read_by_name
from lakemart.sources.profile_report import profile_directory

TEXT = (
    "i,gap,d,b,t,zip,none,mixed\n"
    "1,1,1.5,True,x,01001,,1\n"
    "2,,2.50,False,,01002,,x\n"
    "2,3,2.5,True,x,1001,,1\n"
    "1,1,1.5,True,x,01001,,1\n"
    "1,1,1.5,True,x,01001,,1\n"
)


def test_against_pandas(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TEXT)
    typed = profiles.infer_types(read_by_name(spark, [str(tmp_path / "a.csv")]))
    got = {r["column_name"]: r for r in profiles.profile_columns(typed).collect()}
    expected = pd.read_csv(io.StringIO(TEXT))
    for name, series in expected.items():
        kind = "object" if str(series.dtype) in ("str", "string") else str(series.dtype)
        row = got[name]
        assert row["inferred_type"] == kind, name
        assert row["null_count"] == series.isna().sum()
        assert row["null_percent"] == round(series.isna().mean() * 100, 4)
        assert row["distinct_count"] == series.nunique()
    table = profiles.profile_table(typed).first()
    assert tuple(table) == (5, 8, int(expected.duplicated().sum()))


def test_long_integers_stay_distinct(spark):
    ids = ["9007199254740993000", "9007199254740993001", "99999999999999999999", "99999999999999999998"]
    df = spark.createDataFrame([(i, i[:19]) for i in ids], "long string, bigint string")
    got = {r["column_name"]: r for r in profiles.profile_columns(profiles.infer_types(df)).collect()}
    assert (got["long"]["inferred_type"], got["long"]["distinct_count"]) == ("object", 4)
    assert got["bigint"]["distinct_count"] == 3


def test_first_values_in_file_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TEXT)
    df = read_by_name(spark, [str(tmp_path / "a.csv")])
    assert profiles.first_values(df, ["i", "gap"], 2) == {"i": ["1", "2"], "gap": ["1", "3"]}


def test_empty_frame(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert tuple(profiles.profile_table(df).first()) == (0, 2, 0)
    assert profiles.profile_columns(df).count() == 0


def test_directory_report(spark, data_dir, tmp_path):
    report = profile_directory(spark, data_dir)
    assert [d["file"] for d in report] == sorted(d["file"] for d in report)
    items = next(d for d in report if d["file"] == "x_order_items_dataset.csv")
    assert (items["row_count"], items["column_count"], items["duplicate_rows"]) == (3, 7, 0)
    assert items["size_bytes"] > 0
    price = items["columns"]["price"]
    assert price == {
        "inferred_type": "float64",
        "null_count": 0,
        "null_percent": 0.0,
        "distinct_count": 3,
        "sample_values": [10.0, 20.0, 5.55],
    }
    with pytest.raises(FileNotFoundError):
        profile_directory(spark, str(tmp_path / "lake"))
