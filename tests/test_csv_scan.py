"""Quoted line breaks over several splits, against a sequential CSV reader."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from lakemart.sources import csv_files, csv_scan


def written(path, rows, end="\n"):
    with path.open("w", newline="", encoding="utf-8") as stream:
        csv.writer(stream, lineterminator=end).writerows(rows)
    with path.open(newline="", encoding="utf-8") as stream:
        return list(csv.reader(stream))


def texts(seed, n):
    rng = random.Random(seed)
    words = ["plain", 'with "quotes"', "two\nlines", "a, comma", "", "\n\n", '"', "é\n", "x" * 300, '"\n"', "many\n" * 40]
    return [[str(i), *("".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(2))] for i in range(n)]


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "512")
    spark.conf.set(names[1], "0")
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_counts_and_rows_equal_those_of_a_sequential_reader(spark, small_splits, tmp_path, end):
    expected = {}
    for name, n in (("a.csv", 200), ("b.csv", 1), ("c.csv", 0)):
        expected[name] = written(tmp_path / name, [["id", "left", "right"], *texts(n, n)], end)
    paths = [str(tmp_path / name) for name in expected]
    splits = csv_scan.split_counts(spark, paths).collect()
    assert len(splits) > 20 and {r["parity"] for r in splits} == {0, 1}
    counts = {r["file"]: r["n"] for r in csv_files.quick_row_counts(spark, paths).collect()}
    assert counts == {name: len(rows) - 1 for name, rows in expected.items()}
    assert csv_files.row_count(spark, paths) == sum(counts.values())
    got = csv_files.read_by_name(spark, paths, multi_line=True, na_words=None, file_column="file")
    assert got.columns == ["id", "left", "right", "file"]
    found = sorted((r["file"], int(r["id"]), r["left"] or "", r["right"] or "") for r in got.collect())
    assert found == sorted((name, int(r[0]), r[1], r[2]) for name, rows in expected.items() for r in rows[1:])
    by_place = csv_files.read_by_position(spark, paths, ["x", "y", "z"], multi_line=True)
    assert by_place.agg(F.sum(F.length("y")), F.count("x")).first() == got.agg(F.sum(F.length("left")), F.count("id")).first()


def test_a_record_longer_than_many_splits(spark, small_splits, tmp_path):
    long = "line\n" * 3000
    expected = written(tmp_path / "a.csv", [["id", "text"], ["1", long], ["2", "x"], ["3", long]])
    paths = [str(tmp_path / "a.csv")]
    assert csv_files.quick_row_counts(spark, paths).first()["n"] == 3
    got = csv_files.read_by_name(spark, paths, multi_line=True)
    assert sorted(map(tuple, got.collect())) == [tuple(r) for r in expected[1:]]


@pytest.mark.parametrize("body", ['1,"x\ny",EXTRA\n', '"2\n"\n'])
def test_records_of_another_width_stop_the_read(spark, tmp_path, body):
    (tmp_path / "a.csv").write_text('id,name\n1,"x\ny"\n' + body)
    paths = [str(tmp_path / "a.csv")]
    for read in (lambda: csv_files.read_by_position(spark, paths, ["id", "name"], True).collect(), lambda: csv_files.row_count(spark, paths)):
        with pytest.raises(Exception, match="(?i)malformed"):
            read()


def test_blank_lines_between_records_are_no_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n\n1,"x\n\ny"\n\n\n2,z')
    paths = [str(tmp_path / "a.csv")]
    assert csv_files.quick_row_counts(spark, paths).first()["n"] == 2
    assert sorted(map(tuple, csv_files.read_by_name(spark, paths, True).collect())) == [("1", "x\n\ny"), ("2", "z")]
