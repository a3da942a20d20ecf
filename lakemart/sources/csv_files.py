"""CSV sources, their row counts and fingerprints, and JSON report sinks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions import literal
from lakemart.sources import csv_scan
from lakemart.sources.contract import Contract, DatasetSpec
from lakemart.sources.lake import Files

# The words a type-inferring CSV reader takes for a missing value.
NA_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
# binaryFile keeps a file in memory, so larger ones get a fingerprint from their lines.
WHOLE_FILE_BYTES = 256 * 1024 * 1024


def _reader(spark: SparkSession, multi_line: bool):
    options = {
        "header": True,
        "multiLine": multi_line,
        "quote": '"',
        "escape": '"',
        "encoding": "UTF-8",
        # A row with too few or too many fields stops the read, also where few columns are asked for.
        "mode": "FAILFAST",
        "columnPruning": False,
    }
    return spark.read.options(**options)


def find_files(spark: SparkSession, data_dir: str, pattern: str) -> list[str]:
    return Files(spark, data_dir).matches(pattern)


def require_files(spark: SparkSession, data_dir: str, pattern: str) -> list[str]:
    paths = find_files(spark, data_dir, pattern)
    if not paths:
        raise FileNotFoundError(f"{data_dir}/{pattern}")
    return paths


def na_to_null(df: DataFrame, words: Sequence[str] = NA_WORDS, columns: Sequence[str] | None = None) -> DataFrame:
    """``df`` with null for the ``words`` in ``columns``, else in all."""
    listed = ", ".join(map(literal, words))
    cleaned = df.columns if columns is None else columns
    return df.selectExpr(
        *[f"if(`{c}` in ({listed}), null, `{c}`) as `{c}`" if c in cleaned else f"`{c}`" for c in df.columns]
    )


def read_by_name(
    spark: SparkSession,
    paths: Sequence[str],
    multi_line: bool = False,
    na_words: Sequence[str] | None = NA_WORDS,
    file_column: str | None = None,
) -> DataFrame:
    """All columns as text under their header names; ``na_words`` become null.

    All files must have the same header; another one stops the read. ``multi_line`` files may have
    line breaks inside quotes; they too are read split by split. ``file_column`` names a last
    column with the name of a row's file.
    """
    options = {"inferSchema": False, "enforceSchema": False}
    df = _reader(spark, multi_line).options(**options).csv(list(paths))  # of multi-line files the header only
    if multi_line:
        df = _read_records(spark, paths, df.columns, same_header=True)
    names = df.columns if multi_line else [*df.columns, "_path"]
    if not multi_line:
        df = df.withColumn("_path", F.col("_metadata.file_path"))
    values = [c for c in names if c != "_path"]
    clean = na_to_null(df, na_words, values) if na_words else df
    return _with_file(clean, values, file_column)


def _with_file(df: DataFrame, columns: Sequence[str], file_column: str | None) -> DataFrame:
    """``columns`` and, under ``file_column``, the name of the file at ``_path``."""
    file = [_base_name(F.col("_path")).alias(file_column)] if file_column else []
    return df.select(*[f"`{c}`" for c in columns], *file)


def _read_records(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], same_header: bool) -> DataFrame:
    """(the columns, _path) of files with line breaks inside quotes; a record of another width stops the read."""
    return _parsed_records(spark, paths, columns, same_header).select("_path", "_row.*")


def _parsed_records(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], same_header: bool) -> DataFrame:
    """(_path, _row) of every record but the headers."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    parser = {"quote": '"', "escape": '"', "mode": "FAILFAST", "columnPruning": "false"}
    found = csv_scan.records(spark, paths)
    named = ", ".join(literal(c) for c in columns)
    ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    fields = F.from_csv("text", ddl, parser)
    if same_header:
        other = F.raise_error(F.concat(F.lit("another header: "), F.col("text")))
        expected = F.when(F.array(*[fields.getField(f.name) for f in schema]) == F.expr(f"array({named})"), F.lit(False)).otherwise(other)
        kept = found.filter(F.when(F.col("header"), expected.cast("boolean")).otherwise(F.lit(True)))
    else:
        kept = found.filter(~F.col("header"))
    return kept.select(F.col("path").alias("_path"), fields.alias("_row"))


def read_by_position(
    spark: SparkSession, paths: Sequence[str], columns: Sequence[str], multi_line: bool = False, file_column: str | None = None,
) -> DataFrame:
    """All columns as text, named by position; the header is only skipped. Empty is null.

    ``multi_line`` and ``file_column``: see ``read_by_name``.
    """
    if multi_line:
        return _with_file(_read_records(spark, paths, columns, same_header=False), columns, file_column)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = _reader(spark, multi_line).option("enforceSchema", True).schema(schema).csv(list(paths))
    return _with_file(df.withColumn("_path", F.col("_metadata.file_path")), columns, file_column)


def read_dataset(spark: SparkSession, data_dir: str, spec: DatasetSpec) -> DataFrame:
    """The form contract checks work on."""
    paths = require_files(spark, data_dir, spec.file)
    return read_by_name(spark, paths, spec.multi_line)


def contract_frames(
    spark: SparkSession, data_dir: str, contract: Contract
) -> dict[str, DataFrame]:
    """Frames of the data sets whose file exists."""
    return {
        name: read_dataset(spark, data_dir, spec)
        for name, spec in contract.datasets.items()
        if find_files(spark, data_dir, spec.file)
    }


def row_count(spark: SparkSession, paths: Sequence[str], multi_line: bool = True) -> int:
    """Data rows of CSV files, aware of quotes and line breaks, without the header.

    Rows are parsed, and one of another width stops the count.
    """
    if not multi_line:
        return read_by_name(spark, paths, na_words=None).count()
    header = _reader(spark, True).options(inferSchema=False, enforceSchema=False).csv(list(paths))
    parsed = _parsed_records(spark, paths, header.columns, same_header=True)
    # A digest of all fields has every record parsed.
    counted = parsed.select("_row.*").agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*header.columns)))
    return counted.first()["n"]


def quick_row_counts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, n): data rows of every file, from its line breaks and quotes alone."""
    counted = csv_scan.record_counts(spark, paths)
    return counted.select(_base_name(F.col("path")).alias("file"), (F.col("records") - 1).alias("n"))


def file_sizes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file, size_bytes``; the content column is pruned, so nothing is read."""
    listed = spark.read.format("binaryFile").load(list(paths))
    return listed.select(_base_name(F.col("path")).alias("file"), F.col("length").alias("size_bytes"))


def _base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def fingerprints(
    spark: SparkSession, paths: Sequence[str], whole_file_bytes: int = WHOLE_FILE_BYTES
) -> DataFrame:
    """``file, sha256``: SHA-256 of the content of each file.

    SHA-256 runs from the first byte to the last, so a file above ``whole_file_bytes`` would be one
    long task. It gets a digest of its lines in their order instead, computed split by split
    (``csv_scan.line_digests``): there too any changed, added or moved byte changes the digest.
    """
    listed = spark.read.format("binaryFile").load(list(paths))
    small = listed.filter(F.col("length") <= whole_file_bytes).select(
        _base_name(F.col("path")).alias("file"), F.sha2("content", 256).alias("sha256")
    )
    large = [
        row["path"]
        for row in listed.filter(F.col("length") > whole_file_bytes).select("path").collect()
    ]
    if not large:
        return small
    digests = csv_scan.line_digests(spark, large)
    return small.unionByName(digests.select(_base_name(F.col("path")).alias("file"), F.col("digest").alias("sha256")))


def report_name(prefix: str, at: dt.datetime | None = None) -> str:
    at = at or dt.datetime.now(dt.timezone.utc)
    return f"{prefix}_{at.astimezone(dt.timezone.utc):%Y%m%dT%H%M%SZ}.json"


def write_report(results: DataFrame, path: str) -> None:
    """Result rows (a few per data set) as one JSON file under ``path``."""
    results.coalesce(1).write.mode("overwrite").json(path)
