"""Profile of every CSV file in a folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from lakemart.operators.profiles import first_values, infer_types, profile_columns, profile_table
from lakemart.session import work_path
from lakemart.sources.csv_files import file_sizes, read_by_name, require_files


def profile_frame(df: DataFrame) -> dict:
    """Table and column profile of typed rows; a few values per column reach the driver."""
    report = profile_table(df).first().asDict()
    found = {row["column_name"]: row for row in profile_columns(df).collect()}
    held = [name for name, row in found.items() if row["distinct_count"]]
    samples = first_values(df, held)
    report["columns"] = {}
    for name in df.columns:
        row = found.get(name)
        report["columns"][name] = {
            "inferred_type": row["inferred_type"] if row else "object",
            "null_count": row["null_count"] if row else 0,
            "null_percent": row["null_percent"] if row else 0.0,
            "distinct_count": row["distinct_count"] if row else 0,
            "sample_values": samples.get(name, []),
        }
    return report


def profile_directory(
    spark: SparkSession, data_dir: str, multi_line: bool = True, pattern: str = "*.csv"
) -> list[dict]:
    """One report per file, sorted by name; raises when there is none.

    ``multi_line`` reads quoted line breaks correctly. Files are parsed once, into a work folder. Of
    a file in several splits, samples are first values of splits, in their order.
    """
    paths = require_files(spark, data_dir, pattern)
    sizes = {row["file"]: row["size_bytes"] for row in file_sizes(spark, paths).collect()}
    reports = []
    for path in paths:
        file = path.rsplit("/", 1)[-1]
        parsed, held = read_by_name(spark, [path], multi_line), work_path(spark, "profile")
        parsed.write.parquet(held)
        typed = infer_types(spark.read.schema(parsed.schema).parquet(held))
        reports.append({"file": file, "size_bytes": sizes[file], **profile_frame(typed)})
    return reports


def write_profile(spark: SparkSession, reports: list[dict], path: str) -> None:
    """The reports as JSON lines, one per file."""
    lines = [(json.dumps(report, ensure_ascii=False, default=str),) for report in reports]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("overwrite").text(path)
