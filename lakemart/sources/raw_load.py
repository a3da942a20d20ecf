"""RAW zone: append-only text tables with batch columns, loaded all or nothing."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.checks import union_all
from lakemart.sources.contract import COMMERCE_CONTRACT, Contract
from lakemart.sources.csv_files import (
    fingerprints,
    quick_row_counts,
    read_by_name,
    read_by_position,
    require_files,
)
from lakemart.sources.lake import Lake, Transaction

LOAD_HISTORY = "audit.load_history"
HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("dataset_name", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("file_sha256", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("load_status", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)
# Fixed value of the audit table for loads without a file.
NO_FILE_HASH = "NOT_APPLICABLE"


def raw_table(dataset: str) -> str:
    return f"raw.{dataset}"


def stamp(
    rows: DataFrame,
    batch_id: str,
    loaded_at: dt.datetime | Column,
    source_file: Column,
    source_updated_at: Column | None = None,
) -> DataFrame:
    """Add the batch columns. One batch shares one id and one load time."""
    time = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    changed = F.lit(None).cast("timestamp") if source_updated_at is None else source_updated_at
    return rows.withColumns(
        {
            "source_file": source_file,
            "batch_id": F.lit(batch_id),
            "loaded_at": time,
            "source_updated_at": changed,
        }
    )


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def append_history(tx: Transaction, rows: list[tuple]) -> None:
    spark = tx.lake.spark
    tx.append(LOAD_HISTORY, spark.createDataFrame(rows, HISTORY_SCHEMA))


def load_raw(
    lake: Lake,
    data_dir: str,
    contract: Contract = COMMERCE_CONTRACT,
    replace: bool = False,
    by_name: bool = False,
) -> str:
    """Load every data set of the contract as one batch and return its id.

    All files are looked up and all targets tested before anything is written; the batch,
    its history rows and, with ``replace``, the removal of older rows become visible together.
    Columns are taken by position (the header is skipped) unless ``by_name``.
    """
    spark = lake.spark
    paths = {
        name: require_files(spark, data_dir, spec.file) for name, spec in contract.datasets.items()
    }
    batch_id, loaded_at = str(uuid.uuid4()), utc_now()
    with lake.transaction() as tx:
        for name in contract.datasets:
            table = raw_table(name)
            if tx.has(table) and not replace and not tx.read(table).isEmpty():
                raise RuntimeError(f"{table} has rows; pass replace=True to load it again")
            if replace:
                tx.drop(table)
        history = []
        for name, spec in contract.datasets.items():
            columns = list(spec.required_columns)
            if by_name:
                rows = read_by_name(spark, paths[name], spec.multi_line, None, "_file").select(*columns, "_file")
            else:
                rows = read_by_position(spark, paths[name], columns, spec.multi_line, "_file")
            stamped = stamp(rows, batch_id, loaded_at, F.col("_file")).drop("_file")
            written = tx.append(raw_table(name), stamped)
            per_file = written.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
            counts = {row["source_file"]: row["n"] for row in per_file.collect()}
            for row in fingerprints(spark, paths[name]).collect():
                n = counts.get(row["file"], 0)
                history.append(
                    (batch_id, name, row["file"], row["sha256"], n, "SUCCESS", loaded_at)
                )
        append_history(tx, history)
    return batch_id


def reconcile_raw(
    lake: Lake, data_dir: str, contract: Contract = COMMERCE_CONTRACT
) -> DataFrame:
    """CSV rows against RAW rows per data set; meant for right after a full load.

    The files are counted by their line breaks and quotes, so not by the reader that loaded them.
    """
    spark = lake.spark
    counted = []
    for name, spec in contract.datasets.items():
        files = quick_row_counts(spark, require_files(spark, data_dir, spec.file))
        raw = lake.read(raw_table(name)).select(F.lit(0).cast("bigint").alias("l"), F.lit(1).cast("bigint").alias("r"))
        both = files.select(F.col("n").alias("l"), F.lit(0).cast("bigint").alias("r")).unionByName(raw)
        sums = both.agg(F.coalesce(F.sum("l"), F.lit(0)).alias("source_count"), F.coalesce(F.sum("r"), F.lit(0)).alias("target_count"))
        counted.append(sums.select(F.lit(name).alias("dataset"), "*"))
    return union_all(counted).selectExpr("*", "if(source_count = target_count, 'PASS', 'ERROR') as status")


def raw_frames(lake: Lake) -> dict[str, DataFrame]:
    """All RAW tables by data set name."""
    prefix = "raw."
    return {
        table[len(prefix) :]: lake.read(table)
        for table in lake.tables()
        if table.startswith(prefix)
    }
