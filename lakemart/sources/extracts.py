"""Watermark extraction from a source database (or any table with a change time) into RAW."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.checks import union_all
from lakemart.operators.upserts import EPOCH, extract_delta
from lakemart.sources.contract import COMMERCE_CONTRACT, INCREMENTAL_DATASETS, Contract
from lakemart.sources.lake import Lake
from lakemart.sources.raw_load import NO_FILE_HASH, append_history, raw_table, stamp, utc_now

WATERMARKS = "audit.pipeline_watermarks"
WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("dataset_name", T.StringType()),
        T.StructField("watermark_value", T.TimestampType()),
        T.StructField("last_batch_id", T.StringType()),
        T.StructField("rows_extracted", T.LongType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
UPDATED_AT = "updated_at"


def read_source(spark: SparkSession, source_format: str, **options: str) -> DataFrame:
    """Any Spark source: Parquet, or JDBC, where time predicates run in the database."""
    return spark.read.format(source_format).options(**options).load()


def as_raw_text(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Business columns in canonical text plus the change time."""
    return source.select(*[F.col(c).cast("string").alias(c) for c in columns], UPDATED_AT)


def _guard(dataset: str) -> None:
    if dataset not in INCREMENTAL_DATASETS:
        raise ValueError(f"data set has no incremental extract: {dataset}")


def _stored_watermark(lake: Lake, dataset: str) -> dt.datetime:
    epoch = EPOCH.replace(tzinfo=dt.timezone.utc)
    if not lake.has(WATERMARKS):
        return epoch
    row = lake.read(WATERMARKS).filter(F.col("dataset_name") == dataset).first()
    return row["watermark_value"].astimezone(dt.timezone.utc) if row else epoch


def source_bound(source: DataFrame, previous: dt.datetime) -> dt.datetime:
    """The latest change time that the source holds, or ``previous`` where that is later.

    It comes from the source itself, so that no clock but the one that stamped the rows decides
    what has been read. Of a Parquet or a database source only the one column is read.
    """
    latest = source.agg(F.max(F.col(UPDATED_AT).cast("timestamp")).alias("latest")).first()["latest"]
    return max(previous, latest.astimezone(dt.timezone.utc)) if latest else previous


def ingest(
    lake: Lake,
    dataset: str,
    source: DataFrame,
    upper: dt.datetime | None = None,
    lookback: dt.timedelta | None = None,
    contract: Contract = COMMERCE_CONTRACT,
) -> dict:
    """Append the rows with ``previous < updated_at <= upper`` to RAW.

    ``upper`` is the source's own clock, read before the extract; without one it is the latest
    change time in the source (``source_bound``), never the clock of this driver: one that is ahead
    would move the watermark past rows that the source has yet to stamp. The RAW rows, the new watermark and
    the history row are one commit: a failed run leaves nothing and the next one re-reads the
    same range. The watermark moves to a given ``upper`` even when there was no row. ``lookback``
    re-reads a stretch below the watermark for rows that were committed late; the extra
    versions are removed by staging.
    """
    _guard(dataset)
    previous = _stored_watermark(lake, dataset)
    upper = upper or source_bound(source, previous)
    lower = previous - lookback if lookback else previous
    batch_id, now = str(uuid.uuid4()), utc_now()
    uri = f"source://{dataset}"
    columns = contract.datasets[dataset].required_columns
    delta = extract_delta(source, UPDATED_AT, F.lit(lower), F.lit(upper))
    rows = as_raw_text(delta, columns).withColumnRenamed(UPDATED_AT, "_changed")
    stamped = stamp(rows, batch_id, now, F.lit(uri), F.col("_changed")).drop("_changed")
    with lake.transaction() as tx:
        extracted = tx.append(raw_table(dataset), stamped).count()
        mark = [(dataset, upper, batch_id, extracted, now)]
        marks = lake.spark.createDataFrame(mark, WATERMARK_SCHEMA)
        tx.upsert(WATERMARKS, marks, ["dataset_name"])
        append_history(tx, [(batch_id, dataset, uri, NO_FILE_HASH, extracted, "SUCCESS", now)])
    return {
        "dataset": dataset,
        "batch_id": batch_id,
        "rows_extracted": extracted,
        "previous_watermark": previous,
        "new_watermark": upper,
    }


def ingest_all(
    lake: Lake, sources: dict[str, DataFrame], upper: dt.datetime | None = None
) -> list[dict]:
    """Extract each given data set in its own commit, so one failure does not undo others."""
    return [ingest(lake, name, source, upper) for name, source in sources.items()]


def high_marks(sources: dict[str, DataFrame], time: str = UPDATED_AT) -> DataFrame:
    """``dataset_name, watermark_value``: the latest change time of every source."""
    return union_all(
        [
            df.agg(F.max(time).alias("watermark_value")).select(
                F.lit(name).alias("dataset_name"), "watermark_value"
            )
            for name, df in sources.items()
        ]
    )


def seed_watermarks(lake: Lake, sources: dict[str, DataFrame]) -> DataFrame:
    """Set the watermark of each source to its latest change time, e.g. after a full load."""
    for name in sources:
        _guard(name)
    rows = high_marks(sources).filter(F.col("watermark_value").isNotNull())
    seeded = rows.select(
        "dataset_name",
        F.col("watermark_value").cast("timestamp"),
        F.lit(None).cast("string").alias("last_batch_id"),
        F.lit(0).cast("bigint").alias("rows_extracted"),
        F.lit(utc_now()).alias("updated_at"),
    )
    with lake.transaction() as tx:
        return tx.upsert(WATERMARKS, seeded.coalesce(1), ["dataset_name"])


def watermarks(lake: Lake) -> DataFrame:
    return lake.read(WATERMARKS).orderBy("dataset_name")


def without_watermark(marks: DataFrame, wanted: DataFrame) -> DataFrame:
    """Data sets that have no watermark yet."""
    return wanted.join(marks.select("dataset_name"), "dataset_name", "left_anti").select("dataset_name")


def require_watermarks(lake: Lake, datasets: Sequence[str] = INCREMENTAL_DATASETS) -> int:
    """Readiness gate before an incremental run; returns the number of configured data sets."""
    stored = lake.read(WATERMARKS).select("dataset_name").collect() if lake.has(WATERMARKS) else []
    missing = sorted(set(datasets) - {row[0] for row in stored})
    if missing:
        raise RuntimeError(f"no watermark for {missing}")
    return len(stored)
