"""Upsert and incremental-delta operators over DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = dt.datetime(1970, 1, 1)


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the target rows that share a key with ``changes``, then add ``changes``.

    The result has the columns of ``changes``: columns it adds are null on kept rows and
    columns it lacks are dropped. Keys are non-null.
    """
    kept = target.join(changes.select(*keys), list(keys), "left_anti")
    return sync_columns(kept, changes).unionByName(changes)


def sync_columns(df: DataFrame, model: DataFrame) -> DataFrame:
    """``df`` with exactly the columns and types of ``model``."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in model.schema.fields
        ]
    )


def epoch_like(time_type: str) -> Column:
    """1970-01-01 in the type of the compared time column."""
    text = "1970-01-01 00:00:00" if "ntz" in time_type else "1970-01-01 00:00:00+00:00"
    return F.lit(text).cast(time_type)


def time_literal(value: dt.datetime, data_type: T.DataType) -> Column:
    """A collected time as a literal of the column type it came from."""
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(data_type)
    return F.lit(value)


def high_watermark(df: DataFrame, time: str) -> DataFrame:
    """One row: the latest ``time``, or 1970-01-01 for an empty table."""
    kind = df.schema[time].dataType.simpleString()
    return df.agg(F.coalesce(F.max(time), epoch_like(kind)).alias("watermark"))


def extract_delta(source: DataFrame, time: str, previous: Column, upper: Column) -> DataFrame:
    """Rows with ``previous < time <= upper``; plain comparisons, so scans can skip data."""
    return source.filter((F.col(time) > previous) & (F.col(time) <= upper))


def changed_since(df: DataFrame, time: str, watermark: Column) -> DataFrame:
    return df.filter(F.col(time) > watermark)
