"""Joins of a large table to a table that is unique on the join key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import UNKNOWN_KEY, stable_key
from lakemart.session import work_path

# A side is broadcast only if the files it is read from stay below this.
BROADCAST_BYTES = 32 * 1024 * 1024
# A key is hot from this share of the rows on, so there are fewer than 1 / share of them.
HOT_SHARE = 0.001
# Missing keys up to this number are broadcast instead of shuffling the fact; a million short ids take
# about 130 MB of an executor.
MISSING_KEYS = 1_000_000


def source_bytes(df: DataFrame) -> int:
    """Catalyst's size of everything the plan of ``df`` reads, after column pruning."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether everything ``df`` is computed from is small enough to send to every task."""
    return source_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Values of ``key`` that hold at least about ``share`` of the rows.

    One pass with a frequent-items sketch, so nothing is shuffled but the sketches. It only
    steers how rows are joined: an estimate that is off costs time, never a row.
    """
    slots = int(1 / share)
    found = df.filter(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k({key}, {slots}, {10 * slots})").alias("top"),
    ).first()
    floor = max(2, found["n"] * share)
    return [entry["item"] for entry in (found["top"] or []) if entry["count"] >= floor]


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    broadcast_bytes: int | None = None,
    share: float = HOT_SHARE,
    seen: DataFrame | None = None,
) -> DataFrame:
    """``fact`` joined to ``dim`` on ``key``, for a ``dim`` with one row per key.

    A dimension read from little data is broadcast. Otherwise the rows of hot keys (a bounded
    number of keys, so a bounded number of dimension rows) join by broadcast where they lie,
    and only the evenly spread rest is shuffled. No row is dropped or sampled.

    ``seen`` may name a cheaper table to look for hot keys in, such as the scan that an
    expensive ``fact`` is computed from.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    if fits_broadcast(dim, broadcast_bytes):
        return fact.join(F.broadcast(dim), key, how)
    hot = hot_keys(fact if seen is None else seen, key, share)
    if not hot:
        if how == "left" and fact.schema[key].nullable:
            return _join_with_spread_nulls(fact, dim, key)
        return fact.join(dim, key, how)
    # A null key matches nothing; it stays with the rows that are not shuffled.
    stays = F.col(key).isNull() | F.col(key).isin(hot)
    even = fact.filter(~stays).join(dim, key, how)
    skewed = fact.filter(stays).join(F.broadcast(dim.filter(F.col(key).isin(hot))), key, how)
    return even.unionByName(skewed)


def _join_with_spread_nulls(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join in which rows without a key, which match nothing, spread over all partitions.

    Their place follows from their other columns, so that a task that runs again deals them alike.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(*fact.columns)).otherwise(F.lit(0))
    sides = fact.withColumn("_spread", spread), dim.withColumn("_spread", F.lit(0).cast("bigint"))
    return sides[0].join(sides[1], [key, "_spread"], "left").drop("_spread")


def lookup_key(
    fact: DataFrame,
    dim_ids: DataFrame,
    natural_id: str,
    key: str,
    default: int = UNKNOWN_KEY,
    broadcast_bytes: int | None = None,
    missing_keys: int | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Add the surrogate ``key`` of ``natural_id``; ``default`` where the dimension lacks it.

    A surrogate key is a function of the natural id, so all the dimension has to tell is which
    ids it lacks. For a large dimension those are found from the distinct ids of the fact, and
    while there are few the fact itself is never shuffled. ``seen`` may name a cheaper table
    that holds all ids of the fact.
    """
    ids = dim_ids.select(natural_id)
    if not fits_broadcast(ids, broadcast_bytes):
        most = MISSING_KEYS if missing_keys is None else missing_keys
        source = fact if seen is None else seen
        wanted = source.select(natural_id).filter(F.col(natural_id).isNotNull()).distinct()
        absent = _stored(wanted.join(ids, natural_id, "left_anti"), "absent-keys")
        if absent.count() <= most:
            return _key_unless_absent(fact, absent, natural_id, key, default)
    known = ids.filter(F.col(natural_id).isNotNull()).withColumn("_known", F.lit(True))
    joined = lookup_join(fact, known, natural_id, "left", broadcast_bytes, seen=seen)
    return joined.withColumn(key, _key_or(F.col("_known"), natural_id, default)).drop("_known")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a work folder and read back: its rows are then counted from file footers."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _key_unless_absent(
    fact: DataFrame, absent: DataFrame, natural_id: str, key: str, default: int
) -> DataFrame:
    """``absent`` holds at most ``missing_keys`` ids, which are broadcast; none passes the driver."""
    gone = absent.withColumn("_absent", F.lit(True))
    joined = fact.join(F.broadcast(gone), natural_id, "left")
    known = F.col(natural_id).isNotNull() & F.col("_absent").isNull()
    return joined.withColumn(key, _key_or(known, natural_id, default)).drop("_absent")


def _key_or(known: Column, natural_id: str, default: int) -> Column:
    return F.coalesce(F.when(known, stable_key(natural_id)), F.lit(default).cast("bigint"))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """``(key, n)`` of the non-null keys.

    Rows are counted per task before the exchange, so a hot key travels as a few rows.
    """
    keys = df.select(F.col(key).alias("key")).filter(F.col("key").isNotNull())
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def missing_parents(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """``(key, n)``: child keys without a parent and how many child rows hold them."""
    parents = parent.select(F.col(parent_key).alias("key"))
    return key_counts(child, child_key).join(parents, "key", "left_anti")
