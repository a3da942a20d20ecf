"""Current state of an append-only table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    recency: Sequence[str],
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the newest by ``recency``, then by ``tie_breakers`` (all descending).

    The rank-and-keep-first form lets Catalyst put a group limit before the exchange, so
    each task sends at most one row per key however many versions a hot key has.
    """
    newest_first = ", ".join(f"`{c}` desc nulls last" for c in (*recency, *tie_breakers))
    key = ", ".join(f"`{c}`" for c in keys)
    rank = f"row_number() over (partition by {key} order by {newest_first}) as _rank"
    return df.selectExpr("*", rank).filter("_rank = 1").drop("_rank")


def current_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the current state, without reading any other column."""
    return df.select(*keys).distinct()
