"""Tables kept by Spark's own writers: partitioned folders that are upserted in place, and bucketed tables.

An upsert rewrites only the partitions that hold a changed key, with dynamic partition overwrite;
all other folders stay as they are. The partitions of a table of N rows are chosen so that each
holds about ROWS_PER_FOLDER of them: ranges of the key's hash, so that they split evenly whatever
the keys, or a value of the rows, such as a month, where changes are close together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.upserts import sync_columns

#: Rows of a partition, about, where partitions are ranges of the key's hash.
ROWS_PER_FOLDER = 1_000_000
#: Buckets of a small table, so that it is still written and read by several tasks.
LEAST_BUCKETS = 8
FOLDER = "folder"


def folder_of(keys: Sequence[str], folders: int) -> str:
    """SQL of the partition of a row by its keys."""
    return f"cast(pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), {folders}) as int)"


def folder_count(rows: int, rows_per_folder: int = ROWS_PER_FOLDER) -> int:
    return max(1, -(-rows // rows_per_folder))


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_FOLDER) -> int:
    """Buckets of a table of about ``rows`` rows: a task sorts one of them, whatever the size of the table."""
    return max(LEAST_BUCKETS, folder_count(rows, rows_per_bucket))


class FolderTable:
    """A Parquet table at ``path``, partitioned by ``by`` (SQL over its rows), one row a key.

    ``by`` has to stay the same for the life of the table. A commit replaces whole partitions, one
    after the other: a job that dies in between may have replaced some of them, and running the
    same changes again gives the same table.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], by: str):
        self.spark, self.path, self.schema, self.keys, self.by = spark, path.rstrip("/"), schema, list(keys), by

    def read(self, folder: bool = False) -> DataFrame:
        """The rows; ``folder`` keeps the partition column."""
        typed = T.StructType([*self.schema.fields, T.StructField(FOLDER, T.IntegerType())])
        rows = self.spark.read.schema(typed).parquet(self.path)
        return rows if folder else rows.drop(FOLDER)

    def _write(self, rows: DataFrame, how: str) -> None:
        # The hint gathers a partition's rows, and lets the planner cut a large one into several tasks.
        rows.hint("rebalance", FOLDER).write.mode("overwrite").option("partitionOverwriteMode", how).partitionBy(FOLDER).parquet(self.path)

    def overwrite(self, rows: DataFrame) -> None:
        """The table with ``rows`` only."""
        self._write(rows.withColumn(FOLDER, F.expr(self.by)), "static")

    def upsert(self, changes: DataFrame) -> list[int]:
        """Replace the rows that share a key with ``changes``, and return the partitions rewritten.

        A key's partition may change with its row (``by`` a month, say): the partitions that hold the
        changed keys now are found by a scan of the key columns alone. One that is left without any
        row is not replaced by Spark's writer, so ``upsert`` refuses a change that would empty it.
        """
        placed = sync_columns(changes, self.read()).withColumn(FOLDER, F.expr(self.by))
        held = self.read(folder=True).select(*self.keys, FOLDER).join(placed.select(*self.keys), self.keys, "left_semi")
        # At most one row for each partition of the table.
        touched = sorted(r[0] for r in placed.select(FOLDER).union(held.select(FOLDER)).distinct().collect())
        if touched:
            current = self.read(folder=True).filter(F.col(FOLDER).isin(touched))
            kept = current.join(placed.select(*self.keys), self.keys, "left_anti")
            left = kept.select(FOLDER).union(placed.select(FOLDER)).distinct().collect()
            if emptied := sorted(set(touched) - {r[0] for r in left}):
                raise ValueError(f"partitions would lose their last row: {emptied}")
            self._write(kept.unionByName(placed), "dynamic")
        return touched


def write_bucketed(rows: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """``rows`` as a catalogue table of ``buckets`` by ``key``; groupings by it then need no exchange.

    The rows of a hot key share a bucket; that suits keys with few rows each, such as an order.
    """
    rows.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return rows.sparkSession.table(table)
