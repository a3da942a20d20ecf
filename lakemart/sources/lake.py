"""Tables as immutable Parquet folders plus one pointer file per commit.

Plain Parquet has no MERGE and no transaction over several tables. Writers therefore only add
folders; a commit publishes one small JSON document that lists the folders of every table.
Readers see the newest document, so a job that dies half-way has published nothing, and a
table can be read while its next version is written. One writer at a time is expected; a
second one loses the rename of the pointer file and raises.

Layout: ``<root>/<table>/lake_version=<commit>/[<partition>=<value>/]*.parquet`` and
``<root>/_commits/<number>.json``.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import threading
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.upserts import sync_columns

VERSION = "lake_version"
# Text columns of RAW tables and ids get a fifth to a third smaller than with the default.
CODEC = "zstd"
COMMITS = "_commits"
# Spark's name of a folder for rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Spark's setting by which a statement removes its shuffle files as it ends. Else they stay until the
# driver happens to collect the plan as garbage, and a build holds those of all its statements at once.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Two tables in the same buckets of one column also meet by that and further columns as they lie.
AS_THEY_LIE = "spark.sql.requireAllClusterKeysForCoPartition"
WITHIN = {RELEASE: "true", AS_THEY_LIE: "false"}


_registering = threading.Lock()


class ConcurrentCommitError(RuntimeError):
    """Another writer published first."""


@dataclass
class TableState:
    """Folders of one table: ``(relative path, partition value or None)``.

    ``partition`` is the name of an integer layout column and ``by`` its SQL expression. With ``buckets``,
    the files of each folder are Spark's buckets of the column ``bucket``.
    """

    schema: T.StructType
    partition: str | None = None
    by: str | None = None
    folders: list[tuple[str, str | None]] = field(default_factory=list)
    bucket: str | None = None
    buckets: int = 0

    def layout(self) -> dict:
        return {"partition": self.partition, "by": self.by, "bucket": self.bucket, "buckets": self.buckets}

    def to_json(self) -> dict:
        return {"schema": self.schema.jsonValue(), "folders": self.folders, **self.layout()}

    @staticmethod
    def from_json(doc: dict) -> TableState:
        folders = [(path, value) for path, value in doc["folders"]]
        schema = T.StructType.fromJson(doc["schema"])
        return TableState(schema, doc["partition"], doc["by"], folders, doc.get("bucket"), doc.get("buckets", 0))


class Files:
    """The few file-system calls needed, through the Hadoop API, so any Spark path works."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self.path("").getFileSystem(self._conf)

    def path(self, relative: str):
        full = f"{self.root}/{relative}" if relative else self.root
        return self._jvm.org.apache.hadoop.fs.Path(full)

    def names(self, relative: str, pattern: str = "*") -> list[str]:
        found = self._fs.globStatus(self.path(f"{relative}/{pattern}" if relative else pattern))
        return sorted(status.getPath().getName() for status in (found or []))

    def matches(self, pattern: str) -> list[str]:
        """Full paths of the files under the root that match a glob, sorted."""
        found = self._fs.globStatus(self.path(pattern))
        return sorted(status.getPath().toString() for status in (found or []))

    def read_text(self, relative: str) -> str:
        stream = self._fs.open(self.path(relative))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish_text(self, relative: str, text: str) -> bool:
        """Make a whole new file visible at once; False if it exists already."""
        target = self.path(relative)
        draft = self.path(f"{relative}.{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            return False
        return True


class Lake:
    """Read access to the newest commit under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.files = Files(spark, root)
        self.root = self.files.root
        self._listed: set[str] = set()

    def state(self) -> tuple[int, dict[str, TableState]]:
        commits = self.files.names(COMMITS, "*.json")
        if not commits:
            return 0, {}
        document = json.loads(self.files.read_text(f"{COMMITS}/{commits[-1]}"))
        tables = {name: TableState.from_json(doc) for name, doc in document["tables"].items()}
        return int(commits[-1].removesuffix(".json")), tables

    def tables(self) -> list[str]:
        return sorted(self.state()[1])

    def has(self, table: str) -> bool:
        return table in self.state()[1]

    def read(self, table: str, layout: bool = False) -> DataFrame:
        """The table as published; ``layout`` keeps the physical partition column."""
        return self._load(table, self.state()[1][table], layout)

    def _load(
        self, table: str, state: TableState, layout: bool = False, only: set | None = None
    ) -> DataFrame:
        folders = [path for path, value in state.folders if only is None or value in only]
        schema = state.schema
        if state.partition and layout:
            schema = T.StructType([*schema.fields, T.StructField(state.partition, T.IntegerType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        typed = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
        if state.buckets:
            return self._bucketed(table, state, folders).select(*schema.names)
        reader = self.spark.read.schema(typed).option("basePath", f"{self.root}/{table}")
        df = reader.parquet(*[f"{self.root}/{path}" for path in folders])
        return df.select(*[f.name for f in schema.fields])

    def _bucketed(self, table: str, state: TableState, folders: Sequence[str]) -> DataFrame:
        """The folders as a catalogue table, by which Spark learns of their buckets.

        Its name follows from its content. It stays in the session's catalogue, where plans look it up
        again when they run; its files are not the catalogue's.
        """
        parts = {VERSION: "string", state.partition: "int"}
        listed = sorted(folders)
        digest = hashlib.sha256(json.dumps([self.root, table, state.schema.jsonValue(), listed]).encode()).hexdigest()
        name = f"lake_{digest[:40]}"
        specs = []
        for folder in listed:
            version, value = (part.split("=", 1)[1] for part in folder.rsplit("/", 2)[1:])
            specs.append(f"partition ({VERSION} = '{version}', `{state.partition}` = {'null' if value == NO_VALUE else value})")
        with _registering:  # a table is not read before all its folders are listed
            if name not in self._listed or not self.spark.catalog.tableExists(name):
                self._register(name, f"{self.root}/{table}", state, parts)
                self.spark.sql(f"alter table {name} add if not exists {' '.join(specs)}")
                self._listed.add(name)
        return self.spark.table(name)

    def _register(self, name: str, path: str, state: TableState, parts: dict[str, str]) -> None:
        columns = ", ".join(f"`{c}` {kind}" for c, kind in {**{f.name: f.dataType.simpleString() for f in state.schema.fields}, **parts}.items())
        by = ", ".join(f"`{c}`" for c in parts)
        self.spark.sql(
            f"create table if not exists {name} ({columns}) using parquet options (compression '{CODEC}')"
            f" partitioned by ({by}) clustered by (`{state.bucket}`) sorted by (`{state.bucket}`) into {state.buckets} buckets location '{path}'"
        )

    def transaction(self) -> Transaction:
        return Transaction(self)


class Transaction:
    """Changes to any number of tables, published together when the block ends without error.

    The settings ``WITHIN`` hold inside the block.
    """

    def __init__(self, lake: Lake):
        self.lake = lake
        self.base, self.tables = lake.state()
        self._parts = itertools.count(1)
        self._id = uuid.uuid4().hex[:12]

    def __enter__(self) -> Transaction:
        conf = self.lake.spark.conf
        self._kept = {name: conf.get(name) for name in WITHIN}
        for name, value in WITHIN.items():
            conf.set(name, value)
        return self

    def __exit__(self, failure, *_) -> None:
        for name, value in self._kept.items():
            self.lake.spark.conf.set(name, value)
        if failure is None:
            self.commit()

    def has(self, table: str) -> bool:
        return table in self.tables

    def buckets(self, table: str) -> int:
        """Buckets of the table's folders, 0 where they have none."""
        return self.tables[table].buckets

    def read(self, table: str, layout: bool = False) -> DataFrame:
        """The table with the changes made so far in this transaction."""
        return self.lake._load(table, self.tables[table], layout)

    def _write(
        self, table: str, df: DataFrame, partition: str | None = None, by: str | None = None, bucket: str | None = None, buckets: int = 0,
        late: dict[str, Column] | None = None,
    ) -> list[tuple[str, str | None]]:
        """Write one new folder (or one per partition value) and list what was written.

        ``late`` states columns of ``df`` again, as functions of its others: they are left out of the
        exchange that gathers the partitions, and computed after it.

        With ``buckets`` rows are dealt by ``bucket`` instead. Spark leaves that exchange out where they
        already are, as they come from joins and sums of tables with the same buckets.
        """
        folder = f"{table}/{VERSION}={self.base + 1:08d}-{self._id}-{next(self._parts)}"
        target = f"{self.lake.root}/{folder}"
        if partition is None:
            df.write.mode("errorifexists").parquet(target, compression=CODEC)
            return [(folder, None)]
        if buckets:
            state = TableState(df.schema, partition, by, bucket=bucket, buckets=buckets)
            name = f"lake_{uuid.uuid4().hex}"
            self.lake._register(name, target, state, {partition: "int"})
            try:
                df.selectExpr("*", f"{by} as {partition}").repartition(buckets, bucket).write.insertInto(name)
            finally:
                self.lake.spark.sql(f"drop table {name}")  # the entry only: tables with a location keep their files
            names = self.lake.files.names(folder, f"{partition}=*")
            return [(f"{folder}/{name}", name.split("=", 1)[1]) for name in names]
        # The rebalance hint groups rows by partition value and lets the adaptive planner cut
        # a value with many rows into several tasks and merge small ones.
        late = late or {}
        placed = df.selectExpr("*", f"{by} as {partition}").drop(*late).hint("rebalance", partition)
        rows = placed.select(*[late[c].cast(df.schema[c].dataType).alias(c) if c in late else c for c in [*df.columns, partition]])
        rows.write.mode("errorifexists").partitionBy(partition).parquet(target, compression=CODEC)
        names = self.lake.files.names(folder, f"{partition}=*")
        return [(f"{folder}/{name}", name.split("=", 1)[1]) for name in names]

    def append(self, table: str, df: DataFrame) -> DataFrame:
        """Add rows as a new folder and return them as written."""
        state = self.tables.get(table) or TableState(df.schema)
        folders = self._write(table, df, **state.layout())
        merged = list(state.schema.fields)
        merged += [f for f in df.schema.fields if f.name not in state.schema.names]
        self.tables[table] = replace(state, schema=T.StructType(merged), folders=[*state.folders, *folders])
        return self.lake._load(table, replace(state, schema=df.schema, folders=folders))

    def overwrite(
        self, table: str, df: DataFrame, partition: str | None = None, by: str | None = None, late: dict[str, Column] | None = None,
        bucket: str | None = None, buckets: int = 0,
    ) -> DataFrame:
        """The table with the rows of ``df`` only; ``late``, ``buckets``: see ``_write``."""
        folders = self._write(table, df, partition, by, bucket, buckets, late)
        self.tables[table] = TableState(df.schema, partition, by, folders, bucket, buckets)
        return self.read(table)

    def upsert(
        self,
        table: str,
        changes: DataFrame,
        keys: Sequence[str],
        partition: str | None = None,
        by: str | None = None,
        late: dict[str, Column] | None = None,
        bucket: str | None = None,
        buckets: int = 0,
    ) -> DataFrame:
        """Replace the rows that share a key with ``changes``; return the changes as written.

        The changes become new folders first, which makes their size known to the joins that
        follow. Then only partitions that hold a changed key are rewritten without it: they
        are found by scanning the key columns alone. The others stay as they are.
        """
        if table not in self.tables:
            return self.overwrite(table, changes, partition, by, late, bucket, buckets)
        old = self.tables[table]
        fresh = self._write(table, changes, **old.layout(), late=late)
        written = replace(old, schema=changes.schema, folders=fresh)
        delta = self.lake._load(table, written)
        if delta.isEmpty() and changes.schema == old.schema:
            return delta
        changed_keys = delta.select(*keys)

        hit: set[str | None]
        if old.partition:
            held = self.lake._load(table, old, layout=True).select(*keys, old.partition)
            found = held.join(changed_keys, list(keys), "left_semi")
            rows = found.select(F.col(old.partition).cast("string")).distinct().collect()
            hit = {NO_VALUE if r[0] is None else r[0] for r in rows}
        else:
            held = self.lake._load(table, old).select(*keys)
            empty = held.join(changed_keys, list(keys), "left_semi").isEmpty()
            hit = set() if empty else {None}

        kept_folders = [f for f in old.folders if f[1] not in hit]
        if hit:
            touched = self.lake._load(table, old, only=hit)
            # Rows in buckets stay as they are dealt only where both sides are read by bucket.
            changed_keys = changed_keys.hint("merge") if old.buckets else changed_keys
            kept = touched.join(changed_keys, list(keys), "left_anti")
            kept = sync_columns(kept, changes)
            kept_folders += self._write(table, kept, **old.layout())
        self.tables[table] = replace(written, folders=[*kept_folders, *fresh])
        return delta

    def drop(self, table: str) -> None:
        self.tables.pop(table, None)

    def commit(self) -> int:
        document = {"tables": {name: state.to_json() for name, state in self.tables.items()}}
        number = self.base + 1
        if not self.lake.files.publish_text(f"{COMMITS}/{number:08d}.json", json.dumps(document)):
            raise ConcurrentCommitError(f"commit {number} was published by another writer")
        self.base = number
        return number
