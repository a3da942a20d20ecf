"""Shared helpers: reading tables, tables in the shared folder, and row-wise Arrow mapping."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code points of ASCII white space, the only separators of words in this package.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that one call of a mapped function gets at most.
ROWS_PER_CALL = 512

_local_dirs: dict[str, str] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share; a local one only where the master is local."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    app = spark.sparkContext
    if not app.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if app.applicationId not in _local_dirs:
        _local_dirs[app.applicationId] = tempfile.mkdtemp(prefix="llm-")
    return _local_dirs[app.applicationId]


def new_table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that its lineage ends there."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, under fixed names, whatever else ``docs`` holds."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def whole_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_and_text`` with a null text as the empty one."""
    return id_and_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))


def map_rows(
    df: DataFrame, schema: str, function: Callable[[list[dict]], list[tuple]] | None = None,
    factory: Callable[[], Callable[[list[dict]], list[tuple]]] | None = None,
) -> DataFrame:
    """``df`` with lists of its rows mapped to rows of ``schema``.

    ``factory`` builds the function once for each task, for functions with state of their own.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = factory() if factory else function
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_CALL):
                rows = call(batch.slice(start, ROWS_PER_CALL).to_pylist())
                columns = list(zip(*rows, strict=True)) if rows else [()] * len(out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, out, strict=True)], schema=out
                )

    return df.mapInArrow(run, schema)


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_remainder(id_column: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(id_column).cast("string") if isinstance(id_column, str) else id_column.cast("string")) % modulus


def appended(docs: DataFrame, column: str, added: str, function: Callable[[list], list], name: str) -> DataFrame:
    """``docs`` with a last column ``name`` of type ``added``, computed from lists of ``column``.

    All columns of ``docs`` pass through as they are, whatever their names, without a shuffle.
    """
    from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    if name in docs.columns:
        raise ValueError(f"the documents have a column {name}")
    kind = _parse_datatype_string(added)
    schema = StructType([*docs.schema.fields, StructField(name, kind)])
    fields, arrow = to_arrow_schema(schema), to_arrow_type(kind)
    at = docs.columns.index(column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_CALL):
                part = batch.slice(start, ROWS_PER_CALL)
                values = pa.array(function(part.column(at).to_pylist()), type=arrow)
                columns = [c.cast(f.type) for c, f in zip([*part.columns, values], fields, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=fields)

    return docs.mapInArrow(run, schema)


def release_memory() -> None:
    """Gives memory of finished steps back to the machine: Spark reuses Python workers for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library can do it
        ctypes.CDLL(None).malloc_trim(0)
