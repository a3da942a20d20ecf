"""Documents in groups of bounded size, and numbers packed for a shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import shuffle_tasks

#: Bytes of text in a group of documents, about.
GROUP_BYTES = 24_000_000


def packed(**columns) -> bytes:
    """Columns as one compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pydict(columns)
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def pack_numbers(*columns: tuple[np.ndarray, int]) -> bytes:
    """Columns of numbers with so many low bytes each, compressed byte by byte."""
    planes = [
        np.ascontiguousarray(x.astype("<i8" if x.dtype.kind == "i" else "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
        for x, width in columns
    ]
    return len(columns[0][0]).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack_numbers(blob: bytes, *widths: int) -> list[np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    raw = zstandard.ZstdDecompressor().decompress(blob[8:])
    out, at = [], 0
    for width in widths:
        full = np.zeros((n, 8), np.uint8)
        full[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        out.append(full.view("<u8").ravel())
        at += n * width
    return out


def unpack_all(blobs: Iterable[bytes], *widths: int) -> list[np.ndarray]:
    parts = [unpack_numbers(b, *widths) for b in blobs]
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.empty(0, np.uint64) for _ in widths]


def cut(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key with the positions that hold it, in order."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    names, first = np.unique(keys[order], return_index=True)
    for name, a, b in zip(names.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
        yield name, order[a:b]


def batches_of(schema: str, *columns: list) -> pa.RecordBatch:
    """Columns under a schema of int, bigint and binary columns."""
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, schema.split(", "))])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)


def grouped(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """``rows`` with a group number ``grp``, and the bytes of all texts.

    Equal rows share a group. Groups hold about GROUP_BYTES, so there are more of them as the
    documents grow, and as many as shuffle tasks at least.
    """
    total = rows.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    groups = max(shuffle_tasks(rows.sparkSession), -(-total // GROUP_BYTES))
    return rows.withColumn("grp", F.pmod(F.xxhash64(id_col, text_col), F.lit(groups)).cast("int")), total


def group_texts(grouped: DataFrame) -> DataFrame:
    """(grp, texts): compressed documents by group, of rows (doc_id, text, grp)."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column(2).to_numpy()
            order = np.argsort(groups, kind="stable")
            names, first = np.unique(groups[order], return_index=True)
            ends = np.append(first[1:], len(order))
            blobs = []
            for a, b in zip(first, ends, strict=True):
                part = batch.take(pa.array(order[a:b]))
                blobs.append(packed(doc_id=part.column(0), text=part.column(1).cast(pa.binary())))
            yield batches_of("grp int, texts binary", names.tolist(), blobs)

    return grouped.mapInArrow(pack, "grp int, texts binary")


def group_rows(texts: pa.Table) -> list[tuple[int, bytes]]:
    """Distinct (id, text) of a group by id, without null ids."""
    rows = {
        (i, raw)
        for blob in texts.column("texts").to_pylist()
        for i, raw in zip(*(c.to_pylist() for c in pa.ipc.open_stream(blob).read_all().columns), strict=True)
        if i is not None
    }
    return sorted(rows)
