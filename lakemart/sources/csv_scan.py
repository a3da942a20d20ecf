"""CSV files with line breaks inside quotes, cut into records by many tasks.

Whether a line break ends a record depends on the quotes before it: inside a quoted field the
number of quotes so far is odd (a doubled quote counts twice). A split of a file therefore counts
its lines for both cases, as if it started outside and as if it started inside quotes, along with
the parity of its own quotes. The parities, added up over the splits of a file, tell which case
holds. So a file of any size is counted and read split by split; only the first and last pieces of
each split, which may belong to one record, travel.

Quotes must be balanced as in RFC 4180. Blank lines between records are no records.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPLIT = "path string, start bigint"
PIECES = f"{SPLIT}, kind int, header boolean, text string"
#: Kinds of pieces: a whole record, the last one of a split, and what continues an earlier split's.
WHOLE, LAST, CONTINUED = 0, 1, 2


def lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, start, text, quotes, blank) of every line, with the start of its split.

    Lines of one split are rows of one task, in order; splits are as long as Spark cuts them.
    """
    read = spark.read.option("lineSep", "\n").text(list(paths))
    return read.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("text"),
        (F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
        F.col("value").isin("", "\r").alias("blank"),
    )


def _runs(path: np.ndarray, start: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of rows that belong to one split."""
    change = np.flatnonzero((start[1:] != start[:-1]) | (path[1:] != path[:-1])) + 1
    bounds = [0, *change.tolist(), len(start)]
    yield from zip(bounds[:-1], bounds[1:], strict=True)


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    return tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)


def split_counts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, start, parity, outside, inside): records that begin in a split, for both cases."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parity, begun = None, 0, [0, 0]

        def row() -> pa.RecordBatch:
            values = [*held, parity, *begun]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["path", "start", "parity", "outside", "inside"])

        for batch in batches:
            path, start, quotes, blank = _columns(batch)
            for a, b in _runs(path, start):
                if held != (path[a], int(start[a])):
                    if held:
                        yield row()
                    held, parity, begun = (path[a], int(start[a])), 0, [0, 0]
                before = (parity + np.cumsum(quotes[a:b]) - quotes[a:b]) % 2
                for case in (0, 1):
                    begun[case] += int(((before == case) & ~blank[a:b]).sum())
                parity = int((parity + quotes[a:b].sum()) % 2)
        if held:
            yield row()

    slim = lines(spark, paths).select("path", "start", "quotes", "blank")
    return slim.mapInArrow(count, f"{SPLIT}, parity bigint, outside bigint, inside bigint")


def split_states(splits: DataFrame) -> DataFrame:
    """``splits`` with ``state``: 1 where the split starts inside quotes, else 0."""
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("state", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)


def record_counts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, records) of every file that has a line; the header is a record."""
    begun = F.when(F.col("state") == 0, F.col("outside")).otherwise(F.col("inside"))
    return split_states(split_counts(spark, paths)).groupBy("path").agg(F.sum(begun).alias("records"))


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header, text) of every record; the first one of each file is its header."""
    # One row for each split that starts inside quotes: some 20 bytes for every 128 MB of files.
    inside = split_states(split_counts(spark, paths)).filter("state = 1").select("path", "start", F.lit(True).alias("quoted"))
    placed = lines(spark, paths).join(F.broadcast(inside), ["path", "start"], "left").select(
        "path", "start", "text", "quotes", "blank", F.coalesce("quoted", F.lit(False)).alias("quoted")
    )

    def piece(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state, open_lines, kind, header = None, 0, [], WHOLE, False
        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["path", "start", "kind", "header", "text"]
            )

        def close(last: bool) -> None:
            if open_lines:
                of = LAST if last and kind == WHOLE else kind
                out.append((*held, of, header, "\n".join(open_lines)))

        for batch in batches:
            path, start, text, quotes, blank, quoted = _columns(batch)
            for a, b in _runs(path, start):
                if held != (path[a], int(start[a])):
                    close(last=True)
                    held, state = (path[a], int(start[a])), int(quoted[a])
                    open_lines, kind, header = [], CONTINUED if state else WHOLE, False
                    first = held[1] == 0
                before = (state + np.cumsum(quotes[a:b]) - quotes[a:b]) % 2
                for i, inside_quotes in zip(range(a, b), before.tolist(), strict=True):
                    if inside_quotes:
                        open_lines.append(text[i])
                    elif not blank[i]:
                        close(last=False)
                        open_lines, kind, header, first = [text[i]], WHOLE, first, False
                state = int((state + quotes[a:b].sum()) % 2)
            if out:
                yield flushed()
        close(last=True)
        if out:
            yield flushed()

    pieces = placed.mapInArrow(piece, PIECES)
    whole = pieces.filter(F.col("kind") == WHOLE).select("path", "header", "text")
    # A split's last record goes on in the next splits as long as those have only continued lines at
    # their head. At most two pieces of a split travel.
    order = Window.partitionBy("path").orderBy("start", F.desc("kind"))
    parts = pieces.filter(F.col("kind") != WHOLE).withColumn("record", F.count_if(F.col("kind") == LAST).over(order))
    joined = parts.groupBy("path", "record").agg(
        F.bool_or("header").alias("header"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), "\n").alias("text"),
    )
    both = whole.unionByName(joined.select("path", "header", "text"))
    return both.withColumn("text", F.regexp_replace("text", "\r$", ""))


# ---- digests of whole files -----------------------------------------------------------------

#: Line digests are the coefficients of a polynomial modulo this prime, taken at BASE.
PRIME = 2**255 - 19
BASE = int.from_bytes(hashlib.sha256(b"order-keeping digest of lines").digest(), "big") % PRIME


def line_digests(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, digest) of every file, from its bytes in their order, computed split by split.

    Digests of neighbouring stretches of lines combine like numbers written one after the other:
    the digest of a file does not depend on where it is cut, and a moved line changes it. With the
    file's size, which tells whether the last line has an end, it is hashed once more.
    """
    read = spark.read.option("lineSep", "\n").text(list(paths))
    raw = read.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("line"),
    )
    schema = f"{SPLIT}, size bigint, lines bigint, value binary"

    def stretch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, value = None, 0, 0

        def row() -> pa.RecordBatch:
            values = [*held, count, value.to_bytes(32, "big")]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=["path", "start", "size", "lines", "value"])

        for batch in batches:
            path, start, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            texts = batch.column(3).to_pylist()
            for a, b in _runs(path, start):
                if held is None or held[:2] != (path[a], int(start[a])):
                    if held:
                        yield row()
                    held, count, value = (path[a], int(start[a]), int(size[a])), 0, 0
                for line in texts[a:b]:
                    value = (value * BASE + int.from_bytes(hashlib.sha256(line).digest(), "big")) % PRIME
                count += b - a
        if held:
            yield row()

    def combine(rows: pa.Table) -> pa.Table:
        parts = rows.sort_by("start").to_pylist()
        total, value = 0, 0
        for part in parts:
            value = (value * pow(BASE, part["lines"], PRIME) + int.from_bytes(part["value"], "big")) % PRIME
            total += part["lines"]
        digest = hashlib.sha256(f"{parts[0]['size']}:{total}:{value:x}".encode()).hexdigest()
        return pa.table({"path": [parts[0]["path"]], "digest": [digest]})

    # One row for each split of a file meets there.
    return raw.mapInArrow(stretch, schema).groupBy("path").applyInArrow(combine, "path string, digest string")
