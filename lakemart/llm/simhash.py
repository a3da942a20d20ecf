"""Near duplicates by SimHash: fingerprints meet in a self-join of binary tries.

Two fingerprints that differ in at most d of 64 bits agree in two whole blocks when the bits are
cut into d + 2. Fingerprints are therefore dealt once for each pair of blocks, by the values of
the two. Those that agree there form a trie over their remaining bits, held as a sorted array in
which a node is a range. The trie is joined with itself: pairs of nodes are descended together,
bit by bit; a pair of unlike branches adds a differing bit, and pairs with more than d are pruned.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import documents, map_rows, stored, whole_texts
from lakemart.llm.components import components, forest

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Shingles whose bits are counted at a time.
SHINGLES_PER_COUNT = 65_536


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of a text as a signed 64-bit number."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    spaced = b" ".join
    digest = xxhash.xxh64_intdigest
    grams = max(1, len(words) - shingle + 1)
    total = np.zeros(64, np.int64)
    for start in range(0, grams, SHINGLES_PER_COUNT):
        hashes = np.array(
            [digest(spaced(words[i : i + shingle]), SEED) for i in range(start, min(grams, start + SHINGLES_PER_COUNT))], ">u8"
        )
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > grams).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    rows = whole_texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(
        rows, f"doc_id {kind}, fingerprint bigint", lambda batch: [(r["doc_id"], fingerprint(r["text"], shingle)) for r in batch]
    )


def arrangements(max_bits: int) -> list[list[tuple[int, int]]]:
    """Orders of (offset, width) blocks of the 64 bits; in each another pair of blocks leads."""
    edges = np.linspace(0, 64, max_bits + 3).astype(int).tolist()
    blocks = [(a, b - a) for a, b in itertools.pairwise(edges)]
    return [[*pair, *(x for x in blocks if x not in pair)] for pair in itertools.combinations(blocks, 2)]


def rearranged(values: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    """Bits of unsigned ``values`` with the blocks in the given order, the first one highest."""
    out = np.zeros_like(values)
    for offset, width in order:
        mask = np.uint64((1 << width) - 1)
        out = (out << np.uint64(width)) | ((values >> np.uint64(offset)) & mask)
    return out


def trie_self_join(values: np.ndarray, bits: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of pairs of distinct sorted ``values`` that agree above the low ``bits`` and differ in few.

    Node pairs are held as ranges (a, b) of ``values`` with the number of differing bits so far.
    """
    group = values >> np.uint64(bits)
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    ends = np.append(starts[1:], len(values))
    many = ends - starts > 1
    a0, a1 = starts[many], ends[many]
    b0, b1, differ = a0, a1, np.zeros(len(a0), np.int8)
    for bit in range(bits - 1, -1, -1):
        if not len(a0):
            break
        one = np.uint64(1 << bit)
        above = np.uint64(~((1 << (bit + 1)) - 1) & (2**64 - 1))
        a_mid = np.searchsorted(values, (values[a0] & above) | one)
        b_mid = np.searchsorted(values, (values[b0] & above) | one)
        same = a0 == b0
        low = (a0, a_mid, b0, b_mid, differ)
        high = (a_mid, a1, b_mid, b1, differ)
        cross = (a0, a_mid, b_mid, b1, differ + 1)
        back = tuple(x[~same] for x in (a_mid, a1, b0, b_mid, differ + 1))
        a0, a1, b0, b1, differ = (np.concatenate(x) for x in zip(low, high, cross, back, strict=True))
        keep = (a0 < a1) & (b0 < b1) & (differ <= max_bits) & ~((a0 == b0) & (a1 - a0 == 1))
        a0, a1, b0, b1, differ = (x[keep] for x in (a0, a1, b0, b1, differ))
    return a0, b0


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links whose closure is that of all pairs of ``fingerprint`` within ``max_bits``.

    Each task reduces the pairs it finds to a spanning forest; at least one of the tasks finds
    any given pair.
    """
    orders = arrangements(max_bits)

    def leading(order):
        value = F.lit(0).cast("bigint")
        for offset, width in order[:2]:
            part = F.shiftrightunsigned("fingerprint", offset).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
            value = F.shiftleft(value, width).bitwiseOR(part)
        return value

    dealt = distinct.select(
        "fingerprint",
        F.explode(F.array(*(F.struct(F.lit(i).alias("arrangement"), leading(o).alias("lead")) for i, o in enumerate(orders)))).alias("x"),
    ).select("x.arrangement", "x.lead", "fingerprint")

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not held:
            return
        which, raw = (np.concatenate(x) for x in zip(*held, strict=True))
        found = [(np.empty(0, np.int64),) * 2]
        for i, order in enumerate(orders):
            own = raw[which == i].view(np.uint64)
            values = rearranged(own, order)
            rank = np.argsort(values)
            own = own[rank].view(np.int64)
            x, y = trie_self_join(values[rank], 64 - sum(w for _, w in order[:2]), max_bits)
            found.append((own[x], own[y]))
        a, b = forest(*(np.concatenate(x) for x in zip(*found, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return (
        dealt.repartition("arrangement", "lead").select(F.col("arrangement").cast("int"), "fingerprint")
        .mapInArrow(join, "a bigint, b bigint")
    )


def simhash_components(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; the component is its smallest reachable id.

    A null text counts as empty; texts without words have fingerprint zero and are linked like
    any other. Repeated rows and ids each keep their row. A null id has a row and never names a
    component but where all ids of it are null. An empty table gives no rows; other columns are
    not read. Copies are joined as one distinct fingerprint, whatever their number.
    """
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(distinct.select("fingerprint"), max_bits))
    rooted = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    named = stored(rooted, "rooted-fingerprints")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fingerprint = named.join(smallest, "root").select("fingerprint", "component_id")
    return rows.join(of_fingerprint, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents."""
    return simhash_components(documents(spark, sf_dir))
