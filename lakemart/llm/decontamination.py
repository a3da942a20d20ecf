"""Benchmark passages in documents, by the q-gram lemma.

Texts are compared by their letters and digits alone, in lower case. A passage of m characters
that occurs with at most e edits shares at least m - q + 1 - q * e of its q-grams with the place,
and their diagonals (position in the document less position in the passage) span at most e. So
the shared q-grams are counted in overlapping bands of diagonals, bands that reach the bound are
kept, and a banded alignment decides.
"""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import appended, documents, id_and_text

Q = 8
#: Edits allowed, as a share of a passage's characters.
EDIT_SHARE = 0.1
#: Items are cut into passages of each of these lengths, a new one every half; shorter ones stay whole.
#: The long ones allow edits that crowd together, the short ones find short copies: any verbatim
#: copy of LEAST_COPY letters and digits of an item holds a whole short passage.
PASSAGES = (120, 60)
LEAST_COPY = PASSAGES[-1] + PASSAGES[-1] // 2 - 1
#: Items with fewer letters and digits are looked for exactly, and between word borders.
EXACT_CHARS = 20
#: Items with fewer letters and digits hold no q-gram, as "yes" or a year, and say nothing of a leak.
LEAST_CHARS = Q
#: Characters of benchmark text that one pass over the documents looks for.
BLOCK_CHARS = 8_000_000
#: Bits of the table that sifts a document's q-grams.
SIEVE_BITS = 20

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
DROPPED = bytes(b for b in range(128) if not chr(b).isalnum())
LEAKS = "array<struct<item_id:string,start:int,end:int,n_passages:int,distance:int>>"


def normalised(raw: bytes) -> bytes:
    return raw.translate(LOWER, DROPPED)


def codes(raw: bytes) -> np.ndarray:
    """A 64-bit number for each q-gram of 8 bytes, equal for equal q-grams only."""
    n = len(raw) - Q + 1
    return np.ndarray((n,), "<u8", raw, strides=(1,)).copy() if n > 0 else np.empty(0, np.uint64)


def sieve(grams: np.ndarray) -> np.ndarray:
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)


def budget(length: int) -> int:
    """Edits allowed in a passage, fewer where the lemma would ask for no shared q-gram at all."""
    return max(0, min(int(EDIT_SHARE * length), (length - Q) // Q))


def masks_of(passage: bytes) -> dict[int, int]:
    """For each byte of a passage the set of its places, as bits."""
    masks: dict[int, int] = {}
    for i, c in enumerate(passage):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def within(masks: dict[int, int], length: int, text: bytes, most: int) -> bool:
    """Whether a part of ``text`` is at most ``most`` edits from a passage, by Myers' bit vectors."""
    whole, last = (1 << length) - 1, 1 << length - 1
    up, down, distance = whole, 0, length
    left = len(text) + most
    for equal in map(masks.get, text, itertools.repeat(0)):
        across = (((equal & up) + up) ^ up) | equal
        more = down | ~(across | up) & whole
        less = up & across
        left -= 1
        if more & last:
            distance += 1
        elif less & last:
            distance -= 1
            if distance <= most:
                return True
        if distance > left:
            return False
        more, less = more << 1 & whole, less << 1 & whole
        same = equal | down
        up = less | ~(same | more) & whole
        down = more & same
    return False


def band_distance(passage: bytes, text: bytes, slack: int) -> tuple[int, int, int]:
    """Least edits that turn ``passage`` into a part of ``text``, with the part's start and end.

    Cells further than ``slack`` from the text's diagonals [0, len(text) - len(passage)] are left
    out. Each cell carries its alignment's start in the low bits of its value.
    """
    p, t = np.frombuffer(passage, np.uint8), np.frombuffer(text, np.uint8)
    m, n, shift = len(p), len(t), 20
    width = max(n - m, 0) + 2 * slack + 1  # cell k of row i is column i - slack + k
    far = (m + n + 1) << shift
    columns = np.arange(width) - slack
    row = np.where((columns >= 0) & (columns <= n), np.clip(columns, 0, n), far).astype(np.int64)
    steps = np.arange(width, dtype=np.int64) << shift
    for i in range(1, m + 1):
        at = columns + i
        held = (at >= 1) & (at <= n)
        unlike = np.ones(width, np.int64)
        unlike[held] = t[at[held] - 1] != p[i - 1]
        new = np.where(held, row + (unlike << shift), far)
        new[:-1] = np.minimum(new[:-1], row[1:] + (1 << shift))
        new = np.where((at >= 0) & (at <= n), new, far)
        row = np.minimum(np.minimum.accumulate(new - steps) + steps, far)
        row = np.where((at >= 0) & (at <= n), row, far)
    best = int(np.argmin(row >> shift))
    return int(row[best] >> shift), int(row[best] & ((1 << shift) - 1)), int(columns[best] + m)


def places(whole: bytes) -> np.ndarray:
    """Where the bytes of ``normalised(whole)`` are in ``whole``."""
    return np.flatnonzero(np.isin(np.frombuffer(whole, np.uint8), np.frombuffer(DROPPED, np.uint8), invert=True))


def on_borders(letters: np.ndarray, start: int, end: int) -> bool:
    """Whether no letter or digit touches the letters from ``start`` to ``end`` from outside."""
    before = start == 0 or letters[start - 1] + 1 < letters[start]
    return bool(before and (end == len(letters) or letters[end - 1] + 1 < letters[end]))


class Passages:
    """Index of the passages of a block of benchmark items."""

    def __init__(self, items: tuple[tuple[str, str], ...]):
        self.items, self.raw, grams, owner, offset = [], [], [], [], []
        for item, text in items:
            raw = normalised((text or "").encode("utf-8", "surrogatepass"))
            if len(raw) < LEAST_CHARS:
                continue
            parts = set()
            for length in PASSAGES:
                last = max(0, len(raw) - length)
                parts |= {(start, min(start + length, len(raw))) for start in (*range(0, last + 1, length // 2), last)}
            for start, end in sorted(parts):
                part = raw[start:end]
                own = codes(part)
                grams.append(own)
                owner.append(np.full(len(own), len(self.raw)))
                offset.append(np.arange(len(own)))
                self.items.append(item)
                self.raw.append(part)
        none = [np.empty(0, np.int64)]
        self.grams = np.concatenate([g.astype(np.uint64) for g in grams] or none).astype(np.uint64)
        order = np.argsort(self.grams, kind="stable")
        self.grams = self.grams[order]
        self.owner = np.concatenate(owner or none)[order]
        self.offset = np.concatenate(offset or none)[order]
        self.bits: list[dict[int, int] | None] = [None] * len(self.raw)
        lengths = np.array([len(p) for p in self.raw], np.int64)
        self.edits = np.array([budget(len(p)) if len(p) >= EXACT_CHARS else 0 for p in self.raw], np.int64)
        self.least = lengths - Q + 1 - Q * self.edits
        self.table = np.zeros(1 << SIEVE_BITS, bool)
        self.table[sieve(self.grams)] = True

    def masks(self, p: int) -> dict[int, int]:
        if self.bits[p] is None:
            self.bits[p] = masks_of(self.raw[p])
        return self.bits[p]

    def bands(self, raw: bytes) -> list[tuple[int, int, int]]:
        """(passage, lowest diagonal, highest) of the bands that hold enough of a passage's q-grams."""
        own = codes(raw)
        at = np.flatnonzero(self.table[sieve(own)])
        first = np.searchsorted(self.grams, own[at], "left")
        count = np.searchsorted(self.grams, own[at], "right") - first
        total = int(count.sum())
        if not total:
            return []
        entry = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(total)
        passage, offset = self.owner[entry], self.offset[entry]
        diagonal = np.repeat(at, count) - offset
        # A passage without enough shared q-grams in the whole text has none in a band.
        often = np.bincount(passage, minlength=len(self.least)) >= self.least
        some = often[passage]
        passage, offset, diagonal = passage[some], offset[some], diagonal[some]
        if not len(passage):
            return []
        # Every range of e + 1 diagonals lies in one of the bands of 2 * (e + 1) that start every e + 1.
        step = self.edits[passage] + 1
        band = np.floor_divide(diagonal, step)
        passage = np.concatenate([passage, passage])
        band = np.concatenate([band, band - 1])
        offset = np.concatenate([offset, offset])
        # Distinct q-grams of a passage in a band; sorting by one number keeps this cheap.
        low = int(band.min())
        span = int(band.max()) - low + 1
        key = np.sort(((passage * span + band - low) << 10) | offset)
        key = key[np.concatenate(([True], key[1:] != key[:-1]))] >> 10
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        groups, sizes = key[first], np.diff(first, append=len(key))
        owner = groups // span
        held = sizes >= self.least[owner]
        out = []
        for p, b in zip(owner[held].tolist(), (groups[held] % span + low).tolist(), strict=True):
            width = int(self.edits[p]) + 1
            if out and out[-1][0] == p and out[-1][1:] == ((b - 1) * width, (b + 1) * width - 1):
                out[-1] = (p, (b - 1) * width, (b + 2) * width - 1)  # a pair of bands that overlap is aligned once
            else:
                out.append((p, b * width, (b + 2) * width - 1))
        return out

    def leaks(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(item, start, end, passages, least distance) of a text; positions count code points."""
        whole = text.encode("utf-8", "surrogatepass")
        raw = normalised(whole)
        letters: np.ndarray | None = None
        found: dict[str, list[tuple[int, int, int, int]]] = {}
        seen: dict[int, int] = {}
        for p, low, high in self.bands(raw):
            if seen.get(p, math.inf) == 0:
                continue  # an exact copy of this passage is known
            passage, edits = self.raw[p], int(self.edits[p])
            start = max(0, low - edits)
            end = min(len(raw), high + len(passage) + edits)
            exact = raw.find(passage, start, end)
            if len(passage) < EXACT_CHARS:
                letters = places(whole) if letters is None else letters
                while exact >= 0 and not on_borders(letters, exact, exact + len(passage)):
                    exact = raw.find(passage, exact + 1, end)
            if exact < 0 and (not edits or not within(self.masks(p), len(passage), raw[start:end], edits)):
                continue
            distance, a, b = (0, exact - start, exact - start + len(passage)) if exact >= 0 else band_distance(passage, raw[start:end], edits)
            if distance <= edits:
                seen[p] = min(distance, seen.get(p, distance))
                found.setdefault(self.items[p], []).append((p, distance, start + a, start + b))
        if not found:
            return []
        kept = places(whole) if letters is None else letters
        points = np.cumsum((np.frombuffer(whole, np.uint8) & 0xC0) != 0x80)  # code points up to each byte
        out = []
        for item, hits in sorted(found.items()):
            start, end = min(h[2] for h in hits), max(h[3] for h in hits)
            out.append((item, int(points[kept[start]]) - 1, int(points[kept[end - 1]]), len({h[0] for h in hits}), min(h[1] for h in hits)))
        return out


@functools.lru_cache(maxsize=2)
def index(items: tuple[tuple[str, str], ...]) -> Passages:
    return Passages(items)


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[tuple[tuple[str, str], ...]]:
    """The benchmark in blocks of about BLOCK_CHARS characters: one, for all but huge benchmarks."""
    items = id_and_text(benchmark, id_col, text_col).filter(F.col("text").isNotNull()).withColumn("doc_id", F.col("doc_id").cast("string"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-chars // BLOCK_CHARS))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)))
    return [
        tuple(sorted({(r["doc_id"] or "", r["text"]) for r in dealt.filter(F.col("block") == b).select("doc_id", "text").collect()}))
        for b in range(count)
    ]


def with_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", name: str = "leaks") -> DataFrame:
    """``docs`` with a column of the items that leak into each text, in no shuffle.

    A null text leaks nothing; repeated rows each have their leaks; repeated or null items of the
    benchmark are looked for once or not at all; a null item id is the empty one; without items
    or documents nothing leaks. Every item of LEAST_CHARS letters and digits or more is looked for in
    every whole text, those under EXACT_CHARS exactly: a benchmark of more than BLOCK_CHARS
    characters in several passes, one for each block. Of longer items any verbatim copy of
    LEAST_COPY letters and digits is found; shorter copies are found where they hold a passage.
    """
    out, names = docs, []
    for i, items in enumerate(blocks(benchmark)):
        names.append(f"{name}_{i}")

        def leaks(texts: list, items=items) -> list:
            found = index(items)
            return [
                [dict(zip(("item_id", "start", "end", "n_passages", "distance"), leak, strict=True)) for leak in found.leaks(t)] if t else []
                for t in texts
            ]

        out = appended(out, text_col, LEAKS, leaks, names[-1])
    joined = F.flatten(F.array(*names)) if len(names) > 1 else F.col(names[0])
    return out.withColumn(name, joined).drop(*names)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that leaks into it."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = with_leaks(id_and_text(documents(spark, sf_dir), "doc_id", "text"), benchmark)
    kind = benchmark.schema["item_id"].dataType.simpleString()
    return found.select("doc_id", F.inline("leaks")).withColumn("item_id", F.col("item_id").cast(kind))
