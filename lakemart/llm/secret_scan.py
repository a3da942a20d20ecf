"""Secrets by patterns and by a battery of randomness tests.

Long runs of encoding characters are candidates. The smallest encoding that holds all characters
of a candidate is taken as its alphabet, and three tests ask whether its characters could have
been drawn evenly and independently from it: a chi-squared test of the symbols, a runs test about
the middle of the alphabet, and a lag-1 serial correlation. Fisher's method joins them into one
p-value, even on [0, 1] for random candidates and near 0 for words and identifiers.

Short candidates tell the two apart less well than long ones, so the share of false discoveries
is controlled apart for each family of encoding and length, over all documents, and the family's
threshold is the lowest that keeps that share. Ordinary candidates above a threshold are at most
the family's candidates times the share of ordinary names that get so far (``ORDINARY``); in
families with many random candidates, those are also estimated from the upper half of p-values, and
the rest above a threshold counts as false.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import appended, documents, map_rows, stored, whole_texts
from lakemart.llm.spans import SPANS, digest_columns, one_per_code_point, ordered, redacted, without_overlap

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "random")
#: Share of false discoveries that a family of candidates may have.
FALSE_SHARE = 0.05
#: Bins of p-values of which thresholds are whole multiples.
BINS = 64

#: Bins of p-values, and the share of ordinary names that reach them, by size class (the last one for
#: all longer ones): the worst of eight ways to join English words and numbers (CamelCase, capitals,
#: paths, snake_case and so on, 4000 names each).
ORDINARY_BINS = (1, 2, 4, 8, 16, 32)
ORDINARY = {
    8: (0.53, 0.49, 0.40, 0.27, 0.175, 0.048),
    9: (0.21, 0.145, 0.11, 0.071, 0.033, 0.012),
    10: (0.027, 0.02, 0.012, 0.006, 0.003, 0.001),
    11: (0.002, 0.0014, 0.001, 0.001, 0.001, 0.0005),
}
#: Base32 has no small letters: names in capitals reach further.
ORDINARY_BASE32 = {
    8: (0.65, 0.60, 0.51, 0.40, 0.28, 0.13),
    9: (0.43, 0.37, 0.30, 0.22, 0.12, 0.036),
    10: (0.14, 0.11, 0.068, 0.036, 0.016, 0.0042),
    11: (0.013, 0.009, 0.006, 0.006, 0.001, 0.001),
}
#: Candidates in the upper half of p-values from which their number tells that of random ones.
MANY = 20

#: Words that a secret is assigned to.
ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
#: Encodings by their symbols in order, smallest first.
DIGITS = b"0123456789"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
ENCODINGS = (
    ("hex", DIGITS + b"abcdef"),
    ("HEX", DIGITS + b"ABCDEF"),
    ("base32", UPPER + b"234567"),
    ("base62", DIGITS + UPPER + LOWER),
    ("base64", UPPER + LOWER + DIGITS + b"+/"),
    ("base64url", UPPER + LOWER + DIGITS + b"-_"),
)
#: Length from which candidates are tested.
SHORTEST = 20
SIZE = {name: len(symbols) for name, symbols in ENCODINGS}
SYMBOL = {name: np.array([symbols.find(b) for b in range(256)]) for name, symbols in ENCODINGS}
RUN = np.zeros(256, bool)
RUN[np.frombuffer(DIGITS + UPPER + LOWER + b"+/_=.-", np.uint8)] = True
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_-]{20,}")
#: A candidate may be part of a path or of a name joined by hyphens: the parts are candidates too.
#: Words and plain numbers at their ends are left out.
PARTS = tuple(re.compile(p) for p in (rb"[^/]{20,}", rb"[^_-]{20,}", rb"[^/_-]{20,}"))
FIRST_WORDS = re.compile(rb"(?:(?:[A-Z]?[a-z]{0,18}|[A-Z]{1,19}|[0-9]{1,19})[/_-])*")
LAST_WORDS = re.compile(rb"(?:(?:[a-z]{0,18}[A-Z]?|[A-Z]{1,19}|[0-9]{1,19})[/_-])*")  # of a reversed run

FOUND = (
    f"spans {SPANS}, candidates array<struct<start:int,end:int,encoding:string,size_class:int,bin:int>>"
)


def normal_tails(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def infer(raw: bytes) -> tuple[str, np.ndarray] | None:
    """Smallest encoding with all characters of a candidate, and the candidate's symbols."""
    if not raw.strip(DIGITS):
        return None  # a number
    codes = np.frombuffer(raw, np.uint8)
    for name, _ in ENCODINGS:
        symbols = SYMBOL[name][codes]
        if symbols.min() >= 0:
            return name, symbols
    return None


def randomness(symbols: np.ndarray, size: int) -> float:
    """Joint p-value of the three tests that ``symbols`` are even and independent over ``size``."""
    n = len(symbols)
    counts = np.bincount(symbols, minlength=size)
    chi = float((counts.astype(float) ** 2).sum() * size / n - n)
    # The exact mean and variance of the statistic under evenness; too many repeats count against.
    uniform = math.erfc((chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n) / math.sqrt(2)) / 2
    high = symbols >= size / 2
    above = int(high.sum())
    below = n - above
    if not above or not below:
        return 0.0
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 1 + 2 * above * below / n
    variance = (mean - 1) * (mean - 2) / (n - 1)
    run_test = normal_tails((runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0
    centred = symbols - symbols.mean()
    spread = float((centred**2).sum())
    if spread == 0:
        return 0.0
    serial = float((centred[1:] * centred[:-1]).sum()) / spread
    correlation = normal_tails((serial + 1 / n) * math.sqrt(n))
    x = -sum(math.log(max(p, 1e-300)) for p in (uniform, run_test, correlation))
    return math.exp(-x) * (1 + x + x * x / 2)


def long_runs(raw: bytes) -> list[tuple[int, int]]:
    """Maximal stretches of SHORTEST and more characters that patterns and encodings share."""
    held = np.concatenate(([False], RUN[np.frombuffer(raw, np.uint8)], [False]))
    edges = np.flatnonzero(held[1:] != held[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= SHORTEST
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def candidate_places(run: bytes) -> list[tuple[int, int]]:
    """Whole candidates of a run and their parts, by start, the longest first."""
    found = set()
    for m in CANDIDATE.finditer(run):
        places = {m.span()}
        if b"/" in m[0] or b"-" in m[0] or b"_" in m[0]:
            places |= {(m.start() + part.start(), m.start() + part.end()) for pattern in PARTS for part in pattern.finditer(m[0])}
        for a, b in places:
            a = FIRST_WORDS.match(run, a, b).end()
            b -= LAST_WORDS.match(run[a:b][::-1]).end()
            if b - a >= SHORTEST:
                found.add((a, b))
    return sorted(found, key=lambda x: (x[0], -x[1]))


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple]]:
    """Base spans of a text, and its candidates with encoding, size class and bin of the p-value."""
    raw = one_per_code_point(text)
    base, candidates = [], []
    lower = raw.lower()
    if any(word.encode() in lower for word in ASSIGN_WORDS):
        base += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    for start, end in long_runs(raw):
        run = raw[start:end]
        base += [("access", start + m.start(), start + m.end()) for m in ACCESS.finditer(run) if m.end() - m.start() >= 20]
        base += [("hex", start + m.start(), start + m.end()) for m in HEX.finditer(run)]
        for a, b in candidate_places(run):
            if inferred := infer(run[a:b]):
                name, symbols = inferred
                size = SIZE[name]
                p = randomness(symbols, size)
                size_class = int(2 * math.log2(len(symbols)))
                candidates.append((start + a, start + b, name, size_class, min(BINS - 1, int(p * BINS))))
    return ordered(base, KINDS), candidates


def ordinary_share(encoding: str, size_class: int, first: int) -> float:
    """Share of ordinary candidates of a family whose p-values reach the bin ``first``, at most."""
    known = (ORDINARY_BASE32 if encoding == "base32" else ORDINARY)[min(size_class, max(ORDINARY))]
    return min((share for at, share in zip(ORDINARY_BINS, known, strict=True) if at <= first), default=1.0)


def without_nested(found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """``found`` without spans that lie inside others of ``found``."""
    out, end = [], -1
    for span in sorted(found, key=lambda s: (s[1], -s[2])):
        if span[2] > end:
            out.append(span)
            end = span[2]
    return out


def thresholds(candidates: DataFrame, false_share: float = FALSE_SHARE) -> dict[tuple[str, int], int]:
    """Lowest bin of p-values that counts as random, for each family that has one.

    ``candidates`` has (encoding, size_class, bin). What comes to the driver is a count for each
    family and bin: at most six encodings by some fifty size classes by BINS.
    """
    counts: dict[tuple[str, int], np.ndarray] = {}
    for row in candidates.groupBy("encoding", "size_class", "bin").count().collect():
        counts.setdefault((row["encoding"], row["size_class"]), np.zeros(BINS))[row["bin"]] = row["count"]
    out = {}
    for family, by_bin in counts.items():
        upper = by_bin[BINS // 2 :].sum()
        for first in range(BINS):
            passed = by_bin[first:].sum()
            false = by_bin.sum() * ordinary_share(*family, first)
            if upper >= MANY:
                false = min(false, passed - 2 * upper * (BINS - first) / BINS)
            if passed and false / passed <= false_share:
                out[family] = first
                break
    return out


def spans_of(text: str, least: dict[tuple[str, int], int]) -> list[dict]:
    """Base spans of a text, and its longest candidates that count as random and overlap none of them."""
    base, candidates = scan(text)
    extra = [("random", a, b) for a, b, e, s, p in candidates if p >= least.get((e, s), BINS)]
    extra = without_nested(without_overlap(extra, base))
    return [{"kind": k, "start": a, "end": b} for k, a, b in ordered(base + extra, KINDS)]


def redact(docs: DataFrame, text_col: str = "text", false_share: float = FALSE_SHARE, mark: str = "[{}]") -> DataFrame:
    """``docs`` with each secret of the texts replaced by its kind, in no shuffle of the texts.

    The texts are read twice: once for the families' thresholds, once to redact. A null text
    stays null; all other columns pass through.
    """
    rows = docs.select(F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))

    def count(batch: list[dict]) -> list[tuple]:
        return [(e, s, p) for r in batch for *_, e, s, p in scan(r["text"])[1]]

    least = thresholds(map_rows(rows, "encoding string, size_class int, bin int", count), false_share)

    def clean(texts: list) -> list:
        return [None if t is None else redacted(t, spans_of(t, least), mark) for t in texts]

    name = "_".join(["redacted", *docs.columns])
    return appended(docs, text_col, "string", clean, name).withColumn(text_col, F.col(f"`{name}`")).drop(name)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """(doc_id, spans) of every row; positions count code points, ends are exclusive.

    A null text counts as empty and has no spans; repeated rows each give a row and each count in
    the families; an empty table gives no rows; other columns are not read. Base spans of
    different kinds may overlap; ``random`` spans overlap none of them and lie not inside each other.
    """
    rows = whole_texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def call(batch: list[dict]) -> list[tuple]:
        out = []
        for r in batch:
            base, candidates = scan(r["text"])
            # Candidates that overlap a base span count in their family and give no span.
            free = {s[1:] for s in without_overlap([("", a, b) for a, b, *_ in candidates], base)}
            out.append((
                r["doc_id"],
                [{"kind": k, "start": a, "end": b} for k, a, b in base],
                [{"start": a if (a, b) in free else -1, "end": b, "encoding": e, "size_class": s, "bin": p} for a, b, e, s, p in candidates],
            ))
        return out

    scanned = stored(map_rows(rows, f"doc_id {kind}, {FOUND}", call), "secret-candidates")
    least = thresholds(scanned.select(F.inline("candidates")), false_share)
    table = F.create_map(*(F.lit(x) for (e, s), b in least.items() for x in (f"{e} {s}", b))) if least else None

    def passes(c):
        if table is None:
            return F.lit(False)
        bound = F.element_at(table, F.concat_ws(" ", c["encoding"], c["size_class"]))
        return (c["start"] >= 0) & F.coalesce(c["bin"] >= bound, F.lit(False))

    extra = F.transform(
        F.filter("candidates", passes),
        lambda c: F.struct(F.lit("random").alias("kind"), c["start"].alias("start"), c["end"].alias("end")),
    )
    # Candidates are by start, the longest first: the one before with the last end holds what is nested.
    ends = F.struct(F.array().cast(SPANS).alias("out"), F.lit(-1).alias("end"))
    extra = F.aggregate(
        extra, ends,
        lambda held, c: F.when(
            c["end"] > held["end"], F.struct(F.concat(held["out"], F.array(c)).alias("out"), c["end"].alias("end"))
        ).otherwise(held),
        lambda held: held["out"],
    )
    rank = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))
    by_place = lambda a, b: F.when(
        F.struct(a["start"], rank[a["kind"]]) < F.struct(b["start"], rank[b["kind"]]), -1
    ).otherwise(1)
    joined = F.when(F.size(extra) == 0, F.col("spans")).otherwise(F.array_sort(F.concat("spans", extra), by_place))
    return scanned.select("doc_id", joined.alias("spans"))


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return digest_columns(find_secrets(documents(spark, sf_dir)), BASE)
