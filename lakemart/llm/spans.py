"""Spans found in texts: their text form, digests and redaction."""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int>>"


def one_per_code_point(text: str) -> bytes:
    """A byte for each code point: itself up to U+00FF, a question mark beyond."""
    return text.encode("latin-1", "replace")


def ordered(found: list[tuple[str, int, int]], kinds: tuple[str, ...]) -> list[tuple[str, int, int]]:
    """Spans by start, then by the order of ``kinds``."""
    rank = {kind: i for i, kind in enumerate(kinds)}
    return sorted(found, key=lambda s: (s[1], rank[s[0]], s[2]))


def without_overlap(extra: list[tuple[str, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """``extra`` without spans that share a character with one of ``base``."""
    out = []
    base = sorted((s[1], s[2]) for s in base)
    most = [0]
    for _, end in base:
        most.append(max(most[-1], end))
    starts = [s for s, _ in base]
    for span in extra:
        at = bisect.bisect_left(starts, span[2])
        if most[at] <= span[1]:
            out.append(span)
    return out


def not_inside(extra: list[tuple[str, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """``extra`` without spans that lie wholly inside one of ``base``."""
    base = sorted((s[1], s[2]) for s in base)
    most = [0]
    for _, end in base:
        most.append(max(most[-1], end))
    starts = [s for s, _ in base]
    return [x for x in extra if most[bisect.bisect_right(starts, x[1])] < x[2]]


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest_columns(found: DataFrame, base: tuple[str, ...]) -> DataFrame:
    """(doc_id, n_<kind> for each base kind, base_sha256, spans) of rows (doc_id, spans)."""
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(as_text(of(*base)), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )


def redacted(text: str, spans: list[dict], mark: str) -> str:
    """``text`` with each stretch that spans cover replaced by ``mark`` in which {} is the kind."""
    out, at = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if span["end"] <= at:
            continue
        if span["start"] >= at:
            out += [text[at : span["start"]], mark.format(span["kind"])]
        at = span["end"]
    return "".join([*out, text[at:]])
