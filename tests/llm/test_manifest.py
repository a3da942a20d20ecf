"""The Merkle manifest against a tree built row by row."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakemart.llm import manifest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, part int, key string, leaf string, i int, path string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest(*(said(v) for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes, fanout):
    """All levels over ``nodes``, and for each of them the siblings (left, right) level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[k : k + fanout]) for k in range(0, len(below), fanout)])
    steps = []
    for i in range(len(nodes)):
        own = []
        for level in levels[:-1]:
            first = i - i % fanout
            own.append((level[first:i], level[i + 1 : first + fanout]))
            i //= fanout
        steps.append(own)
    return levels[-1][0], steps


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute_force(rows, fanout):
    sources = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        own = leaf(doc_id, source, lang, n_chars, text)
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        other = leaf(doc_id, source, lang, n_chars, lower(text)) if hit and text is not None else own
        sources[source].append((doc_id is not None, doc_id or 0, own, other))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(sources[s])], fanout) for s in names}
    root, upper = climb([trees[s][0] for s in names], fanout)
    out = []
    for at, s in enumerate(names):
        subroot, steps = trees[s]
        for (known, doc_id, own, other), below in zip(sorted(sources[s]), steps, strict=True):
            path = below + upper[at]
            folded = other
            for left, right in path:
                folded = digest(*left, folded, *right)
            proof = digest(*(h for left, right in path for h in left + right))
            out.append((doc_id if known else None, own, subroot, root, proof, folded, folded == root))
    return out


def proved(docs, **sizes):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(tampered, F.translate("text", manifest.UPPER, manifest.LOWER)).otherwise(F.col("text"))
    return [tuple(r) for r in manifest.manifest(docs, claimed={"text": text}, **sizes).collect()]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "k", "l", 0, "p") for r in rows], SCHEMA)


ORDER = lambda r: (r[0] is not None, r[0] or 0, r[1:])


def test_proofs_follow_a_tree_built_row_by_row(spark):
    """Small fanout and parts, so that sources of many sizes climb through several ragged rounds."""
    sizes = {"a": 1, "b": 2, "c": 3, "d": 4, "e": 9, "f": 10, "g": 28, "é": 82, None: 5, "": 7}
    rows, doc_id = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            doc_id = (doc_id * 7 + 3) % 1009
            rows.append((doc_id, f"Text {doc_id} ÄB" if doc_id % 4 else None, "en" if doc_id % 3 else None, source, doc_id % 2 or None))
    rows += [(None, "Null Id", "en", "g", 1), (None, None, None, None, None), (77, "", "en", "b", 0)]
    rows += [(5000, "Same row", "en", "e", 8)] * 4 + [(5000, "Other text", "en", "e", 8)]
    assert sorted(proved(frame(spark, rows), fanout=3, local=1), key=ORDER) == sorted(brute_force(rows, 3), key=ORDER)


def test_large_parts_and_the_stated_fanout(spark):
    rows = [(i, f"Document {i} OF MANY", "en", "hot" if i % 3 else f"s{i % 20}", i) for i in range(7000)]
    rows.append((7001, "A" * 2_000_000, "en", "long", 1))
    got = proved(frame(spark, rows))
    assert sorted(got, key=ORDER) == sorted(brute_force(rows, 16), key=ORDER)
    changed = [r for r in got if not r[6]]
    assert changed and all(zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in changed)


@pytest.mark.parametrize("rows", [[], [(1, "One", "en", "x", 3)], [(1, None, None, None, None)] * 2])
def test_few_rows(spark, rows):
    got = proved(frame(spark, rows))
    assert sorted(got, key=ORDER) == sorted(brute_force(rows, 16), key=ORDER) if rows else got == []


def test_without_claims_every_row_is_verified(spark):
    rows = [(i, "T", "en", f"s{i % 3}", i) for i in range(50)]
    assert all(r["verified"] for r in manifest.manifest(frame(spark, rows)).collect())
