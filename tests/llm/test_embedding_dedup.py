"""Near duplicates among embeddings against all pairs in double precision."""

import math
from collections import defaultdict

import numpy as np
import pytest

from lakemart.llm import embedding_dedup as dedup
from lakemart.llm import oracles

SCHEMA = "vec_id bigint, embedding array<float>, label int, node int, copies string, buckets int, own int, n_links string"


def usable(label, vector):
    return label is not None and vector and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def brute_force(rows, threshold=0.93):
    """(vec_id, n_links, component_id, kept) of every row."""
    n = len(rows)
    linked = [[] for _ in rows]
    by = defaultdict(list)
    for k, (_, vector, label) in enumerate(rows):
        if usable(label, vector):
            by[label, len(vector)].append(k)
    for members in by.values():
        x = np.array([rows[k][1] for k in members], np.float32).astype(float)
        x /= np.abs(x).max(axis=1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        for p, q in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1)), strict=True):
            linked[members[p]].append(members[q])
            linked[members[q]].append(members[p])
    root = list(range(n))

    def top(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k in range(n):
        for m in linked[k]:
            root[top(k)] = top(m)
    least = {}
    for k, (i, *_) in enumerate(rows):
        least[top(k)] = min((x for x in (least.get(top(k)), i) if x is not None), default=None)
    return [(i, len(linked[k]), least[top(k)], i == least[top(k)]) for k, (i, *_) in enumerate(rows)]


ORDER = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] or 0)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2, 3, "x") for r in rows], SCHEMA)


def found(spark, rows, **how):
    return sorted((tuple(r) for r in dedup.near_duplicates(frame(spark, rows), **how).collect()), key=ORDER)


def planted(seed, base, dim, labels, families, most, noise):
    """Random vectors, and families of near copies around some of them."""
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.standard_normal(dim).astype(np.float32).tolist(), int(rng.integers(labels))) for i in rng.permutation(base)]
    at = base
    for i, vector, label in list(rows)[:families]:
        for _ in range(int(rng.integers(1, most))):
            other = np.array(vector) + noise * rng.standard_normal(dim)
            rows.append((at, other.astype(np.float32).tolist(), label))
            at += 1
    return rows


def test_edge_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (9, [1.0, 2.0, 3.0], 1), (4, [2.0, 4.0, 6.0], 1), (4, [2.0, 4.0, 6.0], 1), (7, [1.0, 2.0, 3.0], 2), (None, [1.0, 2.0, 3.1], 1),
        (1, None, 1), (2, [], 1), (3, [0.0, -0.0, 0.0], 1), (5, [1.0, None, 3.0], 1), (6, [1.0, inf, 3.0], 1), (8, [nan, 2.0, 3.0], 1),
        (10, [1.0, 2.0, 3.0], None), (11, [1.0, 2.0], 1), (None, [-1.0, 0.0, 0.0], 3), (None, [-1.0, -0.0, 0.0], 3), (12, [5.0], 4), (13, [7.0], 4),
        (14, [-7.0], 4), (15, [1e38, 3e38], 5), (16, [1e-38, 3e-38], 5), (17, [-1e38, 3e38], 5),
    ]
    assert found(spark, rows) == sorted(brute_force(rows), key=ORDER)
    assert found(spark, []) == []


def test_one_bucket_and_its_blocks_find_every_pair(spark):
    rows = planted(1, 300, 24, 2, 40, 12, 0.12) + [(5000 + i, [1.0] * 24, 0) for i in range(70)]
    want = sorted(brute_force(rows), key=ORDER)
    assert sum(r[1] for r in want) > 5000
    assert found(spark, rows) == want
    assert found(spark, rows, block=50) == want  # buckets above a block are met block by block


def test_recall_of_buckets_against_all_pairs(spark):
    rows = planted(2, 1500, 32, 1, 300, 6, 0.2)
    want = {r[0]: r[1] for r in brute_force(rows)}
    got = {r[0]: r[1] for r in found(spark, rows, bucket=32, block=64)}
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.98 * sum(want.values()) > 1000


def test_the_bound_holds_and_excludes_most_pairs():
    rng = np.random.default_rng(3)
    dim, t = 64, 0.93
    x = rng.standard_normal((4000, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.standard_normal((4000, dim))
    side -= np.einsum("ij,ij->i", side, x)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    y = t * x + math.sqrt(1 - t * t) * side
    turned = x @ dedup.rotation(dim, 0).T
    code, other = np.where(turned >= 0, 1, -1) / math.sqrt(dim), y @ dedup.rotation(dim, 0).T
    factor = np.einsum("ij,ij->i", code, turned)
    products = np.einsum("ij,ij->i", code, other)
    assert abs((products / factor).mean() - t) < 0.005  # unbiased
    least = dedup.least_code_products(factor, dim, t, dedup.EPSILON)
    assert (products >= least).all()
    unlike = np.einsum("ij,ij->i", code, np.roll(other, 1, axis=0))
    assert (unlike >= least).mean() < 0.001


def test_tables_reach_the_recall():
    for depth in (1, 4, 12, 20):
        share = (1 - math.acos(0.93) / math.pi) ** depth
        assert 1 - (1 - share) ** dedup.tables(depth, 0.93, 0.99) >= 0.99


@pytest.mark.parametrize("name", ["embeddings"])
def test_sql_gives_the_same(spark, name):
    import duckdb

    rows = planted(4, 120, 8, 3, 30, 5, 0.15)
    db = duckdb.connect()
    db.register(name, frame(spark, rows).toPandas())
    assert sorted(db.execute(oracles.embedding_dedup()).fetchall()) == found(spark, rows)
