"""Near duplicates among embeddings by randomly rotated binary codes.

A unit vector is turned by a random rotation and stored as the signs of its components, with a
correction factor: the inner product of the vector with its own code. The inner product of one
vector's code with another, turned vector, divided by the factor, estimates the vectors' inner
product without bias. How far it may be off is known from the factor, so a pair is computed in
double precision only if its estimate does not exclude the threshold.

Which pairs are estimated at all: signs of further rotations name buckets, in as many tables as it
takes to bring a pair at the threshold into one bucket with probability ``recall``. Labels of up
to BUCKET vectors are one bucket, so all of their pairs are estimated.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import stored
from lakemart.llm.components import components, forest

THRESHOLD = 0.93
#: Unlike vectors of a label that a bucket may hold on average; larger labels are cut into more buckets.
BUCKET = 4096
#: Rows of a bucket on one side of a task; larger buckets are met block by block.
BLOCK = 4096
#: Least chance that a pair at the threshold shares a bucket; nearer pairs have better ones.
RECALL = 0.99
#: Half-width of the confidence bound in standard deviations of the estimate: one pair in 10^9 is beyond.
EPSILON = 6.0
SEED = 20_011
#: Rows of a block that are estimated at a time, and numbers that are gathered at a time.
TILE, GATHERED = 1024, 4_000_000
#: Parts into which the rows of one vector are dealt when they look up their group.
SALTS = 64


@functools.lru_cache(maxsize=16)
def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    return np.linalg.qr(np.random.default_rng([SEED, dim, number]).standard_normal((dim, dim)))[0]


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled by powers of two, which is exact and keeps squares in range, and their norms."""
    scaled = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
    return scaled, np.sqrt(np.einsum("ij,ij->i", scaled, scaled))


def tables(depth: int, threshold: float, recall: float) -> int:
    """Tables of buckets of ``depth`` signs that a pair at ``threshold`` shares one of with chance ``recall``."""
    if not depth:
        return 1
    share = (1 - math.acos(threshold) / math.pi) ** depth
    return max(1, math.ceil(math.log1p(-recall) / math.log1p(-share)))


def signs(turned: np.ndarray) -> np.ndarray:
    return np.where(turned >= 0, np.float32(1), np.float32(-1))


def bucket_names(vectors: np.ndarray, depth: int, count: int) -> np.ndarray:
    """Names of the buckets of unit ``vectors`` in each of ``count`` tables: ``depth`` signs each."""
    dim = vectors.shape[1]
    bits = np.concatenate([vectors @ rotation(dim, 1 + r).T >= 0 for r in range(-(-depth * count // dim))], axis=1)
    weights = np.int64(1) << np.arange(depth, dtype=np.int64)
    return bits[:, : depth * count].reshape(len(vectors), count, depth) @ weights


def least_code_products(factors: np.ndarray, dim: int, threshold: float, epsilon: float) -> np.ndarray:
    """Least product of a code with a unit vector at ``threshold`` or nearer, by the code's factor.

    Code = factor * own vector + sqrt(1 - factor^2) * an error at right angles to it. The other
    vector lies in that error's space with sqrt(1 - threshold^2) at most, in a random direction:
    its share of the error has standard deviation 1 / sqrt(dim - 1), and is never above 1.
    """
    off = min(1.0, epsilon / math.sqrt(dim - 1)) if dim > 1 else 1.0
    error = np.sqrt(np.maximum(0, 1 - factors**2)) * math.sqrt(1 - threshold**2)
    return factors * threshold - off * error - 1e-5  # products are taken in single precision


def near_pairs(vectors: np.ndarray, codes: np.ndarray, factors: np.ndarray, first: int, threshold: float, epsilon: float):
    """Yields index arrays (p, q), p < q, of pairs with a cosine of ``threshold`` or more.

    With ``first`` > 0 only pairs across the two blocks [0, first) and [first, n) are looked at.
    """
    n, dim = vectors.shape
    scaled, norms = unit(vectors)
    turned = ((scaled / norms[:, None]) @ rotation(dim, 0).T).astype(np.float32)
    code = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    least = (least_code_products(factors, dim, threshold, epsilon) * math.sqrt(dim)).astype(np.float32)
    for a in range(0, first or n, TILE):
        a_end = min(a + TILE, first or n)
        for b in range(first or a, n, TILE):
            p, q = np.nonzero(code[a:a_end] @ turned[b : b + TILE].T >= least[a:a_end, None])
            p, q = p + a, q + b
            p, q = (x[p < q] for x in (p, q))
            kept = [np.empty(0, np.int64)]
            for at in range(0, len(p), max(1, GATHERED // dim)):
                part = slice(at, at + max(1, GATHERED // dim))
                cosine = np.einsum("ij,ij->i", scaled[p[part]], scaled[q[part]]) / (norms[p[part]] * norms[q[part]])
                kept.append(at + np.flatnonzero(cosine >= threshold))
            kept = np.concatenate(kept)
            if len(kept):
                yield p[kept], q[kept]


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(node, label, vector, copies, first, h1, h2): one row for all copies of a vector with one label.

    Copies are counted before they are shuffled, so any number of them meets as one row a task.
    """
    grouped = rows.groupBy("label", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    return grouped.select(F.monotonically_increasing_id().alias("node"), "*", *digest())


def digest():
    """A name of 128 bits for label and vector."""
    return F.xxhash64("label", "vector").alias("h1"), F.xxhash64(F.lit(1), "label", "vector").alias("h2")


def matrix(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def signed(nodes: DataFrame, threshold: float, recall: float, bucket: int) -> DataFrame:
    """``nodes`` with ``code``, ``factor`` and the names ``buckets`` of its buckets, one for each table.

    The number of signs in a name is that of halvings which bring the label's vectors to ``bucket``.
    """
    sizes = nodes.groupBy("label", F.size("vector").alias("dim")).count().filter(F.col("count") > bucket)
    depth = F.ceil(F.log2(F.col("count") / F.lit(bucket)) - F.lit(1e-9)).cast("int")
    with_depth = (
        nodes.withColumn("dim", F.size("vector")).join(sizes, ["label", "dim"], "left")
        .select("node", "copies", "label", "dim", F.coalesce(depth, F.lit(0)).alias("depth"), "vector")
    )

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, depths = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            for dim, depth in sorted(set(zip(dims.tolist(), depths.tolist(), strict=True))):
                part = batch.take(pa.array(np.flatnonzero((dims == dim) & (depths == depth))))
                n = part.num_rows
                scaled, norms = unit(matrix(part.column(5), n))
                vectors = scaled / norms[:, None]
                turned = vectors @ rotation(dim, 0).T
                code = np.packbits(turned >= 0, axis=1)
                factor = np.abs(turned).sum(axis=1) / math.sqrt(dim)
                names = bucket_names(vectors, depth, tables(depth, threshold, recall)) if depth else np.zeros((n, 1), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in (0, 1, 2, 3, 5)),
                        pa.array([c.tobytes() for c in code], pa.binary()),
                        pa.array(np.minimum(factor, 1.0)),
                        pa.array(list(names), pa.list_(pa.int64())),
                    ],
                    names=["node", "copies", "label", "dim", "vector", "code", "factor", "buckets"],
                )

    label = nodes.schema["label"].dataType.simpleString()
    return with_depth.mapInArrow(
        sign, f"node bigint, copies bigint, label {label}, dim int, vector array<double>, code binary, factor double, buckets array<bigint>"
    )


def met(coded: DataFrame, threshold: float, epsilon: float, block: int) -> DataFrame:
    """Rows (a, null, n): node a has n more links; and (a, b, null): links whose closure is that of all.

    A pair is counted in the first table that brings it together. A bucket with more than ``block``
    rows is cut into blocks, and each two of them meet in a group of their own.
    """
    place = ["label", "dim", "table", "bucket"]
    names = coded.select("node", "label", "dim", F.posexplode("buckets").alias("table", "bucket"))
    hot = names.groupBy(*place).count().filter(F.col("count") > block)
    hot = hot.select(*place, F.ceil(F.col("count") / F.lit(block)).cast("int").alias("blocks"))
    placed = (
        coded.select("*", F.posexplode("buckets").alias("table", "bucket")).join(hot, place, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    )

    def meet(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("own", "ascending"), ("node", "ascending")])
        n = rows.num_rows
        own, node, copies = (rows.column(c).to_numpy() for c in ("own", "node", "copies"))
        links, chains = np.zeros(n, np.int64), [(np.empty(0, np.int64),) * 2]
        across = rows.column("i")[0].as_py() != rows.column("j")[0].as_py()
        first = int((own == own[0]).sum()) if across else 0
        if n > max(1, first):
            buckets = matrix(rows.column("buckets"), n)[:, : rows.column("table")[0].as_py()]
            codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(n, -1)
            factors = rows.column("factor").to_numpy()
            for p, q in near_pairs(matrix(rows.column("vector"), n), codes, factors, first, threshold, epsilon):
                fresh = np.ones(len(p), bool)
                for earlier in buckets.T:
                    fresh &= earlier[p] != earlier[q]
                p, q = p[fresh], q[fresh]
                links += np.bincount(p, copies[q], n).astype(np.int64) + np.bincount(q, copies[p], n).astype(np.int64)
                chains.append(forest(node[p], node[q]))
        a, b = forest(*(np.concatenate(x) for x in zip(*chains, strict=True)))
        linked = np.flatnonzero(links)
        return pa.table(
            {
                "a": pa.array(np.concatenate([node[linked], a]), pa.int64()),
                "b": pa.array([None] * len(linked) + b.tolist(), pa.int64()),
                "n": pa.array(links[linked].tolist() + [None] * len(a), pa.int64()),
            }
        )

    columns = placed.select(*place, "i", "j", "own", "node", "copies", "code", "factor", "vector", "buckets")
    return columns.groupBy(*place, "i", "j").applyInArrow(meet, "a bigint, b bigint, n bigint")


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, epsilon: float = EPSILON,
    bucket: int = BUCKET, block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``.

    Rows link if their labels are equal and their cosine is ``threshold`` (above 0) or more. Rows
    with a null label, and vectors that are null, empty, zero or hold a null or non-finite component,
    link with nothing. Vectors of unlike lengths do not link. Every copy of a vector is a link of its
    own, repeated rows and ids too. A component is named by its smallest id; a row without an id
    names none but where no row of the component has one, and is kept only there. An empty table
    gives no rows; other columns are not read.
    """
    rows = vectors.select(
        vectors[id_col].alias("vec_id"), vectors[label_col].alias("label"), vectors[vector_col].cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = F.coalesce(F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    # Minus zero is zero, so that equal vectors are equal in all bits.
    plain = F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    usable = rows.filter(valid).withColumn("vector", plain)
    members = stored(
        usable.select("vec_id", *digest(), (F.monotonically_increasing_id() % SALTS).alias("salt")), "vector-members"
    )
    nodes = stored(distinct_vectors(usable), "distinct-vectors")
    coded = stored(signed(nodes, threshold, recall, bucket), "vector-codes")
    found = stored(met(coded, threshold, epsilon, block), "vector-links")
    counts = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    roots = components(found.filter("b is not null").select("a", "b"))
    named = stored(
        nodes.select("node", "h1", "h2", "copies", "first").join(counts, "node", "left").join(roots, "node", "left").select(
            "h1", "h2", "first", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ),
        "named-vectors",
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = named.join(smallest, "root").select("h1", "h2", "n_links", "component_id")
    # Rows of one vector are dealt into SALTS parts, so a third of all rows may be copies of one.
    dealt = members.select("h1", "h2", "salt").distinct().join(groups, ["h1", "h2"])
    linked = members.join(dealt, ["h1", "h2", "salt"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~valid).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
