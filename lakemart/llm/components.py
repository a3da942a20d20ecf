"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for the nodes of the links (a[i], b[i]) but the roots, the least of each group."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        after = label.copy()
        np.minimum.at(after, x, least)
        np.minimum.at(after, y, least)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) but the roots, the least node of a component.

    Each round makes every node point to the least of its neighbours (large star), then every
    node and its lesser neighbours to the least of those (small star). The number of rounds grows
    with the logarithm of a component's size. Each round is written to the shared folder, so that
    a lost executor costs one round at most. A node's neighbours are only aggregated and joined,
    never gathered. Nulls and links of a node with itself are left out; an empty table stays empty.
    """
    pair = lambda df, a, b: df.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    edges = stored(pair(links.filter(F.col("a") != F.col("b")), "a", "b").distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = state
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        # A lesser neighbour of u is linked to m through its own row of ``least`` or is m itself.
        large = (
            both.join(least, "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo")).distinct()
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").filter(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = stored(small.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct(), "links")
