"""A Merkle manifest of a dataset, with a proof for every row, by butterfly exchange.

Rows are leaves, ordered by id within their source. An aligned stretch of ``FANOUT ** LOCAL``
leaves is a part: one task holds it whole and hashes its subtree by itself. Above that, the parts
of a source climb together. In round r the parts whose numbers differ only in digit r (to the base
``fanout``) meet: they swap the roots they have reached, and each hashes the same ancestor for itself.
What a part has met on its way is its upper proof, so nothing has to travel down again. The roots
of the sources form a tree of the same kind.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakemart.llm.common import documents, shuffle_tasks, stored

FANOUT = 16
#: Levels of a part's own subtree; a part holds at most FANOUT ** LOCAL leaves.
LOCAL = 3
#: Leaves that one task sorts, about.
SORTED_ROWS = 1_000_000
#: Parts of a document's leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULUS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PATH = "array<struct<at:int,run:array<string>>>"


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*fields: Column) -> Column:
    """Digest of fields: '-' for a null, else its UTF-8 length, ':' and the value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` (key, id, leaf, ...) with place ``i`` in their key by (id, leaf), and ``total`` of the key.

    Leaves are sorted by ranges of (key, id, leaf), so a key of any size is spread over tasks; a
    place is the number of the key's leaves in earlier ranges plus that in the own one. Equal
    leaves may fall into several ranges. Only one row for each range and key is summed in order.
    """
    tasks = max(shuffle_tasks(leaves.sparkSession), -(-leaves.count() // SORTED_ROWS))
    order = ["key", "id", "leaf", "tie"]
    in_order = (
        leaves.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("tie")
        .withColumn("at", F.monotonically_increasing_id()).withColumn("range", F.shiftright("at", 33))
    )
    held = stored(in_order, "ranges-of-leaves")
    runs = held.groupBy("key", "range").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    of_key = Window.partitionBy("key")
    before = of_key.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "key", "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("start")).alias("shift"), F.sum("n").over(of_key).alias("total")
    )
    return held.join(runs, ["key", "range"]).withColumn("i", F.col("at") + F.col("shift")).drop("at", "range", "shift")


def ladder(digests: list[str], parts: int, fanout: int, local: int) -> list[list[str]]:
    """Levels of nodes over a part's ``digests``: ``local`` more, or until one node is left if it is the only part."""
    levels = [digests]
    while len(levels[-1]) > 1 if parts == 1 else len(levels) <= local:
        below = levels[-1]
        levels.append([sha256("".join(below[k : k + fanout])) for k in range(0, len(below), fanout)])
    return levels


def in_parts(leaves: DataFrame, fanout: int, local: int) -> DataFrame:
    """Ranked leaves with the number ``part`` of their part and the number ``parts`` of those of their key."""
    size = fanout**local
    return leaves.withColumn("part", F.floor(F.col("i") / size)).withColumn("parts", F.ceil(F.col("total") / size))


def part_roots(leaves: DataFrame, fanout: int, local: int) -> DataFrame:
    """(key, part, parts, digest) of each part."""

    def climb(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("i")
        parts = rows.column("parts")[0].as_py()
        top = ladder(rows.column("leaf").to_pylist(), parts, fanout, local)[-1][0]
        return pa.table([rows.column("key").slice(0, 1), rows.column("part").slice(0, 1), pa.array([parts]), pa.array([top])], names=["key", "part", "parts", "digest"])

    columns = leaves.select("key", "part", "parts", "i", "leaf")
    return columns.groupBy("key", "part").applyInArrow(climb, "key string, part bigint, parts bigint, digest string")


def butterfly(parts: DataFrame, fanout: int) -> DataFrame:
    """(key, part, parts, digest, path): the root that each part has reached, and the runs met on its way.

    In a round of stride s, part p stands for node p // s of its level, in lane p % s. The lanes
    of ``fanout`` sibling nodes meet, so that every part of a node hears of all siblings, once. The
    last node of a level may have fewer parts than lanes; each of its parts then also speaks, but
    does not listen, in the lanes s' further on, where s' is the number of its parts.
    """
    state = parts.withColumn("path", F.array().cast(PATH))
    most = parts.agg(F.max("parts")).first()[0] or 0
    stride = 1
    while stride < most:
        node = F.floor(F.col("part") / stride)
        lane = F.col("part") % stride
        own = F.least(F.lit(stride), F.col("parts") - node * stride)  # parts of this node
        heard = F.when((own < stride) & (node % fanout > 0), F.sequence(lane, F.lit(stride - 1), own)).otherwise(F.array(lane))
        spoken = state.select(
            "*", node.alias("node"), lane.alias("own_lane"), F.explode(heard).alias("lane")
        ).withColumn("listens", F.col("lane") == F.col("own_lane"))
        met = spoken.groupBy("key", F.floor(F.col("node") / fanout).alias("parent"), "lane").agg(
            F.sort_array(F.collect_list(F.struct("node", "digest")))["digest"].alias("run"),
            F.collect_list(F.when(F.col("listens"), F.struct("part", "parts", "digest", "path", "node"))).alias("listeners"),
        )
        here = met.select("key", "run", F.explode("listeners").alias("p"))
        climbs = F.col("p.parts") > stride  # else the source's root is reached
        step = F.struct((F.col("p.node") % fanout).cast("int").alias("at"), F.col("run").alias("run"))
        state = here.select(
            "key", "p.part", "p.parts",
            F.when(climbs, F.sha2(F.array_join("run", "").cast("binary"), 256)).otherwise(F.col("p.digest")).alias("digest"),
            F.when(climbs, F.concat("p.path", F.array(step))).otherwise(F.col("p.path")).alias("path"),
        )
        stride *= fanout
    return state


def local_path(levels: list[list[str]], i: int, fanout: int) -> list[dict]:
    """The runs in which leaf ``i`` of a part and its ancestors stand, level by level."""
    path = []
    for nodes in levels[:-1]:
        at = i % fanout
        path.append({"at": at, "run": nodes[i - at : i - at + fanout]})
        i //= fanout
    return path


def beside(path: list[dict]) -> list[tuple[str, str]]:
    """The siblings to the left and to the right at each level of a path."""
    return [("".join(x["run"][: x["at"]]), "".join(x["run"][x["at"] + 1 :])) for x in path]


def fold(digest: str, steps: list[tuple[str, str]]) -> str:
    for left, right in steps:
        digest = sha256(left + digest + right)
    return digest


def paths_of_sources(tops: DataFrame, fanout: int, local: int) -> DataFrame:
    """(key, subroot, root, path) of each source, of rows (key, subroot): the tree over the sources."""
    leaves = in_parts(ranked(tops.select(F.lit("").alias("key"), F.col("key").alias("id"), F.col("subroot").alias("leaf"))), fanout, local)
    upper = butterfly(part_roots(leaves, fanout, local), fanout)

    def climb(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows, top = rows.sort_by("i"), above.to_pylist()[0]
        levels = ladder(rows.column("leaf").to_pylist(), top["parts"], fanout, local)
        n = rows.num_rows
        paths = [local_path(levels, i, fanout) + top["path"] for i in range(n)]
        kind = pa.list_(pa.struct([("at", pa.int32()), ("run", pa.list_(pa.string()))]))
        columns = [rows.column("id"), rows.column("leaf"), pa.array([top["digest"]] * n, pa.string()), pa.array(paths, kind)]
        return pa.table(columns, names=["key", "subroot", "root", "path"])

    both = leaves.groupBy("key", "part").cogroup(upper.groupBy("key", "part"))
    return both.applyInArrow(climb, f"key string, subroot string, root string, path {PATH}")


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, source_col: str = "source", id_col: str = "doc_id", claimed: dict[str, Column] | None = None,
    fanout: int = FANOUT, local: int = LOCAL,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    ``claimed`` maps fields to what another copy of the row holds there; its leaf is folded with the
    siblings of the row's own leaf, and ``verified`` says whether that gives the root. Fields that
    ``claimed`` lacks, or all where it is None, are the row's own. A null field is '-', so it differs
    from an empty text. Null sources form a source of their own, before all others; null ids come
    first in a source. Repeated ids are ordered by their leaves; repeated rows are leaves of their
    own, in places next to each other that their copies share out in any way. Texts are hashed
    whole. An empty table gives no rows. Columns other than ``fields`` are not read. A lone leaf is
    the root, with an empty proof.
    """
    claimed = claimed or {}
    own = [docs[c] for c in fields]
    held = [claimed.get(c, docs[c]) for c in fields]
    source = docs[source_col].cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("key"),  # the null source sorts first
        docs[id_col].alias("id"),
        leaf_of(*own).alias("leaf"),
        (leaf_of(*held) if claimed else F.lit(None).cast("string")).alias("claimed"),
    )
    # Stored before they are sorted, as ranges are sampled first: texts are read and hashed once.
    places = in_parts(ranked(stored(leaves, "leaves")), fanout, local)
    parts = stored(butterfly(part_roots(places, fanout, local), fanout), "parts-of-manifest")
    sources = paths_of_sources(parts.filter("part = 0").select("key", F.col("digest").alias("subroot")), fanout, local)
    above = parts.select("key", "part", "parts", F.col("path").alias("own_path")).join(sources, "key").select(
        "key", "part", "parts", "subroot", "root", F.concat("own_path", "path").alias("path")
    )

    def prove(rows: pa.Table, above: pa.Table) -> pa.Table:
        rows, top = rows.sort_by("i"), above.to_pylist()[0]
        digests = rows.column("leaf").to_pylist()
        levels = ladder(digests, top["parts"], fanout, local)
        upper = beside(top["path"])
        tail = "".join(left + right for left, right in upper)
        proofs, folded = [], []
        for i, (leaf, other) in enumerate(zip(digests, rows.column("claimed").to_pylist(), strict=True)):
            steps = beside(local_path(levels, i, fanout))
            proofs.append(sha256("".join(left + right for left, right in steps) + tail))
            folded.append(fold(other or leaf, steps + upper))
        n = rows.num_rows
        same = [f == top["root"] for f in folded]
        columns = [rows.column("id"), rows.column("leaf"), [top["subroot"]] * n, [top["root"]] * n, proofs, folded, same]
        return pa.table(columns, names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        places.select("key", "part", "i", "id", "leaf", "claimed").groupBy("key", "part").cogroup(above.groupBy("key", "part"))
        .applyInArrow(
            prove, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        )
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents; of every fifth id, by its crc32, a copy with lower-cased text is verified."""
    docs = documents(spark, sf_dir)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_MODULUS == 0
    text = F.when(tampered, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return manifest(docs, claimed={"text": text})
