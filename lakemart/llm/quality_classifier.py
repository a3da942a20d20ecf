"""Quality classifier from weak labels.

Heuristic labellers vote on every document: the quality rules, and the human labels where a
document has some. Expectation-maximisation over the counts of vote patterns estimates how far
each labeller is right and the posterior quality of each pattern. The posteriors of a bounded
sample of labelled documents train a linear scorer over hashed words and shapes of a text, and
that scorer judges every document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.common import appended, documents, id_and_text, map_rows, stored, whole_texts
from lakemart.llm.quality_rules import ABSTAIN, GOOD_LEAST, KEEP, MEASURES, REJECT, RULES, fit, measure, votes

#: Labelled documents that the scorer is trained on, at most.
SAMPLE_DOCS = 20_000
#: Hashed features; the last positions hold the shapes.
FEATURE_BITS = 18
SHAPES = 64
#: Documents of the sample that must have a feature before it gets a weight.
LEAST_DOCS = 10
EPOCHS = 30
LEAST_QUALITY = 0.5
HUMAN = ("quality", "toxic")
#: A short text is not a bad one, so the rule about lengths is no labeller.
LABELLERS = [f"vote_{r[0]}" for r in RULES if r[0] != "words"]
PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
SYMBOLS = frozenset(b"#*$%&|<>")


def bin_of(share: float) -> int:
    """0 for none, 1 to 7 for ever larger shares."""
    return 0 if share <= 0 else 1 + int(np.searchsorted((0.02, 0.05, 0.1, 0.2, 0.35, 0.6), share))


def features(text: str) -> np.ndarray:
    """Sorted distinct features of a text: its words without case and edges, and its shapes."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n = max(1, len(words))
    distinct = set(words)
    marked = sum(not SYMBOLS.isdisjoint(w) for w in words)
    capital = sum(w.isupper() and len(w) > 1 for w in words)
    shares = (
        marked / n,
        capital / n,
        1 - len(distinct) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(line.rstrip()[-1:] not in (b".", b"!", b"?") for line in lines) / max(1, len(lines)),
    )
    first = (1 << FEATURE_BITS) - SHAPES
    shapes = {first + 8 * i + bin_of(share) for i, share in enumerate(shares)}
    shapes.add(first + 40 + min(15, len(words).bit_length()))
    hashed = {zlib.crc32(w.strip(PUNCTUATION).lower()) % first for w in distinct}
    return np.array(sorted(hashed | shapes), np.int32)


def train(rows: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """Logistic regression by mini-batches with Adagrad; the bias is the last weight."""
    size = 1 << FEATURE_BITS
    weights, squares = np.zeros(size + 1, np.float32), np.full(size + 1, 1e-2, np.float32)
    docs = np.zeros(size, np.int32)
    for row in rows:
        docs[row] += 1  # a row's features are distinct
    rows = [r[docs[r] >= LEAST_DOCS] for r in rows]
    lengths = np.array([len(r) for r in rows])
    # Both classes weigh the same, and a short text as much as a long one.
    good = max(float(target.sum()), 1.0)
    weight = np.where(target >= 0.5, len(target) / (2 * good), len(target) / (2 * max(len(target) - good, 1.0)))
    order = np.random.default_rng(1).permutation(len(rows))
    for epoch in range(EPOCHS):
        for start in range(0, len(order), 256):
            own = order[start : start + 256]
            ids = np.concatenate([rows[i] for i in own])
            at = np.repeat(np.arange(len(own)), lengths[own])
            score = np.bincount(at, weights[ids], minlength=len(own)) + weights[-1]
            error = weight[own] * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target[own])
            used, position = np.unique(ids, return_inverse=True)
            gradient = (np.bincount(position, error[at]) / len(own) + 1e-4 * weights[used]).astype(np.float32)
            squares[used] += gradient**2
            weights[used] -= 0.1 * gradient / np.sqrt(squares[used])
            bias = float(error.mean())
            squares[-1] += bias**2
            weights[-1] -= 0.1 * bias / np.sqrt(squares[-1])
    return weights


def score(weights: np.ndarray, text: str | None) -> float:
    """Probability of quality of a text; a null text counts as empty."""
    total = float(weights[features(text or "")].sum() + weights[-1])
    return 1 / (1 + float(np.exp(-min(max(total, -30.0), 30.0))))


def posteriors(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, labelled, posterior) of every row by the labellers' votes.

    Repeated labels of an id count as one, the worst. What comes to the driver is a count for
    each pattern of votes, at most three to the power of the number of labellers.
    """
    rows = whole_texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    measured = map_rows(rows, f"doc_id {kind}, {MEASURES}", lambda batch: [(r["doc_id"], *measure(r["text"])) for r in batch])
    names = [*LABELLERS]
    voted = measured.select("doc_id", *votes()).select("doc_id", *names)
    if labels is None:
        voted = voted.select("*", *(F.lit(ABSTAIN).alias(f"vote_human_{h}") for h in HUMAN), F.lit(False).alias("labelled"))
    else:
        human = labels.groupBy(labels["doc_id"].alias("label_id")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        voted = voted.join(human, F.col("doc_id") == F.col("label_id"), "left").select(
            "doc_id", *names,
            F.when(F.col("quality") == 0, REJECT).when(F.col("quality") == 1, KEEP).otherwise(ABSTAIN).alias("vote_human_quality"),
            # A document without abuse may be bad in other ways: that says nothing.
            F.when(F.col("toxic") == 1, REJECT).otherwise(ABSTAIN).alias("vote_human_toxic"),
            F.col("label_id").isNotNull().alias("labelled"),
        )
    names += [f"vote_human_{h}" for h in HUMAN]
    voted = stored(voted, "labeller-votes")
    seen = voted.groupBy(*names).count().collect()
    patterns = np.array([r[:-1] for r in seen], np.int64).reshape(len(seen), len(names))
    human = np.array([n.startswith("vote_human") for n in names])
    # People judge the document itself: their votes are the measure of the rules'.
    least = np.concatenate([GOOD_LEAST[[r[0] != "words" for r in RULES]], np.full(len(HUMAN), 0.9999)])
    *_, posterior = fit(patterns, np.array([r["count"] for r in seen], float), least, np.where(human, 0.5, 0.25))
    table = docs.sparkSession.createDataFrame(
        [(*map(int, p), float(x)) for p, x in zip(patterns, posterior, strict=True)],
        ", ".join(f"{n} int" for n in names) + ", posterior double",
    )
    return voted.join(F.broadcast(table), names).select("doc_id", "labelled", "posterior")  # at most 3 ** len(names) rows


def trained(docs: DataFrame, labels: DataFrame | None, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Weights of the scorer, from at most ``sample_docs`` documents.

    The sample is the labelled documents with the smallest hashes of their ids, or of all
    documents where none is labelled.
    """
    judged = posteriors(docs, labels, id_col, text_col).dropDuplicates(["doc_id"])
    labelled = judged.filter("labelled")
    if not labelled.isEmpty():
        judged = labelled
    sample = judged.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs).select(F.col("doc_id").alias("sample_id"), "posterior")
    texts = whole_texts(docs, id_col, text_col)
    picked = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("sample_id"))  # at most sample_docs rows

    def extract(rows: list[dict]) -> list[tuple]:
        return [(zlib.crc32(str(r["doc_id"]).encode()), r["posterior"], features(r["text"]).tobytes()) for r in rows]

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["rank"], r["posterior"], r["features"]) for b in batches for r in b.to_pylist())
        weights = train([np.frombuffer(f, np.int32) for *_, f in rows], np.array([p for _, p, _ in rows]))
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], names=["weights"])

    extracted = map_rows(picked, "rank bigint, posterior double, features binary", extract)
    found = extracted.repartition(1).mapInArrow(learn, "weights binary").collect()
    return np.frombuffer(found[0]["weights"], np.float32) if found else np.zeros((1 << FEATURE_BITS) + 1, np.float32)


def with_quality(docs: DataFrame, labels: DataFrame | None, text_col: str = "text", id_col: str = "doc_id", name: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of quality of each text, in no shuffle of the texts.

    A null text counts as empty; repeated rows each get their score; without documents nothing
    is trained; other columns pass through. Where no document is labelled, the rules' votes
    alone train the scorer.
    """
    weights = trained(docs, labels, SAMPLE_DOCS, id_col, text_col)
    return appended(docs, text_col, "double", lambda texts: [score(weights, t) for t in texts], name)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, quality_score, kept) of all documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = with_quality(id_and_text(documents(spark, sf_dir), "doc_id", "text"), labels)
    return scored.select("doc_id", "quality_score", (F.col("quality_score") >= LEAST_QUALITY).alias("kept"))
