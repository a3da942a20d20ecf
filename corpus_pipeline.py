"""A training-data pipeline over ``documents``: each stage reads what the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm.bpe import round_trip
from lakemart.llm.common import documents, stored
from lakemart.llm.decontamination import with_leaks
from lakemart.llm.quality_classifier import LEAST_QUALITY, with_quality
from lakemart.llm.secret_scan import redact
from lakemart.llm.simhash import MAX_BITS, SHINGLE, simhash_components

TOKENIZER = "byte_bpe_50k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; of repeated ids each row by its own text."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    name = "_".join(["quality_score", *docs.columns])
    return with_quality(docs, labels, name=name).filter(F.col(f"`{name}`") >= LEAST_QUALITY).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id, nulls last.

    Rows are told apart by a number made here, so repeated rows are near duplicates like any others,
    and an unlike text stays whatever other texts share its id. A null text counts as empty.
    """
    row = "row"
    while row.lower() in {c.lower() for c in docs.columns}:
        row += "_"
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = simhash_components(numbered, SHINGLE, MAX_BITS, id_col=row).select(F.col("doc_id").alias(row), "component_id")
    known = numbered.select(row, "doc_id").join(groups, row)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col(row).alias("row"))
    first = known.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.row").alias(row))
    return numbered.join(first, row, "left_semi").select(*[f"`{c}`" for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks; a null text is clean."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    name = "_".join(["leaks", *docs.columns])
    return with_leaks(docs, benchmark, name=name).filter(F.size(f"`{name}`") == 0).drop(name)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced by their kinds, and ``n_chars`` of the new texts."""
    clean = redact(docs)
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(count))
    return clean


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts of the documents left; a null text has no tokens."""
    return round_trip(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("BPE encoding and decoding", encode_and_decode),
]

#: The stages train a model and hash, align and encode texts in ways that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage returns is written and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
