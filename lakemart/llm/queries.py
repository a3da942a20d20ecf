"""The queries of this package by name, and SQL equivalents where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakemart.llm import oracles
from lakemart.llm.bpe import op9_bpe_round_trip
from lakemart.llm.decontamination import op8_decontamination
from lakemart.llm.embedding_dedup import op11_embedding_dedup
from lakemart.llm.language_model import op3_language_model
from lakemart.llm.manifest import op13_merkle_manifest
from lakemart.llm.pii import op10_pii
from lakemart.llm.quality_classifier import op2_quality_classifier
from lakemart.llm.quality_rules import op5_quality_rules
from lakemart.llm.repeats import op6_repeats
from lakemart.llm.secret_scan import op1_secret_scan
from lakemart.llm.simhash import op7_simhash
from lakemart.llm.spelling import op12_spelling_variants
from lakemart.llm.token_counts import op4_token_counts


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_secret_scan,
            op2_quality_classifier,
            op3_language_model,
            op4_token_counts,
            op5_quality_rules,
            op6_repeats,
            op7_simhash,
            op8_decontamination,
            op9_bpe_round_trip,
            op10_pii,
            op11_embedding_dedup,
            op12_spelling_variants,
            op13_merkle_manifest,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op11_embedding_dedup": oracles.embedding_dedup(),
        "op12_spelling_variants": oracles.spelling_variants(),
        "op13_merkle_manifest": oracles.merkle_manifest(),
    }
