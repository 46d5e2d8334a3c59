"""The registered queries of this package, and SQL for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe,
    class_model,
    compression_rules,
    decontamination,
    filter_audit,
    manifest,
    mixing,
    ngram_join,
    quality,
    recompression,
    sharding,
    suffix_dedup,
    toxicity,
)

_QUERIES = (
    mixing.op1_source_mix,
    decontamination.op2_decontamination,
    sharding.op3_balanced_shards,
    class_model.op4_class_bigrams,
    suffix_dedup.op5_suffix_array_dedup,
    toxicity.op6_toxicity_pu,
    ngram_join.op7_ngram_jaccard,
    compression_rules.op8_compression_bands,
    recompression.op9_recompression,
    quality.op10_pairwise_quality,
    manifest.op11_merkle_manifest,
    bpe.op12_speculative_bpe,
    filter_audit.op13_filter_audit,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_source_mix": mixing.ORACLE,
        "op2_decontamination": decontamination.ORACLE,
        "op5_suffix_array_dedup": suffix_dedup.ORACLE,
        "op7_ngram_jaccard": ngram_join.ORACLE,
        "op9_recompression": recompression.ORACLE,
        "op11_merkle_manifest": manifest.ORACLE,
        "op13_filter_audit": filter_audit.ORACLE,
    }
