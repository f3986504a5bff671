"""Queries of the training-data operators over the test tables: thin wrappers with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evidencelake.llm import bpe, filter_audit, fingerprints, lm, ngram_join, packing, quality, secret_scan, sharding, source_audit, substring, tensored, toxicity
from evidencelake.llm.common import documents, table


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_report(documents(spark, sf_dir))


def vocabulary(name: str) -> str:
    """The installed public tokenizers; their package says where the files are."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), with_ids=False)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def packing_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 on instruction data, where all three of its limits bind."""
    return packing.pack_conversations(table(spark, sf_dir, "conversations"), vocabulary("byte_bpe_50k.json"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(documents(spark, sf_dir))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergences(documents(spark, sf_dir))


def op12_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tensored.near_dedup(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}
    return out | {"packing_conversations": packing_conversations}


def oracle_sql() -> dict[str, str]:
    return {"op11_source_divergence": source_audit.ORACLE, "op12_filter_interaction": filter_audit.ORACLE}
