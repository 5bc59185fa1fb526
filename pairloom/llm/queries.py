"""One query per operator over its whole table, in the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import (
    brown,
    decontaminate,
    extraction,
    fingerprints,
    hard_negatives,
    language,
    packing,
    passages,
    prefix_trie,
    quality,
    secrets,
    simhash,
    urls,
)
from pairloom.llm.shared import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passages.without_repeats(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(documents(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filtered(spark.read.parquet(f"{sf_dir}/pages.parquet"), urls.RULES)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted(documents(spark, sf_dir))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(documents(spark, sf_dir))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.scored(documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    found = [
        op1_benchmark_decontamination,
        op2_substring_dedup,
        op3_document_fingerprints,
        op4_packing,
        op5_url_filters,
        op6_quality_classifier,
        op7_language_id,
        op8_simhash_near_dedup,
        op9_secret_scans,
        op10_html_extraction,
        op11_hard_negative_mining,
        op12_conversation_prefix_trie,
        op13_lm_scoring,
    ]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_url_filters": urls.ORACLE_SQL,
        "op9_secret_scans": secrets.ORACLE_SQL,
        "op11_hard_negative_mining": hard_negatives.ORACLE_SQL,
        "op12_conversation_prefix_trie": prefix_trie.ORACLE_SQL,
    }
