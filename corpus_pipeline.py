"""The training-data pipeline over ``documents``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pairloom.llm import decontaminate, packing, quality, secrets, simhash
from pairloom.llm.shared import documents, dropped, for_long_texts, steps, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    for_long_texts(spark)
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles link at 3 or fewer differing bits stays."""
    return simhash.one_of_each(docs, shingle_words=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live secrets are cut out of the texts."""
    return secrets.without_secrets(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences for training."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("packing", packed_sequences),
]

#: Models, fingerprints and a tokenizer are beyond SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the written rows of the one before; what a stage wrote on its way goes when it is done.

    Rows with a null text or doc_id, empty and very long texts, repeated rows and further columns take part as each
    operator's docstring says; an empty ``documents`` gives no pieces.
    """
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        with steps():
            done = written(stage(spark, docs, sf_dir), name, result=True)
        if before is not None:
            dropped(before)
        docs = before = done
    return docs
