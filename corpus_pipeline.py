"""The corpus pipeline: quality, near-dedup, decontamination, mixing, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spindle.llm import decontaminate, mix_sources, near_dedup, quality, token_store
from spindle.llm.common import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the ratings of all documents, doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.select(docs, quality.fit(docs, labels))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return near_dedup.dedup(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix_sources.apply_mix(docs, mix_sources.mix(docs))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document, or copy, from the shard files: doc_id, start, n_tokens, ids_crc32."""
    return token_store.read_shards(token_store.write_shards(docs))


STAGES = [
    ("quality_classifier", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

#: Classifier, alignment and tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from ``documents``, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
