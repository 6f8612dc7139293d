"""From documents to tokens: quality rules, near duplicates, benchmark passages, personal data, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm import bpe, decontaminate, near_dedup, personal, quality
from floodmark.llm.scratch import Scratch

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail a rule nor come from a host that mostly fails."""
    return quality.good_documents(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near duplicates."""
    return near_dedup.distinct_documents(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal spans in the text replaced by their kind; n_chars counts the new text."""
    return personal.mask_personal_data(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with hashes of the ids and of the bytes they decode to."""
    return bpe.encode(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii", personal_data_stage),
    ("byte_level_bpe", encoding_stage),
]

#: SQL has neither the embedding and edit search nor the merges; tests hold the run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written to the shared folder and read by the next."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
