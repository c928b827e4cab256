"""Preparing documents as training data: each stage works on the rows its predecessor kept.

Quality classifier (what it rejects goes), exact duplicates, near duplicates (one document of each group stays), mixing
of sources to target weights, byte-level BPE. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weirgauge.llm import bpe, exact_dedup, jaccard_join, mixing, quality
from weirgauge.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.ByteBpe(spark, path, public_tokenizers.PATTERN).round_trip(docs, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good),
    ("exact_dedup", different),
    ("near_dedup", dissimilar),
    ("mixing", mixed),
    ("encoding", encoded),
]

#: A trained classifier, seeded draws and tokenization cannot be said in SQL; a test compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
