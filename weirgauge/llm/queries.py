"""The registered queries: each applies one operator to its whole table and derives the agreed columns from its rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgauge.llm import ann, bpe, conversation_repair, exact_dedup, filter_audit, jaccard_join, langid, licences, mixing, packing, quality, substring_dedup, warc
from weirgauge.llm.common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


#: Where the rank file is and what splits texts before the merges; on a cluster, a path that the driver can open.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.ByteBpe(spark, RANKS, public_tokenizers.PATTERN).round_trip(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.draws(table(spark, sf_dir, "documents")))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.clustered(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scanned(table(spark, sf_dir, "documents"))


#: The tokenizer of the packed sequences; on a cluster, a path that the driver can open.
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(table(spark, sf_dir, "documents"), packing.read_model(spark, WORD_MODEL))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audited(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = filter_audit.failures(table(spark, sf_dir, "documents"))
    return filter_audit.audit(filter_audit.counted(failed, table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_ann": op2_ann,
    "op3_bpe": op3_bpe,
    "op4_mixing": op4_mixing,
    "op5_quality": op5_quality,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_langid": op8_langid,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_licences": op10_licences,
    "op11_packing": op11_packing,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_filter_audit": op13_filter_audit,
}
