"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from retention.llm import (alignment, conversations, encoding, licenses, mixing, neighbours, postings, quality, sharding, simhash, suffixes, token_counts, warc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), n_shards=16)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge_documents(docs, quality.train_chain(docs, table(spark, sf_dir, "labels")))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), k=20, query_step=20)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), length=100)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(conversations.damage(table(spark, sf_dir, "conversations")))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op13_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10).drop("spans", "items")


QUERIES = {f.__name__: f for f in (op1_simhash, op2_mixing, op3_sharding, op4_token_counts, op5_quality, op6_warc, op7_bpe,
                                   op8_licenses, op9_neighbours, op10_suffix_dedup, op11_conversations, op12_alignment, op13_postings)}
ORACLES: dict[str, str] = {"op6_warc": warc.pages_sql(), "op10_suffix_dedup": suffixes.repeats_sql(100),
                          "op11_conversations": conversations.repair_sql(),
                          "op13_postings": postings.decontaminate_sql(10)}
