"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.llm import encoding, mixing, quality, simhash, suffixes
from retention.llm.common import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are mostly boilerplate lines go."""
    chain = quality.train_chain(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge_documents(docs, chain, carry=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays (3-word shingles, 3 bits)."""
    return simhash.one_of_each(docs, size=3, radius=3)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 100-byte strings that also start earlier are cut out; ``n_chars`` follows the text."""
    cut = suffixes.without_repeats(docs, length=100)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture of their sources."""
    return mixing.in_mixed_order(docs, mixing.mix_documents(docs))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus of token ids: a row per document with its ``ids``, their count and the digests of ids and decoded text, and
    its ``position`` in the mixed order."""
    return mixing.with_position(docs, lambda rows: encoding.encode_documents(
        rows, public_tokenizers.path("word_bpe_49k.json"), with_ids=True, carry=["_file", "_row"]))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("mix", mix), ("bpe", bpe)]

# The chain's verdicts, the suffix arrays and the merges have no SQL form; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), f"{i}-{name}")
        if i:
            scratch.drop(f"{i - 1}-{STAGES[i - 1][0]}")
    return docs
