"""Corpus pipeline: quality classifier, SimHash near-dedup, benchmark decontamination, PII, byte-level BPE.

Each stage takes all that the stage before it kept and is written as Parquet before the next one reads it.
All but the last return the columns of ``documents``; the last returns a digest of each text's ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from txnguard.llm import bpe, decontaminate, pii, quality, simhash
from txnguard.llm.common import documents, staged
from txnguard.session import ship_package
from txnguard.sources.tables import read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is 1, unchanged. Learns from the documents it is given."""
    ship_package(spark)
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at SimHash distance 4 or less, the one of least doc_id."""
    ship_package(spark)
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_package(spark)
    return decontaminate.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data and terms that disclose it are replaced by their kind."""
    return pii.redact(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every text that is left: counts and digests of ids and of the decoded bytes."""
    ship_package(spark)
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("byte_bpe", tokens_stage),
]

#: The classifier's votes and the BPE merges are not expressible in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
