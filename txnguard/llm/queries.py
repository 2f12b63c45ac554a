"""Registered queries of the text operators, one per operator, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from txnguard.llm import (
    ann, bpe, decontaminate, merkle, oracle, pii, quality, ranked, sharding, simhash, substrings, suffix_dedup, token_files,
    vector_dedup,
)
from txnguard.llm.common import documents
from txnguard.sources.tables import read_table


def op1_decontaminate(spark, sf_dir):
    """Pairs of a document and a benchmark item that it holds; clean documents have no row."""
    return decontaminate.leaks(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op2_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op3_suffix_trees(spark, sf_dir):
    return substrings.kept_texts(documents(spark, sf_dir), digest=True)


def op4_token_files(spark, sf_dir):
    return token_files.token_digest(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_multiprobe(spark, sf_dir):
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_quality(spark, sf_dir):
    return quality.predictions(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op7_byte_bpe(spark, sf_dir):
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def op8_sharding(spark, sf_dir):
    placed = sharding.assign_shards(documents(spark, sf_dir), n_shards=24)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op9_pii(spark, sf_dir):
    return pii.find(documents(spark, sf_dir))


def op10_suffix_merge(spark, sf_dir):
    return suffix_dedup.kept_bytes(documents(spark, sf_dir), digest=True)


def op11_merkle(spark, sf_dir):
    """Proofs of all documents; where 3 divides the checksum of the id, the claimed text is in small letters."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claimed = F.when(tampered, small).otherwise(F.col("text"))
    return merkle.proofs(documents(spark, sf_dir), changed={"text": claimed}, digest=True)


def op12_ranked_search(spark, sf_dir):
    return ranked.search(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op13_sorted_passes(spark, sf_dir):
    return vector_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


LLM_QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op") and callable(f)}

LLM_ORACLES = {"op11_merkle": oracle.OP11, "op12_ranked_search": oracle.OP12, "op13_sorted_passes": oracle.OP13}
