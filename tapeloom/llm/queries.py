"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm import (
    bloom_lm,
    byte_bpe,
    fm_index,
    merkle,
    mixing,
    multi_index,
    ngram_join,
    orchard,
    personal_data,
    quality,
    secret_scan,
    substring_dedup,
    unigram_count,
)
from tapeloom.llm.shipping import ship
from tapeloom.sources.paths import shared_dir

RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of 0.75 or more."""
    return ngram_join.join_documents(documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of every document that repeat an earlier passage."""
    return substring_dedup.repeated_spans(documents(spark, sf_dir))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, in two deliveries to one ledger.

    The first has the English documents, when the rules were fewer; the second has all documents,
    and only the blobs and rule versions that the ledger does not know are scanned.
    """
    docs = documents(spark, sf_dir)
    path = shared_dir(spark, "secret-ledger")
    secret_scan.Ledger(spark, path, secret_scan.BASE_RULES).scan(docs.where("lang = 'en'"))
    return secret_scan.scan_documents(docs, secret_scan.Ledger(spark, path))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix by source weights takes of every document."""
    return mixing.mix(documents(spark, sf_dir))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return personal_data.find_personal_data(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and line-first verdict of every document."""
    return quality.assess(documents(spark, sf_dir))


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector."""
    ship(spark)
    return multi_index.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=100)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and unigram tokens of every document."""
    return unigram_count.count_tokens(documents(spark, sf_dir), public_tokenizers.path(PIECES))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    path = public_tokenizers.path(RANKS)
    return byte_bpe.digests(byte_bpe.encode(documents(spark, sf_dir), path))


def op10_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by a model trained on six sevenths of them."""
    docs = documents(spark, sf_dir)
    return bloom_lm.score(docs, bloom_lm.train(docs))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and whether a tampered one still verifies."""
    return merkle.manifest(documents(spark, sf_dir))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of every document that windows of the benchmark's items hit."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return fm_index.decontaminate(documents(spark, sf_dir), items)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, and the digest of the codebooks."""
    ship(spark)
    return orchard.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_secret_scans": op3_secret_scans,
    "op4_mixing": op4_mixing,
    "op5_personal_data": op5_personal_data,
    "op6_quality_rules": op6_quality_rules,
    "op7_multi_index": op7_multi_index,
    "op8_token_counts": op8_token_counts,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_bloom_lm": op10_bloom_lm,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_decontamination": op12_decontamination,
    "op13_vector_codes": op13_vector_codes,
}
