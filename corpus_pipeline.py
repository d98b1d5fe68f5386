"""The corpus pipeline: five operators over all documents, each on what the one before it kept.

    quality rules      documents that the rules reject go, and of the others the lines that fail
    near duplicates    one document of each component of the n-gram join stays
    secret scans       secrets in the texts are replaced
    source mix         every document is repeated as often as the mix takes it
    byte-level BPE     ids of every text, as counts and digests

A stage's rows are written as Parquet to the shared folder and read again as the next one's
documents, so a lost executor repeats a part of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm import byte_bpe, mixing, ngram_join, quality, secret_scan
from tapeloom.llm.shipping import ship
from tapeloom.sources.paths import shared_dir

RANKS = "byte_bpe_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality.keep_clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return ngram_join.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return byte_bpe.digests(byte_bpe.encode(docs, public_tokenizers.path(RANKS)))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mix),
    ("byte_level_bpe", byte_level_bpe),
]

# SQL has no byte-pair merging; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole table of documents."""
    folder = shared_dir(spark, "corpus-pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
