"""From documents to packed training sequences; each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairloom.llm import copies, findings, mixing, packing, quality, queries
from pairloom.session import settle

SHARE = 0.9


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality scorer rejects go."""
    return quality.keep_good(docs)


def copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word similarity of 0.8 or more) stays: the one of the smallest id."""
    return copies.keep_first(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced; every document stays."""
    return findings.redact(docs, findings.fit(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the budget of their source stay."""
    return mixing.keep_mixed(docs, SHARE, queries.mixture(), queries.domain())


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences."""
    return packing.pack_documents(docs, queries.vocabulary("byte_bpe_50k.tiktoken"), queries.SPECIAL)


STAGES = [
    ("quality", quality_stage),
    ("near_copies", copies_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Hashes, forests and token ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
