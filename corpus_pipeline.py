"""Corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next.

All stages but the last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from speechloom.llm import language_id, minhash, mixing, packing, pii
from speechloom.workspace import written


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; texts that are null or hold no letter go."""
    return language_id.keep_known(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return minhash.drop_near_duplicates(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their weights, in random order."""
    return mixing.mix(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their ids and places in sequences."""
    return packing.pack(docs, keep_ids=True)


STAGES = [
    ("language_id", identified),
    ("minhash", deduplicated),
    ("pii", redacted),
    ("mixing", mixed),
    ("packing", packed),
]

# language identification and packing have no SQL counterpart; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
