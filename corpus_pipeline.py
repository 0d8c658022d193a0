"""The corpus pipeline: five stages from raw documents to packed batches.

Each stage reads the documents that the one before kept. All but the last return the
columns of ``documents``; the last returns the batch of every document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumefeed.config import materialize
from plumefeed.llm import minhash, packing, secret_scan, spaced_seeds, toxicity
from plumefeed.llm.queries import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by shingles of five words."""
    return minhash.drop_near_duplicates(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return spaced_seeds.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

# Toxicity learns a model, and packing solves an optimisation; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
