"""From raw documents to digests of the mixed, tokenised corpus, in stages that each read their predecessor's rows.

Every stage is a function (spark, docs, sf_dir) -> DataFrame; its rows are written as Parquet and reread for the
next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textpulse import storage
from textpulse.llm import mixing, passages, pieces, repeats, simhash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the passage classifier, fitted on the labelled ones, does not reject."""
    return passages.accepted(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints."""
    return simhash.deduplicate(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that an earlier document has."""
    return repeats.without_repeats(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: a row for each pass over a document."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of every text, and the digest of the text they decode to."""
    return pieces.digests(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("source mixing", mixture),
    ("sentencepiece", tokens),
]

# A fitted classifier, suffix arrays and merges cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES:
        docs = storage.materialize(stage(spark, docs, sf_dir), storage.fresh_dir(spark, "stage"))
    return docs
