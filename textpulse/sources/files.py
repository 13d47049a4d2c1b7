"""CSV sources. Quoted fields may hold line breaks, so for Spark's reader a file is the unit of work; with ``landed``
large files are first landed by many tasks (``landing``) at that path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textpulse import rules, schemas
from textpulse.sources.landing import land_csv

CSV_OPTIONS = {"multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def _rows(spark: SparkSession, path: str, schema: StructType, header: bool, landed: str | None) -> DataFrame:
    if landed:
        return land_csv(spark, path, landed, schema, header)
    return spark.read.options(**CSV_OPTIONS).csv(path, schema=schema, header=header)


def training_rows(spark: SparkSession, path: str, landed: str | None = None) -> DataFrame:
    """Header-less labelled texts."""
    return _rows(spark, path, schemas.TRAINING, False, landed)


def archived_tweets(spark: SparkSession, path: str, landed: str | None = None) -> DataFrame:
    """Messages from a tweet archive read by field position, header skipped.

    Shorter records have no text field, so the length test drops them too.
    """
    fields = [f"field{i}" for i in range(rules.TWEET_FIELDS)]
    schema = StructType([StructField(name, StringType()) for name in fields])
    text = F.col(fields[rules.TWEET_TEXT_FIELD])
    archive = _rows(spark, path, schema, True, landed)
    return archive.where(F.length(text) >= rules.MIN_TEXT_LENGTH).select(
        F.lit(rules.SOURCE_TWEETS_CSV).alias("source"),
        text.alias("text"),
        F.col(fields[rules.TWEET_DATE_FIELD]).alias("created_at"),
    )
