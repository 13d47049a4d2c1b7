"""Additive measures of the facts per hour, kept beside every fact folder.

A load writes the hours of the folders it writes, and no others. Days that lose or move facts are written anew with
their hours, so nothing has to be taken back: the hours of the folders a version names are those of its facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["date_id", "source_id", "topic_id", "sentiment_class"]
MEASURES = ["messages", "score_sum", "word_sum", "hashtag_sum"]


def hourly(facts: DataFrame) -> DataFrame:
    """``created_at`` becomes the start of the hour. Summed before the shuffle, so a busy source is no hot spot."""
    return facts.groupBy(*KEYS, F.date_trunc("hour", "created_at").alias("created_at")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.col("sentiment_score").cast("double")).alias("score_sum"),
        F.sum("word_count").alias("word_sum"),
        F.sum("hashtags_count").alias("hashtag_sum"),
    )
