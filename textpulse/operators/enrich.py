"""Message preparation and the fact projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse import rules
from textpulse.functions import dates, keys, text


def prepare(
    messages: DataFrame,
    run_ts: str,
    topics: Mapping[str, Sequence[str]] = rules.TOPIC_RULES,
) -> DataFrame:
    """Cleaned text, counts, topic and a usable time. ``text`` becomes the cleaned text, the
    original moves to ``raw_text``; a missing source becomes 'unknown' for fact and dimension alike.

    Each step is a projection of its own, so the cleaning and the split run once per row.
    """
    timed = messages.withColumns(
        {
            "source": F.coalesce("source", F.lit(rules.UNKNOWN_SOURCE)),
            "parsed_ts": F.try_to_timestamp("created_at"),
            "raw_text": F.col("text"),
            "clean_text": text.clean_for_scoring("text"),
            "hashtags_count": text.hashtag_count("text"),
        }
    ).withColumn("safe_ts", F.coalesce("parsed_ts", dates.moment(run_ts)))
    split_once = timed.withColumn("split_words", text.words("clean_text"))
    return split_once.withColumns(
        {
            "word_count": text.word_count("clean_text", F.col("split_words")),
            "topic_name": text.topic_of("split_words", topics),
            "text": F.col("clean_text"),
            "created_ts": dates.to_second("safe_ts"),
        }
    ).drop("split_words")


def sentiment_class(prediction: Column | str = "prediction") -> Column:
    """0 is negative, 1 positive, anything else neutral."""
    prediction = F.col(prediction) if isinstance(prediction, str) else prediction
    first, second, rest = rules.CLASSES
    return F.when(prediction == 0.0, first).when(prediction == 1.0, second).otherwise(rest)


def sentiment_score() -> Column:
    return F.lit(1.0).cast("float")


def to_facts(scored: DataFrame) -> DataFrame:
    """The fact columns. The message's key is the fact's id, so reloads and retries are identical."""
    return scored.select(
        F.col("message_key").alias("fact_id"),
        keys.surrogate_key("source").alias("source_id"),
        keys.surrogate_key("topic_name").alias("topic_id"),
        F.col("raw_text").alias("text"),
        sentiment_class().alias("sentiment_class"),
        sentiment_score().alias("sentiment_score"),
        F.col("word_count").cast("int").alias("word_count"),
        F.col("hashtags_count").cast("int").alias("hashtags_count"),
        F.col("created_ts").alias("created_at"),
        dates.date_key("created_ts").alias("date_id"),
    )
