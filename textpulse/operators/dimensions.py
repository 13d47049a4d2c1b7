"""Dimension rows from prepared messages. ``distinct`` combines before its shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse import rules
from textpulse.functions import dates, keys


def source_rows(messages: DataFrame, run_ts: str) -> DataFrame:
    names = messages.select(F.coalesce("source", F.lit(rules.UNKNOWN_SOURCE)).alias("source_name"))
    return names.distinct().select(
        keys.surrogate_key("source_name").alias("source_id"),
        "source_name",
        F.lit(rules.SOURCE_TYPE).alias("source_type"),
        dates.moment(run_ts).alias("load_dt"),
    )


def date_rows(messages: DataFrame, run_ts: str) -> DataFrame:
    timed = messages.where(F.col("created_ts").isNotNull())
    days = timed.select(F.to_date("created_ts").alias("date_value")).distinct()
    return days.select(
        dates.date_key("date_value").alias("date_id"),
        "date_value",
        *[part.alias(name) for name, part in dates.calendar_parts("date_value").items()],
        dates.moment(run_ts).alias("load_dt"),
    )


def topic_rows(messages: DataFrame, run_ts: str) -> DataFrame:
    return messages.select("topic_name").distinct().select(
        keys.surrogate_key("topic_name").alias("topic_id"),
        "topic_name",
        dates.moment(run_ts).alias("load_dt"),
    )
