"""Business measures from one additive summary.

Every report here is a sum of counts, so facts are first summed by dimension keys (narrow columns,
combined before the shuffle, immune to a source or topic that holds most rows), and only that small
result meets the dimensions. Measures a report does not use are pruned by Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpulse import rules
from textpulse.functions import dates
from textpulse.operators.star import EVERYTHING, Criteria, Star

CLASS_COUNTS = list(rules.CLASSES)


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("messages"),
        *[F.count_if(F.col("sentiment_class") == c).alias(c) for c in CLASS_COUNTS],
        F.sum(F.col("sentiment_score").cast("double")).alias("score_sum"),
        F.sum("word_count").alias("word_sum"),
        F.sum("hashtags_count").alias("hashtag_sum"),
    ]


def _measures_of_hours() -> list[Column]:
    of_class = [F.sum(F.when(F.col("sentiment_class") == c, F.col("messages")).otherwise(0)) for c in CLASS_COUNTS]
    return [
        F.sum("messages").alias("messages"),
        *[counted.alias(c) for counted, c in zip(of_class, CLASS_COUNTS)],
        *[F.sum(m).alias(m) for m in ("score_sum", "word_sum", "hashtag_sum")],
    ]


def _summed(star: Star, criteria: Criteria, finest: str, *keys: Column | str) -> DataFrame:
    """Measures per key, from the maintained hours where no key is finer than an hour."""
    hours = None if finest == "Minute" else star.narrowed_hours(criteria)
    if hours is None:
        return star.narrowed(criteria).groupBy(*keys).agg(*_measures())
    return hours.groupBy(*keys).agg(*_measures_of_hours())


def summarise(star: Star, criteria: Criteria = EVERYTHING, **by: Column) -> DataFrame:
    """Measures per source, topic and the extra keys given."""
    extra = [column.alias(name) for name, column in by.items()]
    return star.with_names(_summed(star, criteria, "Minute" if by else "Day", "source_id", "topic_id", *extra), criteria)


def summarise_by_time(star: Star, grain: str, criteria: Criteria = EVERYTHING) -> DataFrame:
    bucket = dates.time_bucket("created_at", grain).alias("bucket")
    return star.with_names(_summed(star, criteria, grain, "source_id", "topic_id", bucket), criteria)


def _total(measure: str) -> Column:
    return F.coalesce(F.sum(measure), F.lit(0))


def _mean(measure: str) -> Column:
    return F.coalesce(F.try_divide(F.sum(measure), F.sum("messages")), F.lit(0.0))


def engagement() -> Column:
    return _mean("word_sum") + rules.HASHTAG_WEIGHT * _mean("hashtag_sum")


def kpis(summary: DataFrame) -> DataFrame:
    """One row, zeros when nothing matches."""
    return summary.agg(
        _total("messages").alias("messages"),
        _mean("positive").alias("positive_rate"),
        _mean("negative").alias("negative_rate"),
        _mean("score_sum").alias("avg_score"),
        engagement().alias("engagement"),
    )


def over_time(summary: DataFrame) -> DataFrame:
    """Counts per bucket, one column per class."""
    return summary.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in CLASS_COUNTS])


def as_long(wide: DataFrame) -> DataFrame:
    return wide.unpivot(["bucket"], CLASS_COUNTS, "sentiment", "messages")


def class_shares(summary: DataFrame) -> DataFrame:
    """Count and share of each class that occurs (at most three rows reach the window)."""
    totals = summary.agg(*[F.sum(c).alias(c) for c in CLASS_COUNTS])
    counts = totals.unpivot([], CLASS_COUNTS, "sentiment_class", "messages")
    share = F.col("messages") / F.sum("messages").over(Window.partitionBy())
    return counts.where(F.col("messages") > 0).withColumn("share", share)


def top(summary: DataFrame, name: str, measure: str, n: int) -> DataFrame:
    """The n names with most of a measure; names break ties."""
    counts = summary.groupBy(name).agg(F.sum(measure).alias(measure)).where(F.col(measure) > 0)
    return counts.orderBy(F.desc(measure), F.asc(name)).limit(n)


def top_topics(summary: DataFrame, n: int = rules.TOP_TOPICS) -> DataFrame:
    return top(summary, "topic_name", "messages", n)


def top_negative_topics(summary: DataFrame, n: int = rules.TOP_NEGATIVE) -> DataFrame:
    return top(summary, "topic_name", "negative", n)


def top_negative_sources(summary: DataFrame, n: int = rules.TOP_NEGATIVE) -> DataFrame:
    return top(summary, "source_name", "negative", n)


def calendar_rollup(star: Star, criteria: Criteria = EVERYTHING) -> DataFrame:
    """Counts per day of the calendar; facts are summed per date key before the join."""
    per_day = star.with_calendar(_summed(star, criteria, "Day", "date_id"))
    return per_day.groupBy("year", "month", "day").agg(
        F.sum("messages").alias("messages"), *[F.sum(c).alias(c) for c in CLASS_COUNTS]
    )


def distinct_values(
    table: DataFrame, column: str, limit: int = rules.FILTER_VALUES_LIMIT
) -> DataFrame:
    """Choices for a filter, in order so that the limit is repeatable."""
    return table.select(column).distinct().orderBy(column).limit(limit)


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("row_count"))
