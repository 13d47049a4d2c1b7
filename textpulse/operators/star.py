"""The star join and the criteria that narrow it."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.functions import dates, keys, text
from textpulse.operators import textindex
from textpulse.sources.warehouse import Warehouse


@dataclass(frozen=True)
class Criteria:
    """Optional narrowing; an empty one keeps every row. All values are bound, never spliced.

    The dimension keys are a function of the names, so a choice of names also gives a filter on the
    fact's own columns. That one reaches the Parquet scan, where rows are sorted by source.
    """

    sources: tuple[str, ...] = ()
    topics: tuple[str, ...] = ()
    sentiments: tuple[str, ...] = ()
    days: tuple[date, date] | None = None
    keyword: str = ""

    def on_facts(self) -> Column:
        tests = [F.lit(True)]
        if self.days:
            tests.append(dates.within_days(*self.days))
        if self.sentiments:
            tests.append(F.col("sentiment_class").isin(*self.sentiments))
        if self.keyword:
            tests.append(text.contains_ignoring_case("text", self.keyword))
        for names, key in ((self.sources, "source_id"), (self.topics, "topic_id")):
            if names:
                tests.append(F.col(key).isin(*[keys.surrogate_key(F.lit(n)) for n in names]))
        return reduce(and_, tests)

    def on_sources(self) -> Column:
        return F.col("source_name").isin(*self.sources) if self.sources else F.lit(True)

    def on_topics(self) -> Column:
        return F.col("topic_name").isin(*self.topics) if self.topics else F.lit(True)

    def only(self, sentiment: str) -> Criteria:
        return replace(self, sentiments=(sentiment,))


EVERYTHING = Criteria()


def drill_down(source: str | None = None, topic: str | None = None) -> Criteria:
    """One source and/or one topic; None stands for all."""
    return Criteria(sources=(source,) if source else (), topics=(topic,) if topic else ())


@dataclass(frozen=True)
class Star:
    """A snapshot of the star schema: its files are listed once, however many reports follow.
    Loads that come later show in the next ``Star.of``."""

    facts: DataFrame
    sources: DataFrame
    topics: DataFrame
    dates: DataFrame
    hours: DataFrame | None = None

    @classmethod
    def of(cls, warehouse: Warehouse) -> Star:
        warehouse = warehouse.pinned()
        return cls(warehouse.facts, warehouse.sources, warehouse.topics, warehouse.dates)

    @classmethod
    def rolled_up(cls, warehouse: Warehouse) -> Star:
        """The same with the measures per hour that loads maintain: reports that need no finer rows read those."""
        warehouse = warehouse.pinned()
        return replace(cls.of(warehouse), hours=warehouse.hours)

    @classmethod
    def searching(cls, warehouse: Warehouse, keyword: str) -> Star:
        """For criteria with this keyword: the facts are those of the folders that may hold it, by the text index."""
        warehouse = warehouse.pinned()
        return replace(cls.of(warehouse), facts=textindex.searched(warehouse, keyword))

    def register_views(self) -> Star:
        """Temp views under the tables' own names, for free SQL."""
        self.facts.createOrReplaceTempView("fact_sentiment")
        self.sources.createOrReplaceTempView("dim_source")
        self.topics.createOrReplaceTempView("dim_topic")
        self.dates.createOrReplaceTempView("dim_date")
        return self

    def narrowed(self, criteria: Criteria) -> DataFrame:
        return self.facts.where(criteria.on_facts())

    def narrowed_hours(self, criteria: Criteria) -> DataFrame | None:
        """Measures per hour of the rows that fulfil the criteria; None where only the facts can tell. Criteria on
        days are about whole days, so an hour is in or out as a whole."""
        return None if self.hours is None or criteria.keyword else self.hours.where(criteria.on_facts())

    def with_names(self, rows: DataFrame, criteria: Criteria = EVERYTHING) -> DataFrame:
        """Inner joins on the surrogate keys.

        No broadcast hint: the tables' file sizes decide, so a dimension is broadcast while it is
        small, and beyond that AQE splits the sources that hold most of the rows.
        """
        sources = self.sources.where(criteria.on_sources()).select("source_id", "source_name")
        topics = self.topics.where(criteria.on_topics()).select("topic_id", "topic_name")
        return rows.join(sources, "source_id").join(topics, "topic_id")

    def joined(self, criteria: Criteria = EVERYTHING) -> DataFrame:
        return self.with_names(self.narrowed(criteria), criteria).select(
            "sentiment_class",
            "sentiment_score",
            "created_at",
            "text",
            "word_count",
            "hashtags_count",
            "source_name",
            "topic_name",
            "fact_id",
        )

    def with_calendar(self, rows: DataFrame) -> DataFrame:
        days = self.dates.select("date_id", "date_value", "year", "month", "day")
        return rows.join(days, "date_id")
