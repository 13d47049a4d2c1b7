"""Ad-hoc queries: composed from criteria, or free SQL over the star schema's views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from textpulse import rules
from textpulse.operators.recent import load_recent
from textpulse.operators.star import Criteria, Star

DEFAULT_SQL = "SELECT count(*) AS row_count FROM fact_sentiment"


COLUMNS = ["created_at", "source_name", "topic_name", "sentiment_class", "sentiment_score", "text"]


def adhoc_rows(star: Star, criteria: Criteria) -> DataFrame:
    """All rows that meet the criteria, with their ids, in no order."""
    return star.joined(criteria).select(*COLUMNS, "fact_id")


def adhoc(star: Star, criteria: Criteria, limit: int = rules.ADHOC_LIMIT) -> DataFrame:
    """Newest rows that meet all criteria, newest first. The facts are narrowed before they meet the names."""
    return load_recent(star, limit, criteria).select(*COLUMNS)


def raw_sql(star: Star, statement: str = DEFAULT_SQL) -> DataFrame:
    return star.register_views().facts.sparkSession.sql(statement)
