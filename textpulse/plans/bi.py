"""The overview and diagnostics page as a set of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from textpulse import storage
from textpulse.operators import recent, summary
from textpulse.operators.star import EVERYTHING, Criteria, Star


def page(
    star: Star, grain: str = "Hour", criteria: Criteria = EVERYTHING, scratch: str | None = None
) -> dict[str, DataFrame]:
    """All panels from one scan of the facts: the summary is written once and read by each panel.
    Its size follows the number of buckets, sources and topics, not the number of messages.
    A caller that gives ``scratch`` can delete it when it has read the panels."""
    spark = star.facts.sparkSession
    cube = storage.materialize(
        summary.summarise_by_time(star, grain, criteria), scratch or storage.fresh_dir(spark, "page")
    )
    return {
        "kpis": summary.kpis(cube),
        "over_time": summary.as_long(summary.over_time(cube)),
        "class_shares": summary.class_shares(cube),
        "top_topics": summary.top_topics(cube),
        "top_negative_topics": summary.top_negative_topics(cube),
        "top_negative_sources": summary.top_negative_sources(cube),
        "negative_examples": recent.negative_examples(star, criteria),
    }
