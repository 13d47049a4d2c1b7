"""What the plans must and must not contain."""

from datetime import date

import pytest

from __spark_entry__ import queries
from textpulse.operators import summary
from textpulse.operators.star import Criteria, drill_down
from workload import inputs
from workload.registry import QUERIES

STREAMS_AND_MODELS = ("stream", "ml_", "job_", "sink_", "src_")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", [k for k in sorted(QUERIES) if not k.startswith(STREAMS_AND_MODELS)])
def test_no_python_workers_and_no_cross_joins(key, spark, sf_dir):
    plan = plan_of(queries()[key](spark, sf_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_day_range_prunes_partitions(spark, sf_dir):
    star = inputs.star(spark, sf_dir)
    plan = plan_of(star.narrowed(Criteria(days=(date(2024, 1, 2), date(2024, 1, 3)))))
    partition_filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "20240102" in partition_filters and "20240103" in partition_filters
    assert "GreaterThanOrEqual(created_at" in plan


def test_choice_of_source_reaches_the_fact_scan(spark, sf_dir):
    plan = plan_of(inputs.star(spark, sf_dir).joined(drill_down(source="src3")))
    fact_scan = next(line for line in plan.split("\n") if "fact_sentiment" in line or "sentiment_class" in line and "FileScan" in line)
    assert "EqualTo(source_id," in fact_scan


def test_json_is_parsed_once(spark, sf_dir):
    for key in ("src_wiki_changes", "filter_watchlist", "sink_publish_messages"):
        assert plan_of(queries()[key](spark, sf_dir)).count("from_json(") == 1


def test_reports_read_only_their_columns(spark, sf_dir):
    report = summary.top_topics(summary.summarise(inputs.star(spark, sf_dir)))
    schemas = [part.split(">")[0] for part in plan_of(report).split("ReadSchema: struct<")[1:]]
    assert sorted(schemas) == sorted(
        ["source_id:bigint,topic_id:bigint", "source_id:bigint", "topic_id:bigint,topic_name:string"]
    )


def test_dimensions_are_broadcast_by_size_only(spark, sf_dir):
    star = inputs.star(spark, sf_dir)
    assert plan_of(star.joined()).count("BroadcastHashJoin") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_of(star.joined())
        assert star.joined().count() == star.facts.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
