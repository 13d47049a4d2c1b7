"""The compacted log and the catalogue's tables."""

import re

from pyspark.sql import functions as F

from textpulse import storage
from textpulse.functions.keys import message_key
from textpulse.operators import compaction, staging
from textpulse.plans import etl
from textpulse.session import use_utc
from textpulse.sources.catalogue import STAGING, Catalogue
from textpulse.sources.warehouse import Warehouse
from workload import inputs

RUN = "2024-02-01 00:00:00"


def grown_log(spark, log, first, last):
    """Batches first to last - 1 of 30 messages; texts come again in later batches, one in every batch."""
    rows = spark.range((last - first) * 30).select(
        (F.lit(first) + F.floor(F.col("id") / 30)).cast("bigint").alias("batch_id"), (F.col("id") % 30).alias("arrival")
    )
    text = F.when(F.col("arrival") < 10, "hot").otherwise(
        F.concat(F.lit("t"), F.pmod(F.xxhash64("batch_id", "arrival"), F.lit(700)))
    )
    rows.select(
        text.alias("text"), F.concat(F.lit("s"), "batch_id", F.lit("-"), "arrival").alias("source"),
        F.lit("2024-01-01").alias("created_at"), F.lit(None).cast("string").alias("value"), "arrival",
        F.lit(staging.LOADS).alias("run"), "batch_id", F.lit(staging.MESSAGE).alias("kind"),
    ).withColumn("message_key", message_key("text")).write.mode("append").partitionBy("run", "batch_id", "kind").parquet(log)


def test_a_hundred_batches_in_one_run(spark):
    log = storage.fresh_dir(spark, "test-log")
    compacted = compaction.CompactedLog(spark, log, storage.fresh_dir(spark, "test-runs"), buckets=4, fan_in=2)
    grown_log(spark, log, 0, 1)
    assert compacted.current().count() == staging.current_messages(staging.read_log(spark, log)).count()
    for first, last in ((1, 25), (25, 50), (50, 75), (75, 100)):
        grown_log(spark, log, first, last)
        compacted.compact()
    version, buckets, runs = compacted.state()
    assert [(r.level, len(r.batches)) for r in runs] == [(2, 100)] and buckets == 4 and version == 4
    want = staging.current_messages(staging.read_log(spark, log)).collect()
    got = compacted.current()
    assert sorted(got.collect()) == sorted(want)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    files = [f for f in storage.names(spark, f"{compacted.root}/{runs[0].name}") if f.startswith("part-")]
    assert len(files) == 4

    # New batches are merged with the run, which is not shuffled for it, nor when both become one.
    grown_log(spark, log, 100, 103)
    want = sorted(staging.current_messages(staging.read_log(spark, log)).collect())
    got = compacted.current()
    assert sorted(got.collect()) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join FullOuter" in plan
    physical = got._jdf.queryExecution().executedPlan().toString()
    base = physical[physical.index("Scan parquet") if physical.count("Scan parquet") == 1 else 0 :]
    sides = physical.split("SortMergeJoin")[-1]
    run_side = next(part for part in re.split(r"\n(?=\s*[:+]- )", sides) if runs[0].name in part)
    assert "Exchange" not in run_side and "Bucketed: true" in base
    compacted.compact()
    again = compaction.CompactedLog(spark, log, compacted.root)
    spark.sql(f"DROP TABLE {runs[0].name}")  # as in a new session
    assert sorted(again.current().collect()) == want
    again.vacuum()
    left = {n for n in storage.names(spark, compacted.root) if n.startswith("textpulse_run_")}
    assert left == {r.name for r in again.state()[2]} and sorted(again.current().collect()) == want


def test_an_older_batch_does_not_win(spark):
    log = storage.fresh_dir(spark, "test-log")
    compacted = compaction.CompactedLog(spark, log, storage.fresh_dir(spark, "test-runs"), buckets=2, fan_in=2)
    for first in (5, 2, 7):
        grown_log(spark, log, first, first + 1)
        compacted.compact()
    want = staging.current_messages(staging.read_log(spark, log)).collect()
    assert sorted(compacted.current().collect()) == sorted(want)
    hot = compacted.current().where("id = 'hot'").first()
    assert hot.batch_id == 7 and hot.arrival == 9


def test_catalogue_tables_follow_the_warehouse(spark, sf_dir):
    use_utc(spark)
    place = storage.fresh_dir(spark, "test-catalogue")
    tables = Catalogue(spark, f"test_{place[-12:]}", place).create().create()
    source = Warehouse(spark, storage.fresh_dir(spark, "test-star"))
    log = storage.fresh_dir(spark, "test-log")
    rows = staging.read_log(spark, inputs.staging_log(spark, sf_dir))
    columns = sorted(source.create().facts.columns)

    def facts(frame):
        return sorted(map(str, frame.select(*columns).collect()))

    for wave in ("batch_id < 2", "batch_id >= 2", "false"):
        rows.where(wave).write.mode("append").partitionBy("run", "batch_id", "kind").parquet(log)
        etl.load(spark, log, source, inputs.scorer(spark, sf_dir), RUN)
        tables.refresh(source)
        assert facts(tables.table("fact_sentiment")) == facts(source.facts)
        for dim in ("dim_source", "dim_date", "dim_topic"):
            assert sorted(map(str, tables.table(dim).collect())) == sorted(map(str, source.table(dim).collect()))
        assert tables.held_version() == source.version().number
    # A day that loses all its facts goes.
    day = source.facts.groupBy("date_id").count().orderBy("count", "date_id").first().date_id
    moved = [r.text for r in source.facts.where(F.col("date_id") == day).collect()]
    change = spark.createDataFrame(
        [(t, "zz", "2031-01-01 00:00:00", n) for n, t in enumerate(moved)],
        "text string, source string, created_at string, arrival long",
    )
    change = change.withColumns({"message_key": message_key("text"), "value": F.lit(None).cast("string")})
    etl.write_log_batch(change, log, 9)
    etl.load(spark, log, source, lambda p: p.withColumn("prediction", F.lit(2.0)), RUN)
    tables.refresh(source)
    assert facts(tables.table("fact_sentiment")) == facts(source.facts)
    days = {r.partition for r in spark.sql(f"SHOW PARTITIONS {tables.name('fact_sentiment')}").collect()}
    assert f"date_id={day}" not in days and "date_id=20310101" in days


def test_defaults_fill_what_an_insert_leaves_out(spark):
    place = storage.fresh_dir(spark, "test-catalogue")
    tables = Catalogue(spark, f"test_{place[-12:]}", place).create()
    tables.insert("dim_topic", spark.createDataFrame([("Other", 7)], "topic_name string, topic_id long"))
    spark.sql(f"INSERT INTO {tables.name('dim_topic')} (topic_id, topic_name) VALUES (8, 'AI')")
    rows = tables.table("dim_topic").collect()
    assert {(r.topic_id, r.topic_name) for r in rows} == {(7, "Other"), (8, "AI")} and all(r.load_dt for r in rows)
    tables.insert(STAGING, spark.createDataFrame([("t",)], "id string"))
    assert tables.table(STAGING).first().source is None
