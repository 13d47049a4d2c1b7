"""Staging, loads, reports and streams end to end on small hand-made logs."""

import math
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from textpulse import storage
from textpulse.functions.keys import message_key
from textpulse.operators import dimensions, evaluation, recent, staging, summary
from textpulse.operators.star import Criteria, Star, drill_down
from textpulse.plans import adhoc, bi, etl
from textpulse.session import use_utc
from textpulse.sinks import publish
from textpulse.sources import files, messages
from textpulse.sources.models import load_metrics
from textpulse.sources.warehouse import Warehouse
from textpulse.streaming import ingest, live
from workload import inputs

RUN = "2024-02-01 00:00:00"
DRAIN = {"availableNow": True}


def log_rows(spark, rows):
    """(text, source, created_at, arrival) with the log's key."""
    frame = spark.createDataFrame(rows, "text string, source string, created_at string, arrival bigint")
    return frame.select(
        message_key("text").alias("message_key"), "source", "text", "created_at",
        F.lit(None).cast("string").alias("value"), "arrival",
    )


def by_word(prepared):
    """A class from the text, in place of a model."""
    return prepared.withColumn(
        "prediction",
        F.when(F.contains("raw_text", F.lit("bad")), 0.0)
        .when(F.contains("raw_text", F.lit("good")), 1.0)
        .otherwise(2.0),
    )


FIRST = [
    ("good bitcoin #a #b", "x", "2024-01-01 10:00:00", 1),
    ("bad game", "y", "2024-01-01 10:30:00", 2),
    ("plain words here", None, "no date", 3),
    ("", "x", "2024-01-02 00:00:00", 4),
    (None, "x", "2024-01-02 00:00:00", 5),
    ("bad game", "x", "2024-01-01 11:30:00", 6),
]
SECOND = [("bad movie", "z", "2024-01-08 00:00:00", 1), ("bad game", "q", "2024-01-09 00:00:00", 2)]


def first_load(spark):
    use_utc(spark)
    log = storage.fresh_dir(spark, "test-log")
    etl.write_log_batch(log_rows(spark, FIRST), log, 0)
    target = Warehouse(spark, storage.fresh_dir(spark, "test-star"))
    etl.load(spark, log, target, by_word, RUN)
    return target, log


@pytest.fixture(scope="module")
def loaded(spark):
    """For tests that only read."""
    return first_load(spark)[0]


@pytest.fixture
def warehouse(spark):
    return first_load(spark)


def counts(warehouse):
    return {t: warehouse.table(t).count() for t in ("dim_source", "dim_date", "dim_topic", "fact_sentiment")}


def test_last_write_wins(spark):
    log = log_rows(spark, FIRST).withColumn("batch_id", F.lit(0)).unionByName(
        log_rows(spark, SECOND).withColumn("batch_id", F.lit(1))
    )
    current = {r.text: (r.source, r.batch_id) for r in staging.current_messages(log).collect()}
    assert current == {
        "good bitcoin #a #b": ("x", 0), "plain words here": (None, 0), "": ("x", 0),
        "bad movie": ("z", 1), "bad game": ("q", 1),
    }


def test_repeated_text_is_cut_before_the_shuffle(spark):
    """One text makes up a third of all rows; each map task sends one row of it."""
    rows = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"),
        F.lit("s").alias("source"), F.lit("2024").alias("created_at"), F.col("id").alias("arrival"),
        F.lit(0).alias("batch_id"),
    ).withColumn("message_key", message_key("text"))
    current = staging.current_messages(rows)
    assert current.count() == 20_001
    assert current.where("text = 'hot'").first().arrival == 29_997
    plan = current._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning(message_key")[1]
    assert "row_number(), 1, Partial" in before_shuffle


def test_load(loaded):
    target = loaded
    assert counts(target) == {"dim_source": 2, "dim_date": 3, "dim_topic": 3, "fact_sentiment": 4}
    rows = {r.text: r for r in Star.of(target).joined().collect()}
    assert rows["bad game"].source_name == "x" and rows["bad game"].sentiment_class == "negative"
    assert rows["bad game"].topic_name == "Gaming"
    assert rows["plain words here"].source_name == "unknown"
    assert str(rows["plain words here"].created_at.date()) == "2024-02-01"
    assert rows["good bitcoin #a #b"].hashtags_count == 2
    assert rows[""].word_count == 0 and rows[""].topic_name == "Other"


def test_later_loads_add_new_and_changed_messages(spark, warehouse):
    target, log = warehouse
    before = counts(target)
    etl.load(spark, log, target, by_word, "2024-03-01 00:00:00")
    assert counts(target) == before
    etl.write_log_batch(log_rows(spark, SECOND), log, 1)
    etl.load(spark, log, target, by_word, RUN, since_batch=0)
    # A changed message brings its new source and day along, as one load of both batches does.
    assert counts(target) == {"dim_source": 4, "dim_date": 5, "dim_topic": 4, "fact_sentiment": 5}
    assert Star.of(target).joined().count() == 5


def facts_of(target):
    joined = Star.of(target).joined().select("text", "source_name", F.col("created_at").cast("string").alias("at"))
    return sorted(map(tuple, joined.collect()))


def test_facts_follow_changed_messages(spark, warehouse):
    """Two loads equal one; the day a message has left keeps its other facts or goes."""
    target, log = warehouse
    etl.write_log_batch(log_rows(spark, SECOND + [("plain words here", "y", None, 3)]), log, 1)
    for since in (0, 0, None):
        etl.load(spark, log, target, by_word, RUN, since_batch=since)
    whole = Warehouse(spark, storage.fresh_dir(spark, "test-star"))
    etl.load(spark, log, whole, by_word, RUN)
    assert facts_of(target) == facts_of(whole)
    assert ("bad game", "q", "2024-01-09 00:00:00") in facts_of(target)
    etl.write_log_batch(log_rows(spark, [("bad movie", "z", "2024-01-10 00:00:00", 1)]), log, 2)
    etl.load(spark, log, target, by_word, RUN, since_batch=1)
    days = {row.date_id for row in target.facts.select("date_id").collect()}
    assert 20240110 in days and 20240108 not in days and target.facts.count() == 5


def test_empty_log(spark):
    log = storage.fresh_dir(spark, "test-log")
    etl.write_log_batch(log_rows(spark, []), log, 0)
    target = Warehouse(spark, storage.fresh_dir(spark, "test-star"))
    etl.load(spark, log, target, by_word, RUN)
    assert counts(target) == {"dim_source": 0, "dim_date": 0, "dim_topic": 0, "fact_sentiment": 0}
    star = Star.of(target)
    kpis = summary.kpis(summary.summarise(star)).first()
    assert tuple(kpis) == (0, 0.0, 0.0, 0.0, 0.0)
    assert summary.class_shares(summary.summarise(star)).count() == 0


def test_rejected_rows_keep_their_value(spark):
    log = storage.fresh_dir(spark, "test-log")
    etl.write_log_batch(log_rows(spark, FIRST), log, 0)
    assert staging.read_rejected(spark, log).count() == 1


def test_kpis(loaded):
    kpis = summary.kpis(summary.summarise(Star.of(loaded))).first()
    assert kpis.messages == 4 and kpis.positive_rate == 0.25 and kpis.negative_rate == 0.25
    assert kpis.avg_score == 1.0
    assert kpis.engagement == pytest.approx((4 + 2 + 3 + 0) / 4 + 3 * 2 / 4)


@pytest.mark.parametrize("grain", ["Minute", "Hour", "Day", "Week"])
def test_rollups_add_up(spark, sf_dir, grain):
    star = inputs.star(spark, sf_dir)
    wide = summary.over_time(summary.summarise_by_time(star, grain))
    total = wide.selectExpr("sum(negative + positive + neutral)").first()[0]
    assert total == star.facts.count()
    assert summary.as_long(wide).selectExpr("sum(messages)").first()[0] == total


def test_shares_add_up(spark, sf_dir):
    shares = summary.class_shares(summary.summarise(inputs.star(spark, sf_dir)))
    assert shares.selectExpr("sum(share)").first()[0] == pytest.approx(1.0)


def test_page_equals_single_reports(spark, sf_dir):
    star, criteria = inputs.star(spark, sf_dir), Criteria(sentiments=("negative", "positive"))
    page = bi.page(star, "Day", criteria)
    alone = summary.summarise(star, criteria)
    assert page["kpis"].collect() == summary.kpis(alone).collect()
    assert page["top_topics"].collect() == summary.top_topics(alone).collect()
    assert page["top_negative_sources"].collect() == summary.top_negative_sources(alone).collect()
    assert page["negative_examples"].collect() == recent.negative_examples(star).collect()


def test_drill_down_equals_filter_on_names(spark, sf_dir):
    star = inputs.star(spark, sf_dir)
    everything = star.joined().select("fact_id", "source_name", "topic_name")
    for source, topic in ((None, None), ("src2", None), (None, "Other"), ("src2", "Other"), ("nobody", None)):
        want = everything
        want = want.where(F.col("source_name") == source) if source else want
        want = want.where(F.col("topic_name") == topic) if topic else want
        got = star.joined(drill_down(source, topic)).select("fact_id", "source_name", "topic_name")
        assert sorted(got.collect()) == sorted(want.collect())


def test_hostile_criteria_are_values(spark, sf_dir):
    star = inputs.star(spark, sf_dir)
    for evil in ("x') OR 1=1 --", "'", "%", "\\"):
        assert star.joined(Criteria(sources=(evil,))).count() == 0
        assert star.joined(Criteria(keyword=evil + "zz")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 37, 187, 188, 5000])
def test_newest_by_counting_equals_sort(spark, sf_dir, n):
    facts = inputs.star(spark, sf_dir).facts
    got = recent.newest(facts, n, small=-1).select("fact_id").collect()
    want = facts.orderBy(*recent.newest_first()).limit(n).select("fact_id").collect()
    assert sorted(got) == sorted(want)


def test_newest_with_many_equal_times(spark, sf_dir):
    """Every row at the same second: only the keys tell them apart."""
    facts = inputs.star(spark, sf_dir).facts
    same = facts.withColumn("created_at", F.lit(RUN).cast("timestamp")).withColumn("date_id", F.lit(20240201))
    for n in (3, 100):
        got = recent.newest(same, n, small=-1).select("fact_id").collect()
        want = same.orderBy("fact_id").limit(n).select("fact_id").collect()
        assert sorted(got) == sorted(want)


def test_load_recent(spark, sf_dir, monkeypatch):
    star = inputs.star(spark, sf_dir)
    want = star.joined().orderBy(*recent.newest_first()).limit(50).select("fact_id").collect()
    missing = replace(star, sources=star.sources.where("source_name <> 'src1'"))
    for small in (10_000, 10):  # by sort, by counting
        monkeypatch.setattr(recent.newest, "__defaults__", (small,))
        assert recent.load_recent(star, 50).select("fact_id").collect() == want
        rest = recent.load_recent(missing, 50)
        assert rest.count() == 50 and rest.where("source_name = 'src1'").isEmpty()
    assert recent.load_recent(star, None).count() == star.facts.count()


def test_reports_over_the_newest_rows(spark, sf_dir):
    star = inputs.star(spark, sf_dir)
    newest = star.joined().orderBy(*recent.newest_first()).limit(60)
    want = {r.topic_name: r["count"] for r in newest.groupBy("topic_name").count().collect()}
    top = summary.top_topics(summary.summarise(recent.limited(star, 60)))
    assert {r.topic_name: r.messages for r in top.collect()} == want


def test_adhoc_is_newest_first(spark, sf_dir):
    got = [r.created_at for r in adhoc.adhoc(inputs.star(spark, sf_dir), Criteria(), limit=40).collect()]
    assert len(got) == 40 and got == sorted(got, reverse=True)


def test_raw_sql_default(spark, sf_dir):
    star = inputs.star(spark, sf_dir)
    assert adhoc.raw_sql(star).first().row_count == star.facts.count()


# Streams

def test_stream_equals_batch(spark, sf_dir):
    path, log = storage.fresh_dir(spark, "test-topic"), storage.fresh_dir(spark, "test-log")
    rows = inputs.raw_messages(spark, sf_dir)
    publish.to_files(rows, path)
    checkpoint = storage.fresh_dir(spark, "test-checkpoint")
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest(messages.file_stream(spark, path), log, checkpoint, DRAIN).awaitTermination()
    columns = ["source", "text", "created_at"]
    streamed = staging.read_log(spark, log).select(*columns)
    batch = rows.where("text IS NOT NULL").select(*columns)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    assert staging.read_rejected(spark, log).count() == rows.where("text IS NULL").count()


def test_replayed_batch_replaces_itself(spark):
    log = storage.fresh_dir(spark, "test-log")
    records = spark.createDataFrame([('{"source":"s","text":"t"}',), ("broken",)], "value string")
    records = records.selectExpr("value", "1L AS arrival", "'file' AS part", "0L AS position")
    for _ in range(2):
        ingest.stage_batch(records, log, "s000001-x", 7)
    assert [tuple(r) for r in staging.read_log(spark, log).select("text", "batch_id").collect()] == [("t", 7)]
    assert [r.value for r in staging.read_rejected(spark, log).collect()] == ["broken"]


def test_new_checkpoint_adds_and_last_write_wins(spark):
    """Two streams number their batches from 0 into one log. Inside a batch the later line of a file wins."""
    log = storage.fresh_dir(spark, "test-log")
    waves = [[("t", "a"), ("u", "a"), ("t", "b"), ("t", "c")], [("t", "d"), ("v", "d")]]
    for wave in waves:
        path = storage.fresh_dir(spark, "test-topic")
        rows = spark.createDataFrame(wave, "text string, source string").withColumn("created_at", F.lit("2024-01-01"))
        publish.to_files(rows.coalesce(1), path)
        checkpoint = storage.fresh_dir(spark, "test-checkpoint")
        ingest.ingest(messages.file_stream(spark, path), log, checkpoint, DRAIN).awaitTermination()
        current = staging.current_messages(staging.read_log(spark, log))
        last = {r.text: r.source for r in current.collect()}
        assert last == ({"t": "c", "u": "a"} if wave is waves[0] else {"t": "d", "u": "a", "v": "d"})
    assert staging.read_log(spark, log).count() == 6
    assert len(storage.names(spark, log)) == 2


def test_live_counts_of_two_streams_add_up(spark):
    """Files come newest first; without a watermark every row counts, and a second stream adds to the first."""
    out, schema = storage.fresh_dir(spark, "test-live"), "ts timestamp, kind string"
    for _ in range(2):
        folder = storage.fresh_dir(spark, "test-events")
        for day in range(5, 0, -1):
            row = spark.range(3).select(F.make_timestamp(*map(F.lit, (2024, 1, day, 0, 0, 0))).alias("ts"))
            row.withColumn("kind", F.lit("k")).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        counts = live.live_counts(stream, "ts", "kind", "Hour", lateness=None)
        live.write_live(counts, out, storage.fresh_dir(spark, "test-checkpoint"), DRAIN).awaitTermination()
    assert [r.messages for r in live.read_live(spark, out).collect()] == [6] * 5


def _days(spark, folder, days):
    for day in days:
        row = spark.range(3).select(F.make_timestamp(*map(F.lit, (2024, 1, day, 0, 0, 0))).alias("ts"))
        row.withColumn("kind", F.lit("k")).coalesce(1).write.mode("append").parquet(folder)


def test_late_rows_count_and_are_told_apart(spark):
    """One stream, started three times, with sums between; days 5, 4, 3 come, then 6 and 1, then none, then 2."""
    out, folder = storage.fresh_dir(spark, "test-live"), storage.fresh_dir(spark, "test-events")
    checkpoint = storage.fresh_dir(spark, "test-checkpoint")

    def counts():
        return {r.bucket.day: (r.messages, r.late) for r in live.read_additions(spark, out).collect()}

    assert counts() == {} and live.compact_additions(spark, out) == 0
    expected = {}
    for days, sums in (([5, 4, 3], 1), ([6, 1], 1), ([], 0), ([2, 5], 1)):
        newest = max(expected, default=0)
        _days(spark, folder, days)
        for day in days:
            n, late = expected.get(day, (0, 0))
            expected[day] = (n + 3, late + 3 * (day < newest))
            newest = max(newest, day)
        if days:
            stream = spark.readStream.schema("ts timestamp, kind string").option("maxFilesPerTrigger", 1).parquet(folder)
            live.write_additions(stream, out, checkpoint, DRAIN, "ts", "kind").awaitTermination()
        assert counts() == expected
        assert live.compact_additions(spark, out, least=2) == sums
        assert counts() == expected


def test_a_batch_written_again_counts_once(spark):
    out = storage.fresh_dir(spark, "test-live")
    days = spark.sql("SELECT timestamp'2024-01-05 10:20:00' AS ts, 'k' AS kind UNION ALL SELECT NULL, 'k'")
    for batch_id in (0, 1, 1, 2, 2):
        live.add_batch(days, batch_id, out, "r", "ts", "kind", "Week", "10 minutes")
    assert live.compact_additions(spark, out, least=1) == 1
    live.add_batch(days, 2, out, "r", "ts", "kind", "Week", "10 minutes")
    live.add_batch(days.limit(0), 3, out, "r", "ts", "kind", "Week", "10 minutes")
    row, = live.read_additions(spark, out).collect()
    assert (str(row.bucket.date()), row.messages, row.late) == ("2024-01-07", 3, 0)


def test_two_names_with_one_key_fail_the_load(spark):
    """Both names have the CRC-32 1306201125."""
    target = Warehouse(spark, storage.fresh_dir(spark, "test-star")).create()

    def load(*names):
        rows = spark.createDataFrame([(n,) for n in names], "source string")
        etl.append_dimension(target, "dim_source", dimensions.source_rows(rows, RUN), "source_name")

    with pytest.raises(ValueError, match="plumless"):
        load("plumless", "buckeroo")
    assert target.sources.isEmpty()
    load("plumless")
    with pytest.raises(ValueError, match="buckeroo"):
        load("buckeroo")
    load("plumless")
    assert target.sources.count() == 1


@pytest.mark.parametrize("small", [4, 5, 6])
def test_adhoc_and_negative_examples_around_the_small_limit(spark, sf_dir, monkeypatch, small):
    """One contract on both sides of the switch: five rows, newest first."""
    monkeypatch.setattr(recent.newest, "__defaults__", (small,))
    star = inputs.star(spark, sf_dir)
    order = [F.desc("created_at"), F.asc("fact_id")]
    for got, rows in (
        (adhoc.adhoc(star, Criteria(), 5), star.joined()),
        (recent.negative_examples(star, n=5), star.joined().where("sentiment_class = 'negative'")),
    ):
        want = rows.orderBy(*order).limit(5).select(*got.columns)
        assert got.collect() == want.collect()


@pytest.mark.parametrize("grain", ["Hour", "Week"])
def test_live_rollup_equals_batch(spark, sf_dir, grain):
    """Facts arrive in several micro-batches, oldest day first; the live counts end as the batch ones."""
    star = inputs.star(spark, sf_dir)
    folder, out = storage.fresh_dir(spark, "test-facts"), storage.fresh_dir(spark, "test-live")
    checkpoint = storage.fresh_dir(spark, "test-checkpoint")
    schema = star.facts.select("created_at", "sentiment_class").schema
    days = [date(2024, 1, 1), date(2024, 1, 3), date(2024, 1, 5), date(2024, 2, 2)]
    for first, last in zip(days, days[1:]):
        part = star.facts.where((F.col("created_at") >= F.lit(first)) & (F.col("created_at") < F.lit(last)))
        part.select("created_at", "sentiment_class").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        rolled = live.live_counts(stream, "created_at", "sentiment_class", grain)
        live.write_live(rolled, out, checkpoint, DRAIN).awaitTermination()
    got = {(str(r.bucket), r.category): r.messages for r in live.read_live(spark, out).collect()}
    batch = summary.as_long(summary.over_time(summary.summarise_by_time(star, grain)))
    want = {(str(r.bucket), r.sentiment): r.messages for r in batch.collect() if r.messages}
    assert got == want


# Files

def test_tweet_archive(spark, tmp_path):
    lines = [
        "a,b,c,d,e,f,g,h,date,text,extra",
        '1,2,3,4,5,6,7,8,2024-01-01,"long enough, with ""quotes""\nand a line",x',
        "1,2,3,4,5,6,7,8,2024-01-02,too short,x",
        "1,2,3,4,5,6,7,8,2024-01-03",
        "1,2,3,4,5,6,7,8,2024-01-04,exactly 10",
        "1,2,3,4,5,6,7,8,2024-01-05,,x",
    ]
    (tmp_path / "tweets.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    got = files.archived_tweets(spark, str(tmp_path / "tweets.csv")).collect()
    assert [(r.created_at, r.text) for r in got] == [
        ("2024-01-01", 'long enough, with "quotes"\nand a line'), ("2024-01-04", "exactly 10"),
    ]
    assert {r.source for r in got} == {"Twitter (Bitcoin Dataset)"}


# Evaluation

PUBLISHED = [[3799, 414, 243], [298, 3567, 247], [312, 484, 2769]]


def test_published_matrix_gives_published_scores(spark):
    matrix = spark.createDataFrame([(PUBLISHED,)], "confusion_matrix array<array<bigint>>")
    scores = evaluation.scores(matrix).first()
    assert scores.accuracy == pytest.approx(0.8353251462952279, abs=1e-12)
    assert scores.precision == pytest.approx(0.83684865330454, abs=1e-12)
    assert scores.recall == pytest.approx(0.8353251462952279, abs=1e-12)
    assert scores.f1 == pytest.approx(0.8351193093473033, abs=1e-12)


def test_matrix_with_missing_class(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (0.0, 2.0), (2.0, 2.0)], "label double, prediction double")
    matrix = evaluation.confusion(rows)
    assert matrix.first().confusion_matrix == [[1, 0, 1], [0, 0, 0], [0, 0, 1]]
    assert [r.label for r in evaluation.matrix_rows(matrix).collect()] == [0.0, 1.0, 2.0]
    empty = evaluation.scores(evaluation.confusion(rows.limit(0))).first()
    assert (empty.accuracy, empty.precision, empty.recall, empty.f1) == (0.0, 0.0, 0.0, 0.0)
    assert not any(math.isnan(v) for v in evaluation.scores(matrix).drop("confusion_matrix").first())


def test_missing_metrics_give_no_row(spark):
    assert load_metrics(spark, storage.fresh_dir(spark, "test-nothing")).isEmpty()
