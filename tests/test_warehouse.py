"""Versions of the star schema: what a load reads, what readers see, and what is left when a load is cut short."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from textpulse import storage
from textpulse.functions.keys import message_key
from textpulse.operators import keyfilter, recent, summary
from textpulse.operators.star import EVERYTHING, Criteria, Star
from textpulse.plans import etl
from textpulse.session import use_utc
from textpulse.sources import catalogue
from textpulse.sources import warehouse as versions
from textpulse.sources.warehouse import Change, Warehouse

RUN = "2024-02-01 00:00:00"


def write_batch(spark, log, number, rows, run=None):
    """(text, source, created_at) in order of arrival."""
    frame = spark.createDataFrame(
        [(*row, n) for n, row in enumerate(rows)], "text string, source string, created_at string, arrival bigint"
    ).withColumns({"message_key": message_key("text"), "value": F.lit(None).cast("string")})
    if run is None:
        etl.write_log_batch(frame, log, number)
    else:
        kind = F.when(F.col("text").isNull(), "rejected").otherwise("message")
        frame.withColumn("kind", kind).write.partitionBy("kind").parquet(f"{log}/run={run}/batch_id={number}")


def neutral(prepared):
    return prepared.withColumn("prediction", F.lit(2.0))


def load(spark, log, target, **options):
    etl.load(spark, log, target, neutral, RUN, **options)


def facts_of(target):
    joined = Star.of(target).joined().select("text", "source_name", F.col("created_at").cast("string"))
    return sorted(map(tuple, joined.collect()))


@pytest.fixture
def places(spark):
    use_utc(spark)
    log = storage.fresh_dir(spark, "test-log")
    for number in range(3):
        write_batch(spark, log, number, [(f"t{number} {i}", "s", f"2024-01-0{number + 1} 0{i}:00:00") for i in range(5)])
    return log, Warehouse(spark, storage.fresh_dir(spark, "test-star"))


def test_ledger_names_what_was_taken_in(spark, places):
    log, target = places
    load(spark, log, target)
    assert {(r.run, r.batch_id) for r in target.ledger().collect()} == {("loads", n) for n in range(3)}
    write_batch(spark, log, 7, [("later", "s", "2024-01-09")])
    assert etl.pending(spark, log, target) == [("loads", 7)]
    load(spark, log, target)
    loads = {r.batch_id: r.load for r in target.ledger().collect()}
    assert loads[0] == loads[1] == loads[2] < loads[7]


def test_a_second_load_opens_neither_log_nor_facts(spark, places, monkeypatch):
    log, target = places
    load(spark, log, target)
    before = target.versions()

    def never(*_args, **_options):
        raise AssertionError("nothing is to be read")

    monkeypatch.setattr(Warehouse, "_rows", never)
    monkeypatch.setattr(etl.staging, "read_log", never)
    load(spark, log, target)
    assert target.versions() == before


def test_only_days_whose_filter_answers_are_opened(spark, places):
    log, target = places
    load(spark, log, target)
    known = spark.createDataFrame([("t1 3",), ("unheard of",)], "text string").select(message_key("text").alias("k"))
    hits = keyfilter.answering(target.key_filters(), known, "k")
    assert [r.date_id for r in hits.collect()] == [20240102]
    facts = etl.loaded_facts(target, hits.withColumnRenamed("k", "message_key"))
    assert [r.text for r in facts.select("text").collect()] == ["t1 3"]
    scans = [p for p in facts.inputFiles() if "fact_sentiment" in p]
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert scans and "20240102" in plan.split("PartitionFilters: [")[1].split("]")[0]
    none = etl.loaded_facts(target, hits.where("k = 'x'").withColumnRenamed("k", "message_key"))
    assert none.count() == 0 and "fact_sentiment" not in none._jdf.queryExecution().optimizedPlan().toString()


def test_filters_miss_no_key_and_answer_few_others(spark):
    facts = spark.range(40_000).select(
        F.md5(F.col("id").cast("string")).alias("fact_id"), (F.pmod("id", F.lit(7)) * F.col("id") % 3).alias("date_id")
    )
    held = keyfilter.filters(facts)
    found = keyfilter.answering(held, facts, "fact_id")
    assert facts.join(found, ["fact_id", "date_id"], "left_anti").isEmpty()
    others = spark.range(40_000).select(F.md5(F.concat(F.lit("x"), "id")).alias("fact_id"))
    assert keyfilter.answering(held, others, "fact_id").count() < 40
    assert held.groupBy("date_id", "level", "word").count().where("count > 1").isEmpty()


@pytest.mark.parametrize("step", ["add_dimension", "add_facts", "publish"])
def test_readers_see_the_old_or_the_new_never_neither(spark, places, monkeypatch, step):
    """A load is killed at each of its steps. It changes days (a message moves) and adds some."""
    log, target = places
    load(spark, log, target)
    before, seen = facts_of(target), Star.of(target)
    write_batch(spark, log, 3, [("t0 1", "other", "2024-01-20 00:00:00"), ("new", "third", "2024-01-01 00:00:00")])

    def killed(*_args, **_options):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        if step == "publish":
            patched.setattr(Change, "publish", killed)
        else:
            patched.setattr(etl, step, killed)
        with pytest.raises(KeyboardInterrupt):
            load(spark, log, target)
    assert facts_of(target) == before
    assert {r.source_name for r in target.sources.collect()} == {"s"}
    load(spark, log, target)
    after = facts_of(target)
    assert ("t0 1", "other", "2024-01-20 00:00:00") in after and ("new", "third", "2024-01-01 00:00:00") in after
    assert len(after) == len(before) + 1
    assert seen.facts.count() == len(before)
    target.vacuum(keep=1)
    assert facts_of(target) == after
    loads = {name for name in storage.names(spark, target.path("fact_sentiment")) if name.startswith("load=")}
    assert len(loads) == 2


def test_of_two_loads_at_once_one_fails(spark, places):
    log, target = places
    target.create()
    slow, fast = Change(target), Change(target)
    fast.publish([("loads", 0)])
    with pytest.raises(RuntimeError, match="meanwhile"):
        slow.publish([("loads", 0)])
    assert target.version().batches == {("loads", 0): fast.load}


def test_crowded_days_and_dimensions_are_written_anew(spark, places, monkeypatch):
    monkeypatch.setattr(versions, "MOST_FOLDERS", 2)
    _, target = places
    log = storage.fresh_dir(spark, "test-log")
    want = []
    for number in range(5):
        text = f"same day {number}"
        write_batch(spark, log, number, [(text, f"s{number}", "2024-01-01 00:00:00")])
        want.append((text, f"s{number}", "2024-01-01 00:00:00"))
        load(spark, log, target)
        assert facts_of(target) == want
        for table in ("fact_sentiment", "dim_source"):
            assert len(target.version().folders[table]) <= 2


def test_batches_out_of_order_equal_one_load(spark, places):
    """A stream's old batch is loaded after a newer run's: its messages do not win over later ones."""
    log, target = places
    load(spark, log, target)
    write_batch(spark, log, 0, [("t0 1", "newest", "2024-01-05 00:00:00"), ("b", "b", "2024-01-05")], run="s000002-x")
    load(spark, log, target)
    write_batch(spark, log, 4, [("t0 1", "older", "2024-01-06"), ("b", "c", "2024-01-07"), ("d", "d", "2024-01-08")], run="s000001-y")
    load(spark, log, target)
    whole = Warehouse(spark, storage.fresh_dir(spark, "test-star"))
    load(spark, log, whole)
    assert facts_of(target) == facts_of(whole)
    assert ("t0 1", "newest", "2024-01-05 00:00:00") in facts_of(target)


def test_half_written_batches_wait(spark, places):
    log, target = places
    storage.delete(spark, f"{log}/run=loads/batch_id=2/_SUCCESS")
    load(spark, log, target)
    assert {b for _, b in target.version().batches} == {0, 1} and target.facts.count() == 10


def test_maintained_hours_equal_recomputation(spark, places):
    """Three loads: one adds, one moves messages to other days and sources, one changes nothing."""
    log, target = places
    waves = [[], [("t0 1", "other", "2024-01-03 07:30:00"), ("bitcoin now", "s", "2024-01-01 00:59:59")], []]
    for number, wave in enumerate(waves, 3):
        if wave:
            write_batch(spark, log, number, wave)
        load(spark, log, target)
        plain, rolled = Star.of(target), Star.rolled_up(target)
        asked = [(EVERYTHING, "Hour")]
        if number == 5:
            asked += [
                (EVERYTHING, "Minute"), (Criteria(sources=("s",)), "Day"), (Criteria(sentiments=("neutral",)), "Week"),
                (Criteria(topics=("Crypto",)), "Hour"), (Criteria(keyword="t0"), "Hour"),
                (Criteria(days=(date(2024, 1, 1), date(2024, 1, 2))), "Hour"),
            ]
        for criteria, grain in asked:
            one, other = (summary.summarise_by_time(star, grain, criteria) for star in (plain, rolled))
            assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
        for report in (summary.summarise, summary.calendar_rollup):
            assert sorted(map(str, report(plain).collect())) == sorted(map(str, report(rolled).collect()))
    read = summary.summarise_by_time(rolled, "Day").inputFiles()
    assert any("fact_hours" in f for f in read) and not any("fact_sentiment" in f for f in read)
    assert recent.limited(rolled, 3).hours is None


def test_a_day_gets_one_file_of_filters_and_one_of_hours_however_many_tasks_make_them(spark, places):
    log, target = places
    write_batch(spark, log, 0, [(f"text {n}", f"s{n % 9}", f"2024-01-0{1 + n % 3} 0{n % 7}:00:00") for n in range(400)])
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    held = spark.conf.get(merging)
    spark.conf.set(merging, "false")
    try:
        load(spark, log, target)
    finally:
        spark.conf.set(merging, held)
    for table in versions.BESIDE_FACTS:
        for run, day in target.version().folders[versions.FACTS]:
            inside = storage.names(spark, f"{target.path(table)}/load={run}/date_id={day}")
            assert len([name for name in inside if name.endswith(".parquet")]) == 1


def test_messages_are_written_with_the_codec_for_texts(spark, places):
    log, target = places
    load(spark, log, target)
    place = storage.fresh_dir(spark, "catalogue")
    tables = catalogue.Catalogue(spark, "textpulse_codec", place).create()
    tables.insert(catalogue.STAGING, spark.createDataFrame([("a", "a")], "id string, text string"))
    tables.refresh(target)
    run, day = target.version().folders[versions.FACTS][0]
    for folder in (f"{target.path(versions.FACTS)}/load={run}/date_id={day}", f"{place}/{versions.FACTS}/date_id={day}", f"{place}/raw_data"):
        written = [name for name in storage.names(spark, folder) if name.endswith(".parquet")]
        assert written and all(name.endswith(".zstd.parquet") for name in written)
    assert tables.table(versions.FACTS).count() == target.facts.count()
