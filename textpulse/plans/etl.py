"""Staging to star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse import rules, storage
from textpulse.functions import dates, keys
from textpulse.operators import dimensions, enrich, keyfilter, linear, staging
from textpulse.plans import training
from textpulse.session import use_utc
from textpulse.sinks.tables import add_dimension, add_facts, append_dimension  # noqa: F401
from textpulse.sources.warehouse import Batch, Change, Warehouse

Scorer = Callable[[DataFrame], DataFrame]

LOADED = [
    "message_key", "source", "topic_name", "created_ts", "raw_text",
    "word_count", "hashtags_count", "prediction", "replaces",
]


def model_scorer(model: PipelineModel, clean: str = "train") -> Scorer:
    """Adds ``prediction``. ``clean="train"`` cleans texts as training did; ``"serve"`` feeds the
    scoring-cleaned text instead."""

    def score(prepared: DataFrame) -> DataFrame:
        if clean == "train":
            prepared = prepared.withColumn("clean_text", training.term_text("raw_text"))
        scored = model.transform(prepared)
        return scored.select(*prepared.columns, "prediction")

    return score


def table_scorer(weights: DataFrame) -> Scorer:
    """Adds ``prediction`` by a linear classifier kept as a table; texts are cleaned as for training."""
    terms = PipelineModel(training.term_stages())

    def score(prepared: DataFrame) -> DataFrame:
        cleaned = prepared.withColumn("clean_text", training.term_text("raw_text"))
        scored = linear.scored(terms.transform(cleaned), weights)
        return scored.select(*prepared.columns, "prediction")

    return score


def pending(
    spark: SparkSession,
    log_path: str,
    warehouse: Warehouse,
    since_batch: int | None = None,
    since_run: str = staging.LOADS,
) -> list[Batch]:
    """The log's batches that no load has taken in; or, given ``since_batch``, those of ``since_run`` after it and all
    of later runs, whatever the ledger says."""
    there = staging.batches(spark, log_path)
    if since_batch is not None:
        return [b for b in there if b > (since_run, since_batch)]
    taken = warehouse.version().batches
    return [b for b in there if b not in taken]


def messages_of(spark: SparkSession, log_path: str, warehouse: Warehouse, wanted: list[Batch]) -> DataFrame:
    """All the log knows about the messages of some batches. Where batches that sort after the first of these were
    taken in before, what those say of the same messages comes along: it may be newer."""
    log = staging.read_batches(spark, log_path, wanted)
    later = [b for b in warehouse.version().batches if b > min(wanted) and b not in set(wanted)]
    if not later:
        return log
    again = staging.read_batches(spark, log_path, later)
    return log.unionByName(again.join(log.select("message_key").distinct(), "message_key", "left_semi").select(*log.columns))


def loaded_facts(warehouse: Warehouse, hits: DataFrame) -> DataFrame:
    """Facts that ``hits`` (message_key, date_id) may mean. Only the days it names are opened."""
    days = sorted(row["date_id"] for row in hits.select("date_id").distinct().collect())
    facts = warehouse.facts.where(F.col("date_id").isin(days)) if days else warehouse.facts.where("false")
    asked = hits.select(F.col("message_key").alias("fact_id"), "date_id")
    return facts.join(asked, ["fact_id", "date_id"], "left_semi")


def new_or_changed(current: DataFrame, facts: DataFrame) -> DataFrame:
    """Messages the facts lack, or hold with another source or time; ``replaces`` is the day of the old
    fact. A time that cannot be read is no change: it would be the clock of each load anew."""
    loaded = facts.select(
        F.col("fact_id").alias("message_key"), F.col("source_id").alias("_source_id"),
        F.col("created_at").alias("_created_ts"), F.col("date_id").alias("replaces"),
    )
    met = current.join(loaded, "message_key", "left")
    source = keys.surrogate_key(F.coalesce("source", F.lit(rules.UNKNOWN_SOURCE)))
    time = dates.to_second(F.try_to_timestamp("created_at"))
    moved = (source != F.col("_source_id")) | F.coalesce(time != F.col("_created_ts"), F.lit(False))
    return met.where(F.col("replaces").isNull() | moved).drop("_source_id", "_created_ts")


def load(
    spark: SparkSession,
    log_path: str,
    warehouse: Warehouse,
    scorer: Scorer,
    run_ts: str,
    since_batch: int | None = None,
    since_run: str = staging.LOADS,
) -> None:
    """Loads the batches the warehouse has not taken in yet; a second run opens neither log nor facts.

    The fact ids' filters say in which days a message may have a fact; those days alone are looked into, and known
    messages leave before any cleaning or scoring. The prepared rows are written once to scratch: the dimensions then
    read a few narrow columns of it and the facts the rest. Everything goes to folders of this load, which its version
    makes visible in one step together with the batches it took in: a load that is cut short changes nothing.
    """
    use_utc(spark)
    warehouse.create()
    change = Change(warehouse)
    held = change.held
    wanted = pending(spark, log_path, held, since_batch, since_run)
    if not wanted:
        return
    log = messages_of(spark, log_path, held, wanted)
    scratch, asked = storage.fresh_dir(spark, "load"), storage.fresh_dir(spark, "asked")
    try:
        hits = storage.materialize(keyfilter.answering(held.key_filters(), log, "message_key"), asked)
        fresh = new_or_changed(staging.current_messages(log), loaded_facts(held, hits))
        prepared = storage.materialize(
            scorer(enrich.prepare(fresh, run_ts)).select(*LOADED), scratch, **storage.TEXT_CODEC
        )
        if not prepared.isEmpty():
            add_dimension(change, "dim_source", dimensions.source_rows(prepared, run_ts), "source_name")
            add_dimension(change, "dim_date", dimensions.date_rows(prepared, run_ts), "date_id")
            add_dimension(change, "dim_topic", dimensions.topic_rows(prepared, run_ts), "topic_name")
            gone = prepared.where("replaces IS NOT NULL").select(
                F.col("message_key").alias("fact_id"), F.col("replaces").alias("date_id")
            )
            add_facts(change, enrich.to_facts(prepared), gone)
        change.publish(wanted)
    finally:
        storage.delete(spark, scratch)
        storage.delete(spark, asked)


def write_log_batch(messages: DataFrame, log_path: str, batch_id: int) -> None:
    """One batch folder of the staging log, for batch loads. A retry replaces the same folder."""
    rows = messages.withColumn(
        "kind",
        F.when(F.col("text").isNull(), staging.REJECTED).otherwise(staging.MESSAGE),
    )
    rows.write.mode("overwrite").options(**storage.TEXT_CODEC).partitionBy("kind").parquet(
        f"{log_path}/run={staging.LOADS}/batch_id={batch_id}"
    )
