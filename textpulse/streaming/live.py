"""Live roll-up: class counts per time bucket with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textpulse import schemas, storage
from textpulse.streaming.runs import query_id

# Width and offset of each grain; weeks start on Monday (the epoch was a Thursday).
WINDOWS = {
    "Minute": ("1 minute", "0 seconds"),
    "Hour": ("1 hour", "0 seconds"),
    "Day": ("1 day", "0 seconds"),
    "Week": ("7 days", "4 days"),
}


def live_counts(
    rows: DataFrame, ts: str, category: str, grain: str = "Hour", lateness: str | None = "10 minutes"
) -> DataFrame:
    """State holds one count per open bucket and class; the watermark closes buckets.
    Counting combines before the shuffle, so one busy class is no hot spot.

    Rows later than ``lateness`` behind the newest are not counted; ``write_additions`` counts them. A finite drain,
    whose files may come in any order, takes None: no bucket closes and every row counts.
    """
    width, offset = WINDOWS[grain]
    timed = rows if lateness is None else rows.withWatermark(ts, lateness)
    windowed = timed.groupBy(
        F.window(ts, width, width, offset).alias("window"), F.col(category).alias("category")
    )
    start = F.col("window.start")
    bucket = start + F.expr("INTERVAL 6 DAYS") if grain == "Week" else start
    return windowed.agg(F.count(F.lit(1)).alias("messages")).select(
        bucket.alias("bucket"), "category", "messages"
    )


def write_live(counts: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Update mode: a batch writes only the buckets it changed, in a folder of its own and its stream's."""
    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(
            lambda batch, batch_id: batch.write.mode("overwrite").parquet(
                f"{path}/run={query_id(batch)}/batch_id={batch_id}"
            )
        )
        .trigger(**trigger)
        .start()
    )


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """Every bucket's last count in each stream, summed: a stream with a new checkpoint counts from zero."""
    last = (
        spark.read.schema(schemas.LIVE_COUNTS)
        .parquet(path)
        .groupBy("run", "bucket", "category")
        .agg(F.max_by("messages", "batch_id").alias("messages"))
    )
    return last.groupBy("bucket", "category").agg(F.sum("messages").alias("messages"))


def add_batch(
    batch: DataFrame, batch_id: int, path: str, run: str, ts: str, category: str, grain: str, lateness: str
) -> None:
    """Writes a micro-batch's own counts in a folder of its own; a replayed batch replaces it. ``late`` are the rows more
    than ``lateness`` behind the newest row of the batches before: a watermark would have lost them."""
    spark = batch.sparkSession
    width, offset = WINDOWS[grain]
    start = F.col("window.start")
    before = _additions(spark, path).where((F.col("run") == run) & (F.col("batch_id") < batch_id))
    newest = before.agg(F.unix_micros(F.max("newest")).alias("t")).first()["t"]
    behind = F.lit(False)
    if newest is not None:
        behind = F.col("ts") < F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {lateness}")
    timed = batch.select(F.col(ts).alias("ts"), F.col(category).alias("category"))
    (
        timed.groupBy(F.window("ts", width, width, offset).alias("window"), "category")
        .agg(F.count(F.lit(1)).alias("messages"), F.count_if(behind).alias("late"), F.max("ts").alias("newest"))
        .select(
            (start + F.expr("INTERVAL 6 DAYS") if grain == "Week" else start).alias("bucket"),
            "category", "messages", "late", "newest",
        )
        .coalesce(1)
        .write.mode("overwrite")
        .parquet(f"{path}/run={run}/batch_id={batch_id}")
    )


def write_additions(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict, ts: str, category: str,
    grain: str = "Hour", lateness: str = "10 minutes",
) -> StreamingQuery:
    """Live counts that lose no row however late it comes, without any state on the executors: a batch writes what it
    adds to each bucket, closed ones too, and readers sum. ``compact_additions`` keeps what they read small."""
    return (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(
            lambda batch, batch_id: add_batch(batch, batch_id, path, query_id(batch), ts, category, grain, lateness)
        )
        .trigger(**trigger)
        .start()
    )


def _folders(spark: SparkSession, run_path: str, prefix: str) -> list[int]:
    """Numbers of the complete folders of one kind, in order."""
    found = [int(name[len(prefix):]) for name in storage.names(spark, run_path) if name.startswith(prefix)]
    return sorted(n for n in found if storage.exists(spark, f"{run_path}/{prefix}{n}/_SUCCESS"))


def _current(spark: SparkSession, run_path: str) -> tuple[list[str], int, int]:
    """The folders that together hold every row of a stream once: the newest sum and the batches after it; then that
    sum's last batch (-1 without one), and the last batch of all."""
    sums = _folders(spark, run_path, "upto=")
    covered = sums[-1] if sums else -1
    after = [n for n in _folders(spark, run_path, "batch_id=") if n > covered]
    folders = ([f"{run_path}/upto={covered}"] if sums else []) + [f"{run_path}/batch_id={n}" for n in after]
    return folders, covered, after[-1] if after else covered


def _additions(spark: SparkSession, path: str) -> DataFrame:
    """Rows (bucket, category, messages, late, newest, run, batch_id); a sum goes by the last batch in it."""
    rows = spark.createDataFrame([], schemas.LIVE_ADDITIONS)
    folders = [
        folder
        for run in storage.names(spark, path) if run.startswith("run=")
        for folder in _current(spark, f"{path}/{run}")[0]
    ]
    if not folders:
        return rows
    stored = [f for f in schemas.LIVE_ADDITIONS.fields if f.name not in ("run", "batch_id")]
    place = F.col("_metadata.file_path")
    return spark.read.schema(type(schemas.LIVE_ADDITIONS)(stored)).parquet(*folders).select(
        *[f.name for f in stored],
        F.regexp_extract(place, "/run=([^/]+)/", 1).alias("run"),
        F.regexp_extract(place, "/(?:upto|batch_id)=([0-9]+)/", 1).cast("bigint").alias("batch_id"),
    )


def compact_additions(spark: SparkSession, path: str, least: int = 32) -> int:
    """Sums each stream's batches, once there are ``least`` since its last sum, into one folder; returns how many streams.

    The newest batch stays apart, since a restart may write it again. Readers take a sum from the moment its folder is
    complete, and the batches behind it no more: none counts twice and none is missed. Older folders stay for readers
    that have begun.
    """
    done = 0
    for run in storage.names(spark, path):
        if not run.startswith("run="):
            continue
        _, covered, last = _current(spark, f"{path}/{run}")
        if last - 1 - covered < least:
            continue
        held = _additions(spark, path).where((F.col("run") == run[4:]) & (F.col("batch_id") < last))
        (
            held.groupBy("bucket", "category")
            .agg(F.sum("messages").alias("messages"), F.sum("late").alias("late"), F.max("newest").alias("newest"))
            .write.mode("overwrite")
            .parquet(f"{path}/{run}/upto={last - 1}")
        )
        done += 1
    return done


def read_additions(spark: SparkSession, path: str) -> DataFrame:
    """(bucket, category, messages, late) over all streams: every row counted, and how many of them came late."""
    return _additions(spark, path).groupBy("bucket", "category").agg(
        F.sum("messages").alias("messages"), F.sum("late").alias("late")
    )
