"""Session defaults. Any session works; these are the ones the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


# Shuffle partitions before AQE merges them: with 128 MB each, a shuffle of 500 GB.
INITIAL_PARTITIONS = 4_000


def build_session(app: str = "textpulse", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew handling, and as many shuffle partitions as AQE may need.

    AQE starts from INITIAL_PARTITIONS and merges small partitions up to the advisory size, so one setting
    serves both small and very large inputs. A caller's own ``spark.sql.shuffle.partitions`` is kept instead.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    if "spark.sql.shuffle.partitions" not in conf:
        settings.setdefault("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(INITIAL_PARTITIONS))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are parsed, truncated and keyed in UTC whatever the caller's session says. The setting stays:
    plans run after the functions that made them have returned."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
