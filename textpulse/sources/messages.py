"""The message topic: batch or stream, Kafka or files of JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse.functions import payload
from textpulse.functions.keys import message_key


# Bounds of one micro-batch; options of the same names override them.
OFFSETS_PER_BATCH = 50_000_000
FILES_PER_BATCH = 10_000


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """(value, arrival, part, position) from a Kafka topic: the broker's record time in µs, partition and offset.

    Connection secrets belong in the Spark configuration or in ``options``, not in code.
    """
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("maxOffsetsPerTrigger", OFFSETS_PER_BATCH)
        .options(**options)
        .load()
    )
    return records.select(
        F.col("value").cast("string").alias("value"),
        F.unix_micros("timestamp").alias("arrival"),
        F.col("partition").cast("string").alias("part"),
        F.col("offset").alias("position"),
    )


def file_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(value, arrival, part, position) from a folder that JSON-line files land in: the file's modification
    time in µs, its path and where the task's part of it starts. The sink numbers the lines of a part."""
    lines = spark.readStream.option("maxFilesPerTrigger", FILES_PER_BATCH).options(**options).text(path)
    return lines.select(
        "value",
        F.unix_micros("_metadata.file_modification_time").alias("arrival"),
        F.col("_metadata.file_path").alias("part"),
        F.col("_metadata.file_block_start").alias("position"),
    )


def decode(records: DataFrame) -> DataFrame:
    """Adds the message's columns, its id (the text) and the hash of the id."""
    return (
        records.select("*", payload.decode("value"))
        .withColumn("id", F.col("text"))
        .withColumn("message_key", message_key("text"))
    )
