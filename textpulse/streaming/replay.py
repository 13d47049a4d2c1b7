"""Stored rows re-emitted as a message stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from textpulse import storage
from textpulse.functions import payload


def table_stream(
    spark: SparkSession, folder: str, name: str, schema: StructType | str, files_per_batch: int = 1_000
) -> DataFrame:
    """Stream over a stored table: a folder of files, or a single file among others."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if storage.is_directory(spark, f"{folder}/{name}"):
        return reader.parquet(f"{folder}/{name}")
    return reader.option("pathGlobFilter", name).parquet(folder)


def replay(
    rows: DataFrame,
    source: Column,
    text: Column,
    created_at: Column,
    path: str,
    checkpoint: str,
    trigger: dict,
) -> StreamingQuery:
    """Rows as JSON lines for the file-based topic."""
    messages = rows.select(
        source.alias("source"), text.alias("text"), created_at.alias("created_at")
    ).select(payload.encode_message().alias("value"))
    return (
        messages.writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
