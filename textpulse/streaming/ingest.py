"""Message topic to staging log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textpulse.operators.staging import MESSAGE, REJECTED
from textpulse.sources.messages import decode
from textpulse.streaming.runs import run_name


def stage_batch(records: DataFrame, log_path: str, run: str, batch_id: int) -> None:
    """One micro-batch, one pass, one folder: accepted messages and, with their raw value, the
    unreadable ones. A replayed batch replaces its own folder, so nothing doubles; another stream has
    another ``run``, so nothing is lost.

    The lines of one part of a file are read by one task in order, so their running numbers say who came
    later, whichever task it is after a replay.
    """
    accepted = F.col("text").isNotNull()
    rows = decode(records).select(
        "message_key",
        "source",
        "text",
        "created_at",
        F.when(~accepted, F.col("value")).alias("value"),
        "arrival",
        "part",
        "position",
        F.monotonically_increasing_id().alias("line"),
        F.when(accepted, MESSAGE).otherwise(REJECTED).alias("kind"),
    )
    rows.write.mode("overwrite").partitionBy("kind").parquet(f"{log_path}/run={run}/batch_id={batch_id}")


def ingest(
    records: DataFrame, log_path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Starts the stream. ``trigger={"availableNow": True}`` drains what is there and stops."""
    writer = (
        records.writeStream.option("checkpointLocation", checkpoint)
        .outputMode("append")
        .foreachBatch(lambda batch, batch_id: stage_batch(batch, log_path, run_name(batch, log_path), batch_id))
    )
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
