"""Which stream a micro-batch belongs to. Batch numbers start at 0 again with every new checkpoint."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from textpulse import storage

_RUN = re.compile(r"run=s(\d+)-(.+)")


def query_id(batch: DataFrame) -> str:
    """The id kept in the stream's checkpoint: the same after a restart, another with a new checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def run_name(batch: DataFrame, log_path: str) -> str:
    """The stream's folder in a log: the one it has, or the next number. Names sort by first batch, and after
    the folder of batch loads."""
    wanted = query_id(batch)
    found = [_RUN.fullmatch(name) for name in storage.names(batch.sparkSession, log_path)]
    numbers = {match[2]: int(match[1]) for match in found if match}
    return f"s{numbers.get(wanted, max(numbers.values(), default=0) + 1):06d}-{wanted}"
