"""Messages out to the topic."""

from __future__ import annotations

from pyspark.sql import DataFrame

from textpulse.functions import payload


def encode(messages: DataFrame) -> DataFrame:
    return messages.select(payload.encode_message().alias("value"))


def to_kafka(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    writer = encode(messages).write.format("kafka").options(**options)
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def to_files(messages: DataFrame, path: str) -> None:
    """JSON lines for the file-based topic."""
    encode(messages).write.mode("append").text(path)
