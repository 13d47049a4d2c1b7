"""JSON payloads of the message topic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textpulse import schemas


def encode_message(source: str = "source", text: str = "text", created_at: str = "created_at") -> Column:
    parts = [F.col(source).alias("source"), F.col(text).alias("text"), F.col(created_at).alias("created_at")]
    return F.to_json(F.struct(*parts))


def decode(value: Column | str, schema: StructType = schemas.MESSAGE) -> Column:
    """The fields of a JSON object as columns; bad JSON gives nulls.

    A generator, because filters on its columns stay above it. On a plain projection Spark pushes
    them down with a copy of the parsing for every field they test.
    """
    return F.inline(F.array(F.from_json(value, schema)))
