"""Query registration: a key, its Spark function and, where SQL can say it, its check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DoubleType, FloatType, IntegerType, ShortType, TimestampType

from textpulse.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str | Callable[[], str]] = {}
DIGITS = 6


def portable(df: DataFrame) -> DataFrame:
    """Column types both engines share: bigint, double to six digits, timestamp without zone, and
    days as text."""

    def cast(name: str, kind) -> F.Column:
        column = F.col(f"`{name}`")
        if isinstance(kind, (ByteType, ShortType, IntegerType)):
            return column.cast("bigint").alias(name)
        if isinstance(kind, (FloatType, DoubleType)):
            return F.round(column.cast("double"), DIGITS).alias(name)
        if isinstance(kind, TimestampType):
            return column.cast("timestamp_ntz").alias(name)
        if isinstance(kind, DateType):
            return column.cast("string").alias(name)
        return column

    return df.select(*[cast(f.name, f.dataType) for f in df.schema.fields])


def oracles() -> dict[str, str]:
    """The check queries; those given as functions are made here, never while importing."""
    return {key: sql if isinstance(sql, str) else sql() for key, sql in ORACLES.items()}


def register(key: str, oracle: str | Callable[[], str] | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(query(use_utc(spark), sf_dir.rstrip("/")))

        QUERIES[key] = run
        if oracle:
            ORACLES[key] = oracle
        return query

    return add
