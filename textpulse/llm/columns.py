"""Keeps an operator's own column names apart from those a table brings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def guarded(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table with every column but the ``used`` ones renamed, and a function that gives the names back."""
    hidden = {c: c if c in used else f"_column{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(h) for c, h in hidden.items()])
    return renamed, lambda rows: rows.select(*[F.col(h).alias(c) for c, h in hidden.items()])
