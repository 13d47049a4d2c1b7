"""Saved models and metrics documents."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def save_metrics(metrics: DataFrame, path: str) -> None:
    """One row, one JSON document."""
    metrics.write.mode("overwrite").json(path)


def save_weights(weights: DataFrame, path: str) -> None:
    """A linear classifier's table, sorted by slot; a second save replaces the first."""
    weights.repartition(1).sortWithinPartitions("bucket", "class").write.mode("overwrite").parquet(path)
