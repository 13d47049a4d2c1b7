"""Saved models and their metrics."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from textpulse import schemas, storage
from textpulse.operators import linear


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_weights(spark: SparkSession, path: str) -> DataFrame:
    """A saved linear classifier as the table it is."""
    return spark.read.schema(linear.SCHEMA).parquet(path)


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics document, or no row when training has not run."""
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schemas.METRICS)
    return spark.read.schema(schemas.METRICS).json(path)
