"""Classifier evaluation from one pass over the predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse import rules

CLASS_IDS = range(len(rules.CLASSES))


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row with the matrix (row = true class, column = predicted). A class that does not occur
    still has its row of zeros. All cells are one aggregate: nothing is grouped or shuffled."""

    def cell(i: int, j: int) -> Column:
        return F.count_if((F.col(label) == float(i)) & (F.col(prediction) == float(j)))

    matrix = F.array(*[F.array(*[cell(i, j) for j in CLASS_IDS]) for i in CLASS_IDS])
    return predictions.agg(matrix.alias("confusion_matrix"))


def matrix_rows(matrix: DataFrame) -> DataFrame:
    """The matrix as a table ordered by label."""
    rows = matrix.select(F.posexplode("confusion_matrix").alias("label", "cells"))
    predicted = [F.col("cells")[j].alias(f"predicted_{j}") for j in CLASS_IDS]
    return rows.select(F.col("label").cast("double").alias("label"), *predicted).orderBy("label")


def scores(matrix: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1; 0 where a ratio has no base."""

    def cell(i: int, j: int) -> Column:
        return F.col("confusion_matrix")[i][j]

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    support = [sum((cell(i, j) for j in CLASS_IDS), F.lit(0)) for i in CLASS_IDS]
    guessed = [sum((cell(i, j) for i in CLASS_IDS), F.lit(0)) for j in CLASS_IDS]
    total = sum(support, F.lit(0))
    right = sum((cell(i, i) for i in CLASS_IDS), F.lit(0))

    def weighted(per_class: list[Column]) -> Column:
        parts = (ratio(support[i], total) * per_class[i] for i in CLASS_IDS)
        return sum(parts, F.lit(0.0))

    precision = [ratio(cell(i, i), guessed[i]) for i in CLASS_IDS]
    recall = [ratio(cell(i, i), support[i]) for i in CLASS_IDS]
    f1 = [ratio(2 * cell(i, i), support[i] + guessed[i]) for i in CLASS_IDS]
    return matrix.select(
        ratio(right, total).alias("accuracy"),
        weighted(precision).alias("precision"),
        weighted(recall).alias("recall"),
        weighted(f1).alias("f1"),
        "confusion_matrix",
    )
