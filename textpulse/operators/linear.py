"""Linear text classifiers as tables: weights per hashed term and class, scores as column expressions.

A classifier is (bucket, class, weight); the class's constant stands at bucket -1. Scoring holds the weights as one
array per class, at most HASH_BUCKETS numbers each whatever the data, so rows are scored where they are, unshuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse import rules

CONSTANT = -1
SCHEMA = "bucket int, class int, weight double"
CLASS_IDS = range(len(rules.CLASSES))


def _table(spark: SparkSession, weights: np.ndarray, constants: np.ndarray) -> DataFrame:
    classes, buckets = weights.nonzero()
    terms = pd.DataFrame({"bucket": buckets, "class": classes, "weight": weights[classes, buckets]})
    rest = pd.DataFrame({"bucket": CONSTANT, "class": list(CLASS_IDS), "weight": constants})
    return spark.createDataFrame(pd.concat([terms, rest]), SCHEMA)


def weights_of(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The table of a fitted pipeline whose last stages weigh terms and classify. A term's own weight is multiplied in,
    so the table applies to plain term counts. Zero weights are left out."""
    idf, classifier = model.stages[-2:]
    held = classifier.coefficientMatrix.toArray() * idf.idf.toArray()
    return _table(spark, held, classifier.interceptVector.toArray())


def feature_weights_of(spark: SparkSession, classifier: LogisticRegressionModel) -> DataFrame:
    """The table of a classifier alone; it applies to the features it was fitted on."""
    return _table(spark, classifier.coefficientMatrix.toArray(), classifier.interceptVector.toArray())


def count_weights(counted: DataFrame, buckets: int = rules.HASH_BUCKETS) -> DataFrame:
    """A classifier by counting alone (multinomial Bayes, one added to every count): the logarithm of a term's share
    in its class, and of the class's share of the rows. ``counted`` has label and rawFeatures. Classes without rows
    get no constant and are never predicted; no rows give an empty table."""
    rows = counted.select(F.col("label").cast("int").alias("class"), F.unwrap_udt("rawFeatures").alias("v"))
    found = rows.select("class", F.explode(F.arrays_zip("v.indices", "v.values")).alias("t"))
    sums = found.groupBy("class", F.col("t.indices").alias("bucket")).agg(F.sum("t.values").alias("tf"))
    totals = rows.groupBy("class").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.aggregate("v.values", F.lit(0.0), lambda acc, x: acc + x)).alias("terms"),
    )
    share = F.ln((F.coalesce("tf", F.lit(0.0)) + 1) / (F.col("terms") + buckets))
    slots = counted.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    # At most HASH_BUCKETS rows for each class: the classes are dealt to every slot by an array, not by a join.
    every = slots.select("bucket", F.explode(F.array(*[F.lit(c) for c in CLASS_IDS])).alias("class"))
    terms = every.join(totals, "class").join(sums, ["class", "bucket"], "left")
    whole = totals.agg(F.sum("row_count").alias("all_rows"), F.collect_list(F.struct("class", "row_count")).alias("c"))
    constants = whole.select("all_rows", F.explode("c").alias("c")).select(
        F.lit(CONSTANT).alias("bucket"), F.col("c.class").alias("class"),
        F.ln(F.col("c.row_count") / F.col("all_rows")).alias("weight"),
    )
    return terms.select("bucket", "class", share.alias("weight")).unionByName(constants)


def _lists(weights: DataFrame, buckets: int) -> DataFrame:
    """One row: per class its constant (null without one) and the weights of all slots in order."""
    placed = weights.groupBy("bucket").pivot("class", list(CLASS_IDS)).agg(F.first("weight"))
    slots = weights.sparkSession.range(CONSTANT, buckets).select(F.col("id").cast("int").alias("bucket"))
    known = [F.col(str(c)) for c in CLASS_IDS]
    filled = slots.join(placed, "bucket", "left").select(
        "bucket", *[F.when(F.col("bucket") >= 0, F.coalesce(k, F.lit(0.0))).otherwise(k).alias(str(c))
                    for c, k in zip(CLASS_IDS, known)])
    ordered = filled.agg(F.array_sort(F.collect_list(F.struct("bucket", *map(str, CLASS_IDS)))).alias("s"))
    return ordered.select(F.struct(*[F.col(f"s.{c}").alias(f"w{c}") for c in CLASS_IDS]).alias("lists"))


def scored(counted: DataFrame, weights: DataFrame, buckets: int = rules.HASH_BUCKETS) -> DataFrame:
    """Adds ``margins``, ``shares`` (softmax) and ``prediction`` to rows with rawFeatures. Equal margins go to the
    lower class; a class without a constant never wins. Rows without a vector, and all rows where no class has a
    constant, get nulls."""
    held = _lists(weights, buckets).scalar()
    vector = F.unwrap_udt("rawFeatures")

    def margin(c: int) -> Column:
        own = F.col("_lists")[f"w{c}"]
        parts = F.zip_with(F.col("_v.indices"), F.col("_v.values"), lambda i, x: F.get(own, i + 1) * x)
        return F.coalesce(F.aggregate(parts, F.get(own, F.lit(0)), lambda acc, x: acc + x), F.lit(float("-inf")))

    plain = counted.withColumns({"_v": vector, "_lists": held})
    summed = plain.withColumn(
        "margins", F.when(F.col("_v").isNotNull(), F.array(*map(margin, CLASS_IDS)))
    ).drop("_v", "_lists")
    best = F.array_max("margins")
    usable = summed.withColumn("margins", F.when(best > float("-inf"), F.col("margins")))
    raised = usable.withColumn("_raised", F.transform("margins", lambda m: F.exp(m - best)))
    whole = F.aggregate("_raised", F.lit(0.0), lambda acc, x: acc + x)
    return raised.withColumns({
        "shares": F.transform("_raised", lambda x: x / whole),
        "prediction": (F.array_position("margins", best) - 1).cast("double"),
    }).drop("_raised")


def certificate(featured: DataFrame, weights: DataFrame, penalty: float = rules.REGULARISATION) -> DataFrame:
    """How far a fit is from the best one, from one aggregate over the rows and independent of the code that fitted.

    ``featured`` has label, features and shares; ``weights`` are those of the features as fitted. One row: ``row_count``,
    ``loss`` (mean log loss plus the penalty on weights scaled by their feature's deviation), ``gradient`` (norm of its
    slope in the scaled weights), ``start_gradient`` (the same where all weights are zero and the constants say the class
    shares), ``constant_gradient`` (largest slope in a constant) and ``gap``: with constants at their best the loss lies
    at most this far above the least one (squared slope over twice the penalty, as the loss is strongly convex)."""
    rows = featured.select("shares", F.col("label").cast("int").alias("label"), F.unwrap_udt("features").alias("v"))
    classes = [F.struct(
        F.lit(c).alias("class"),
        (F.get("shares", F.lit(c)) - (F.col("label") == c).cast("double")).alias("off"),
        (F.col("label") == c).cast("double").alias("hit"),
    ) for c in CLASS_IDS]
    totals = rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg(-F.ln(F.get("shares", "label"))).alias("log_loss"),
        F.array(*[F.avg(s["off"]) for s in classes]).alias("slopes"),
        F.array(*[F.avg(s["hit"]) for s in classes]).alias("base"),
    )
    found = rows.select(
        F.array(*classes).alias("classes"), F.explode(F.arrays_zip("v.indices", "v.values")).alias("t")
    ).select("classes", F.col("t.indices").alias("bucket"), F.col("t.values").alias("x"))
    sums = found.groupBy("bucket").agg(
        F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("x")).alias("sxx"),
        *[F.sum(F.col("x") * F.col("classes")[c]["off"]).alias(f"off{c}") for c in CLASS_IDS],
        *[F.sum(F.col("x") * F.col("classes")[c]["hit"]).alias(f"hit{c}") for c in CLASS_IDS],
    )
    per_class = F.explode(F.array(*[
        F.struct(F.lit(c).alias("class"), F.col(f"off{c}").alias("off"), F.col(f"hit{c}").alias("hit"))
        for c in CLASS_IDS
    ])).alias("s")
    slopes = sums.select("bucket", "sx", "sxx", per_class).select("bucket", "sx", "sxx", "s.class", "s.off", "s.hit")
    terms = slopes.join(weights.where(F.col("bucket") >= 0), ["bucket", "class"], "left")
    n, base = F.col("row_count"), F.get("base", "class")
    mean = F.col("sx") / n
    deviation = F.sqrt(F.greatest((F.col("sxx") - n * mean * mean) / F.greatest(n - 1, F.lit(1)), F.lit(0.0)))
    held = F.coalesce("weight", F.lit(0.0))
    # Slopes are taken around the mean of a feature, where the constants do not mix in.
    centred = F.col("off") / n - mean * F.get("slopes", "class")
    at_start = base * mean - F.col("hit") / n
    one = totals.select(F.struct("*")).scalar()
    measured = terms.withColumn("_t", one).select("*", "_t.*").withColumn("sd", deviation).where("sd > 0").agg(
        F.sum(F.pow(centred / F.col("sd") + penalty * held * F.col("sd"), 2)).alias("squared"),
        F.sum(F.pow(at_start / F.col("sd"), 2)).alias("start_squared"),
        F.sum(F.pow(held * F.col("sd"), 2)).alias("size"),
    )
    return measured.withColumn("_t", one).select(
        F.col("_t.row_count").alias("row_count"),
        (F.col("_t.log_loss") + penalty / 2 * F.col("size")).alias("loss"),
        F.sqrt("squared").alias("gradient"),
        F.sqrt("start_squared").alias("start_gradient"),
        F.array_max(F.transform("_t.slopes", lambda s: F.abs(s))).alias("constant_gradient"),
        (F.col("squared") / (2 * penalty)).alias("gap"),
    )
