"""Training and evaluation of the three-class sentiment model."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse import rules
from textpulse.functions import keys, text
from textpulse.operators import evaluation, linear
from textpulse.sinks.models import save_metrics, save_model
from textpulse.sources.files import training_rows


def usable(rows: DataFrame) -> DataFrame:
    """Rows with a text and a label that counts."""
    return rows.dropna(subset=["text", "sentiment"]).where(
        F.col("sentiment") != rules.IGNORED_LABEL
    )


def label_of(sentiment: Column | str) -> Column:
    sentiment = F.col(sentiment) if isinstance(sentiment, str) else sentiment
    first, second, _ = rules.LABELS
    return F.when(sentiment == first, 0.0).when(sentiment == second, 1.0).otherwise(2.0)


def term_text(raw: str) -> Column:
    """The cleaned text that terms are taken from. Never null: the tokenizer fails on nulls, also on rows that a filter
    would drop, because Spark may test a filter on the scores first."""
    return F.coalesce(text.clean_for_training(raw), F.lit(""))


def labelled(rows: DataFrame) -> DataFrame:
    return usable(rows).select(
        term_text("text").alias("clean_text"),
        label_of("sentiment").alias("label"),
        keys.digest("text").alias("split_key"),
    )


def split(rows: DataFrame, by: str = "hash") -> tuple[DataFrame, DataFrame]:
    """80/20. ``"hash"`` goes by the text: the same on any cluster and after a lost executor, and
    copies of one text stay on one side. ``"random"`` is Spark's seeded split, which depends on how
    the rows are laid out."""
    if by == "random":
        shares = [rules.TRAIN_SHARE, 1 - rules.TRAIN_SHARE]
        first, second = rows.randomSplit(shares, seed=rules.SPLIT_SEED)
        return first, second
    in_training = keys.slot("split_key", 100) < round(100 * rules.TRAIN_SHARE)
    return rows.where(in_training), rows.where(~in_training)


def term_stages() -> list:
    """Tokens, without stop words, as hashed term frequencies."""
    return [
        RegexTokenizer(inputCol="clean_text", outputCol="words", pattern="\\s+"),
        StopWordsRemover(inputCol="words", outputCol="filtered_words"),
        HashingTF(
            inputCol="filtered_words", outputCol="rawFeatures", numFeatures=rules.HASH_BUCKETS
        ),
    ]


def document_frequency(counted: DataFrame) -> DataFrame:
    """(bucket, doc_freq) from hashed term frequencies: rows with each term, summed on the executors into
    one vector of HASH_BUCKETS numbers, whatever the number of rows."""
    present = counted.agg(Summarizer.numNonZeros(F.col("rawFeatures")).alias("present"))
    exploded = present.select(F.posexplode(vector_to_array("present")).alias("bucket", "doc_freq"))
    return exploded.where("doc_freq > 0").select(*[F.col(c).cast("bigint").alias(c) for c in exploded.columns])


def weighting() -> IDF:
    return IDF(inputCol="rawFeatures", outputCol="features")


def classifier() -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features",
        labelCol="label",
        family="multinomial",
        maxIter=rules.MAX_ITERATIONS,
        regParam=rules.REGULARISATION,
        elasticNetParam=0.0,
    )


def balanced(rows: DataFrame) -> DataFrame:
    """Even partitions for the many passes to come, whatever files the rows came from (one CSV file
    is one task) and however often a text repeats."""
    return rows.hint("rebalance")


def fit(train: DataFrame) -> PipelineModel:
    """Texts are read and hashed once; both estimators work on the kept term vectors."""
    terms = PipelineModel(term_stages())
    counted = terms.transform(balanced(train.select("clean_text", "label")))
    kept = counted.select("rawFeatures", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weights = weighting().fit(kept)
        model = classifier().fit(weights.transform(kept).select("features", "label"))
    finally:
        kept.unpersist()
    return PipelineModel([*terms.stages, weights, model])


def certified(features: DataFrame, classifier_model: LogisticRegressionModel) -> DataFrame:
    """``linear.certificate`` of a fit over the rows (label, features) it was made from."""
    scored = classifier_model.transform(features).withColumn("shares", vector_to_array("probability"))
    return linear.certificate(scored, linear.feature_weights_of(features.sparkSession, classifier_model))


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    """The metrics document; all of it from one pass over the hold-out rows."""
    return evaluation.scores(evaluation.confusion(model.transform(test)))


def train(
    spark: SparkSession, dataset: str, model_path: str, metrics_path: str, split_by: str = "hash"
) -> PipelineModel:
    """File of labelled texts in, saved model and metrics document out."""
    training, test = split(labelled(training_rows(spark, dataset)), split_by)
    model = fit(training)
    save_model(model, model_path)
    save_metrics(evaluate(model, test), metrics_path)
    return model
