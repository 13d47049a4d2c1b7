"""Model settings, training jobs and agreement with MLlib's own evaluator and estimators."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from textpulse.operators import evaluation, linear, staging
from textpulse.plans import etl, training
from textpulse.sources.models import load_metrics, load_model
from workload import inputs, ml_queries, sql
from workload.registry import QUERIES


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    return inputs.trained(spark, sf_dir)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return training.labelled(inputs.training_set(spark, sf_dir))


def test_stage_settings(trained):
    tokenizer, remover, tf, idf, model = load_model(f"{trained}/model").stages
    assert (tokenizer.getPattern(), tokenizer.getGaps(), tokenizer.getMinTokenLength()) == ("\\s+", True, 1)
    assert tokenizer.getToLowercase() and tokenizer.getInputCol() == "clean_text"
    assert len(remover.getStopWords()) == 181 and not remover.getCaseSensitive()
    assert tf.getNumFeatures() == 20_000 and not tf.getBinary() and idf.getMinDocFreq() == 0
    assert (model.getMaxIter(), model.getRegParam(), model.getElasticNetParam()) == (20, 0.01, 0.0)
    assert model.getFamily() == "multinomial" and model.getTol() == 1e-6
    assert model.getStandardization() and model.getFitIntercept() and model.numClasses == 3


def test_saved_metrics_equal_mllib_evaluator(spark, trained, rows):
    _, test = training.split(rows)
    scored = load_model(f"{trained}/model").transform(test)
    saved = load_metrics(spark, f"{trained}/metrics").first()
    evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for name, metric in (
        ("accuracy", "accuracy"), ("precision", "weightedPrecision"),
        ("recall", "weightedRecall"), ("f1", "f1"),
    ):
        want = evaluator.evaluate(scored, {evaluator.metricName: metric})
        assert saved[name] == pytest.approx(want, abs=1e-9)
    assert sum(map(sum, saved.confusion_matrix)) == test.count()


def test_document_frequency_by_brute_force(rows):
    from pyspark.ml import PipelineModel

    counted = PipelineModel(training.term_stages()).transform(rows).select("rawFeatures", "label")
    model = training.weighting().fit(counted)
    want = [0] * 20_000
    for row in counted.collect():
        for bucket in row.rawFeatures.indices:
            want[bucket] += 1
    assert list(model.docFreq) == want


def test_split_is_repeatable_and_keeps_copies_together(rows):
    first, second = training.split(rows)
    again, _ = training.split(rows.repartition(3))
    assert sorted(first.collect()) == sorted(again.collect())
    assert first.count() + second.count() == rows.count()
    assert first.join(second, "split_key").isEmpty()
    share = first.count() / rows.count()
    assert 0.6 < share < 0.95


def test_random_split(rows):
    first, second = training.split(rows, by="random")
    assert first.count() + second.count() == rows.count()


def test_scoring_cleaners(spark, sf_dir, trained):
    model = load_model(f"{trained}/model")
    current = staging.current_messages(inputs.staged(spark, sf_dir)).withColumn("raw_text", F.col("text"))
    serving = current.withColumn("clean_text", training.text.clean_for_scoring("raw_text"))
    for clean in ("train", "serve"):
        scored = etl.model_scorer(model, clean)(serving)
        assert scored.where("prediction IN (0, 1, 2)").count() == current.count()


def test_evaluation_is_one_aggregate(rows):
    plan = evaluation.confusion(rows.withColumn("prediction", F.col("label")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange SinglePartition") == 1 and "hashpartitioning" not in text


def test_stop_words_of_the_check_are_sparks(spark):
    assert sql.stop_words() == StopWordsRemover.loadDefaultStopWords("english")


def test_document_frequency_is_that_of_the_fitted_stage(spark, sf_dir):
    model, _ = ml_queries._fitted_idf(spark, sf_dir)
    counted = {row.bucket: row.doc_freq for row in QUERIES["idf_docfreq"](spark, sf_dir).collect()}
    assert counted and counted == {bucket: int(n) for bucket, n in enumerate(model.docFreq) if n}


def _features(rows, model):
    from pyspark.ml import PipelineModel

    return PipelineModel(model.stages[:-2]).transform(rows).drop("words", "filtered_words")


def test_table_scores_every_row_like_the_fitted_pipeline(spark, trained, rows):
    model = load_model(f"{trained}/model")
    odd = spark.createDataFrame([("", 0.0, "a"), ("   ", 1.0, "b"), ("neverseenword", 2.0, "c")], rows.schema)
    every = rows.unionByName(odd)
    want = model.transform(every).select("split_key", "clean_text", "prediction", training.vector_to_array("probability").alias("p"))
    got = linear.scored(_features(every, model), linear.weights_of(spark, model))
    got = got.select("split_key", "clean_text", F.col("prediction").alias("own"), "shares")
    both = want.distinct().join(got.distinct(), ["split_key", "clean_text"])
    assert both.count() == every.select("split_key", "clean_text").distinct().count()
    assert both.where("prediction <> own").isEmpty()
    far = F.exists(F.zip_with("p", "shares", lambda a, b: F.abs(a - b)), lambda d: d > 1e-9)
    assert both.where(far).isEmpty()


def test_scoring_by_table_shuffles_no_rows(spark, trained, rows):
    model = load_model(f"{trained}/model")
    scored = linear.scored(_features(rows, model), linear.weights_of(spark, model)).select("prediction")
    plan = scored._jdf.queryExecution().optimizedPlan().toString().split("\n")
    outer = [line for line in plan if not line.lstrip(" :+-").startswith(("Aggregate", "Join", "Range"))]
    assert plan[0].startswith("Project") and len(outer) < len(plan)
    assert "BatchEvalPython" not in "".join(plan) and "Nested" not in "".join(plan)


def test_tables_without_constants_and_ties(spark, rows, trained):
    some = _features(rows, load_model(f"{trained}/model")).limit(5)
    empty = spark.createDataFrame([], linear.SCHEMA)
    assert {r.prediction for r in linear.scored(some, empty).collect()} == {None}
    tied = spark.createDataFrame([(linear.CONSTANT, 1, 0.5), (linear.CONSTANT, 2, 0.5)], linear.SCHEMA)
    for row in linear.scored(some, tied).collect():
        assert row.prediction == 1.0 and list(row.shares) == [0.0, 0.5, 0.5]
    assert linear.count_weights(some.limit(0)).isEmpty()


def test_certificate_by_numpy_and_by_the_fit_itself(spark, sf_dir):
    import numpy as np

    weights, counted = ml_queries._fitted_idf(spark, sf_dir)
    ready = weights.transform(counted).select("features", "label")
    model = training.classifier().fit(ready)
    got = training.certified(ready, model).first()
    assert got.loss == pytest.approx(model.summary.objectiveHistory[-1], rel=1e-9)
    held = ready.collect()
    x = np.stack([r.features.toArray() for r in held])
    hit = np.eye(3)[[int(r.label) for r in held]]
    sd = x.std(axis=0, ddof=1)
    margins = x @ model.coefficientMatrix.toArray().T + model.interceptVector.toArray()
    shares = np.exp(margins - margins.max(axis=1, keepdims=True))
    shares /= shares.sum(axis=1, keepdims=True)
    used = sd > 0
    scaled = (x - x.mean(axis=0))[:, used] / sd[used]

    def slope(shares, w):
        return np.linalg.norm((shares - hit).T @ scaled / len(x) + 0.01 * w[:, used] * sd[used])

    assert got.row_count == len(x)
    assert got.gradient == pytest.approx(slope(shares, model.coefficientMatrix.toArray()), rel=1e-6)
    start = np.tile(hit.mean(axis=0), (len(x), 1))
    assert got.start_gradient == pytest.approx(slope(start, np.zeros((3, x.shape[1]))), rel=1e-6)
    assert got.constant_gradient == pytest.approx(np.abs((shares - hit).mean(axis=0)).max(), abs=1e-9)
    # A fit run to its end is better by no more than the gap that was promised.
    best = training.classifier().setMaxIter(500).fit(ready).summary.objectiveHistory[-1]
    assert 0 <= got.loss - best <= got.gap * 1.05


def test_hash_of_the_check_for_every_length(spark):
    import duckdb

    terms = ["abcdefghijklmnopqrstuvwxyz"[:n] * m for n in range(1, 10) for m in (1, 3)]
    tf = training.term_stages()[2]
    frame = spark.createDataFrame([(t, [t]) for t in terms], "t string, filtered_words array<string>")
    want = {r.t: int(r.rawFeatures.indices[0]) for r in tf.transform(frame).collect()}
    listed = ", ".join(f"('{t}')" for t in terms)
    got = duckdb.execute(f"SELECT t, {sql.term_bucket('t')} FROM (VALUES {listed}) v(t)").fetchall()
    assert dict(got) == want
