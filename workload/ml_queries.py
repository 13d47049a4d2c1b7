"""Model training, scoring and evaluation."""

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from textpulse import storage
from textpulse.operators import evaluation, linear, staging
from textpulse.plans import etl, training
from textpulse.sinks.models import save_metrics, save_model, save_weights
from textpulse.sources.models import load_metrics, load_model, load_weights
from textpulse.sources.warehouse import Warehouse
from workload import inputs, sql
from workload.registry import register

_MATRIX = f"""{sql.JUDGED},
cells AS (SELECT t.label, count(*) FILTER (j.prediction = 0) AS predicted_0,
  count(*) FILTER (j.prediction = 1) AS predicted_1, count(*) FILTER (j.prediction = 2) AS predicted_2
  FROM (VALUES (0.0::DOUBLE), (1.0), (2.0)) t(label) LEFT JOIN judged j ON j.label = t.label
  GROUP BY t.label)"""


def _labelled(spark, sf_dir):
    return training.labelled(inputs.training_set(spark, sf_dir))


# Evaluation

@register("confusion_matrix", f"WITH {_MATRIX} SELECT * FROM cells ORDER BY label")
def confusion_matrix(spark, sf_dir):
    return evaluation.matrix_rows(evaluation.confusion(inputs.judged(spark, sf_dir)))


@register("cm_to_array", f"""WITH {_MATRIX} SELECT to_json(list([predicted_0, predicted_1, predicted_2]
  ORDER BY label))::VARCHAR AS confusion_matrix FROM cells""")
def cm_to_array(spark, sf_dir):
    matrix = evaluation.confusion(inputs.judged(spark, sf_dir))
    return matrix.select(F.to_json("confusion_matrix").alias("confusion_matrix"))


@register("metrics_multiclass", f"""WITH {sql.JUDGED},
per_class AS (SELECT c,
  count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS guessed,
  count(*) FILTER (label = c AND prediction = c) AS hit, count(*) AS total
  FROM judged, (VALUES (0.0), (1.0), (2.0)) t(c) GROUP BY c)
SELECT round(sum(hit) / any_value(total), 6) AS accuracy,
  round(sum(support / total * CASE WHEN guessed = 0 THEN 0 ELSE hit / guessed END), 6) AS "precision",
  round(sum(support / total * CASE WHEN support = 0 THEN 0 ELSE hit / support END), 6) AS recall,
  round(sum(support / total * CASE WHEN support + guessed = 0 THEN 0
    ELSE 2 * hit / (support + guessed) END), 6) AS f1 FROM per_class""")
def metrics_multiclass(spark, sf_dir):
    matrix = evaluation.confusion(inputs.judged(spark, sf_dir))
    return evaluation.scores(matrix).drop("confusion_matrix")


# Features

@register("random_split", f"""WITH {sql.TRAINING}
SELECT id, CASE WHEN {sql.slot('sha256(text)', 100)} < 80 THEN 'train' ELSE 'test' END AS part FROM usable""")
def random_split(spark, sf_dir):
    rows = training.usable(inputs.training_set(spark, sf_dir)).select(
        "id", training.keys.digest("text").alias("split_key")
    )
    first, second = training.split(rows)
    return first.select("id", F.lit("train").alias("part")).unionByName(
        second.select("id", F.lit("test").alias("part"))
    )


@register("ml_hashing_tf", lambda: rf"""WITH {sql.TRAINING},
split AS (SELECT {sql.LABEL} AS label, list_filter(regexp_split_to_array({sql.clean_for_training('text')}, '\s+'),
  lambda t: length(t) >= 1 AND NOT list_contains([{sql.quoted(sql.stop_words())}], t)) AS tokens FROM usable)
SELECT label, count(*) AS row_count, sum(len(tokens))::DOUBLE AS total_terms FROM split GROUP BY label""")
def ml_hashing_tf(spark, sf_dir):
    """Term-frequency vectors, summed per label; SQL can check that no term got lost."""
    rows = _labelled(spark, sf_dir)
    counted = PipelineModel(training.term_stages()).transform(rows)
    return _vector_totals(counted, "rawFeatures", "total_terms")


def _vector_totals(rows, vector, name):
    """Sum of all weights per label. The vectors stay sparse; one sum vector per label comes out, whose entries are summed
    with what each addition rounds off carried along (Kahan): plain sums differ in the sixth decimal."""
    sums = rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("row_count"), Summarizer.sum(F.col(vector)).alias("sums")
    )
    total = F.aggregate(
        vector_to_array("sums"), F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("over")),
        lambda acc, x: F.struct(
            (acc["sum"] + (x - acc["over"])).alias("sum"),
            ((acc["sum"] + (x - acc["over"])) - acc["sum"] - (x - acc["over"])).alias("over"),
        ),
        lambda acc: acc["sum"],
    )
    return sums.select("label", "row_count", total.alias(name))


def _fitted_idf(spark, sf_dir):
    rows = training.balanced(_labelled(spark, sf_dir).select("clean_text", "label"))
    counted = PipelineModel(training.term_stages()).transform(rows).select("rawFeatures", "label")
    counted = storage.materialize(counted, storage.fresh_dir(spark, "terms"))
    return training.weighting().fit(counted), counted


@register("idf_docfreq", lambda: f"""WITH {sql.TRAINING}, {sql.term_counts()}
SELECT bucket, count(*) AS doc_freq FROM term_counts GROUP BY bucket""")
def idf_docfreq(spark, sf_dir):
    """Document frequency per hashed term, counted on the executors; a test compares it with the fitted stage."""
    return training.document_frequency(PipelineModel(training.term_stages()).transform(_labelled(spark, sf_dir)))


@register("ml_idf", lambda: f"""WITH {sql.TRAINING}, {sql.term_counts()},
totals AS (SELECT label, count(*) AS row_count FROM texts GROUP BY label),
frequency AS (SELECT bucket, ln(((SELECT sum(row_count) FROM totals) + 1) / (count(*) + 1)) AS weight
  FROM term_counts GROUP BY bucket)
SELECT label, any_value(row_count) AS row_count, round(coalesce(sum(tf * weight), 0), 6) AS total_weight
FROM totals LEFT JOIN term_counts USING (label) LEFT JOIN frequency USING (bucket) GROUP BY label""")
def ml_idf(spark, sf_dir):
    """TF-IDF vectors, summed per label."""
    model, counted = _fitted_idf(spark, sf_dir)
    return _vector_totals(model.transform(counted), "features", "total_weight")


# Model

# Slopes are held against the one at zero weights: a fit cut off after MAX_ITERATIONS rounds has lost four fifths of
# it, one that ran to its end nearly all.
CUT_OFF, AT_END, END_ITERATIONS = 0.2, 0.001, 500


def _certificate_rows(certificate, share):
    return certificate.select(
        "row_count",
        (F.col("gradient") <= share * F.col("start_gradient")).alias("slope_small"),
        (F.col("constant_gradient") <= share / 10).alias("constants_settled"),
    )


_ALL_CERTIFIED = """SELECT count(*) AS row_count, true AS slope_small, true AS constants_settled FROM"""


@register("ml_logreg", f"WITH {sql.TRAINING} {_ALL_CERTIFIED} usable")
def ml_logreg(spark, sf_dir):
    """The classifier alone on ready features, run to its end: its slope, worked out from the rows by the certificate,
    is all but gone, so these are the best weights."""
    weights, counted = _fitted_idf(spark, sf_dir)
    ready = weights.transform(counted).select("features", "label")
    fitted = training.classifier().setMaxIter(END_ITERATIONS).fit(ready)
    return _certificate_rows(training.certified(ready, fitted), AT_END)


@register("ml_logreg_predictions")
def ml_logreg_predictions(spark, sf_dir):
    """The classifier alone, stopped after MAX_ITERATIONS: rows per label and prediction."""
    weights, counted = _fitted_idf(spark, sf_dir)
    ready = weights.transform(counted).select("features", "label")
    scored = training.classifier().fit(ready).transform(ready)
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("row_count"))


@register("ml_train", lambda: f"""WITH {sql.TRAINING}
{_ALL_CERTIFIED} usable WHERE {sql.slot('sha256(text)', 100)} < 80""")
def ml_train(spark, sf_dir):
    """The whole pipeline fitted on the training part, and the certificate of that fit."""
    part, _ = training.split(_labelled(spark, sf_dir))
    model = training.fit(part)
    ready = PipelineModel(model.stages[:-1]).transform(part).select("features", "label")
    ready = storage.materialize(ready, storage.fresh_dir(spark, "features"))
    return _certificate_rows(training.certified(ready, model.stages[-1]), CUT_OFF)


@register("ml_train_predictions")
def ml_train_predictions(spark, sf_dir):
    """The whole pipeline fitted on the training part; rows per label and prediction of that part."""
    part, _ = training.split(_labelled(spark, sf_dir))
    scored = training.fit(part).transform(part)
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("row_count"))


# A classifier made by counting, kept as a table and applied by the same plan as fitted weights

def _counted(rows):
    return PipelineModel(training.term_stages()).transform(rows)


def _weights(spark, sf_dir):
    """Saved and read back; made from the training part."""
    part, _ = training.split(_labelled(spark, sf_dir))
    path = storage.fresh_dir(spark, "weights")
    for _ in range(2):
        save_weights(linear.count_weights(_counted(part)), path)
    return load_weights(spark, path)


@register("sink_save_weights", lambda: f"""WITH {sql.count_weights()}
SELECT class, count(*) AS weights, round(sum(weight), 6) AS total FROM weights GROUP BY class""")
def sink_save_weights(spark, sf_dir):
    """Saves twice (the second replaces the first) and sums what was read back."""
    total = _weights(spark, sf_dir).groupBy("class")
    return total.agg(F.count(F.lit(1)).alias("weights"), F.sum("weight").alias("total"))


@register("src_load_weights", lambda: f"""WITH {sql.count_weights()}, {sql.classified('texts')}
SELECT label, prediction, count(*) AS row_count FROM texts JOIN predicted USING (id) GROUP BY ALL""")
def src_load_weights(spark, sf_dir):
    """Rows per label and prediction of all labelled texts by the loaded table."""
    scored = linear.scored(_counted(_labelled(spark, sf_dir)), _weights(spark, sf_dir))
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("row_count"))


@register("ml_evaluate_table", lambda: f"""WITH {sql.count_weights()}, {sql.classified('texts')}
SELECT count(*) AS row_count, round(avg((label = prediction)::INT), 6) AS accuracy
FROM texts JOIN predicted USING (id) WHERE NOT in_training""")
def ml_evaluate_table(spark, sf_dir):
    """Accuracy of the table on the hold-out part."""
    _, test = training.split(_labelled(spark, sf_dir))
    right = (F.col("label") == F.col("prediction")).cast("int")
    return linear.scored(_counted(test), _weights(spark, sf_dir)).agg(
        F.count(F.lit(1)).alias("row_count"), F.avg(right).alias("accuracy")
    )


@register("ml_predict_table", lambda: f"""WITH {sql.count_weights()}, {sql.LATEST}, {sql.message_terms()},
{sql.classified('message_texts', 'message_counts')}
SELECT prediction, count(*) AS messages FROM predicted GROUP BY prediction""")
def ml_predict_table(spark, sf_dir):
    """Class counts of the current messages by the loaded table."""
    current = staging.current_messages(inputs.staged(spark, sf_dir)).withColumn("raw_text", F.col("text"))
    scored = etl.table_scorer(_weights(spark, sf_dir))(current)
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("messages"))


# The trained model

@register("ml_predict")
def ml_predict(spark, sf_dir):
    """Class counts of the current messages by the saved model."""
    model = load_model(f"{inputs.trained(spark, sf_dir)}/model")
    current = staging.current_messages(inputs.staged(spark, sf_dir))
    scored = etl.model_scorer(model)(current.withColumn("raw_text", F.col("text")))
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("messages"))


@register("ml_evaluate")
def ml_evaluate(spark, sf_dir):
    """Metrics of the saved model on the hold-out part."""
    model = load_model(f"{inputs.trained(spark, sf_dir)}/model")
    _, test = training.split(_labelled(spark, sf_dir))
    return _flat(training.evaluate(model, test))


def _flat(metrics):
    return metrics.withColumn("confusion_matrix", F.to_json("confusion_matrix"))


@register("src_load_model")
def src_load_model(spark, sf_dir):
    """Rows per label and prediction of the labelled texts by the loaded model."""
    model = load_model(f"{inputs.trained(spark, sf_dir)}/model")
    scored = model.transform(_labelled(spark, sf_dir))
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("row_count"))


@register("src_metrics_json")
def src_metrics_json(spark, sf_dir):
    return _flat(load_metrics(spark, f"{inputs.trained(spark, sf_dir)}/metrics"))


@register("sink_save_model")
def sink_save_model(spark, sf_dir):
    """Saves twice (the second replaces the first) and scores with what was read back."""
    model = load_model(f"{inputs.trained(spark, sf_dir)}/model")
    path = storage.fresh_dir(spark, "model")
    for _ in range(2):
        save_model(model, path)
    scored = load_model(path).transform(_labelled(spark, sf_dir))
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("row_count"))


@register("sink_save_metrics", f"""WITH {_MATRIX} SELECT to_json(list(
  [predicted_0, predicted_1, predicted_2] ORDER BY label))::VARCHAR AS confusion_matrix FROM cells""")
def sink_save_metrics(spark, sf_dir):
    path = storage.fresh_dir(spark, "metrics")
    save_metrics(evaluation.scores(evaluation.confusion(inputs.judged(spark, sf_dir))), path)
    return _flat(load_metrics(spark, path)).select("confusion_matrix")


# Jobs

@register("job_train")
def job_train(spark, sf_dir):
    """File in, model and metrics out, from scratch; returns the metrics read back."""
    root = storage.fresh_dir(spark, "train")
    dataset = inputs.training_csv(spark, sf_dir)
    training.train(spark, dataset, f"{root}/model", f"{root}/metrics")
    return _flat(load_metrics(spark, f"{root}/metrics"))


@register("job_etl_model")
def job_etl_model(spark, sf_dir):
    """A whole load scored by the saved model; facts per day and class."""
    model = load_model(f"{inputs.trained(spark, sf_dir)}/model")
    target = Warehouse(spark, storage.fresh_dir(spark, "etl"))
    log = inputs.staging_log(spark, sf_dir)
    etl.load(spark, log, target, etl.model_scorer(model), inputs.RUN_TS)
    return target.facts.groupBy("date_id", "sentiment_class").agg(F.count(F.lit(1)).alias("messages"))
