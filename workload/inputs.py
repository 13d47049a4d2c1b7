"""Stand-ins for the feeds the jobs expect, derived by Spark from the given tables.

Everything here is a projection or a join of whole tables, so its size follows theirs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpulse import storage
from textpulse.functions.keys import message_key
from textpulse.operators import staging
from textpulse.operators.star import Star
from textpulse.plans import etl, training
from textpulse.session import use_utc
from textpulse.sinks import publish
from textpulse.sources.warehouse import Warehouse

RUN_TS = "2024-02-01 00:00:00"
BATCHES = 4
DRAIN = {"availableNow": True}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as social messages: some without source, text or a readable time; with hashtags,
    links and words of every topic. Times advance 37 minutes per document and wrap after a year."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        "lang",
        "CASE WHEN doc_id % 25 = 3 THEN NULL ELSE source END AS source",
        """CASE WHEN doc_id % 40 = 1 THEN NULL WHEN doc_id % 40 = 2 THEN '' ELSE
             replace(text, ' the ', ' #the ')
             || CASE doc_id % 12 WHEN 0 THEN ' bitcoin wallet' WHEN 1 THEN ' python code'
                  WHEN 2 THEN ' steam game' WHEN 3 THEN ' election law' WHEN 4 THEN ' film series'
                  ELSE '' END
             || CASE WHEN doc_id % 7 = 0 THEN ' http://ex.org/' || doc_id % 5 ELSE '' END
           END AS text""",
        """CASE WHEN doc_id % 50 = 5 THEN 'not a date' ELSE
             date_format(timestamp_seconds(1704067200 + (doc_id * 37 % 525600) * 60),
                         'yyyy-MM-dd HH:mm:ss') END AS created_at""",
    )


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as they come from the topic, some of them broken."""
    encoded = raw_messages(spark, sf_dir).select("*", publish.payload.encode_message().alias("json"))
    broken = F.col("doc_id") % 30 == 0
    return encoded.select("doc_id", F.when(broken, "not json").otherwise(F.col("json")).alias("value"))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging log's rows; arrival order is the document's number."""
    return raw_messages(spark, sf_dir).select(
        message_key("text").alias("message_key"),
        "source",
        "text",
        "created_at",
        F.lit(None).cast("string").alias("value"),
        F.col("doc_id").alias("arrival"),
        (F.col("doc_id") % BATCHES).alias("batch_id"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class for each document without a model: toxic is 0, else good quality is 1, else 2."""
    labels = table(spark, sf_dir, "labels")
    return labels.selectExpr(
        "doc_id",
        "CASE WHEN toxic = 1 THEN 0.0D WHEN quality = 1 THEN 1.0D ELSE 2.0D END AS prediction",
    )


def scorer(spark: SparkSession, sf_dir: str) -> etl.Scorer:
    """Stands for the model in loads: the document's class, or 2 where it has no label."""
    classes = predictions(spark, sf_dir)

    def score(prepared: DataFrame) -> DataFrame:
        scored = prepared.join(classes, prepared["arrival"] == classes["doc_id"], "left")
        return scored.withColumn("prediction", F.coalesce("prediction", F.lit(2.0))).drop("doc_id")

    return score


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_messages(spark, sf_dir).join(predictions(spark, sf_dir), "doc_id", "left")
    return rows.withColumn("prediction", F.coalesce("prediction", F.lit(2.0)))


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return rows.selectExpr(
        "doc_id AS id",
        "source AS entity",
        """CASE WHEN doc_id % 17 = 0 THEN 'Irrelevant' WHEN toxic = 1 THEN 'Negative'
             WHEN quality = 1 THEN 'Positive' ELSE 'Neutral' END AS sentiment""",
        "CASE WHEN doc_id % 19 = 0 THEN NULL ELSE text END AS text",
    )


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with a deterministic guess that is right for two rows of three."""
    rows = training.usable(training_set(spark, sf_dir))
    label = training.label_of("sentiment")
    guess = F.when(F.col("id") % 3 == 0, F.col("id") % 2 * 2.0).otherwise(label)
    return rows.select("id", label.alias("label"), guess.alias("prediction"))


def wiki_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        """to_json(named_struct(
             'server_name', CASE WHEN lang = 'en' THEN 'en.wikipedia.org' ELSE 'de.wikipedia.org' END,
             'type', CASE WHEN doc_id % 9 = 0 THEN 'log' ELSE 'edit' END,
             'title', CASE WHEN doc_id % 33 = 0 THEN NULL ELSE source END,
             'comment', CASE WHEN doc_id % 21 = 0 THEN '' ELSE text END)) AS value""",
    )
    return changes


def tweet_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search page per turn, of two tweets: the turn's text in one field or the other (in
    neither at turn 3), and a tweet that lacks the first field."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id",
        "turn",
        """to_json(named_struct('tweets', array(
             named_struct('text', CASE WHEN turn % 2 = 0 THEN text ELSE '' END,
                          'full_text', CASE WHEN turn % 2 = 1 AND turn <> 3 THEN text ELSE '' END),
             named_struct('text', CAST(NULL AS STRING), 'full_text', role || ' ' || turn)))) AS value""",
    )


# --- Written once per session and data set, then read by many queries --------------------------

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written or not storage.exists(spark, _written[key]):
        use_utc(spark)
        path = storage.fresh_dir(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def staging_log(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        rows = staged(spark, sf_dir)
        kind = F.when(F.col("text").isNull(), "rejected").otherwise("message")
        laid_out = rows.withColumn("kind", kind).write.options(**storage.TEXT_CODEC).partitionBy("batch_id", "kind")
        laid_out.parquet(f"{path}/run={staging.LOADS}")

    return _once(spark, sf_dir, "log", write)


def load_into(spark: SparkSession, sf_dir: str, warehouse: Warehouse, **options) -> Warehouse:
    log = staging_log(spark, sf_dir)
    etl.load(spark, log, warehouse, scorer(spark, sf_dir), RUN_TS, **options)
    return warehouse


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    root = _once(
        spark, sf_dir, "star", lambda path: load_into(spark, sf_dir, Warehouse(spark, path))
    )
    return Warehouse(use_utc(spark), root)


_stars: dict[str, Star] = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    """One listing of the tables' files serves all reports until the next refresh, which is
    another ``Star.of``."""
    tables = warehouse(spark, sf_dir)
    if tables.root not in _stars:
        _stars[tables.root] = Star.of(tables)
    return _stars[tables.root]


def published(spark: SparkSession, sf_dir: str) -> str:
    """The topic as files of JSON lines."""
    return _once(
        spark, sf_dir, "topic", lambda path: values(spark, sf_dir).select("value").write.text(path)
    )


def training_csv(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        rows = training_set(spark, sf_dir)
        rows.write.options(
            quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
        ).csv(path)

    return _once(spark, sf_dir, "training", write)


def trained(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the model and the metrics of one training run."""

    def write(path: str) -> None:
        training.train(spark, training_csv(spark, sf_dir), f"{path}/model", f"{path}/metrics")

    return _once(spark, sf_dir, "trained", write)
