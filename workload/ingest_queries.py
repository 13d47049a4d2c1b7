"""Sources, sinks, staging, dimensions and streams."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from textpulse import schemas, storage
from textpulse.operators import compaction, dimensions, enrich, staging, summary
from textpulse.operators.star import Star
from textpulse.plans import adhoc, etl
from textpulse.sinks import publish
from textpulse.sources import catalogue, feeds, files, messages
from textpulse.sources.warehouse import Warehouse
from textpulse.streaming import ingest, live, replay
from workload import inputs, sql
from workload.registry import register

_DECODED = f"""{sql.RAW},
decoded AS (SELECT doc_id, CASE WHEN doc_id % 30 <> 0 THEN source END AS source,
  CASE WHEN doc_id % 30 <> 0 THEN text END AS text,
  CASE WHEN doc_id % 30 <> 0 THEN created_at END AS created_at FROM raw)"""


def _prepared(spark, sf_dir):
    current = staging.current_messages(inputs.staged(spark, sf_dir))
    return enrich.prepare(current, inputs.RUN_TS)


# Sources

@register("src_decode_value", f"WITH {_DECODED} SELECT *, text AS id FROM decoded")
def src_decode_value(spark, sf_dir):
    decoded = messages.decode(inputs.values(spark, sf_dir))
    return decoded.select("doc_id", "source", "text", "created_at", "id")


@register("src_staging_scan", f"""WITH {sql.RAW}
SELECT doc_id % 4 AS batch_id, doc_id AS arrival, {sql.message_key('text')} AS message_key, source, created_at
FROM raw WHERE text IS NOT NULL""")
def src_staging_scan(spark, sf_dir):
    log = staging.read_log(spark, inputs.staging_log(spark, sf_dir))
    return log.select("batch_id", "arrival", "message_key", "source", "created_at")


@register("src_training_csv", f"WITH {sql.TRAINING} SELECT id, entity, sentiment, text FROM training")
def src_training_csv(spark, sf_dir):
    return files.training_rows(spark, inputs.training_csv(spark, sf_dir))


@register("src_training_csv_landed", f"WITH {sql.TRAINING} SELECT id, entity, sentiment, text FROM training")
def src_training_csv_landed(spark, sf_dir):
    """The same file cut into records by byte ranges, in many tasks."""
    return files.training_rows(spark, inputs.training_csv(spark, sf_dir), storage.fresh_dir(spark, "landed"))


def _archive(spark, sf_dir):
    """The messages as a tweet archive: twelve fields, date and text at places 8 and 9."""

    def write(path):
        rows = inputs.raw_messages(spark, sf_dir)
        before = [F.concat(F.lit(f"v{i} "), F.col("doc_id")).alias(f"c{i}") for i in range(8)]
        after = [F.lit("x").alias("c10"), F.lit("y").alias("c11")]
        laid_out = rows.select(*before, F.col("created_at").alias("c8"), F.col("text").alias("c9"), *after)
        laid_out.write.options(
            header="true", quote='"', escape='"',
            ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
        ).csv(path)

    return inputs._once(spark, sf_dir, "archive", write)


@register("src_tweets_csv", f"WITH {sql.RAW} {sql.CSV_MESSAGES}")
def src_tweets_csv(spark, sf_dir):
    return files.archived_tweets(spark, _archive(spark, sf_dir))


@register("src_tweets_csv_landed", f"WITH {sql.RAW} {sql.CSV_MESSAGES}")
def src_tweets_csv_landed(spark, sf_dir):
    return files.archived_tweets(spark, _archive(spark, sf_dir), storage.fresh_dir(spark, "landed"))


@register("src_wiki_changes", f"WITH {sql.CHANGES} {sql.WIKI_MESSAGES}")
def src_wiki_changes(spark, sf_dir):
    changes = feeds.parse_changes(inputs.wiki_changes(spark, sf_dir))
    return feeds.wiki_messages(changes, inputs.RUN_TS)


@register("src_tweet_search", f"WITH {sql.TWEETS} {sql.SEARCH_MESSAGES}")
def src_tweet_search(spark, sf_dir):
    return feeds.search_messages(inputs.tweet_pages(spark, sf_dir), inputs.RUN_TS)


@register("src_dwh_table", f"""WITH {sql.FACTS}
SELECT source_name, 'Social Network' AS source_type, count(*) AS messages FROM facts GROUP BY ALL""")
def src_dwh_table(spark, sf_dir):
    return adhoc.raw_sql(
        inputs.star(spark, sf_dir),
        """SELECT s.source_name, s.source_type, count(*) AS messages
           FROM fact_sentiment f JOIN dim_source s ON f.source_id = s.source_id
           GROUP BY s.source_name, s.source_type""",
    )


@register("union_sources", f"""WITH {sql.RAW}, {sql.CHANGES}, {sql.TWEETS}
{sql.CSV_MESSAGES} UNION ALL {sql.WIKI_MESSAGES} UNION ALL {sql.SEARCH_MESSAGES}""")
def union_sources(spark, sf_dir):
    return feeds.all_messages(
        src_tweets_csv(spark, sf_dir), src_wiki_changes(spark, sf_dir), src_tweet_search(spark, sf_dir)
    )


# Staging

@register("staging_current", f"""WITH {sql.LATEST}
SELECT message_key, id, batch_id, arrival, source, created_at, text FROM latest""")
def staging_current(spark, sf_dir):
    return staging.current_messages(inputs.staged(spark, sf_dir))


@register("staging_compacted", f"""WITH {sql.LATEST}
SELECT message_key, id, batch_id, arrival, source, created_at, text FROM latest""")
def staging_compacted(spark, sf_dir):
    """The log compacted while it grows: two batches become a run, the third another and both are merged; the last
    batch is still in no run."""
    log = storage.fresh_dir(spark, "grows")
    compacted = compaction.CompactedLog(spark, log, storage.fresh_dir(spark, "runs"), buckets=8, fan_in=2)
    rows = staging.read_log(spark, inputs.staging_log(spark, sf_dir))
    for wave in ("batch_id < 2", "batch_id = 2", "batch_id = 3"):
        rows.where(wave).write.mode("append").partitionBy("run", "batch_id", "kind").parquet(log)
        if wave != "batch_id = 3":
            compacted.compact()
    return compacted.current()


# Dimensions

_DIM_OF = "WITH {facts}, {dims} SELECT * FROM {name}"


@register("dim_source_build", _DIM_OF.format(facts=sql.FACTS, dims=sql.DIMS, name="dim_source"))
def dim_source_build(spark, sf_dir):
    return dimensions.source_rows(_prepared(spark, sf_dir), inputs.RUN_TS)


@register("dim_date_build", _DIM_OF.format(facts=sql.FACTS, dims=sql.DIMS, name="dim_date"))
def dim_date_build(spark, sf_dir):
    return dimensions.date_rows(_prepared(spark, sf_dir), inputs.RUN_TS)


@register("dim_topic_build", _DIM_OF.format(facts=sql.FACTS, dims=sql.DIMS, name="dim_topic"))
def dim_topic_build(spark, sf_dir):
    return dimensions.topic_rows(_prepared(spark, sf_dir), inputs.RUN_TS)


@register("distinct_rows", f"""WITH {sql.PREPARED}
SELECT DISTINCT source, topic_name FROM prepared""")
def distinct_rows(spark, sf_dir):
    return _prepared(spark, sf_dir).select("source", "topic_name").distinct()


# Sinks

@register("sink_publish_messages", f"WITH {sql.RAW} SELECT source, text, created_at FROM raw")
def sink_publish_messages(spark, sf_dir):
    path = storage.fresh_dir(spark, "publish")
    publish.to_files(inputs.raw_messages(spark, sf_dir), path)
    return messages.decode(spark.read.text(path)).select("source", "text", "created_at")


@register("sink_dim_upsert", f"""WITH {sql.FACTS}, {sql.DIMS}
SELECT 'dim_source' AS dim, source_id AS id, source_name AS name FROM dim_source
UNION ALL SELECT 'dim_topic', topic_id, topic_name FROM dim_topic
UNION ALL SELECT 'dim_date', date_id, date_value FROM dim_date""")
def sink_dim_upsert(spark, sf_dir):
    """Three loads: the first two batches, all, and all once more."""
    target = Warehouse(spark, storage.fresh_dir(spark, "upsert")).create()
    prepared = storage.materialize(
        _prepared(spark, sf_dir).select("batch_id", "source", "topic_name", "created_ts"),
        storage.fresh_dir(spark, "prepared"),
    )
    for part in (prepared.where("batch_id < 2"), prepared, prepared):
        etl.append_dimension(
            target, "dim_source", dimensions.source_rows(part, inputs.RUN_TS), "source_name"
        )
        etl.append_dimension(
            target, "dim_topic", dimensions.topic_rows(part, inputs.RUN_TS), "topic_name"
        )
        etl.append_dimension(target, "dim_date", dimensions.date_rows(part, inputs.RUN_TS), "date_id")

    def rows(table, key, name):
        return target.table(table).select(
            F.lit(table).alias("dim"), F.col(key).alias("id"), F.col(name).cast("string").alias("name")
        )

    sources = rows("dim_source", "source_id", "source_name")
    topics = rows("dim_topic", "topic_id", "topic_name")
    return sources.unionByName(topics).unionByName(rows("dim_date", "date_id", "date_value"))


@register("sink_fact_append", f"""WITH {sql.FACTS}
SELECT date_id, source_id, count(*) AS messages, count(DISTINCT fact_id) AS ids FROM facts GROUP BY ALL""")
def sink_fact_append(spark, sf_dir):
    """The first batches, all, and all once more leave the facts of one load: texts that came again with
    another source or time are facts of their last message."""
    target = Warehouse(spark, storage.fresh_dir(spark, "append"))
    log = storage.fresh_dir(spark, "waves")
    rows = staging.read_log(spark, inputs.staging_log(spark, sf_dir))
    for wave in ("batch_id < 2", "batch_id >= 2", "false"):
        rows.where(wave).write.mode("append").partitionBy("run", "batch_id", "kind").parquet(log)
        etl.load(spark, log, target, inputs.scorer(spark, sf_dir), inputs.RUN_TS)
    return target.facts.groupBy("date_id", "source_id").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("fact_id").alias("ids")
    )


@register("load_ledger", """SELECT DISTINCT 'loads' AS run, doc_id % 4 AS batch_id,
  CASE WHEN doc_id % 4 < 2 THEN 1::BIGINT ELSE 2 END AS load_number FROM documents""")
def load_ledger(spark, sf_dir):
    """Which load took in which batch, after three loads of a growing log; the third found nothing new."""
    target = Warehouse(spark, storage.fresh_dir(spark, "ledger"))
    log = storage.fresh_dir(spark, "waves")
    rows = spark.read.schema(schemas.STAGING_LOG).parquet(inputs.staging_log(spark, sf_dir))
    for wave in ("batch_id < 2", "batch_id >= 2", "false"):
        rows.where(wave).write.mode("append").partitionBy("run", "batch_id", "kind").parquet(log)
        etl.load(spark, log, target, inputs.scorer(spark, sf_dir), inputs.RUN_TS)
    loads = target.ledger()
    return loads.select("run", "batch_id", F.dense_rank().over(Window.orderBy("load")).cast("bigint").alias("load_number"))


@register("rollup_maintained", f"""WITH {sql.FACTS}
SELECT bucket, source_name, topic_name, sum(messages)::BIGINT AS messages, sum(negative)::BIGINT AS negative,
  sum(word_sum)::BIGINT AS word_sum, sum(hashtag_sum)::BIGINT AS hashtag_sum
FROM (SELECT {sql.bucket('created_at', 'Hour')} AS bucket, source_name, topic_name, 1::BIGINT AS messages,
  CASE WHEN sentiment_class = 'negative' THEN 1::BIGINT ELSE 0 END AS negative, word_count AS word_sum,
  hashtags_count AS hashtag_sum FROM facts) GROUP BY ALL""")
def rollup_maintained(spark, sf_dir):
    """The hours that three loads have kept up: the second changes messages of the first."""
    target = Warehouse(spark, storage.fresh_dir(spark, "rolled"))
    log = storage.fresh_dir(spark, "waves")
    rows = spark.read.schema(schemas.STAGING_LOG).parquet(inputs.staging_log(spark, sf_dir))
    for wave in ("batch_id < 2", "batch_id = 2", "batch_id = 3"):
        rows.where(wave).write.mode("append").partitionBy("run", "batch_id", "kind").parquet(log)
        etl.load(spark, log, target, inputs.scorer(spark, sf_dir), inputs.RUN_TS)
    by_hour = summary.summarise_by_time(Star.rolled_up(target), "Hour")
    return by_hour.select("bucket", "source_name", "topic_name", "messages", "negative", "word_sum", "hashtag_sum")


def _catalogue(spark):
    place = storage.fresh_dir(spark, "catalogue")
    return catalogue.Catalogue(spark, f"textpulse_{place[-12:]}", place).create()


@register("sink_default_now", f"""WITH {sql.FACTS}, {sql.DIMS}
SELECT 'dim_source' AS dim, count(*) AS row_count, count(*) AS stamped FROM dim_source
UNION ALL SELECT 'dim_topic', count(*), count(*) FROM dim_topic
UNION ALL SELECT 'dim_date', count(*), count(*) FROM dim_date""")
def sink_default_now(spark, sf_dir):
    """Inserts that do not name the load time: rows, and those whose time is the insert's own."""
    tables, prepared = _catalogue(spark), _prepared(spark, sf_dir)
    started = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    made = {
        "dim_source": (dimensions.source_rows(prepared, inputs.RUN_TS), "source_id"),
        "dim_topic": (dimensions.topic_rows(prepared, inputs.RUN_TS), "topic_id"),
        "dim_date": (dimensions.date_rows(prepared, inputs.RUN_TS), "date_id"),
    }
    out = []
    for name, (rows, key) in made.items():
        for _ in range(2):
            tables.insert_missing(name, rows.drop("load_dt"), key)
        out.append(tables.table(name).select(F.lit(name).alias("dim"), "load_dt"))
    stamped = (F.col("load_dt") >= F.lit(started)) & (F.col("load_dt") <= F.current_timestamp())
    return feeds.all_messages(*out).groupBy("dim").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(stamped).alias("stamped")
    )


@register("sink_default_load_dt", f"""WITH {sql.FACTS}, {sql.DIMS}
SELECT 'dim_source' AS dim, load_dt, count(*) AS row_count FROM dim_source GROUP BY ALL
UNION ALL SELECT 'dim_topic', load_dt, count(*) FROM dim_topic GROUP BY ALL
UNION ALL SELECT 'dim_date', load_dt, count(*) FROM dim_date GROUP BY ALL""")
def sink_default_load_dt(spark, sf_dir):
    star = inputs.star(spark, sf_dir)
    dims = {"dim_source": star.sources, "dim_topic": star.topics, "dim_date": star.dates}
    tables = [dim.select(F.lit(name).alias("dim"), "load_dt") for name, dim in dims.items()]
    stamped = tables[0].unionByName(tables[1]).unionByName(tables[2])
    return stamped.groupBy("dim", "load_dt").agg(F.count(F.lit(1)).alias("row_count"))


@register("ddl_star_schema", f"""WITH {sql.FACTS}, {sql.DIMS}
SELECT 'dim_source' AS table_name, 4::BIGINT AS n_columns, count(*) AS row_count FROM dim_source
UNION ALL SELECT 'dim_topic', 3, count(*) FROM dim_topic
UNION ALL SELECT 'dim_date', 6, count(*) FROM dim_date
UNION ALL SELECT 'fact_sentiment', 10, count(*) FROM facts""")
def ddl_star_schema(spark, sf_dir):
    warehouse = inputs.warehouse(spark, sf_dir)
    counts = [
        summary.row_count(table).select(
            F.lit(name).alias("table_name"), F.lit(len(table.columns)).alias("n_columns"), "row_count"
        )
        for name in ("dim_source", "dim_topic", "dim_date", "fact_sentiment")
        for table in [warehouse.table(name)]
    ]
    return feeds.all_messages(*counts)


@register("ddl_catalogue", f"""WITH {sql.FACTS}, {sql.DIMS}
SELECT 'raw_data' AS table_name, 'id string, source string, text string, created_at string' AS columns,
  '' AS partitioned_by, '' AS defaults, count(*) AS row_count FROM facts
UNION ALL SELECT 'dim_source', 'source_id bigint, source_name string, source_type string, load_dt timestamp',
  '', 'load_dt current_timestamp()', count(*) FROM dim_source
UNION ALL SELECT 'dim_date', 'date_id bigint, date_value date, year int, month int, day int, load_dt timestamp',
  '', 'load_dt current_timestamp()', count(*) FROM dim_date
UNION ALL SELECT 'dim_topic', 'topic_id bigint, topic_name string, load_dt timestamp',
  '', 'load_dt current_timestamp()', count(*) FROM dim_topic
UNION ALL SELECT 'fact_sentiment', 'fact_id string, source_id bigint, topic_id bigint, text string, '
  || 'sentiment_class string, sentiment_score float, word_count int, hashtags_count int, created_at timestamp, '
  || 'date_id bigint', 'date_id', '', count(*) FROM facts""")
def ddl_catalogue(spark, sf_dir):
    """Columns, types, partitioning and defaults as the catalogue tells them, and the rows of its tables after they
    were filled from the staging log and the star schema."""
    tables = _catalogue(spark)
    current = staging.current_messages(inputs.staged(spark, sf_dir))
    tables.insert(catalogue.STAGING, current.select("id", "source", "text", "created_at"))
    tables.refresh(inputs.warehouse(spark, sf_dir))
    return tables.described()


@register("table_sort_key", f"""WITH {sql.FACTS}
SELECT date_id, count(*) AS row_count, 0::BIGINT AS out_of_order FROM facts GROUP BY ALL""")
def table_sort_key(spark, sf_dir):
    """Rows per day, and how many of them break their file's sort order. A file's rows are read in
    place, so its neighbours are found by row number and no day is gathered."""
    facts = inputs.star(spark, sf_dir).facts.select(
        "date_id",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("place"),
        F.struct("source_id", "fact_id").alias("sort_key"),
    )
    after = facts.select("file", (F.col("place") - 1).alias("place"), F.col("sort_key").alias("next"))
    paired = facts.join(after, ["file", "place"], "left")
    return paired.groupBy("date_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("sort_key") > F.col("next")).alias("out_of_order"),
    )


# Streams

@register("src_kafka_messages", f"""WITH {_DECODED}
SELECT source, text, created_at, text AS id FROM decoded""")
def src_kafka_messages(spark, sf_dir):
    """The topic read as a stream, decoded on the way and landed as it comes."""
    stream = messages.decode(messages.file_stream(spark, inputs.published(spark, sf_dir)))
    path = storage.fresh_dir(spark, "landed")
    query = (
        stream.select("source", "text", "created_at", "id")
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", storage.fresh_dir(spark, "checkpoint"))
        .trigger(**inputs.DRAIN)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema("source string, text string, created_at string, id string").parquet(path)


def _two_streams(spark, sf_dir):
    """A log that two streams, each with a checkpoint of its own, drain half of the messages into; both number
    their batches from 0."""
    log = storage.fresh_dir(spark, "log")
    for half in (0, 1):
        path = storage.fresh_dir(spark, "topic")
        inputs.values(spark, sf_dir).where(F.col("doc_id") % 2 == half).select("value").write.text(path)
        stream = messages.file_stream(spark, path)
        ingest.ingest(stream, log, storage.fresh_dir(spark, "checkpoint"), inputs.DRAIN).awaitTermination()
    return log


@register("sink_stream_staging", f"""WITH {_DECODED}
SELECT {sql.message_key('text')} AS message_key, source, created_at, text FROM decoded WHERE text IS NOT NULL""")
def sink_stream_staging(spark, sf_dir):
    log = staging.read_log(spark, _two_streams(spark, sf_dir))
    return log.select("message_key", "source", "created_at", "text")


@register("stream_ingest", f"""WITH {_DECODED}
SELECT CASE WHEN text IS NULL THEN 'rejected' ELSE 'message' END AS kind, count(*) AS row_count,
  count(DISTINCT text) AS keys FROM decoded GROUP BY ALL""")
def stream_ingest(spark, sf_dir):
    path = _two_streams(spark, sf_dir)
    accepted = staging.read_log(spark, path).select("kind", "message_key")
    rejected = staging.read_rejected(spark, path).select(
        F.lit(staging.REJECTED).alias("kind"), F.lit(None).cast("string").alias("message_key")
    )
    return accepted.unionByName(rejected).groupBy("kind").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("message_key").alias("keys")
    )


@register("stream_dedupe_staging", f"""WITH {sql.RAW}
SELECT {sql.message_key('text')} AS message_key, max(doc_id % 2) AS last_wave FROM raw
WHERE text IS NOT NULL GROUP BY text""")
def stream_dedupe_staging(spark, sf_dir):
    """Two waves of messages through one checkpoint: the second overwrites texts of the first."""
    topic_path, log = storage.fresh_dir(spark, "waves"), storage.fresh_dir(spark, "log")
    checkpoint = storage.fresh_dir(spark, "checkpoint")
    rows = inputs.raw_messages(spark, sf_dir)
    for wave in (0, 1):
        publish.to_files(rows.where(F.col("doc_id") % 2 == wave), topic_path)
        stream = messages.file_stream(spark, topic_path)
        ingest.ingest(stream, log, checkpoint, inputs.DRAIN).awaitTermination()
    current = staging.current_messages(staging.read_log(spark, log))
    return current.select("message_key", F.col("batch_id").alias("last_wave"))


_HOURLY = f"""SELECT {sql.bucket('ts', 'Hour')} AS bucket, event_type AS category, count(*) AS messages
FROM events GROUP BY ALL"""


def _newest_first(spark, sf_dir):
    """The events as a stream: twelve files, newest first, three to a micro-batch."""
    schema = "event_id bigint, ts timestamp_ntz, event_type string"
    folder = storage.fresh_dir(spark, "events")
    stored = inputs.table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    stored.repartitionByRange(12, F.desc("ts")).write.parquet(f"{folder}/events")
    events = replay.table_stream(spark, folder, "events", schema, files_per_batch=3)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


@register("stream_live_rollup", _HOURLY)
def stream_live_rollup(spark, sf_dir):
    path = storage.fresh_dir(spark, "live")
    query = live.write_live(
        live.live_counts(_newest_first(spark, sf_dir), "ts", "event_type", "Hour", lateness=None),
        path,
        storage.fresh_dir(spark, "checkpoint"),
        inputs.DRAIN,
    )
    query.awaitTermination()
    return live.read_live(spark, path)


@register("stream_live_late", _HOURLY)
def stream_live_late(spark, sf_dir):
    """All but the first files come far behind the newest event; the counts are right all the same, also over a sum of
    the first batches."""
    path = storage.fresh_dir(spark, "live")
    live.write_additions(
        _newest_first(spark, sf_dir), path, storage.fresh_dir(spark, "checkpoint"), inputs.DRAIN, "ts", "event_type"
    ).awaitTermination()
    live.compact_additions(spark, path, least=2)
    return live.read_additions(spark, path).select("bucket", "category", "messages")


@register("stream_replay", """SELECT event_type AS source, props AS text,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at FROM events""")
def stream_replay(spark, sf_dir):
    schema = "event_id bigint, ts timestamp_ntz, event_type string, props string"
    events = replay.table_stream(spark, sf_dir, "events.parquet", schema)
    path = storage.fresh_dir(spark, "replay")
    query = replay.replay(
        events,
        F.col("event_type"),
        F.col("props"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        path,
        storage.fresh_dir(spark, "checkpoint"),
        inputs.DRAIN,
    )
    query.awaitTermination()
    return messages.decode(spark.read.text(path)).select("source", "text", "created_at")


# Jobs

@register("job_ingest", f"""WITH {_DECODED}
SELECT DISTINCT {sql.message_key('text')} AS message_key, text AS id FROM decoded WHERE text IS NOT NULL""")
def job_ingest(spark, sf_dir):
    """Topic to staging to current messages, from scratch."""
    log = storage.fresh_dir(spark, "log")
    stream = messages.file_stream(spark, inputs.published(spark, sf_dir))
    checkpoint = storage.fresh_dir(spark, "checkpoint")
    ingest.ingest(stream, log, checkpoint, inputs.DRAIN).awaitTermination()
    return staging.current_messages(staging.read_log(spark, log)).select("message_key", "id")


@register("job_etl", f"""WITH {sql.FACTS}
SELECT fact_id, source_id, topic_id, text, sentiment_class, sentiment_score, word_count,
  hashtags_count, created_at, date_id FROM facts""")
def job_etl(spark, sf_dir):
    """A whole load into an empty warehouse; returns its facts."""
    target = Warehouse(spark, storage.fresh_dir(spark, "etl"))
    return inputs.load_into(spark, sf_dir, target).facts
