"""Projections, filters and scalar functions."""

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from textpulse import rules
from textpulse.functions import dates, keys, payload, text
from textpulse.operators import enrich, staging
from textpulse.plans import training
from textpulse.sinks import publish
from textpulse.sources import feeds
from workload import inputs, sql
from workload.registry import register


def _latest(spark, sf_dir):
    return staging.current_messages(inputs.staged(spark, sf_dir))


def _scored(spark, sf_dir):
    return inputs.scorer(spark, sf_dir)(enrich.prepare(_latest(spark, sf_dir), inputs.RUN_TS))


def _changes(spark, sf_dir):
    return feeds.parse_changes(inputs.wiki_changes(spark, sf_dir))


# Projections

@register("proj_preprocess", f"""WITH {sql.PREPARED}
SELECT message_key, id, batch_id, arrival, source, created_at, text, raw_text, clean_text, parsed_ts,
  safe_ts, created_ts, word_count, hashtags_count, topic_name FROM prepared""")
def proj_preprocess(spark, sf_dir):
    return enrich.prepare(_latest(spark, sf_dir), inputs.RUN_TS)


@register("proj_fact", f"""WITH {sql.FACTS}
SELECT fact_id, source_id, topic_id, text, sentiment_class, sentiment_score, word_count,
  hashtags_count, created_at, date_id FROM facts""")
def proj_fact(spark, sf_dir):
    return enrich.to_facts(_scored(spark, sf_dir))


@register("label_map", f"WITH {sql.TRAINING} SELECT id, sentiment, {sql.LABEL} AS label FROM training")
def label_map(spark, sf_dir):
    rows = inputs.training_set(spark, sf_dir)
    return rows.select("id", "sentiment", training.label_of("sentiment").alias("label"))


@register("class_map", f"""WITH {sql.CLASSES}
SELECT doc_id, prediction, {sql.SENTIMENT} AS sentiment_class FROM classes""")
def class_map(spark, sf_dir):
    rows = inputs.predictions(spark, sf_dir)
    return rows.withColumn("sentiment_class", enrich.sentiment_class())


@register("score_const", "SELECT doc_id, 1.0::DOUBLE AS sentiment_score FROM documents")
def score_const(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "documents")
    return rows.select("doc_id", enrich.sentiment_score().alias("sentiment_score"))


@register("wiki_format", f"""WITH {sql.CHANGES}
SELECT doc_id, 'Article [' || title || ']: ' || comment AS line FROM edits""")
def wiki_format(spark, sf_dir):
    edits = _changes(spark, sf_dir).where(feeds.is_english_edit())
    return edits.select("doc_id", text.article_line("title", "comment").alias("line"))


@register("tweet_text_coalesce", f"""WITH {sql.TWEETS}
SELECT conv_id, turn, place::BIGINT AS place, {sql.TWEET_TEXT} AS tweet_text FROM tweets""")
def tweet_text_coalesce(spark, sf_dir):
    tweets = feeds.explode_pages(inputs.tweet_pages(spark, sf_dir))
    chosen = text.first_nonempty("text", "full_text").alias("tweet_text")
    return tweets.select("conv_id", "turn", "place", chosen)


@register("stamp_ingest_time", "SELECT doc_id, '2024-02-01 00:00:00' AS created_at FROM documents")
def stamp_ingest_time(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "documents")
    return rows.select("doc_id", dates.message_time(inputs.RUN_TS).alias("created_at"))


# Filters

@register("filter_dropna", f"""WITH {sql.TRAINING}
SELECT * FROM training WHERE text IS NOT NULL AND sentiment IS NOT NULL""")
def filter_dropna(spark, sf_dir):
    return inputs.training_set(spark, sf_dir).dropna(subset=["text", "sentiment"])


@register("filter_irrelevant", f"WITH {sql.TRAINING} SELECT * FROM usable")
def filter_irrelevant(spark, sf_dir):
    return training.usable(inputs.training_set(spark, sf_dir))


@register("filter_wiki_edit", f"WITH {sql.CHANGES} SELECT doc_id, title, comment FROM edits")
def filter_wiki_edit(spark, sf_dir):
    edits = _changes(spark, sf_dir).where(feeds.is_english_edit())
    return edits.select("doc_id", "title", "comment")


@register("filter_watchlist", f"""WITH {sql.CHANGES} SELECT doc_id, title, comment FROM edits
WHERE {sql.contains_any("lower(title || ' ' || comment)")}""")
def filter_watchlist(spark, sf_dir):
    edits = _changes(spark, sf_dir).where(feeds.is_english_edit() & feeds.is_watched())
    return edits.select("doc_id", "title", "comment")


@register("filter_min_len", f"WITH {sql.RAW} SELECT doc_id, text FROM raw WHERE length(text) >= 10")
def filter_min_len(spark, sf_dir):
    rows = inputs.raw_messages(spark, sf_dir).select("doc_id", "text")
    return rows.where(F.length("text") >= rules.MIN_TEXT_LENGTH)


@register("filter_nonempty", f"""WITH {sql.TWEETS}
SELECT conv_id, turn, place::BIGINT AS place, {sql.TWEET_TEXT} AS tweet_text
FROM tweets WHERE {sql.TWEET_TEXT} <> ''""")
def filter_nonempty(spark, sf_dir):
    return tweet_text_coalesce(spark, sf_dir).where(F.col("tweet_text") != "")


@register("filter_search_query", f"""WITH {sql.RAW} SELECT doc_id, text FROM raw
WHERE lang = 'en' AND list_has_any(string_split({sql.clean_for_scoring('text')}, ' '),
  ['bitcoin', 'ai', 'python']) ORDER BY doc_id LIMIT 20""")
def filter_search_query(spark, sf_dir):
    tweets = inputs.raw_messages(spark, sf_dir)
    return feeds.search(tweets, [F.asc("doc_id")]).select("doc_id", "text")


@register("filter_ts_notnull", f"""WITH {sql.PREPARED} SELECT message_key, parsed_ts FROM prepared
WHERE parsed_ts IS NOT NULL""")
def filter_ts_notnull(spark, sf_dir):
    prepared = enrich.prepare(_latest(spark, sf_dir), inputs.RUN_TS)
    return prepared.select("message_key", "parsed_ts").where(F.col("parsed_ts").isNotNull())


# Text functions

@register("clean_text_serve", f"""WITH {sql.RAW}
SELECT doc_id, {sql.clean_for_scoring('text')} AS clean_text FROM raw""")
def clean_text_serve(spark, sf_dir):
    rows = inputs.raw_messages(spark, sf_dir)
    return rows.select("doc_id", text.clean_for_scoring("text").alias("clean_text"))


@register("clean_text_train", f"""WITH {sql.RAW}
SELECT doc_id, {sql.clean_for_training('text')} AS clean_text FROM raw""")
def clean_text_train(spark, sf_dir):
    rows = inputs.raw_messages(spark, sf_dir)
    return rows.select("doc_id", text.clean_for_training("text").alias("clean_text"))


@register("word_count", f"""WITH {sql.RAW},
cleaned AS (SELECT doc_id, {sql.clean_for_scoring('text')} AS clean_text FROM raw)
SELECT doc_id, {sql.word_count('clean_text')} AS word_count FROM cleaned""")
def word_count(spark, sf_dir):
    cleaned = clean_text_serve(spark, sf_dir)
    return cleaned.select("doc_id", text.word_count("clean_text").alias("word_count"))


@register("topic_rule", f"""WITH {sql.RAW},
cleaned AS (SELECT doc_id, {sql.clean_for_scoring('text')} AS clean_text FROM raw)
SELECT doc_id, {sql.topic('clean_text')} AS topic_name FROM cleaned""")
def topic_rule(spark, sf_dir):
    split_once = clean_text_serve(spark, sf_dir).select("doc_id", text.words("clean_text").alias("w"))
    return split_once.select("doc_id", text.topic_of("w").alias("topic_name"))


@register("hashtag_count", f"""WITH {sql.RAW}
SELECT doc_id, {sql.hashtag_count('text')} AS hashtags_count FROM raw""")
def hashtag_count(spark, sf_dir):
    rows = inputs.raw_messages(spark, sf_dir)
    return rows.select("doc_id", text.hashtag_count("text").alias("hashtags_count"))


_TOKENS = rf"""list_filter(regexp_split_to_array({sql.clean_for_training('text')}, '\s+'),
  lambda t: length(t) >= 1)"""


@register("tokenize", f"""WITH {sql.TRAINING}, split AS (SELECT id, {_TOKENS} AS tokens FROM usable)
SELECT id, array_to_string(tokens, ' ') AS tokens, len(tokens)::BIGINT AS n_tokens FROM split""")
def tokenize(spark, sf_dir):
    rows = training.usable(inputs.training_set(spark, sf_dir))
    found = rows.select("id", text.tokens(text.clean_for_training("text")).alias("tokens"))
    return found.select(
        "id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n_tokens")
    )


@register("remove_stopwords", lambda: f"""WITH {sql.TRAINING},
split AS (SELECT id, list_filter({_TOKENS},
  lambda t: NOT list_contains([{sql.quoted(sql.stop_words())}], t)) AS tokens FROM usable)
SELECT id, array_to_string(tokens, ' ') AS tokens, len(tokens)::BIGINT AS n_tokens FROM split""")
def remove_stopwords(spark, sf_dir):
    stop_words = StopWordsRemover.loadDefaultStopWords("english")
    rows = training.usable(inputs.training_set(spark, sf_dir))
    found = rows.select("id", text.tokens(text.clean_for_training("text")).alias("tokens"))
    kept = found.select("id", text.without_stop_words("tokens", stop_words).alias("tokens"))
    return kept.select(
        "id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n_tokens")
    )


@register("concat_lower", f"""WITH {sql.CHANGES}
SELECT doc_id, lower(title) || ' ' || lower(comment) AS haystack FROM edits""")
def concat_lower(spark, sf_dir):
    edits = _changes(spark, sf_dir).where(feeds.is_english_edit())
    return edits.select("doc_id", text.lowered_pair("title", "comment").alias("haystack"))


# Time functions

@register("time_bucket", f"""SELECT event_id, {', '.join(
    f"{sql.bucket('ts', g)} AS by_{g.lower()}" for g in dates.GRAINS)} FROM events""")
def time_bucket(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return events.select(
        "event_id", *[dates.time_bucket("ts", g).alias(f"by_{g.lower()}") for g in dates.GRAINS]
    )


@register("safe_timestamp", f"""WITH {sql.RAW}
SELECT doc_id, coalesce(try_cast(created_at AS TIMESTAMP), {sql.RUN_TS}) AS safe_ts FROM raw""")
def safe_timestamp(spark, sf_dir):
    rows = inputs.raw_messages(spark, sf_dir)
    return rows.select("doc_id", dates.safe_timestamp("created_at", inputs.RUN_TS).alias("safe_ts"))


@register("date_key", f"SELECT event_id, {sql.date_key('ts')} AS date_id FROM events")
def date_key(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    return events.select("event_id", dates.date_key("ts").alias("date_id"))


@register("calendar_parts", """SELECT event_id, year(ts)::BIGINT AS "year", month(ts)::BIGINT AS "month",
  day(ts)::BIGINT AS "day" FROM events""")
def calendar_parts(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    parts = dates.calendar_parts("ts").items()
    return events.select("event_id", *[part.alias(name) for name, part in parts])


# Keys and hashes

@register("surrogate_key", f"SELECT doc_id, source, {sql.crc32('source')} AS source_id FROM documents")
def surrogate_key(spark, sf_dir):
    rows = inputs.table(spark, sf_dir, "documents")
    return rows.select("doc_id", "source", keys.surrogate_key("source").alias("source_id"))


@register("fact_uuid", f"""WITH {sql.RAW}
SELECT doc_id, {sql.message_key('text')} AS fact_id FROM raw WHERE text IS NOT NULL""")
def fact_uuid(spark, sf_dir):
    rows = inputs.raw_messages(spark, sf_dir).where(F.col("text").isNotNull())
    return rows.select("doc_id", keys.message_key("text").alias("fact_id"))


@register("hash_sample", f"""WITH {sql.RAW}
SELECT doc_id, text FROM raw WHERE {sql.slot('sha256(text)', rules.SAMPLE_ONE_IN)} = 0""")
def hash_sample(spark, sf_dir):
    sampled = keys.slot(keys.digest("text"), rules.SAMPLE_ONE_IN) == 0
    return inputs.raw_messages(spark, sf_dir).select("doc_id", "text").where(sampled)


# JSON

@register("json_encode", f"""WITH {sql.RAW}
SELECT doc_id, '{{' || concat_ws(',', '"source":' || to_json(source), '"text":' || to_json(text),
  '"created_at":' || to_json(created_at)) || '}}' AS value FROM raw""")
def json_encode(spark, sf_dir):
    rows = inputs.raw_messages(spark, sf_dir)
    return rows.select("doc_id", payload.encode_message().alias("value"))


@register("json_explode", f"""WITH {sql.TWEETS}
SELECT conv_id, turn, place::BIGINT AS place, text, full_text FROM tweets""")
def json_explode(spark, sf_dir):
    return feeds.explode_pages(inputs.tweet_pages(spark, sf_dir))
