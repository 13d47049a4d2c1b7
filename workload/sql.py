"""Building blocks of the check queries (DuckDB SQL over the given tables)."""

from __future__ import annotations

import functools
import pathlib

from textpulse import rules

RUN_TS = "TIMESTAMP '2024-02-01 00:00:00'"


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def crc32(text: str) -> str:
    """CRC-32 bit by bit, for ASCII text."""
    octets = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    step = "lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1))"
    fold = f"lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), {step})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), {fold}), 4294967295)"


def clean_for_scoring(text: str) -> str:
    no_links = rf"regexp_replace(coalesce({text}, ''), 'http\S+', '', 'g')"
    spaced = rf"regexp_replace({no_links}, '[^a-zA-Z0-9\s]', ' ', 'g')"
    return rf"trim(lower(regexp_replace({spaced}, '\s+', ' ', 'g')))"


def clean_for_training(text: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({text}), 'http\S+', '', 'g'), '[^a-z\s]', '', 'g')"


def word_count(clean: str) -> str:
    return f"CASE WHEN {clean} = '' THEN 0 ELSE len(string_split({clean}, ' ')) END::BIGINT"


def hashtag_count(text: str) -> str:
    parts = rf"regexp_split_to_array(coalesce({text}, ''), '\s+')"
    return f"len(list_filter({parts}, lambda w: starts_with(w, '#')))::BIGINT"


def topic(clean: str) -> str:
    cases = " ".join(
        f"WHEN list_has_any(string_split({clean}, ' '), [{quoted(words)}]) THEN '{name}'"
        for name, words in rules.TOPIC_RULES.items()
    )
    return f"CASE {cases} ELSE 'Other' END"


def contains_any(text: str) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in rules.WATCH_LIST) + ")"


def message_key(text: str) -> str:
    return (
        f"regexp_replace(sha256({text}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}}).*$',"
        r" '\1-\2-\3-\4-\5')"
    )


def slot(key: str, slots: int) -> str:
    return f"(('0x' || substr({key}, 1, 8))::BIGINT % {slots})"


def date_key(ts: str) -> str:
    return f"strftime({ts}, '%Y%m%d')::BIGINT"


def bucket(ts: str, grain: str) -> str:
    start = f"date_trunc('{grain.lower()}', {ts})::TIMESTAMP"
    return f"({start} + INTERVAL 6 DAY)" if grain == "Week" else start


@functools.cache
def stop_words() -> list[str]:
    """Spark's default English list, held as text beside this module."""
    lines = (pathlib.Path(__file__).parent / "stop_words.txt").read_text(encoding="utf-8").split("\n")
    return lines[1:]


RAW = """raw AS (
  SELECT doc_id, lang,
    CASE WHEN doc_id % 25 = 3 THEN NULL ELSE source END AS source,
    CASE WHEN doc_id % 40 = 1 THEN NULL WHEN doc_id % 40 = 2 THEN '' ELSE
      replace(text, ' the ', ' #the ')
      || CASE doc_id % 12 WHEN 0 THEN ' bitcoin wallet' WHEN 1 THEN ' python code'
           WHEN 2 THEN ' steam game' WHEN 3 THEN ' election law' WHEN 4 THEN ' film series' ELSE '' END
      || CASE WHEN doc_id % 7 = 0 THEN ' http://ex.org/' || doc_id % 5 ELSE '' END
    END AS text,
    CASE WHEN doc_id % 50 = 5 THEN 'not a date' ELSE
      strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id * 37 % 525600), '%Y-%m-%d %H:%M:%S')
    END AS created_at
  FROM documents)"""

CLASSES = """classes AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN 0.0 WHEN quality = 1 THEN 1.0 ELSE 2.0 END::DOUBLE
    AS prediction FROM labels)"""

LATEST = f"""{RAW},
latest AS (
  SELECT {message_key('text')} AS message_key, text AS id, doc_id % 4 AS batch_id, doc_id AS arrival,
    source, created_at, text
  FROM raw WHERE text IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id % 4 DESC, doc_id DESC) = 1)"""

PREPARED = f"""{LATEST},
cleaned AS (SELECT *, {clean_for_scoring('text')} AS clean_text FROM latest),
prepared AS (
  SELECT message_key, id, batch_id, arrival, coalesce(source, 'unknown') AS source, created_at,
    clean_text AS text, text AS raw_text, clean_text,
    try_cast(created_at AS TIMESTAMP) AS parsed_ts,
    coalesce(try_cast(created_at AS TIMESTAMP), {RUN_TS}) AS safe_ts,
    date_trunc('second', coalesce(try_cast(created_at AS TIMESTAMP), {RUN_TS}))::TIMESTAMP
      AS created_ts,
    {word_count('clean_text')} AS word_count, {hashtag_count('text')} AS hashtags_count,
    {topic('clean_text')} AS topic_name
  FROM cleaned)"""

SENTIMENT = "CASE prediction WHEN 0.0 THEN 'negative' WHEN 1.0 THEN 'positive' ELSE 'neutral' END"

FACTS = f"""{PREPARED}, {CLASSES},
scored AS (
  SELECT p.*, coalesce(c.prediction, 2.0) AS prediction
  FROM prepared p LEFT JOIN classes c ON p.arrival = c.doc_id),
facts AS (
  SELECT message_key AS fact_id, {crc32('source')} AS source_id,
    {crc32('topic_name')} AS topic_id, raw_text AS text, {SENTIMENT} AS sentiment_class,
    1.0::DOUBLE AS sentiment_score, word_count, hashtags_count, created_ts AS created_at,
    {date_key('created_ts')} AS date_id, source AS source_name, topic_name
  FROM scored)"""

DIMS = f"""
dim_source AS (SELECT {crc32('source_name')} AS source_id, source_name,
  'Social Network' AS source_type, {RUN_TS} AS load_dt
  FROM (SELECT DISTINCT source_name FROM facts)),
dim_topic AS (SELECT {crc32('topic_name')} AS topic_id, topic_name, {RUN_TS} AS load_dt
  FROM (SELECT DISTINCT topic_name FROM facts)),
dim_date AS (SELECT {date_key('date_value')} AS date_id, date_value::VARCHAR AS date_value,
  year(date_value)::BIGINT AS "year", month(date_value)::BIGINT AS "month",
  day(date_value)::BIGINT AS "day", {RUN_TS} AS load_dt
  FROM (SELECT DISTINCT created_at::DATE AS date_value FROM facts))"""

TRAINING = """training AS (
  SELECT doc_id AS id, source AS entity,
    CASE WHEN doc_id % 17 = 0 THEN 'Irrelevant' WHEN toxic = 1 THEN 'Negative'
      WHEN quality = 1 THEN 'Positive' ELSE 'Neutral' END AS sentiment,
    CASE WHEN doc_id % 19 = 0 THEN NULL ELSE text END AS text
  FROM documents JOIN labels USING (doc_id)),
usable AS (SELECT * FROM training
  WHERE text IS NOT NULL AND sentiment IS NOT NULL AND sentiment <> 'Irrelevant')"""

LABEL = "CASE sentiment WHEN 'Negative' THEN 0.0 WHEN 'Positive' THEN 1.0 ELSE 2.0 END::DOUBLE"

JUDGED = f"""{TRAINING},
judged AS (SELECT id, {LABEL} AS label,
  CASE WHEN id % 3 = 0 THEN (id % 2) * 2.0 ELSE {LABEL} END::DOUBLE AS prediction FROM usable)"""

CHANGES = """changes AS (
  SELECT doc_id, CASE WHEN lang = 'en' THEN 'en.wikipedia.org' ELSE 'de.wikipedia.org' END
      AS server_name,
    CASE WHEN doc_id % 9 = 0 THEN 'log' ELSE 'edit' END AS "type",
    CASE WHEN doc_id % 33 = 0 THEN NULL ELSE source END AS title,
    CASE WHEN doc_id % 21 = 0 THEN '' ELSE text END AS comment
  FROM documents),
edits AS (SELECT * FROM changes WHERE server_name = 'en.wikipedia.org' AND "type" = 'edit'
  AND comment <> '' AND title IS NOT NULL)"""

TWEETS = """tweets AS (
  SELECT conv_id, turn, 0 AS place, CASE WHEN turn % 2 = 0 THEN text ELSE '' END AS text,
    CASE WHEN turn % 2 = 1 AND turn <> 3 THEN text ELSE '' END AS full_text FROM conversations
  UNION ALL
  SELECT conv_id, turn, 1, NULL, role || ' ' || turn FROM conversations)"""

TWEET_TEXT = "coalesce(nullif(text, ''), nullif(full_text, ''), '')"

WIKI_MESSAGES = f"""SELECT 'Wikipedia (Filtered)' AS source,
  'Article [' || title || ']: ' || comment AS text, '2024-02-01 00:00:00' AS created_at
  FROM edits WHERE {contains_any("lower(title || ' ' || comment)")}"""

CSV_MESSAGES = """SELECT 'Twitter (Bitcoin Dataset)' AS source, text, created_at
  FROM raw WHERE length(text) >= 10"""

SEARCH_MESSAGES = f"""SELECT 'Twitter (Real)' AS source, {TWEET_TEXT} AS text,
  '2024-02-01 00:00:00' AS created_at FROM tweets WHERE {TWEET_TEXT} <> ''"""


def term_bucket(term: str, buckets: int = rules.HASH_BUCKETS) -> str:
    """Slot of a term: its 32-bit Murmur3 hash with seed 42, signed, modulo the number of slots."""

    def wrap(x: str) -> str:
        return f"(({x}) % 4294967296)"

    def turned(x: str, bits: int) -> str:
        return wrap(f"(({x}) << {bits}) | (({x}) >> {32 - bits})")

    def mixed(word: str) -> str:
        first = wrap(f"{word} * 3432918353::UBIGINT")
        return wrap(f"{turned(first, 15)} * 461845907::UBIGINT")

    def word_at(hexed: str) -> str:
        """Four bytes, lowest first; missing ones count as zero."""
        pairs = "".join(f" || substr(rpad({hexed}, 8, '0'), {at}, 2)" for at in (7, 5, 3, 1))
        return f"('0x'{pairs})::UBIGINT"

    hexed = f"hex(encode({term}))"
    whole = f"(length({hexed}) // 8)"
    words = f"list_transform(range(0, {whole}), lambda i: {mixed(word_at(f'substr({hexed}, i * 8 + 1, 8)'))})"
    step = wrap(f"{turned('xor(h, k)', 13)} * 5 + 3864292196::UBIGINT")
    body = f"list_reduce({words}, lambda h, k: {step}, 42::UBIGINT)"
    tail = mixed(word_at(f"substr({hexed}, {whole} * 8 + 1)"))

    def spread(x: str, shift: int, factor: int) -> str:
        return wrap(f"xor({x}, ({x}) >> {shift}) * {factor}::UBIGINT")

    # One list per step, so that each value is worked out once.
    chain = f"[xor(xor({body}, {tail}), (length({hexed}) // 2)::UBIGINT)]"
    for shift, factor in ((16, 2246822507), (13, 3266489909), (16, 1)):
        chain = f"list_transform({chain}, lambda x: {spread('x', shift, factor)})"
    signed = f"list_transform({chain}, lambda x: CASE WHEN x >= 2147483648 THEN x::BIGINT - 4294967296 ELSE x::BIGINT END)[1]"
    return f"((({signed} % {buckets}) + {buckets}) % {buckets})"


def _tokens(text: str) -> str:
    return rf"""list_filter(regexp_split_to_array({clean_for_training(text)}, '\s+'),
  lambda t: length(t) >= 1 AND NOT list_contains([{quoted(stop_words())}], t))"""


def term_counts() -> str:
    """``term_counts(id, label, bucket, tf)`` of the usable training rows, terms hashed once each; needs TRAINING."""
    return rf"""texts AS (SELECT id, {LABEL} AS label, {slot('sha256(text)', 100)} < 80 AS in_training,
  {_tokens('text')} AS tokens FROM usable),
words AS (SELECT id, label, unnest(tokens) AS term FROM texts),
buckets AS (SELECT term, {term_bucket('term')} AS bucket FROM (SELECT DISTINCT term FROM words)),
term_counts AS (SELECT id, label, bucket, count(*) AS tf FROM words JOIN buckets USING (term) GROUP BY ALL)"""


def message_terms() -> str:
    """``message_texts(id)`` and ``message_counts(id, bucket, tf)`` of the current messages; needs LATEST."""
    return rf"""message_texts AS (SELECT message_key AS id, {_tokens('text')} AS tokens FROM latest),
message_words AS (SELECT id, unnest(tokens) AS term FROM message_texts),
message_buckets AS (SELECT term, {term_bucket('term')} AS bucket FROM (SELECT DISTINCT term FROM message_words)),
message_counts AS (SELECT id, bucket, count(*) AS tf FROM message_words JOIN message_buckets USING (term) GROUP BY ALL)"""


def count_weights() -> str:
    """``weights(bucket, class, weight)`` by counting terms of the training part; constants at bucket -1."""
    n = rules.HASH_BUCKETS
    return rf"""{TRAINING}, {term_counts()},
part AS (SELECT label, len(tokens) AS terms FROM texts WHERE in_training),
per_class AS (SELECT label, count(*) AS row_count, sum(terms) AS terms FROM part GROUP BY label),
class_counts AS (SELECT label, bucket, sum(tf) AS tf FROM term_counts
  JOIN texts USING (id, label) WHERE in_training GROUP BY ALL),
weights AS (
  SELECT s.bucket, label::BIGINT AS class, ln((coalesce(tf, 0) + 1) / (terms + {n})) AS weight
  FROM per_class CROSS JOIN range({n}) s(bucket) LEFT JOIN class_counts USING (label, bucket)
  UNION ALL
  SELECT -1, label::BIGINT, ln(row_count / (SELECT sum(row_count) FROM per_class)) FROM per_class)"""


def classified(texts: str, counts: str = "term_counts") -> str:
    """``predicted(id, prediction)`` of texts with term counts, by ``weights``."""
    return rf"""margins AS (
  SELECT id, class, sum(weight) AS margin FROM (
    SELECT id, class, tf * weight AS weight FROM {counts} JOIN weights USING (bucket)
    UNION ALL SELECT id, class, weight FROM {texts}, weights WHERE bucket = -1) GROUP BY ALL),
predicted AS (SELECT id, class::DOUBLE AS prediction FROM margins
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY margin DESC, class) = 1)"""
