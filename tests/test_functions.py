"""Scalar functions: hand-made edge cases, and random texts against slow plain-Python checks."""

import hashlib
import random
import uuid
import zlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from textpulse import rules
from textpulse.functions import dates, keys, payload, text


def column(spark, values, expression, schema="n int, v string"):
    rows = spark.createDataFrame(list(enumerate(values)), schema)
    return [r[0] for r in rows.orderBy("n").select(expression).collect()]


EDGE_CASES = [  # text, cleaned for scoring, words, hashtags
    (None, "", 0, 0),
    ("", "", 0, 0),
    ("   ", "", 0, 0),
    ("See HTTP://A.B http://x.y/z end", "see http a b end", 5, 0),
    ("#Two!! it's #", "two it s", 3, 2),
    ("a#b ##x", "a b x", 3, 1),
    ("été #un", "t un", 2, 1),
    ("http://a z", "z", 1, 0),
    ("http://a\x1cz #\x1d#q", "z q", 2, 2),
    ("KKİi", "k i", 2, 0),
    ("line\nbreak\ttab\x0bvt", "line break tab vt", 4, 0),
    ("http", "http", 1, 0),
    (" #wide　#space", "wide space", 2, 2),
]


def test_edge_cases(spark):
    raw = [case[0] for case in EDGE_CASES]
    assert column(spark, raw, text.clean_for_scoring("v")) == [c[1] for c in EDGE_CASES]
    assert column(spark, raw, text.word_count(text.clean_for_scoring("v"))) == [c[2] for c in EDGE_CASES]
    assert column(spark, raw, text.hashtag_count("v")) == [c[3] for c in EDGE_CASES]


def slow_clean(raw):
    """Character by character: links end at white space, other runs become one space."""
    kept, i = [], 0
    while i < len(raw):
        if raw.startswith("http", i) and i + 4 < len(raw) and not raw[i + 4].isspace():
            i += 4
            while i < len(raw) and not raw[i].isspace():
                i += 1
        else:
            kept.append(raw[i] if raw[i].isascii() and raw[i].isalnum() else " ")
            i += 1
    return " ".join("".join(kept).lower().split())


def slow_topic(clean):
    found = set(clean.split())
    return next((t for t, words in rules.TOPIC_RULES.items() if found & set(words)), "Other")


@pytest.fixture(scope="module")
def random_texts():
    rng = random.Random(7)
    alphabet = list("abzAZ09 #.'-_/") + ["http", "https://", " ai ", "btc", " film", "é", "İ", "K"] + [
        chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x3000, 0x200B)
    ]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(3000)]


def test_random_texts(spark, random_texts):
    cleaned = [slow_clean(t) for t in random_texts]
    assert column(spark, random_texts, text.clean_for_scoring("v")) == cleaned
    assert column(spark, random_texts, text.hashtag_count("v")) == [
        sum(token[0] == "#" for token in t.split()) for t in random_texts
    ]
    words = text.words(text.clean_for_scoring("v"))
    assert column(spark, random_texts, text.topic_of(words)) == [slow_topic(c) for c in cleaned]
    assert column(spark, random_texts, text.word_count(text.clean_for_scoring("v"))) == [
        len(c.split()) for c in cleaned
    ]


@pytest.mark.parametrize(
    "raw, topic",
    [
        ("he said so", "Other"),
        ("ai", "AI & Tech"),
        ("watch bitcoin", "Crypto"),
        ("watch the news", "Politics"),
        ("ends with film", "Movies & TV"),
        ("bitcoins aix", "Other"),
        (None, "Other"),
    ],
)
def test_topic(spark, raw, topic):
    words = text.words(text.clean_for_scoring("v"))
    assert column(spark, [raw], text.topic_of(words)) == [topic]


def test_clean_for_training(spark):
    raw = ["Don't  5 http://x", "A-b C", None]
    assert column(spark, raw, text.clean_for_training("v")) == ["dont   ", "ab c", None]


def test_watch_list_is_substring(spark):
    raw = ["he said so", "quite the opposite", "THE WARDEN".lower(), "nothing here"]
    assert column(spark, raw, text.contains_any("v")) == [True, False, True, False]
    joined = [any(w in t for w in rules.WATCH_LIST) for t in raw]
    assert column(spark, raw, text.contains_any("v")) == joined
    assert len(rules.WATCH_LIST) == 41


def test_keyword_search_takes_wildcards_literally(spark):
    raw = ["100% sure", "100 sure", "a_b", "axb", "back\\slash", "CRISIS now"]
    assert column(spark, raw, text.contains_ignoring_case("v", "100%")) == [True] + [False] * 5
    assert column(spark, raw, text.contains_ignoring_case("v", "A_B"))[2:4] == [True, False]
    assert column(spark, raw, text.contains_ignoring_case("v", "\\"))[4]
    assert column(spark, raw, text.contains_ignoring_case("v", "crisis"))[5]


def test_first_nonempty(spark):
    rows = spark.createDataFrame(
        [("a", "b"), ("", "b"), (None, "b"), ("", ""), (None, None), ("", None)], "x string, y string"
    )
    got = [r[0] for r in rows.select(text.first_nonempty("x", "y")).collect()]
    assert got == ["a", "b", "b", "", "", ""]


def test_tokens_and_stop_words(spark):
    raw = ["  The cat  and THE hat cat ", "", "a"]
    assert column(spark, raw, text.tokens("v")) == [["the", "cat", "and", "the", "hat", "cat"], [], ["a"]]
    kept = text.without_stop_words(text.tokens("v"), ["THE", "and", "a"])
    assert column(spark, raw, kept) == [["cat", "hat", "cat"], [], []]


def test_safe_timestamp(spark):
    raw = ["2024-03-01 10:11:12", "2024-03-01T10:11:12.5", "2024-03-01", "not a date", "", None]
    safe = dates.safe_timestamp("v", "2024-02-01 00:00:00").cast("string")
    assert column(spark, raw, safe) == [
        "2024-03-01 10:11:12", "2024-03-01 10:11:12.5", "2024-03-01 00:00:00",
        "2024-02-01 00:00:00", "2024-02-01 00:00:00", "2024-02-01 00:00:00",
    ]


@pytest.mark.parametrize(
    "moment, sunday",
    [
        ("2024-01-01 00:00:00", "2024-01-07"),
        ("2024-01-07 23:59:59", "2024-01-07"),
        ("2024-01-08 00:00:00", "2024-01-14"),
        ("2023-12-31 12:00:00", "2023-12-31"),
    ],
)
def test_week_is_named_after_its_sunday(spark, moment, sunday):
    bucket = dates.time_bucket(F.col("v").cast("timestamp"), "Week").cast("date")
    assert column(spark, [moment], bucket) == [date.fromisoformat(sunday)]


def test_date_key(spark):
    key = dates.date_key(F.col("v").cast("timestamp"))
    assert column(spark, ["2024-01-09 23:59:59", "0999-12-01 00:00:00"], key) == [20240109, 9991201]


def test_keys(spark):
    names = ["src0", "unknown", "AI & Tech", "Ünïcode"]
    assert column(spark, names, keys.surrogate_key("v")) == [zlib.crc32(n.encode()) for n in names]
    ids = column(spark, names, keys.message_key("v"))
    assert ids == [str(uuid.UUID(hashlib.sha256(n.encode()).hexdigest()[:32])) for n in names]
    assert column(spark, [None], keys.message_key("v")) == [None]
    slots = column(spark, [f"t{i}" for i in range(5000)], keys.slot(keys.message_key("v"), 100))
    assert min(slots) == 0 and max(slots) == 99 and 20 < slots.count(7) < 90


def test_json_round_trip(spark):
    rows = [("s", 'quote " slash / \\ line\n tab\t é  ', "t"), (None, None, None), ("", "", "")]
    messages = spark.createDataFrame(rows, "source string, text string, created_at string")
    decoded = messages.select(payload.encode_message().alias("v")).select(payload.decode("v"))
    assert [tuple(r) for r in decoded.collect()] == rows


def test_bad_json_gives_nulls(spark):
    values = [("not json",), ("{",), ("[]",), (None,), ('{"text": 5}',)]
    decoded = spark.createDataFrame(values, "v string").select("v", payload.decode("v")).collect()
    assert {r.v: r.text for r in decoded} == {**{v[0]: None for v in values[:4]}, '{"text": 5}': "5"}


def test_within_days_is_whole_days(spark):
    moments = ["2024-01-02 23:59:59", "2024-01-03 00:00:00", "2024-01-05 23:59:59", "2024-01-06 00:00:00"]
    rows = spark.createDataFrame([(datetime.fromisoformat(m),) for m in moments], "t timestamp_ntz")
    rows = rows.select(F.col("t").cast("timestamp").alias("created_at"))
    rows = rows.withColumn("date_id", dates.date_key("created_at"))
    kept = rows.where(dates.within_days(date(2024, 1, 3), date(2024, 1, 5)))
    assert [r[0] for r in kept.select(F.col("created_at").cast("string")).collect()] == moments[1:3]
