"""Substring search by three-letter strings: no match lost, few folders opened."""

import pytest
from pyspark.sql import functions as F

from textpulse.operators import textindex
from textpulse.operators.star import Criteria, Star
from textpulse.sources.warehouse import Warehouse

from test_warehouse import load, write_batch


@pytest.fixture(scope="module")
def target(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("star")
    log, held = f"{root}/log", Warehouse(spark, f"{root}/star").create()
    rows = [(f"word{day} day Bitcoin {'ab' if day % 2 else 'ÄÖÜ'}", "s", f"2024-01-{day:02d} 10:00:00") for day in range(1, 21)]
    write_batch(spark, log, 0, [*rows, ("x\nYz 100%_sure 😀b", "s", "2024-01-21 10:00:00"), ("ok", "s", "2024-01-22 10:00:00")])
    load(spark, log, held)
    return log, held


def found(star, keyword):
    return sorted(r.text for r in star.narrowed(Criteria(keyword=keyword)).collect())


KEYWORDS = ["word7", "WORD1", "bitcoin", "äöü", "ab", "x", "", "100%_S", "x\ny", "😀b", "e 😀", "nowhere", "day", "ok", "rd7 day b"]


def test_no_match_is_lost_before_and_after_building(spark, target):
    log, held = target
    for built in (False, True, True):
        if built:
            textindex.build(held)
        for keyword in KEYWORDS:
            assert found(Star.searching(held, keyword), keyword) == found(Star.of(held), keyword)
    assert textindex.build(held) == 0


def test_only_folders_that_hold_the_keyword_are_opened(spark, target):
    _, held = target
    textindex.build(held)
    every = len(held.version().folders["fact_sentiment"])
    assert every == 22
    assert len(textindex.candidates(held, "word7")) == 1
    assert len(textindex.candidates(held, "word1")) == 11
    assert textindex.candidates(held, "nowhere") == [] and Star.searching(held, "nowhere").facts.isEmpty()
    assert len(textindex.candidates(held, "ab")) == every
    files = Star.searching(held, "word7").narrowed(Criteria(keyword="word7")).inputFiles()
    assert {f.split("date_id=")[1].split("/")[0] for f in files} == {"20240107"}


def test_new_folders_are_searched_before_they_are_indexed(spark, target):
    log, held = target
    textindex.build(held)
    write_batch(spark, log, 1, [("late word7", "s", "2024-01-07 12:00:00"), ("other", "s", "2024-01-09 12:00:00")])
    load(spark, log, held)
    assert len(found(Star.searching(held, "word7"), "word7")) == 2
    assert len(textindex.candidates(held, "word7")) == 3
    assert textindex.build(held) == 2
    assert len(textindex.candidates(held, "word7")) == 2
    assert found(Star.searching(held, "word7"), "WORD7") == found(Star.of(held), "WORD7")


def test_strings_of_long_and_odd_texts(spark):
    texts = ["", "ab", None, "abcabcabc", "A\nB\tc", "😀😀😀x"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", textindex.grams(F.col("text")).alias("g"))
    for row in rows.collect():
        low = (row.text or "").lower()
        assert sorted(row.g or []) == sorted({low[i : i + 3] for i in range(len(low) - 2)})
    long = spark.range(1).select(F.repeat(F.lit("abcdefgh "), 200_000).alias("text"))
    assert long.select(F.size(textindex.grams(F.col("text")))).first()[0] == 9
