"""The quality classifier: no caps, the same scores in every run, defined results for odd tables."""

import numpy as np

from textpulse.llm import passages

SCHEMA = "doc_id long, text string, source string, score string"


def table(spark, rows, parts):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def test_scores_do_not_depend_on_order_or_repeats(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = [(r.doc_id, r.text, r.source, "x") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    hot = docs[0]
    repeated = docs + [hot] * 400 + [(docs[5][0], "another text of this id", None, "y"), (docs[6][0], None, None, "y")]
    runs = [
        passages.quality_report(table(spark, rows, parts), labels)
        for rows, parts in ((repeated, 3), (repeated[::-1], 7))
    ]
    one, other = (sorted(map(tuple, r.collect()), key=str) for r in runs)
    assert one == other and len(one) == len(repeated)


def test_long_texts_are_read_whole():
    rng = np.random.default_rng(1)
    words = [f"w{n}" for n in rng.integers(0, 40_000, 100_000)]
    found = passages.passages(" ".join(words))
    assert len(found) == -(-100_000 // passages.PASSAGE_WORDS)
    again = passages.passages(" ".join(words + words))[len(found) + 1 :, -4]
    assert again.min() > 0.9 and found[:, -4].max() < 0.4


def test_empty_tables_and_no_labels(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    none = table(spark, [], 2)
    assert passages.quality_report(none, labels).collect() == []
    kept = passages.accepted(none, labels)
    assert kept.columns == none.columns and kept.collect() == []
    odd = table(spark, [(None, None, None, None), (1, "", "s", "x"), (1, "", "s", "x"), (2, "a " * 50_000, "s", "x")], 2)
    assert [r.score for r in passages.quality_report(odd, labels.limit(0)).collect()] == [0.5] * 4
    assert passages.accepted(odd, labels.limit(0)).count() == 4
