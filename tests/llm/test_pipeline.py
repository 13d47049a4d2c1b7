"""The corpus pipeline and the registered queries."""

import pytest

import corpus_pipeline
from textpulse import storage
from textpulse.llm import passages, queries, simhash


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    seen = {}
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        out = storage.materialize(stage(spark, rows, sf_dir), storage.fresh_dir(spark, "test"))
        seen[name] = (rows, out)
        rows = out
    for name in list(seen)[:-1]:
        assert seen[name][1].columns == docs.columns
    before, after = seen["quality classifier"]
    wanted = passages.quality_report(before, labels).where("predicted = 1").count()
    assert after.count() == wanted
    lost = before.join(labels.where("quality = 1"), "doc_id", "left_semi").join(after, "doc_id", "left_anti")
    assert lost.count() == 0
    before, after = seen["simhash near-dedup"]
    groups = simhash.near_duplicates(before).select("component_id").distinct()
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in groups.collect()}
    before, after = seen["suffix-array dedup"]
    assert after.count() == before.count()
    texts = {r.doc_id: r.text for r in before.collect()}
    shorter = [r for r in after.collect() if len(r.text) < len(texts[r.doc_id])]
    assert shorter and all(len(r.text) == r.n_chars for r in shorter)
    before, after = seen["sentencepiece"]
    assert after.count() == before.count() and set(after.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_one_query_for_each_operator():
    assert sorted(k.split("_")[0] for k in queries.QUERIES) == sorted([*[f"op{n}" for n in range(1, 14)], "pipeline"])


@pytest.mark.parametrize("number", [2, 3, 5, 7])
def test_native_queries_run_no_python_and_no_cross_joins(spark, sf_dir, number):
    key = next(k for k in queries.QUERIES if k.startswith(f"op{number}_"))
    plan = queries.QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for bad in ("EvalPython", "MapInPandas", "MapInArrow", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
