"""Registered queries of the corpus operators: each reads its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from textpulse.llm import (
    alignment,
    byte_pairs,
    imatch,
    licenses,
    mixing,
    neighbours,
    passages,
    piece_table,
    pieces,
    quotes,
    repeats,
    sharding,
    simhash,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _register(key: str, table: str, operator: Callable[[DataFrame], DataFrame], oracle: str | None = None) -> None:
    QUERIES[key] = lambda spark, sf_dir: operator(_table(spark, sf_dir, table))
    if oracle:
        ORACLES[key] = oracle


_register("op1_simhash_pigeonring", "documents", simhash.near_duplicates)
_register("op2_quotation_linking", "conversations", quotes.link_quotes)
_register("op3_jump_hash_sharding", "documents", sharding.shard_documents, sharding.ORACLE)
_register("op5_block_mixing", "documents", mixing.mix_report)
_register("op7_license_sentences", "documents", licenses.scan)
_register("op4_sentencepiece_agenda", "documents", pieces.digests)
_register("op9_imatch_lexicons", "documents", imatch.edited_report)
_register("op6_prefix_free_repeats", "documents", repeats.removal_report)


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES["op10_attention_quality"] = _quality
_register("op8_nn_descent", "embeddings", neighbours.near_duplicates)
_register("op11_exact_text_alignment", "documents", alignment.alignment_report)
_register("op12_piece_table_fim", "documents", piece_table.fim_report, piece_table.ORACLE)
_register("op13_byte_pair_tree", "documents", byte_pairs.digests)
QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
