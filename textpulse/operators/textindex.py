"""An index for substring search: which three-letter strings the texts of each fact folder hold.

Folders of facts never change, so an index of one is written once. ``build`` catches up on the folders that have none,
at any time; a search opens the indexed folders that hold all three-letter strings of its keyword, and every folder that
is not indexed yet. The rows found are tested as without an index, so it never adds a match and never loses one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textpulse import schemas, storage
from textpulse.sources.warehouse import FACTS, Folder, Warehouse

GRAMS, RUNS = "fact_grams", "fact_grams_runs"
_HELD = StructType([StructField("gram", StringType()), StructField("load", StringType()), StructField("date_id", LongType())])


def grams(text: Column) -> Column:
    """The distinct strings of three characters in a lower-cased text; none where it is shorter or null."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(...))."), F.lit(1)))


def _indexed(warehouse: Warehouse) -> dict[Folder, str]:
    """The run that indexed each folder, newest versions' folders or not."""
    base, held = warehouse.path(RUNS), {}
    for name in storage.names(warehouse.spark, base):
        if not name.startswith("_"):
            for load, day in json.loads(storage.read_text(warehouse.spark, f"{base}/{name}")):
                held[load, day] = name
    return held


def build(warehouse: Warehouse) -> int:
    """Indexes the fact folders that are not yet; how many these were. Cut short, it leaves nothing that is read.

    Strings are made distinct in each task before the shuffle: a folder sends each of them once per task.
    """
    known = _indexed(warehouse)
    wanted = [f for f in warehouse.version().folders.get(FACTS, ()) if f not in known]
    if not wanted:
        return 0
    run = uuid.uuid4().hex
    facts = warehouse.folders_of_facts(wanted)
    held = facts.select("load", "date_id", F.explode(grams(F.col("text"))).alias("gram")).distinct()
    laid_out = held.hint("rebalance", "load", "date_id").sortWithinPartitions("load", "date_id", "gram")
    laid_out.write.mode("errorifexists").partitionBy("load", "date_id").parquet(f"{warehouse.path(GRAMS)}/run={run}")
    storage.write_new_text(warehouse.spark, f"{warehouse.path(RUNS)}/{run}", json.dumps(wanted))
    return len(wanted)


def candidates(warehouse: Warehouse, keyword: str) -> list[Folder]:
    """The fact folders that may hold ``keyword``, in any case: all of them for keywords under three characters. The
    driver sees one row for each folder that holds all its strings."""
    every = list(warehouse.version().folders.get(FACTS, ()))
    spark = warehouse.spark
    # Spark lower-cases the keyword as it does the texts.
    wanted = spark.range(1).select(grams(F.lit(keyword))).first()[0]
    known = _indexed(warehouse)
    runs = sorted({known[f] for f in every if f in known})
    if not wanted or not runs:
        return every
    base = warehouse.path(GRAMS)
    rows = spark.read.schema(_HELD).option("basePath", base).parquet(*[f"{base}/run={run}" for run in runs])
    found = rows.where(F.col("gram").isin(wanted)).groupBy("load", "date_id").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(wanted))
    holding = {(row["load"], row["date_id"]) for row in found.collect()}
    return [f for f in every if f not in known or f in holding]


def searched(warehouse: Warehouse, keyword: str) -> DataFrame:
    """The facts of the candidate folders; ``Criteria`` with the keyword still has to be applied."""
    return warehouse.folders_of_facts(candidates(warehouse, keyword)).select(*schemas.FACT.names)
