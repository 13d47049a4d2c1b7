"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse import storage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _contract(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step. ``links`` hold a > b and come out that way.

    Minima are summed up before the shuffle, so a node with a third of all links sends one row per
    task; the join back is split by AQE where a node is hot.
    """
    sides = _both_ways(links)
    least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (
        sides.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    return small.unionByName(least.withColumnRenamed("m", "b")).distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; the component is its smallest node.

    Nodes are any ordered type without nulls; loops and repeated links may occur; no links give no rows.
    Each round is written to the shared folder, which cuts the lineage and outlives executors. Rounds
    grow with the logarithm of the longest chain; the driver sees one count and one sum a round.
    """
    spark = links.sparkSession
    current = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    seen = None
    while True:
        current = storage.materialize(current, storage.fresh_dir(spark, "links"))
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        if state == seen or state["n"] == 0:
            break
        seen, current = state, _contract(current)
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
