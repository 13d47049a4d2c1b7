"""Idempotent additions to the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.sources.warehouse import FACTS, Change, Warehouse


def require_own_keys(rows: DataFrame, table: str, surrogate: str, name: str) -> None:
    """Raises where two names share a surrogate key: facts would join to both."""
    names = rows.groupBy(surrogate).agg(F.min(name).alias("one"), F.max(name).alias("other"))
    clash = names.where(F.col("one") != F.col("other")).first()
    if clash:
        raise ValueError(
            f"{table}: {clash['one']!r} and {clash['other']!r} have one key, {clash[surrogate]}; rename one of them"
        )


def add_dimension(change: Change, table: str, rows: DataFrame, key: str) -> None:
    """Adds the rows whose ``key`` the table lacks; fails before it writes where two names have one id."""
    held = change.held.table(table)
    surrogate = held.columns[0]
    if key != surrogate:
        both = held.select(surrogate, key).unionByName(rows.select(surrogate, key))
        require_own_keys(both, table, surrogate, key)
    missing = rows.join(held.select(key), key, "left_anti").select(*held.columns)
    if change.crowded(table):
        change.add(table, held.unionByName(missing), instead=True)
    else:
        change.add(table, missing)


def append_dimension(warehouse: Warehouse, table: str, rows: DataFrame, key: str) -> None:
    """``add_dimension`` as a version of its own."""
    change = Change(warehouse)
    add_dimension(change, table, rows, key)
    change.publish()


def add_facts(change: Change, facts: DataFrame, gone: DataFrame) -> None:
    """New facts, without those in ``gone`` (fact_id, date_id), which have moved to another day, source or time.

    Only the days that lose facts are written anew, and those in very many folders; other days get one more folder.
    Days are sorted for min/max skipping. The rebalance lets AQE split a day that holds much of the load over many
    tasks, and merge small days, so neither one huge task nor a file per task and day comes out. The driver sees
    numbers of days, of which there are as many as the table has at most.
    """
    anew = {row["date_id"] for row in gone.select("date_id").distinct().collect()}
    crowded = change.crowded(FACTS)
    if crowded:
        anew |= crowded.intersection(row["date_id"] for row in facts.select("date_id").distinct().collect())
    if anew:
        held = change.held.facts.where(F.col("date_id").isin(sorted(anew)))
        facts = facts.unionByName(held.join(gone.select("fact_id"), "fact_id", "left_anti"))
    laid_out = facts.hint("rebalance", "date_id").sortWithinPartitions("date_id", "source_id", "fact_id")
    change.add_facts(laid_out, anew)
