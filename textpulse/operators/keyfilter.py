"""Bloom filters over fact ids, one for each fact folder, as rows.

A filter of 2^level words of 64 bits sets MASK_BITS bits of a single word for each id, so looking an id up is an equal
join on the word, and building a filter is a sum by bit-or that combines before its shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At 32 bits an id and eight of them set, about one unknown id in 20,000 finds a word that answers.
BITS_PER_KEY, MASK_BITS = 32, 8


def _word(key: Column, level: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), level) - 1)


def _mask(key: Column) -> Column:
    bits = F.xxhash64(key, F.lit("mask"))
    one = F.lit(1).cast("bigint")
    places = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(MASK_BITS)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, place) for place in places])


def filters(facts: DataFrame) -> DataFrame:
    """(date_id, level, word, bits): a filter for each day of ``facts(fact_id, date_id, ...)``, sized by its ids."""
    words = F.greatest(F.col("n") * BITS_PER_KEY / 64, F.lit(1.0))
    sizes = facts.groupBy("date_id").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("date_id", F.ceil(F.log2(words)).cast("int").alias("level"))
    key = F.col("fact_id")
    placed = facts.select("date_id", "fact_id").join(sizes, "date_id")
    placed = placed.select("date_id", "level", _word(key, F.col("level")).alias("word"), _mask(key).alias("mask"))
    return placed.groupBy("date_id", "level", "word").agg(F.bit_or("mask").alias("bits"))


def answering(held: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """(key, date_id) where the day's filter says the key may be there; no day that holds a key is left out.

    A word of one level comes once from each folder of that level, so no join key gathers more rows than there are
    folders. The driver sees the levels in use, 64 at most.
    """
    levels = [row["level"] for row in held.select("level").distinct().collect()]
    if not levels:
        return keys.select(key).limit(0).withColumn("date_id", F.lit(None).cast("bigint"))
    asked = keys.select(key).distinct().withColumn("level", F.explode(F.array(*map(F.lit, sorted(levels)))))
    asked = asked.withColumns({"word": _word(F.col(key), F.col("level")), "mask": _mask(F.col(key))})
    met = held.join(asked, ["level", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    return met.select(key, "date_id").distinct()
