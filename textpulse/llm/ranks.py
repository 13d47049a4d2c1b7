"""Running sums over a whole table without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_start(
    rows: DataFrame, group: list[str], bucket: str, order: list[Column], value: Column, out: str
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before, inside ``group``.

    Rows are ordered by ``bucket``, then ``order``. Buckets of a group are summed first (before the
    shuffle) and run up over that short table; rows only run up inside their own bucket, so a group
    that holds a third of all rows is spread over its buckets. Group and bucket hold no nulls.
    """
    keys = [*group, bucket]
    sized = rows.withColumn("_value", value.cast("bigint"))
    totals = sized.groupBy(*keys).agg(F.sum("_value").alias("_total"))
    ahead = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return (
        placed.join(totals, keys)
        .withColumn(out, F.col("_inside") + F.col("_ahead"))
        .drop("_inside", "_ahead", "_value")
    )


def id_buckets(rows: DataFrame, key: str, per_bucket: int) -> Callable[[Column], Column]:
    """Function from a long column to its bucket number: equal ranges of the ids in ``rows[key]``, with
    ``per_bucket`` rows each on average, in id order; nulls come first."""
    seen = rows.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, hi = (seen["lo"], seen["hi"]) if seen["lo"] is not None else (0, 0)
    buckets = max(1, -(-seen["n"] // per_bucket))
    width = max(1, -(-(hi - lo + 1) // buckets))

    def bucket(column: Column) -> Column:
        offset = column.cast("decimal(20,0)") - F.lit(lo).cast("decimal(20,0)")
        number = F.floor(offset / F.lit(width).cast("decimal(20,0)")).cast("bigint")
        return F.coalesce(number, F.lit(-1).cast("bigint"))

    return bucket
