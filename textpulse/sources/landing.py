"""Landing of large CSV files whose quoted fields hold line breaks, with many tasks for one file.

Files are read as lines in byte ranges. Whether a line starts inside quotes depends on all lines before it, but what a
line does to that state does not: it keeps it, turns it, or ends it one way whatever came before. So ranges are worked
out side by side, one small row per range carries the state along the file, and lines then know whether they start a
record. Only records of several lines are put together; the others stay where they are.

Quoting is that of Spark's reader with ``escape='"'``: a field is quoted if it starts with a quote, two quotes inside
stand for one, and after the closing quote the field goes on to the next delimiter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textpulse import storage

# From a place outside quotes: a stretch in quotes, the rest of a field, a delimiter. What this leaves over starts with
# a quote that nothing closes.
_OUTSIDE = r'\G(?:"[^"]*+"|[^",][^,]*+|,)'


def _quotes(line: Column) -> Column:
    return F.contains(line, F.lit('"'))


def _left_open(line: Column) -> Column:
    """Whether a line that starts outside quotes ends inside them. Lines without a quote skip the regex."""
    return F.when(_quotes(line), F.regexp_replace(line, _OUTSIDE, "") != "").otherwise(False)


def _with_state(rows: DataFrame, order: str, by: list[str]) -> DataFrame:
    """``rows`` say how they end (``ends_outside``, ``ends_inside``) for either state they may start in. Adds ``before``
    and ``after`` (outside, inside): the state at a row's start and end for either state at the start of its group.
    The last row that ends one way whatever came before it decides, turned once by each row since that turns."""
    ordered = Window.partitionBy(*by).orderBy(order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("ends_outside") & ~F.col("ends_inside")).cast("bigint")
    settled = F.when(
        F.col("ends_outside") == F.col("ends_inside"),
        F.struct(F.col("ends_outside").alias("state"), F.col("_turns").alias("turns")),
    )
    known = rows.withColumn("_turns", F.sum(turns).over(upto)).withColumns({
        "_settled": F.last(settled, ignorenulls=True).over(before),
        "_turned": F.coalesce(F.sum(turns).over(before), F.lit(0)),
    })
    odd = (F.col("_turned") - F.coalesce("_settled.turns", F.lit(0))) % 2 == 1

    def start(state: bool) -> Column:
        return F.coalesce("_settled.state", F.lit(state)) != odd

    def end(state: str) -> Column:
        return F.when(F.col(f"before.{state}"), F.col("ends_inside")).otherwise(F.col("ends_outside")).alias(state)

    stated = known.withColumn("before", F.struct(start(False).alias("outside"), start(True).alias("inside")))
    return stated.withColumn("after", F.struct(end("outside"), end("inside"))).drop("_turns", "_settled", "_turned")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, range, place, line): lines end at line feeds; ``range`` is where the byte range of the line's start begins,
    ``place`` grows along it."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )


def records(read: DataFrame, header: bool = False) -> DataFrame:
    """(file, range, place, record) of ``lines``, range and place being those of the record's first line. Blank records
    are left out, a carriage return at a record's end goes. A quote that is never closed makes the rest of its file one
    record, as it does for Spark's reader. ``header``: without the first record of each file.

    Texts are shuffled twice: by range, and those of several lines by record. What is known of each range and file is
    a row or two, and written, so that Spark sees its size and lines meet it where they are.
    """
    spark = read.sparkSession
    known = read.withColumns({
        "ends_outside": _left_open(F.col("line")),
        "ends_inside": F.when(_quotes(F.col("line")), _left_open(F.concat(F.lit('"'), F.col("line")))).otherwise(True),
    })
    upto = Window.partitionBy("file", "range").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    # The last line up to here that starts a record, for either state at the start of the range.
    starts = {
        f"start_{state}": F.max(F.when(~F.col(f"before.{state}"), F.col("place"))).over(upto)
        for state in ("outside", "inside")
    }
    stated = _with_state(known, "place", ["file", "range"]).withColumns(starts)
    stated = storage.materialize(stated, storage.fresh_dir(spark, "lines"), **storage.TEXT_CODEC)

    # One row per range: the state along each file.
    by_range = stated.groupBy("file", "range").agg(
        F.max_by("after", "place").alias("after"),
        F.max("start_outside").alias("start_outside"),
        F.max("start_inside").alias("start_inside"),
    ).select("*", F.col("after.outside").alias("ends_outside"), F.col("after.inside").alias("ends_inside")).drop("after")
    along = _with_state(by_range, "range", ["file"]).select(
        "file", "range", F.col("before.outside").alias("inside"),
        F.when(F.col("before.outside"), F.col("start_inside")).otherwise(F.col("start_outside")).alias("last_start"),
    )
    earlier = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.last(F.when(F.col("last_start").isNotNull(), F.struct("range", F.col("last_start").alias("place"))), True)
    along = along.select("file", "range", "inside", opened.over(earlier).alias("open"))
    along = storage.materialize(along, storage.fresh_dir(spark, "ranges"))

    own = F.when(F.col("inside"), F.col("start_inside")).otherwise(F.col("start_outside"))
    placed = stated.join(along, ["file", "range"]).select(
        "file", "range", "place", "line",
        (~F.when(F.col("inside"), F.col("before.inside")).otherwise(F.col("before.outside"))).alias("starts"),
        (~F.when(F.col("inside"), F.col("after.inside")).otherwise(F.col("after.outside"))).alias("ends"),
        F.when(own.isNotNull(), F.struct("range", own.alias("place"))).otherwise(F.col("open")).alias("first"),
    )
    if header:
        # Only a record of one line can be blank: the others hold a quote.
        kept = placed.where(F.col("starts") & (~F.col("ends") | _filled(_bare("line"))))
        headers = kept.groupBy("file").agg(F.min("first").alias("header"))
        headers = storage.materialize(headers, storage.fresh_dir(spark, "headers"))
        placed = placed.join(headers, "file").where(F.col("first") != F.col("header")).drop("header")
    whole = placed.where("starts AND ends").select("file", "range", "place", F.col("line").alias("record"))
    joined = placed.where("NOT (starts AND ends)").groupBy("file", "first").agg(
        F.array_sort(F.collect_list(F.struct("range", "place", "line"))).alias("parts")
    ).select("file", "first.range", "first.place", F.array_join(F.col("parts.line"), "\n").alias("record"))
    return whole.unionByName(joined).withColumn("record", _bare("record")).where(_filled(F.col("record")))


def _bare(record: str) -> Column:
    return F.regexp_replace(record, "\r$", "")


def _filled(record: Column) -> Column:
    return F.trim(record) != ""


def land_csv(spark: SparkSession, path: str, target: str, schema: StructType, header: bool = False) -> DataFrame:
    """CSV files as rows of ``schema``, written as Parquet to ``target`` and read back. ``header``: the first record of
    each file is none of its rows."""
    found = records(lines(spark, path), header)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    rows = found.select(F.from_csv("record", columns, {"quote": '"', "escape": '"'}).alias("row"))
    return storage.materialize(rows.select("row.*"), target, **storage.TEXT_CODEC)
