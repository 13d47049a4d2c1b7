"""Chat formatting by quotation linking: quoted passages are joined by hash to the messages they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpulse import storage
from textpulse.llm.ranks import id_buckets, running_start

MARKS = r"^[ \t]*(?:>[ \t]?)+"
# "On Monday, A wrote:", if what follows is quoted.
ATTRIBUTION = r"(?i)^.{1,200}\b(?:wrote|writes|said):\s*$"
ROWS_PER_BUCKET = 50_000


def normal(text: Column) -> Column:
    """Lower case, white space as single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def lines(text: Column) -> Column:
    """array<(level, line)>: the number of leading quotation marks, and what follows them."""
    parts = F.split(F.coalesce(text, F.lit("")), r"\r?\n")
    return F.transform(
        parts,
        lambda s: F.struct(
            F.regexp_count(F.regexp_extract(s, MARKS, 0), F.lit(">")).alias("level"),
            F.regexp_replace(s, MARKS, "").alias("line"),
        ),
    )


def _runs(parsed: str) -> tuple[Column, Column]:
    """Which lines are blank, and the numbers of the lines that start a passage: those whose level differs
    from the line above or that follow a blank line. Blank lines end a passage of any level, so a quoted
    paragraph is a passage of its own."""
    blank = F.transform(parsed, lambda p: F.trim(p["line"]) == "")
    starts = F.filter(
        F.transform(parsed, lambda p, i: F.when(
            ~F.get(F.col("_blank"), i) & (
                (i == 0) | F.get(F.col("_blank"), i - 1) | (F.get(F.col(parsed), i - 1)["level"] != p["level"])
            ), i)),
        lambda i: i.isNotNull(),
    )
    return blank, starts


def passages(messages: DataFrame) -> DataFrame:
    """Adds ``passages``: array<(level, text, lines)> of the message, in order, and ``body``, the level 0 lines. A line
    that names the author of a quotation right below it, or below one blank line, is left out."""
    rows = messages.withColumn("_all", lines(F.col("text")))

    def below(i: Column) -> Column:
        after = F.get(F.col("_all"), i + 1)
        return F.when(F.trim(after["line"]) == "", F.get(F.col("_all"), i + 2)["level"]).otherwise(after["level"])

    kept = F.filter(
        "_all", lambda p, i: ~(p["line"].rlike(ATTRIBUTION) & (F.coalesce(below(i), F.lit(0)) > p["level"]))
    )
    rows = rows.withColumn("_lines", kept).drop("_all")
    blank, starts = _runs("_lines")
    rows = rows.withColumn("_blank", blank).withColumn("_starts", starts)

    def passage(start: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(F.col("_starts"), k + 1), F.size("_lines"))
        inside = F.slice("_lines", start + 1, stop - start)
        return F.struct(
            F.get(F.col("_lines"), start)["level"].alias("level"),
            normal(F.array_join(F.transform(inside, lambda p: p["line"]), " ")).alias("text"),
            F.filter(F.transform(inside, lambda p: normal(p["line"])), lambda t: t != "").alias("lines"),
        )

    body = F.array_join(
        F.transform(F.filter("_lines", lambda p: p["level"] == 0), lambda p: p["line"]), "\n"
    )
    return rows.withColumns({
        "passages": F.transform("_starts", passage), "body": F.regexp_replace(F.regexp_replace(body, r"\n{3,}", "\n\n"), r"^\s+|\s+$", "")
    }).drop("_lines", "_blank", "_starts")


def _hashed(text: Column) -> Column:
    """128 bits, so that passages of a whole corpus keep apart."""
    return F.md5(text.cast("binary"))


def turn_buckets(rows: DataFrame):
    """Bucket number of a turn: ROWS_PER_BUCKET turns on average, in order, nulls first."""
    return id_buckets(rows, "turn", ROWS_PER_BUCKET)


def wordings(passage: Column) -> Column:
    """What a passage is looked up by: its whole text first, then its lines, if there are several."""
    return F.concat(
        F.array(passage["text"]),
        F.when(F.size(passage["lines"]) > 1, passage["lines"]).otherwise(F.array().cast("array<string>")),
    )


def latest_before(events: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``origin``: the greatest ``said_turn`` at a smaller ``turn`` with the same keys.

    Inside a bucket of turns it is a running maximum, across buckets that of the buckets before. So a passage that is
    said and quoted thousands of times makes no pairs, and its rows are spread over their buckets.
    """
    edge = events.groupBy(*keys, "_bucket").agg(F.max("said_turn").alias("_last"))
    ahead = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.select(*keys, "_bucket", F.max("_last").over(ahead).alias("_earlier"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    found = events.withColumn("_inside", F.max("said_turn").over(inside)).join(edge, [*keys, "_bucket"])
    earlier = F.when(F.col("turn").isNotNull(), F.col("_earlier"))
    return found.withColumn("origin", F.coalesce("_inside", earlier)).drop("_inside", "_earlier")


def link_quotes(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, body, quote_depth, n_quotes, n_linked, parent_turn, position, formatted), a row per message row.

    A quoted passage is a run of lines of one level >= 1. What it can come from are the unquoted passages, their lines and
    the whole bodies of earlier messages of the conversation; both sides are hashed after normalising, and each hash is
    linked to the latest message before the quotation that said it. A passage that nobody said as a whole comes from
    where its lines come from, if all were said: of their latest messages, the first. The parent is the latest message
    that a passage of the lowest level comes from; without one it is the turn before, and the first turn has
    none. Messages come in reply order: by parent, then turn, which puts every message behind its parent
    and keeps the replies to a message together; ``position`` numbers them from 0 without gaps.
    ``formatted`` is the body under its role, without quotes.

    Defined results: a null text is an empty body; a null role is "unknown"; a null turn is ordered first
    and is nobody's parent; null conversations are one conversation; repeated rows keep a place each; an empty
    table gives no rows; other columns are not read.
    """
    spark = messages.sparkSession
    parsed = passages(messages.select("conv_id", "turn", "role", "text")).drop("text")
    rows = storage.materialize(
        parsed.withColumn("row", F.monotonically_increasing_id()), storage.fresh_dir(spark, "messages")
    )
    bucket_of = turn_buckets(rows)
    rows = rows.withColumns({
        "_conv": F.coalesce(F.col("conv_id").cast("string"), F.lit("none")), "_bucket": bucket_of(F.col("turn"))
    })
    own = F.flatten(F.transform(F.filter("passages", lambda p: p["level"] == 0), wordings))
    whole = normal(F.col("body"))
    originals = (
        rows.where("turn IS NOT NULL AND body <> ''")
        .select("_conv", "_bucket", "turn", F.explode(F.array_distinct(F.array_append(own, whole))).alias("said"))
        .select("_conv", _hashed(F.col("said")).alias("hash"), "_bucket", "turn", F.col("turn").alias("said_turn"))
        .distinct()
    )
    quoted = (
        rows.select("row", "_conv", "_bucket", "turn", F.posexplode("passages").alias("k", "p"))
        .where("p.level > 0")
        .select("*", F.posexplode(wordings(F.col("p"))).alias("n", "wording"))
        .select(
            "_conv", _hashed(F.col("wording")).alias("hash"), "_bucket", "turn", "row", "k", "n",
            F.col("p.level").alias("level"),
        )
    )
    linked = latest_before(quoted.unionByName(originals, allowMissingColumns=True), ["_conv", "hash"])
    line = F.col("n") > 0
    known = F.count_if(line & F.col("origin").isNull()) == 0
    per_passage = linked.where("row IS NOT NULL").groupBy("row", "k").agg(
        F.max("level").alias("level"),
        F.coalesce(
            F.max(F.when(~line, F.col("origin"))), F.when(known, F.min(F.when(line, F.col("origin"))))
        ).alias("origin"),
    )
    per_row = per_passage.groupBy("row").agg(
        F.max("level").cast("bigint").alias("depth"),
        F.count(F.lit(1)).alias("quotes"),
        F.count("origin").alias("found"),
        F.max(F.when(F.col("origin").isNotNull(), F.struct((-F.col("level")).alias("l"), F.col("origin").alias("o")))).alias("best"),
    )
    bucketed = rows.drop("passages").join(per_row, "row", "left").withColumns({
        "_conv": F.coalesce(F.col("conv_id").cast("string"), F.lit("none")), "_bucket": bucket_of(F.col("turn"))
    })
    # The turn before: inside a bucket of turns by the window, across buckets by the last turn of an earlier one.
    edge = bucketed.groupBy("_conv", "_bucket").agg(F.max("turn").alias("_last"))
    edge = edge.select(
        "_conv", "_bucket", F.lag("_last").over(Window.partitionBy("_conv").orderBy("_bucket")).alias("_earlier")
    )
    before = Window.partitionBy("_conv", "_bucket").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    replies = (
        bucketed.withColumn("_inside", F.max("turn").over(before))
        .join(edge, ["_conv", "_bucket"])
        .withColumn("parent_turn", F.when(F.col("turn").isNotNull(), F.coalesce(F.col("best.o"), "_inside", "_earlier")))
        .withColumn("_order", bucket_of(F.col("parent_turn")))
    )
    order = [F.asc_nulls_first("parent_turn"), F.asc_nulls_first("turn"), F.asc("row")]
    placed = running_start(replies, ["_conv"], "_order", order, F.lit(1), "position")
    role = F.coalesce("role", F.lit("unknown"))
    return placed.select(
        "conv_id", "turn", "role", "body",
        F.coalesce("depth", F.lit(0)).cast("bigint").alias("quote_depth"),
        F.coalesce("quotes", F.lit(0)).cast("bigint").alias("n_quotes"),
        F.coalesce("found", F.lit(0)).cast("bigint").alias("n_linked"),
        "parent_turn", "position",
        F.concat(F.lit("<|"), role, F.lit("|>\n"), F.col("body")).alias("formatted"),
    )
