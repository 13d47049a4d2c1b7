"""Mixing sources to target weights: fixed-length blocks, multinomial draws per output shard,
pseudorandom index permutations per source, and a join of blocks by index."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpulse import storage
from textpulse.llm.ranks import running_start

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_PASSES = 2
BLOCK_WORDS = 128
SHARD_BLOCKS = 4096
ROWS_PER_BUCKET = 8_000
SEED = 17
SLOTS_PER_TASK = 100_000
_CHUNK = 16_384
_WALK = 16


def size_of(text: str = "text") -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, rank, source_size, target) from (source, source_size).

    Sources are ranked by code point, null last, and weigh WEIGHTS in turn. A target is min(MOST_PASSES *
    size, level * weight), where the one level that spends SHARE of all sizes is what resharing the
    excess by weight ends in. Taking the sources by the level at which they fill, level_i = (what is
    left) / (weight left) rises as long as sources are full and falls afterwards: the answer is its maximum.
    The windows run over one row per source.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    full = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(MOST_PASSES))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ahead = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum("most").over(ahead), F.lit(0.0))
    weighed = F.coalesce(F.sum("weight").over(ahead), F.lit(0.0))
    left = F.sum("source_size").over(everything) * SHARE - spent
    levels = full.withColumn("level", left / (F.sum("weight").over(everything) - weighed))
    level = F.max("level").over(everything)
    return levels.withColumn("target", F.least("most", level * F.col("weight"))).select(
        "source", "rank", "source_size", "target"
    )


def _permuted(index: Column, source: Column, epoch: Column, n: Column) -> Column:
    """One pass of a Feistel network over a grid of at least n cells, about the square root on each side."""
    high = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
    low = F.ceil(n / high).cast("bigint")
    x, y = F.floor(index / low).cast("bigint"), F.pmod(index, low)
    for r in range(3):
        x = F.pmod(x + F.pmod(F.xxhash64(F.lit(SEED), source, epoch, F.lit(2 * r), y), high), high)
        y = F.pmod(y + F.pmod(F.xxhash64(F.lit(SEED), source, epoch, F.lit(2 * r + 1), x), low), low)
    return x * low + y


def permuted(index: Column, source: Column, epoch: Column, n: Column) -> Column:
    """Pseudorandom permutation of 0..n-1 for each source and epoch. What lands on a spare cell of the
    grid walks on; a walk cannot be longer than the spare cells, of which there are fewer than a row."""
    first = _permuted(index, source, epoch, n)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(_WALK)), first,
        lambda at, _: F.when(at < n, at).otherwise(_permuted(at, source, epoch, n)),
        lambda at: F.when(at < n, at).otherwise(F.raise_error(F.lit("the walk left the grid")).cast("bigint")),
    )
    return F.when(first < n, first).otherwise(walked)


def _numbers(rows: DataFrame, start: str, count: str, out: str, tasks: int) -> DataFrame:
    """A row for each of ``count`` numbers from ``start``; a long run is cut first, and the cuts, which are few
    bytes but much work, are dealt out to so many tasks.

    Spark takes the numbers for as few bytes as the runs they come from and would gather them on the driver for a
    broadcast: a join by number needs the hint ``merge``."""
    cut = rows.where(F.col(count) > 0).withColumn(
        "_at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1, F.lit(_CHUNK).cast("bigint")))
    )
    dealt = cut.repartition(tasks, *rows.columns, "_at")
    last = F.least(F.col("_at") + _CHUNK, F.col(count)) - 1
    return dealt.withColumn(out, F.explode(F.sequence(F.col(start) + F.col("_at"), F.col(start) + last))).drop("_at")


@dataclass
class Mix:
    """Written tables: ``sources`` (source, rank, source_size, target, n_blocks, n_slots), ``slots``
    (shard, rank, position, block): block ``block`` of source ``rank`` belongs in output shard ``shard``."""

    sources: DataFrame
    slots: DataFrame


def plan_mix(sizes: DataFrame, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS) -> Mix:
    """Draws the mix of sources given as (source, source_size).

    Every slot of an output shard draws a source with the chance of its share of the slots: slot number
    g meets, by an equal join, the owner of a pseudorandom number below the total. Counts per shard and
    source are therefore multinomial. Draws beyond a source's own total go to the sources left short,
    so that every source meets its target to a block. A source's slots run on through the shards; position
    p of a source with n blocks maps to place p mod n of its permutation number p div n.
    """
    spark = sizes.sparkSession
    ranked = targets(sizes).withColumn("n_blocks", F.ceil(F.col("source_size") / block_words).cast("bigint"))
    wanted = F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")).cast("bigint")
    ranked = ranked.withColumn("n_slots", F.when(F.col("source_size") > 0, wanted).otherwise(0).cast("bigint"))
    order = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("first", F.coalesce(F.sum("n_slots").over(order), F.lit(0)).cast("bigint"))
    sources = storage.materialize(ranked, storage.fresh_dir(spark, "sources"))
    total = sources.agg(F.sum("n_slots")).first()[0] or 0

    tasks = max(spark.sparkContext.defaultParallelism, -(-total // SLOTS_PER_TASK))
    owners = _numbers(sources.select("rank", "first", "n_slots"), "first", "n_slots", "number", tasks).select("rank", "number")
    draws = spark.range(0, total, 1, tasks).select(
        F.floor(F.col("id") / shard_blocks).cast("bigint").alias("shard"),
        F.pmod(F.xxhash64(F.lit(SEED), F.lit("draw"), "id"), F.lit(max(total, 1)).cast("bigint")).alias("number"),
    )
    drawn = draws.join(owners.hint("merge"), "number").groupBy("rank", "shard").agg(F.count(F.lit(1)).alias("n"))
    drawn = storage.materialize(drawn, storage.fresh_dir(spark, "draws"))

    through = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counted = drawn.join(sources.select("rank", "n_slots"), "rank").withColumn(
        "start", F.coalesce(F.sum("n").over(through), F.lit(0))
    )
    kept = counted.withColumn("kept", F.least("n", F.greatest(F.col("n_slots") - F.col("start"), F.lit(0))))
    own = _numbers(kept.select("shard", "rank", "start", "kept"), "start", "kept", "position", tasks).select(
        "shard", "rank", "position"
    )
    # Redraw: surplus draws, numbered through, meet the positions nobody drew. Both sum to the same.
    queue = Window.orderBy("shard", "rank").rowsBetween(Window.unboundedPreceding, -1)
    surplus = kept.withColumn("spare", F.col("n") - F.col("kept")).where("spare > 0")
    surplus = surplus.withColumn("from", F.coalesce(F.sum("spare").over(queue), F.lit(0)))
    spare = _numbers(surplus.select("shard", "rank", "from", "spare"), "from", "spare", "unit", tasks).select("shard", "unit")
    got = drawn.groupBy("rank").agg(F.sum("n").alias("got"))
    short = sources.select("rank", "n_slots").join(got, "rank", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    short = short.withColumn("lack", F.col("n_slots") - F.col("got")).where("lack > 0")
    short = short.withColumn(
        "from", F.coalesce(F.sum("lack").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    missing = _numbers(short, "from", "lack", "unit", tasks).select(
        "rank", "unit", (F.col("got") + F.col("unit") - F.col("from")).alias("position")
    )
    redrawn = spare.join(missing.hint("merge"), "unit").select("shard", "rank", "position")

    slots = own.unionByName(redrawn).join(sources.select("rank", "n_blocks"), "rank")
    block = permuted(
        F.pmod("position", "n_blocks"), F.col("rank"),
        F.floor(F.col("position") / F.col("n_blocks")).cast("bigint"), F.col("n_blocks"),
    )
    slots = slots.select("shard", "rank", "position", block.alias("block"))
    return Mix(sources, storage.materialize(slots, storage.fresh_dir(spark, "slots")))


def _measured(docs: DataFrame, *columns: str) -> DataFrame:
    """Rows with their size, a row number and their pseudorandom bucket, written once: the scan of the
    texts is not repeated and the row number holds."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", *columns, size_of("text").alias("size"),
        F.xxhash64(F.lit(SEED), "doc_id", F.xxhash64("text")).alias("place"),
    )
    return storage.materialize(rows, storage.fresh_dir(docs.sparkSession, "sizes"))


def _pieces(rows: DataFrame, sources: DataFrame, block_words: int) -> DataFrame:
    """(row, rank, block, from, words): which words of a row lie in which block of its source.

    Sources are streams of words, documents in pseudorandom order; cut every ``block_words`` words.
    """
    buckets = max(1, -(-rows.count() // ROWS_PER_BUCKET))
    same = rows["source"].eqNullSafe(sources["source"])
    ranked = rows.where("size > 0").join(sources.select("source", "rank"), same).select(
        "row", "rank", "size", "place", F.pmod("place", F.lit(buckets)).alias("bucket")
    )
    placed = running_start(ranked, ["rank"], "bucket", [F.asc("place"), F.asc("row")], F.col("size"), "start")
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    cut = placed.withColumn("block", F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))))
    lo = F.greatest("start", F.col("block") * block_words)
    hi = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    return cut.select("row", "rank", "block", (lo - F.col("start")).alias("from"), (hi - lo).alias("words"))


def _taken(pieces: DataFrame, mix: Mix) -> DataFrame:
    """Pieces with the number of slots that hold their block. A few long documents make many pieces, which Spark
    would broadcast for the few bytes of the documents' sizes."""
    times = mix.slots.groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
    return pieces.join(times.hint("merge"), ["rank", "block"])


def source_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.sum("size").alias("source_size"))


def mix_report(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, size, source_size, target, taken), a row per document row: words the mix takes of it.

    Defined results: a null or wordless text has size 0 and is never taken; a null source is a source of
    its own, ranked last; repeated rows are packed one by one; an empty table gives no rows; columns other
    than doc_id, text and source are not read.
    """
    rows = _measured(docs)
    mix = plan_mix(source_sizes(rows), block_words)
    taken = _taken(_pieces(rows, mix.sources, block_words), mix)
    by_row = taken.groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    sources = mix.sources.select(F.col("source").alias("_source"), "source_size", "target")
    return (
        rows.join(by_row, "row", "left")
        .join(sources, rows["source"].eqNullSafe(F.col("_source")))
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents with the columns of ``docs``: pass p of a document holds the words of its
    blocks that fill at least p slots, in order; passes without words are left out. ``n_chars``, if there,
    is counted anew. A pass that takes the whole document keeps its text as it is."""
    others = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    renamed = docs.select(
        "doc_id", "source", "text", *[F.col(f"`{c}`").alias(f"_other{i}") for i, c in enumerate(others)]
    )
    rows = _measured(renamed, "text", *[f"_other{i}" for i in range(len(others))])
    narrow = rows.select("row", "source", "size", "place")
    mix = plan_mix(source_sizes(narrow), block_words)
    taken = _taken(_pieces(narrow, mix.sources, block_words), mix)
    passes = taken.withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    parts = passes.groupBy("row", "pass").agg(
        F.sum("words").alias("words"), F.sort_array(F.collect_list(F.struct("from", "words"))).alias("spans")
    )
    words = F.regexp_extract_all("text", F.lit(f"({WORDS})"), F.lit(1))
    cut = F.array_join(
        F.flatten(F.transform("spans", lambda s: F.slice("all", (s["from"] + 1).cast("int"), s["words"].cast("int")))), " "
    )
    joined = rows.join(parts, "row")
    whole = F.col("words") == F.col("size")
    texts = joined.withColumn("all", F.when(~whole, words)).withColumn(
        "text", F.when(whole, F.col("text")).otherwise(cut)
    )
    back = {c: F.col(f"_other{i}") for i, c in enumerate(others)}
    if "n_chars" in back:
        back["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return texts.select(*[back.get(c, F.col(c)).alias(c) for c in docs.columns])
