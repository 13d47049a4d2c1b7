"""SimHash fingerprints and their links, found by pigeonring filtering."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse import storage
from textpulse.llm.columns import guarded
from textpulse.llm.components import connected
from textpulse.llm.shipping import ship

BITS = 64
SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 9
# Buckets with more fingerprints than this are linked through one-bit variants instead of pairs.
PAIRED_BUCKET = 64
_CHUNK = 255 * 256


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes set each bit, most significant first. Eight byte counters share a word, so
    255 rows are added before any of them can overflow."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).view(np.uint64).reshape(-1, BITS // 8)
    lanes = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
    return lanes.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """Bit is 1 where over half of the shingles' XXH64 set it; a text without words has 0."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = iter([b" ".join(tokens)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*[tokens[i:] for i in range(words)]))
        total = len(tokens) - words + 1
    counts = np.zeros(BITS, np.int64)
    digest, left = xxhash.xxh64_intdigest, total
    while left:
        size = min(left, _CHUNK)
        hashes = np.fromiter((digest(next(shingles), SEED) for _ in range(size)), np.uint64, size)
        counts += _bit_counts(hashes)
        left -= size
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big", signed=True)


def simhash(text: str) -> Column:
    """Fingerprint of a text column as a signed long; null counts as empty."""

    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t or "") for t in texts], dtype="int64")

    ship()
    return F.pandas_udf(batch, "bigint")(F.col(text))


def _cuts(segments: int) -> list[int]:
    return [i * BITS // segments for i in range(segments + 1)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def ring_masks(segments: int, start: int, length: int) -> int:
    """Bits of ``length`` consecutive segments of the ring from ``start``, as a signed long."""
    cuts, mask = _cuts(segments), 0
    for i in range(start, start + length):
        lo, hi = cuts[i % segments], cuts[i % segments + 1]
        mask |= ((1 << (hi - lo)) - 1) << lo
    return _signed(mask)


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(a, b): links among distinct fingerprints (column ``fp``) that connect exactly those within
    ``max_bits`` differing bits.

    Pigeonring: of ``segments`` boxes around a ring whose differences sum to at most ``max_bits``, some
    start has every chain of l boxes within l * max_bits / segments. The chains with a budget below one
    bit must be equal: the longest of them is the join key, one per start. The longer chains of that start
    are then checked in turn, and only what passes all of them gets the full Hamming check. A bucket with
    more than PAIRED_BUCKET fingerprints emits no pairs: (for two bits) each fingerprint emits itself and
    its one-bit variants; those that share a variant are at most two bits apart, and all that are share one.
    """
    if max_bits != 2 or segments <= max_bits:
        raise ValueError("hot buckets are linked through one-bit variants, which is exact for two bits")
    exact = (segments - 1) // max_bits
    starts = [
        F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(ring_masks(segments, i, exact))).alias("key"))
        for i in range(segments)
    ]
    keys = fingerprints.select("fp", F.explode(F.array(*starts)).alias("k")).select("fp", "k.i", "k.key")
    shared = keys.groupBy("i", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    spark = fingerprints.sparkSession
    live = storage.materialize(keys.join(shared, ["i", "key"]), storage.fresh_dir(spark, "buckets"))

    left = live.where(F.col("n") <= PAIRED_BUCKET)
    pairs = left.withColumnRenamed("fp", "a").join(
        left.select("i", "key", F.col("fp").alias("b")), ["i", "key"]
    ).where("a > b").withColumn("x", F.col("a").bitwiseXOR(F.col("b")))
    for length in range(exact + 1, segments):
        chain = F.element_at(
            F.array(*[F.lit(ring_masks(segments, i, length)) for i in range(segments)]), F.col("i") + 1
        )
        pairs = pairs.where(F.bit_count(F.col("x").bitwiseAND(chain)) <= length * max_bits // segments)
    paired = pairs.where(F.bit_count("x") <= max_bits).select("a", "b").distinct()

    variants = F.array(F.lit(0).cast("bigint"), *[F.lit(_signed(1 << i)) for i in range(BITS)])
    outside = F.filter(variants, lambda v: v.bitwiseAND(_key_mask(segments, exact)) == 0)
    crowded = live.where(F.col("n") > PAIRED_BUCKET).select(
        "fp", "i", "key", F.explode(outside).alias("flip")
    ).withColumn("meet", F.col("fp").bitwiseXOR(F.col("flip")))
    # At most one fingerprint per variant reaches a meeting point: 65 at the very most.
    met = crowded.groupBy("i", "key", "meet").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    starred = met.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a > b").distinct()
    return paired.unionByName(starred)


def _key_mask(segments: int, exact: int):
    return F.element_at(
        F.array(*[F.lit(ring_masks(segments, i, exact)) for i in range(segments)]), F.col("i") + 1
    )


def groups(fingerprinted: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Adds ``component_id``, the smallest ``doc_id`` reachable, to rows with a fingerprint ``fp``.

    Rows are first summed up by fingerprint, so equal texts cost one row however often they occur. Rows
    without a doc_id link like others; a component without any doc_id has none. ``fingerprinted`` should be
    a written table: it is read three times.
    """
    spark = fingerprinted.sparkSession
    nodes = storage.materialize(
        fingerprinted.groupBy("fp").agg(F.min(doc_id).alias("least")), storage.fresh_dir(spark, "fingerprints")
    )
    found = storage.materialize(links(nodes.select("fp")), storage.fresh_dir(spark, "pairs"))
    member = nodes.join(connected(found), nodes.fp == F.col("node"), "left").select(
        "fp", F.coalesce("component", "fp").alias("root"), "least"
    )
    smallest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return fingerprinted.join(member.select("fp", "root").join(smallest, "root").drop("root"), "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row per document row.

    Defined results: null and wordless texts have fingerprint zero and link like any other; repeated rows
    stay; an empty table gives no rows; other columns are not read, so their names cannot clash.
    """
    narrow = docs.select("doc_id", simhash("text").alias("fp"))
    written = storage.materialize(narrow, storage.fresh_dir(docs.sparkSession, "simhash"))
    return groups(written).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each group stays: the smallest doc_id, among its repeats the smallest text hash, one row."""
    ident = ["_id", "_hash"]
    table, restored = guarded(docs, "doc_id", "text")
    rows = table.withColumns({"_id": F.col("doc_id"), "_hash": F.xxhash64("text")})
    narrow = rows.select(*ident, simhash("text").alias("fp"))
    written = storage.materialize(narrow, storage.fresh_dir(docs.sparkSession, "simhash"))
    grouped = storage.materialize(groups(written, "_id"), storage.fresh_dir(docs.sparkSession, "grouped"))
    chosen = grouped.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull().alias("_none"), *ident)).alias("k"))
    # Components of rows without any doc_id share no number: each keeps its rows, repeats aside.
    keep = chosen.where("component_id IS NOT NULL").select("k.*")
    lone = grouped.where("component_id IS NULL").groupBy("fp").agg(
        F.min(F.struct(F.col("_id").isNull().alias("_none"), *ident)).alias("k")
    ).select("k.*")
    keep = keep.unionByName(lone).select(F.col("_id").alias("_kid"), F.col("_hash").alias("_khash"))
    same = F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_hash") == F.col("_khash"))
    return restored(rows.join(keep, same, "left_semi").dropDuplicates(ident))
