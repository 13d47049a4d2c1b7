"""Jump consistent hashing: stable keys to shards, without a ring table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.llm.ranks import id_buckets, running_start

SHARDS = 40
OVERHEAD_BYTES = 16
ROWS_PER_BUCKET = 50_000

# Fixed value: the multiplier of the published generator (Lamping and Veach, 2014), as two 32-bit halves.
_MULTIPLIER = 2862933555777941757
_HIGH, _LOW = _MULTIPLIER >> 32, _MULTIPLIER & 0xFFFFFFFF


def _jumps(key: str, shards: int) -> Column:
    """The last two shards below ``shards + 1`` that the key jumps to.

    The generator works modulo 2**64, and Spark's arithmetic refuses to wrap, so the key is kept as two
    32-bit halves whose products stay below 2**50. The number of jumps grows with the logarithm of the
    shard count; the bound on steps is only reached with a chance below 1e-30 and then raises.
    """
    steps = min(shards + 1, 64 + 8 * math.ceil(math.log(shards + 2)))
    carried = f"((s.lo & 65535) * {_LOW} + 1 + shiftleft(shiftright(s.lo, 16) * {_LOW} & 65535, 16))"
    low = f"({carried} & 4294967295)"
    high = (
        f"((s.hi & 65535) * {_LOW} + shiftleft(shiftright(s.hi, 16) * {_LOW} & 65535, 16)"
        f" + (s.lo & 65535) * {_HIGH} + shiftleft(shiftright(s.lo, 16) * {_HIGH} & 65535, 16)"
        f" + shiftright({carried}, 32) + shiftright(shiftright(s.lo, 16) * {_LOW}, 16) & 4294967295)"
    )
    jump = f"CAST(floor((s.next + 1) * (2147483648D / (shiftright({high}, 1) + 1))) AS BIGINT)"
    start = (
        f"named_struct('hi', shiftrightunsigned({key}, 32), 'lo', {key} & 4294967295,"
        " 'before', -1L, 'last', -1L, 'next', 0L)"
    )
    step = f"named_struct('hi', {high}, 'lo', {low}, 'before', s.last, 'last', s.next, 'next', {jump})"
    return F.expr(
        f"aggregate(sequence(1, {steps}), {start}, (s, i) -> if(s.next > {shards}, s, {step}),"
        f" s -> if(s.next > {shards}, s, raise_error('too many jumps')))"
    )


def assign(rows: DataFrame, key: Column, shards: int = SHARDS) -> DataFrame:
    """Adds ``shard`` of ``shards`` and ``grown_shard`` of one shard more. Only ``key`` (a long) and the
    number of shards decide; growing moves rows into the new shard alone. A null key counts as 0."""
    if shards < 1:
        raise ValueError("at least one shard")
    keyed = rows.withColumn("_key", F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint")))
    jumped = keyed.withColumn("_jump", _jumps("_key", shards))
    return jumped.withColumns({
        "shard": F.when(F.col("_jump.last") == shards, F.col("_jump.before")).otherwise(F.col("_jump.last")).cast("int"),
        "grown_shard": F.col("_jump.last").cast("int"),
    }).drop("_key", "_jump")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), a row per document row.

    Slots count from 0 without gaps inside a shard, in order of doc_id. A null text has no bytes and the
    CRC of none; a null doc_id hashes like 0 and comes first; repeated rows keep a slot each; an empty
    table gives no rows; other columns are not read.
    """
    octets = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = docs.select(
        "doc_id", (F.octet_length(octets) + OVERHEAD_BYTES).cast("bigint").alias("size"), F.crc32(octets).alias("text_crc32")
    )
    bucket_of = id_buckets(docs, "doc_id", ROWS_PER_BUCKET * shards)
    placed = assign(narrow, F.col("doc_id"), shards).withColumn("_bucket", bucket_of(F.col("doc_id")))
    order = [F.asc_nulls_first("doc_id"), F.asc("text_crc32"), F.asc("size")]
    slotted = running_start(placed, ["shard"], "_bucket", order, F.lit(1), "slot")
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


# The same rows from plain SQL: the generator in 128-bit numbers, the CRC by half bytes.
ORACLE = f"""
WITH RECURSIVE jump(doc_id, state, last, nxt) AS (
  SELECT DISTINCT doc_id, (CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616::HUGEINT
    ELSE coalesce(doc_id, 0)::HUGEINT END), -1::BIGINT, 0::BIGINT FROM documents
  UNION ALL
  SELECT doc_id, (state * {_MULTIPLIER}::HUGEINT + 1) % 18446744073709551616::HUGEINT, nxt,
    floor((nxt + 1) * (2147483648::DOUBLE
      / (((state * {_MULTIPLIER}::HUGEINT + 1) % 18446744073709551616::HUGEINT) // 8589934592 + 1)::DOUBLE))::BIGINT
  FROM jump WHERE nxt <= {SHARDS}),
landed AS (
  SELECT doc_id, max(last) FILTER (last < {SHARDS}) AS shard, max(last) AS grown_shard FROM jump GROUP BY doc_id),
entries AS (
  SELECT list(list_reduce(list_prepend(e, range(4)), lambda v, i: xor(v >> 1, 3988292384::BIGINT * (v & 1))) ORDER BY e) AS tab
  FROM (SELECT unnest(range(16))::BIGINT AS e)),
summed AS (
  SELECT doc_id, strlen(coalesce(text, '')) + {OVERHEAD_BYTES} AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda crc, b: xor(xor(crc >> 4, tab[(xor(crc, b) & 15) + 1]) >> 4,
        tab[(xor(xor(crc >> 4, tab[(xor(crc, b) & 15) + 1]), b >> 4) & 15) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM (SELECT doc_id, text, hex(encode(coalesce(text, ''))) AS h FROM documents), entries)
SELECT s.doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY s.doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
  grown_shard::INTEGER AS grown_shard
FROM summed s JOIN landed l ON s.doc_id IS NOT DISTINCT FROM l.doc_id"""
