"""I-Match fingerprints over randomised lexicons."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textpulse import storage
from textpulse.llm.ranks import id_buckets
from textpulse.llm.shipping import ship, tidy

# Terms are hashed to this many slots, which bounds the lexicon that every task holds (2 MB of bits).
SLOT_BITS = 24
_CHUNK_BITS = 16
MIN_IDF = math.log(50)
MIN_DOCS = 2
# Randomised lexicons: at each level the band's terms are dealt into ``parts`` sets, ``kept`` of which count.
LEVELS = ((1, 1), (2, 2), (8, 8), (32, 12), (128, 12), (512, 12), (2048, 12))
SUBSETS = sum(kept for _, kept in LEVELS)
_HEX = 4
_EMPTY = "0" * _HEX
# A level's likeness counts at least this many sets, so that one chance hit is no likeness.
_LEAST_SETS = 4
ROWS_PER_BUCKET = 2_048
_BATCH_BYTES = 1 << 20

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# Everything but letters, digits and non-ASCII bytes parts terms.
_BLANKS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def _mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    out = values + np.uint64((salt * _BASE) & 0xFFFFFFFFFFFFFFFF)
    out ^= out >> np.uint64(30)
    out *= _MIX
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Hasher:
    """Hashes all words of a buffer at once, from running sums of byte * base**place."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def words(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of every word."""
        if len(buffer) + 1 > len(self.up):
            size = 2 * (len(buffer) + 1)
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)
        inside = np.concatenate(([False], buffer != 32, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, stops = edges[::2], edges[1::2]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * self.up[: len(buffer)])))
        return starts, _mixed((sums[stops] - sums[starts]) * self.down[starts], 1)


_HASHER = _Hasher()


def _slots(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document, slot) of every distinct term of each text, sorted."""
    plain = [t.lower().encode("utf-8", "replace").translate(_BLANKS) for t in texts]
    sizes = np.array([len(p) + 1 for p in plain])
    buffer = np.frombuffer(b" ".join(plain) + b" ", np.uint8)
    starts, hashes = _HASHER.words(buffer)
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right").astype(np.uint64)
    keys = np.unique((owner << np.uint64(SLOT_BITS)) | (hashes >> np.uint64(64 - SLOT_BITS)))
    return (keys >> np.uint64(SLOT_BITS)).astype(np.int64), keys & np.uint64((1 << SLOT_BITS) - 1)


def _batches(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Slices of about _BATCH_BYTES characters; a longer text is a slice of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _BATCH_BYTES:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document counts of this task's slots, a row for each chunk of slots."""
    counts = np.zeros(1 << SLOT_BITS, np.uint32)
    for batch in batches:
        for _, texts in _batches([t or "" for t in batch.column(0).to_pylist()]):
            _, slots = _slots(texts)
            found, times = np.unique(slots, return_counts=True)
            counts[found.astype(np.int64)] += times.astype(np.uint32)
        tidy()
    width = 1 << _CHUNK_BITS
    for chunk in range(len(counts) // width):
        part = counts[chunk * width : (chunk + 1) * width]
        at = np.flatnonzero(part)
        if len(at):
            yield pa.RecordBatch.from_pydict(
                {"chunk": [chunk], "slots": [at.astype(np.uint16).tobytes()], "counts": [part[at].tobytes()]},
                schema=_COUNTS,
            )


_COUNTS = pa.schema([("chunk", pa.int32()), ("slots", pa.binary()), ("counts", pa.binary())])


def _band(low: float, high: float):
    def band(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bits of the slots of one chunk whose document count lies in the band; batches are added up as they come."""
        total, chunk = np.zeros(1 << _CHUNK_BITS, np.int64), None
        for batch in rows:
            for row in batch.to_pylist():
                chunk = row["chunk"]
                total[np.frombuffer(row["slots"], np.uint16)] += np.frombuffer(row["counts"], np.uint32)
        bits = np.packbits((total >= low) & (total <= high))
        yield pa.RecordBatch.from_pydict({"chunk": [chunk], "bits": [bits.tobytes()]}, schema=_BITS)

    return band


_BITS = pa.schema([("chunk", pa.int32()), ("bits", pa.binary())])


def lexicon(docs: DataFrame, min_idf: float = MIN_IDF, min_docs: int = MIN_DOCS) -> bytes:
    """Bits of the slots in the band, from all documents: terms of at least ``min_docs`` documents whose
    inverse document frequency log(N / n) is at least ``min_idf``. Always 2**SLOT_BITS bits, whatever the corpus."""
    ship(docs.sparkSession)
    counted = docs.select("text").mapInArrow(_count, "chunk int, slots binary, counts binary")
    counted = storage.materialize(counted, storage.fresh_dir(docs.sparkSession, "terms"))
    most = max(docs.count() * math.exp(-min_idf), min_docs)
    banded = counted.groupBy("chunk").applyInArrow(_band(min_docs, most), "chunk int, bits binary")
    width = 1 << (_CHUNK_BITS - 3)
    bits = bytearray(1 << (SLOT_BITS - 3))
    for row in banded.collect():  # at most 2**(SLOT_BITS - _CHUNK_BITS) rows of fixed size
        bits[row["chunk"] * width : (row["chunk"] + 1) * width] = row["bits"]
    return bytes(bits)


def _fingerprints(texts: list[str], bits: np.ndarray) -> list[str]:
    """A fingerprint is one short hash for each randomised lexicon: of the text's distinct terms in the band
    that the lexicon holds, in order; zeros where it holds none of them."""
    owner, slots = _slots(texts)
    at = slots.astype(np.int64)
    keep = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    owner, slots = owner[keep], slots[keep]
    out = []
    for level, (parts, kept) in enumerate(LEVELS):
        hashed = _mixed(slots, 2 + 2 * level)
        part = (hashed % np.uint64(parts)).astype(np.int64)
        chosen = part < kept
        sums = np.zeros(len(texts) * kept, np.uint64)
        # Sorted distinct terms are hashed one by one and added up, so a set has one hash.
        np.add.at(sums, owner[chosen] * kept + part[chosen], _mixed(hashed[chosen], 3 + 2 * level))
        short = _mixed(sums, 99) >> np.uint64(64 - 4 * _HEX)
        out.append(np.where(sums == 0, 0, np.maximum(short, 1)).reshape(len(texts), kept))
    table = np.concatenate(out, axis=1).astype(">u2")
    return [row.tobytes().hex() for row in table]


def _fingerprint_udf(shared):
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bits = np.frombuffer(shared.value, np.uint8)
        for series in batches:
            out: list[str | None] = [None] * len(series)
            texts = series.tolist()
            there = [i for i, t in enumerate(texts) if t is not None]
            for start, part in _batches([texts[i] for i in there]):
                for i, value in zip(there[start : start + len(part)], _fingerprints(part, bits)):
                    out[i] = value
            yield pd.Series(out, dtype=object)
            tidy()

    return F.pandas_udf(fingerprint, "string")


def _likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    """1 for equal fingerprints with any term. Else the best level's share of equal sets among those that
    either text has terms in, of at least _LEAST_SETS. 0 where either has no term at all."""
    if not len(a):
        return pd.Series([], dtype="float64")
    missing = (a.isna() | b.isna()).to_numpy()
    blank = _EMPTY * SUBSETS
    left, right = (
        np.frombuffer(bytes.fromhex("".join(x.fillna(blank))), ">u2").reshape(len(x), SUBSETS) for x in (a, b)
    )
    best = np.zeros(len(a))
    start = 0
    for _, kept in LEVELS:
        x, y = left[:, start : start + kept], right[:, start : start + kept]
        start += kept
        hits = ((x == y) & (x > 0)).sum(axis=1)
        either = ((x > 0) | (y > 0)).sum(axis=1)
        best = np.maximum(best, hits / np.maximum(either, min(_LEAST_SETS, kept) if kept > 2 else 2))
    best[(left == right).all(axis=1) & (left > 0).any(axis=1)] = 1.0
    best[missing | ~(left > 0).any(axis=1) | ~(right > 0).any(axis=1)] = 0.0
    return pd.Series(best)


def likeness(a: str, b: str) -> Column:
    ship()
    return F.pandas_udf(_likeness, "double")(F.col(a), F.col(b))


def fingerprints(docs: DataFrame, bits: bytes, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of a text column; null texts have none."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    return docs.withColumn(out, _fingerprint_udf(shared)(F.col(f"`{text}`")))


def edited_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), a row per row.

    The edited text swaps the last third of the code points for the first as many of the next document in
    descending doc_id; the last is followed by the first. Documents are cut into ranges of ids: inside a
    range the next one is a window's lead, across ranges it is the first document of the next range, so no
    order over the whole table is ever built and texts are shuffled once. Null texts count as empty; null
    ids come last; repeated ids follow each other by text hash; an empty table gives no rows; only doc_id
    and text are read.
    """
    spark = ship(docs.sparkSession)
    bits = spark.sparkContext.broadcast(lexicon(docs))
    fingerprint = _fingerprint_udf(bits)
    bucket_of = id_buckets(docs, "doc_id", ROWS_PER_BUCKET)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({
        "bucket": bucket_of(F.col("doc_id")), "tie": F.xxhash64("text")
    })
    order = [F.desc_nulls_last("doc_id"), F.asc("tie")]
    ids = storage.materialize(rows.select("bucket", "doc_id", "tie"), storage.fresh_dir(spark, "order"))
    first = F.row_number().over(Window.partitionBy("bucket").orderBy(*order)) == 1
    heads = ids.groupBy("bucket").agg(F.max("doc_id").alias("doc_id"))
    tied = ids.join(heads, (ids.bucket == heads.bucket) & ids.doc_id.eqNullSafe(heads.doc_id), "left_semi")
    heads = storage.materialize(
        tied.withColumn("first", first).where("first").select("bucket", "doc_id", "tie"), storage.fresh_dir(spark, "heads")
    )
    ring = Window.orderBy(F.desc("bucket"))
    follows = heads.select(
        F.col("bucket").alias("before"),
        F.coalesce(F.lead("bucket").over(ring), F.first("bucket").over(ring.rowsBetween(Window.unboundedPreceding, 0))).alias("bucket"),
    )
    small = heads.select(F.col("bucket").alias("_b"), F.col("doc_id").alias("_d"), F.col("tie").alias("_t"))
    same = (F.col("bucket") == F.col("_b")) & F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t"))
    texts = rows.join(small, same, "left_semi").dropDuplicates(["bucket"])
    after = storage.materialize(
        follows.join(texts.select("bucket", F.col("text").alias("head")), "bucket").select(
            F.col("before").alias("bucket"), "head"
        ),
        storage.fresh_dir(spark, "after"),
    )
    inside = Window.partitionBy("bucket").orderBy(*order)
    swapped = F.floor(F.char_length("text") / 3).cast("int")
    led = rows.withColumns({"next": F.lead("text").over(inside), "place": F.row_number().over(inside)})
    joined = led.join(after, "bucket").withColumn("head", F.when(F.col("next").isNull(), F.col("head")))
    edited = joined.withColumn(
        "edited",
        F.concat(
            F.substring("text", F.lit(1), F.char_length("text") - swapped),
            F.substring(F.coalesce("next", "head"), F.lit(1), swapped),
        ),
    ).drop("next")
    marked = edited.withColumns({
        "fingerprint": fingerprint("text"), "edited_fingerprint": fingerprint("edited"), "head": fingerprint("head"),
        "n_chars": F.char_length("text").cast("bigint"), "edited_sha256": F.sha2(F.col("edited").cast("binary"), 256),
    }).drop("text", "edited")
    following = F.coalesce(F.lead("fingerprint").over(Window.partitionBy("bucket").orderBy("place")), F.col("head"))
    return marked.withColumn("following", following).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "following").alias("near_next"),
    )
