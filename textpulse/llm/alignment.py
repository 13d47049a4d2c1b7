"""Two tokenizers side by side: each distinct text is tokenised and aligned once, whatever the number of its copies.

Texts are grouped by their full wording. Distinct ones are taken in blocks of bounded size; a block is one row that
holds its texts' measures, the stretches they are made of (from a non-space's end to the next), and for each stretch
the links between tokens, as numbers of the block's own list of id pairs. Only these lists meet corpus-wide: a pair
comes once from each block, with the number of documents behind it, so no pair is hot. The counts go back to the
blocks, where everything else is a sum over stretches.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse import storage
from textpulse.llm.shipping import ship, tidy

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
# Bytes of text in a block: what a worker holds at a time. One longer text is a block of its own.
BLOCK_BYTES = 3 << 20
# Documents of one text are met in this many groups.
SALTS = 64
# A place between a non-space and a space is a token border in both vocabularies.
_stretches = re.compile(r"\s*(?:\S+(?:[^\S ]\s*)?)+|\s+").findall


def _packed(values: np.ndarray) -> bytes:
    """Numbers in the least width that holds them, compressed."""
    if values.dtype.kind in "iu":
        top = int(values.max(initial=0))
        values = values.astype(next(t for t in ("u1", "u2", "u4", "i8") if top <= np.iinfo(t).max))
    raw = np.ascontiguousarray(values).tobytes()
    size = len(raw).to_bytes(8, "little")
    return values.dtype.str.encode().ljust(4) + size + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    kind, size = data[:4].decode().strip(), int.from_bytes(data[4:12], "little")
    return np.frombuffer(pa.decompress(data[12:], size, codec="zstd", asbytes=True), kind)


class Pair:
    """Both tokenizers, with the bytes and decimal forms of their entries."""

    def __init__(self, a_path: str, b_path: str):
        with open(a_path, encoding="utf-8") as source:
            model = json.load(source)["model"]
        vocabulary = model["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}
        ranks: dict[bytes, int] = {}
        self.raw_a = [b""] * (max(vocabulary.values()) + 1)
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if [vocabulary[m] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError("entries must be numbered in the order of their merges, after the single bytes")
        for entry in [*byte_of, *merges]:
            raw = bytes(map(byte_of.__getitem__, entry))
            self.raw_a[vocabulary[entry]], ranks[raw] = raw, vocabulary[entry]
        import public_tokenizers

        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.space = self.b.piece_to_id(SPACE)
        self.raw_b = []
        for i in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(i)
            self.raw_b.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.size_a = np.array(list(map(len, self.raw_a)), "i8")
        self.size_b = np.array(list(map(len, self.raw_b)), "i8")
        self.ids_b = len(self.raw_b)
        decimal_a = [str(i) for i in range(len(self.raw_a))]
        decimal_b = [str(i) for i in range(self.ids_b)]
        # An id with what follows it: another id of its side, the other side, the next group, the next stretch.
        self.written = [f"{d}{end}".encode() for end in ",|" for d in decimal_a]
        self.written += [f"{d}{end}".encode() for end in ",;\n" for d in decimal_b]

    def encode(self, stretches: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of stretches, each of which starts with a space."""
        a = [self.a.encode_ordinary(s) for s in stretches]
        b = self.b.encode([s[1:] for s in stretches], num_threads=1)
        return a, [ids or [self.space] for ids in b]


_PAIRS: dict[tuple[str, str], Pair] = {}


def _pair_at(a_path: str | None, b_path: str | None) -> Pair:
    import public_tokenizers

    key = a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE)
    if key not in _PAIRS:
        _PAIRS[key] = Pair(*key)
    return _PAIRS[key]


def _pairs_of_ids(a_path: str | None, b_path: str | None) -> int:
    """Distinct id pairs are at most this many times the first vocabulary's ids."""
    return _pair_at(a_path, b_path).ids_b


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums over stretches that start at ``starts``, none of them empty."""
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, "i8")


def _expanded(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every (start, size)."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return np.arange(total) + np.repeat(starts - before, sizes)


def _aligned(stretches: list[str], both: Pair) -> dict:
    """Links of distinct stretches. A stretch whose tokens do not give its bytes back is not ``sound``."""
    encoded = list(map(str.encode, stretches))
    ids_a, ids_b = both.encode(stretches)
    sound = np.ones(len(stretches), bool)
    raw_a, raw_b = both.raw_a.__getitem__, both.raw_b.__getitem__
    whole = b"".join(encoded)
    flat = [b"".join(map(raw, chain.from_iterable(ids))) for raw, ids in ((raw_a, ids_a), (raw_b, ids_b))]
    if flat != [whole, whole]:
        for n, data in enumerate(encoded):
            sound[n] = data == b"".join(map(raw_a, ids_a[n])) == b"".join(map(raw_b, ids_b[n]))
        # An unsound stretch takes part as if it were one token, whose measures are never read.
        ids_a = [ids if ok else [] for ids, ok in zip(ids_a, sound)]
        ids_b = [ids if ok else [] for ids, ok in zip(ids_b, sound)]
    counts_a, counts_b = (np.fromiter(map(len, ids), "i8", len(ids)) for ids in (ids_a, ids_b))
    a = np.fromiter(chain.from_iterable(ids_a), "i8", int(counts_a.sum()))
    b = np.fromiter(chain.from_iterable(ids_b), "i8", int(counts_b.sum()))
    ends_a, ends_b = np.cumsum(both.size_a[a]), np.cumsum(both.size_b[b])
    shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
    cuts = np.union1d(ends_a, ends_b)
    sizes = np.where(sound, np.fromiter(map(len, encoded), "i8", len(encoded)), 0)
    stops = np.cumsum(sizes)
    link_of = np.searchsorted(stops, cuts)
    pairs = a[np.searchsorted(ends_a, cuts)] * both.ids_b + b[np.searchsorted(ends_b, cuts)]
    groups = np.bincount(np.searchsorted(stops, shared), minlength=len(stretches))
    # Groups in writing: the A ids of a group stand before its B ids.
    group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
    many_a, many_b = np.bincount(group_a, minlength=len(shared)), np.bincount(group_b, minlength=len(shared))
    at_a = np.arange(len(a)) + (np.cumsum(many_b) - many_b)[group_a]
    at_b = np.arange(len(b)) + np.cumsum(many_a)[group_b]
    last_a = np.isin(ends_a, shared, assume_unique=True)
    last_b = np.isin(ends_b, shared, assume_unique=True).astype("i8")
    last_b[np.isin(ends_b, stops)] = 2
    words = np.empty(len(a) + len(b), "i8")
    vocabulary = len(both.raw_a)
    words[at_a] = a + vocabulary * last_a
    words[at_b] = b + 2 * vocabulary + both.ids_b * last_b
    lines = b"".join(map(both.written.__getitem__, words.tolist())).split(b"\n")[:-1]
    written = iter(lines)
    links = np.bincount(link_of, minlength=len(stretches))
    return {
        "sound": sound, "n_a": counts_a, "n_b": counts_b, "n_groups": groups, "n_links": links,
        "written": [next(written) if ok else b"" for ok in sound], "pairs": pairs,
    }


MEASURES = ["n_a", "n_b", "n_groups", "n_links"]


def _block(texts: list[str], copies: list[int], salts: list[int], both: Pair) -> dict:
    """One row for some distinct texts."""
    number: dict[str, int] = defaultdict()
    number.default_factory = number.__len__
    found = [list(map(number.__getitem__, _stretches(" " + t))) for t in texts]
    sizes = np.fromiter(map(len, found), "i8", len(found))
    starts = np.cumsum(sizes) - sizes
    slots = np.fromiter(chain.from_iterable(found), "i8", int(sizes.sum()))
    links = _aligned(list(number), both)
    sound = np.minimum.reduceat(links["sound"][slots].astype("i8"), starts).astype(bool)
    measures = {m: np.where(sound, _sums(links[m][slots], starts), 0) for m in MEASURES}
    written = links["written"]
    digests = b"".join(
        hashlib.sha256(b";".join(map(written.__getitem__, f))).digest() if ok else bytes(32)
        for f, ok in zip(found, sound)
    )
    # Each stretch of a text once, with how often it stands there; unsound texts have none.
    text_of = np.repeat(np.arange(len(texts)), sizes)
    keep = sound[text_of]
    once, times = np.unique(text_of[keep] * len(number) + slots[keep], return_counts=True)
    text_of, slots = once // len(number), once % len(number)
    pairs, pair_of = np.unique(links["pairs"], return_inverse=True)
    # Documents behind each pair of this block: texts that hold it, each with its copies.
    per = links["n_links"]
    first = np.cumsum(per) - per
    held = np.repeat(text_of, per[slots]) * len(pairs) + pair_of[_expanded(first[slots], per[slots])]
    held = np.unique(held)
    weights = np.array(copies, "i8")
    docs = np.zeros(len(pairs), "i8")
    np.add.at(docs, held % len(pairs), weights[held // len(pairs)]) if len(held) else None
    used = docs > 0
    place = np.cumsum(used) - 1
    return {
        "block": uuid.uuid4().hex,
        "keys": b"".join(hashlib.sha256(t.encode()).digest() for t in texts),
        "digests": digests,
        "salts": np.array(salts, "i8").tobytes(),
        "numbers": [
            _packed(v)
            for v in (
                *measures.values(), np.bincount(text_of, minlength=len(texts)), slots, times,
                per, np.where(used[pair_of], place[pair_of], 0), sound.astype("i8"),
            )
        ],
        "pairs": pairs[used],
        "docs": docs[used],
    }


_BLOCKS = pa.schema(
    [
        ("block", pa.string()), ("keys", pa.binary()), ("digests", pa.binary()), ("salts", pa.binary()),
        ("numbers", pa.list_(pa.binary())), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())),
    ]
)
_BLOCK_DDL = (
    "block string, keys binary, digests binary, salts binary, numbers array<binary>, "
    "pairs array<bigint>, docs array<bigint>"
)


def _blocks(a_path: str | None, b_path: str | None, block_bytes: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _pair_at(a_path, b_path)
        held: list[tuple[str, int, int]] = []
        size = 0

        def made() -> pa.RecordBatch:
            row = _block(*map(list, zip(*held)), both)
            held.clear()
            tidy()
            return pa.RecordBatch.from_pylist([row], _BLOCKS)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("text", "copies", "salts"))):
                held.append(row)
                size += len(row[0])
                if size >= block_bytes:
                    yield made()
                    size = 0
        if held:
            yield made()

    return blocks


_MEASURED_DDL = (
    "text_key binary, salts bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block's texts, once the corpus-wide counts of its pairs are at hand."""
    for batch in batches:
        for n in range(batch.num_rows):
            cell = {c: batch.column(c)[n] for c in batch.schema.names}
            known = cell["known"].values
            slots = known.field("slot").to_numpy(zero_copy_only=False) if known is not None else np.zeros(0, "i8")
            counts, best = np.zeros(len(slots) + 1, "i8"), np.zeros(len(slots) + 1, "i8")
            if len(slots):
                counts[slots] = known.field("docs").to_numpy(zero_copy_only=False)
                best[slots] = known.field("best").to_numpy(zero_copy_only=False)
            *measures, sizes, stretches, times, per, pair_of, sound = (
                _unpacked(v.as_py()).astype("i8") for v in cell["numbers"]
            )
            first = np.cumsum(per) - per
            whole = np.zeros(len(per), "i8"), np.zeros(len(per), "i8")
            linked = per > 0
            for out, value in zip(whole, (best, counts)):
                out[linked] = _sums(value[pair_of], first[linked])
            stops = np.cumsum(sizes)
            ends = [np.concatenate([[0], np.cumsum(v[stretches] * times)]) for v in whole]
            n_best, count_sum = (e[stops] - e[stops - sizes] for e in ends)
            keys, digests = cell["keys"].as_py(), cell["digests"].as_py()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[i : i + 32] for i in range(0, len(keys), 32)], pa.binary()),
                    pa.array(np.frombuffer(cell["salts"].as_py(), "i8")),
                    *map(pa.array, measures),
                    pa.array(n_best),
                    pa.array(count_sum),
                    pa.array([digests[32 * i : 32 * i + 32].hex() if ok else "" for i, ok in enumerate(sound)]),
                ],
                [c.split()[0] for c in _MEASURED_DDL.split(", ")],
            )


def align(
    docs: DataFrame, a_path: str | None = None, b_path: str | None = None, block_bytes: int = BLOCK_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(measures of each distinct text, corpus-wide count of each id pair).

    Measures: text_key (SHA-256), salts (bits of the document groups that hold the text) and the numbers of
    ``alignment_report``. Counts: a, b, docs, best (whether no pair of the same A id has more). Blocks are written to
    the shared folder once; their lists of pairs are summed, then joined back.
    """
    spark = ship(docs.sparkSession)
    distinct = (
        docs.where("text <> ''")
        .select("text", _salt().alias("salt"))
        .groupBy("text")
        .agg(F.count(F.lit(1)).alias("copies"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts"))
    )
    blocks = storage.materialize(
        distinct.mapInArrow(_blocks(a_path, b_path, block_bytes), _BLOCK_DDL), storage.fresh_dir(spark, "blocks")
    )
    wide = _pairs_of_ids(a_path, b_path)
    listed = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("slot", "p"))
    listed = listed.select("block", "slot", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    totals = listed.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.expr(f"pair div {wide}"))
    totals = storage.materialize(totals, storage.fresh_dir(spark, "pairs"))
    top = totals.groupBy("a").agg(F.max("docs").alias("top"))
    counts = totals.join(top, "a").withColumn("best", (F.col("docs") == F.col("top")))
    back = (
        listed.select("block", "slot", "pair")
        .join(counts.select("pair", "docs", F.col("best").cast("bigint").alias("best")), "pair")
        .groupBy("block")
        .agg(F.collect_list(F.struct("slot", "docs", "best")).alias("known"))
    )
    rows = blocks.drop("pairs", "docs").join(back, "block", "left")
    measures = rows.mapInArrow(_measured, _MEASURED_DDL)
    return measures, counts.select("a", F.expr(f"pair % {wide}").alias("b"), "docs", "best")


def _salt() -> F.Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")


def alignment_report(
    docs: DataFrame, a_path: str | None = None, b_path: str | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row per document row.

    Null and empty texts, and texts that one of the vocabularies does not give back byte by byte, have zeros and ''.
    Repeated rows count as documents of their own; null ids are passed on; an empty table gives no rows; only doc_id
    and text are read. A text held by a third of all rows is tokenised once, and its rows meet its measures in up to
    64 groups: measures are repeated for the groups that hold the text, so never more often than it has copies.
    """
    measures, _ = align(docs, a_path, b_path, block_bytes)
    held = measures.withColumn("salt", F.explode(F.expr(
        f"filter(sequence(0, {SALTS - 1}), s -> (shiftrightunsigned(salts, s) & 1L) = 1L)"
    ))).drop("salts")
    key = F.when(F.col("text") != "", F.unhex(F.sha2("text", 256)))
    rows = docs.select("doc_id", key.alias("text_key"), _salt().alias("salt"))
    return rows.join(held, ["text_key", "salt"], "left").select(
        "doc_id",
        *[F.coalesce(m, F.lit(0).cast("bigint")).alias(m) for m in [*MEASURES, "n_best", "count_sum"]],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
