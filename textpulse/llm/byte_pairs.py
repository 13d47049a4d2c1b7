"""Byte-level merge vocabularies: encoding and decoding as reductions over a tree of halves.

A text is cut in halves down to short leaves, the leaves are encoded, and neighbours are joined on the way up. Joins
are associative, so any tree gives the same ids. Two facts say what a join may leave alone:

* Matches. The pattern never carries a match from a non-space on to a space, so a place between the two is a border
  of matches whatever stands around it. Only what lies between the last such place on the left and the first on the
  right is matched anew.
* Tokens. A row of tokens is the encoding of its bytes if, and only if, every two neighbours are the encoding of
  theirs: merges inside a token do not look outside, so the first merge across a border would also be made with the
  two tokens alone. A window about the border is encoded anew and grows until it gets on with its neighbours.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.llm.agenda import LISTED, merged
from textpulse.llm.shipping import ship, tidy

RANKS = "byte_bpe_50k.tiktoken"
# Leaves of the trees: characters of a text, bytes of a match, ids of a decoded list.
TEXT_LEAF, MATCH_LEAF, IDS_LEAF = 4_096, 16, 4_096
# Matches up to this length are kept by a worker, this many in each of two generations; pairs of tokens likewise.
CACHED_LENGTH, CACHED_MATCHES, CACHED_PAIRS = 48, 250_000, 500_000
# A sure border of matches: a space after a non-space.
_BORDER = re.compile(r"(?<=\S)(?= )")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path(RANKS)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class _Matches(dict):
    """Ids of matches as little-endian numbers; new ones are encoded, or taken over from the older generation."""

    def __init__(self, model: BytePairs):
        super().__init__()
        self.model, self.older = model, {}

    def __missing__(self, match: str) -> bytes:
        found = self.older.get(match)
        if found is None:
            found = packed(self.model.encode_match(match.encode()))
        if len(match) <= CACHED_LENGTH:
            self[match] = found
        return found

    def settle(self) -> _Matches:
        if len(self) <= CACHED_MATCHES:
            return self
        following = _Matches(self.model)
        following.older, self.older = self, {}
        return following


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def unpacked(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").tolist()


def halved(size: int) -> int:
    """The largest power of two below a size: left halves are whole powers, so that repetitive strings are cut in step."""
    return 1 << (size - 1).bit_length() - 1


class Node(NamedTuple):
    """An encoded stretch of text. ``head`` reaches to its first sure border and ``tail`` starts at its last one, each
    with its ids; ``body`` holds the ids between. A stretch without a border is all head and has no tail."""

    head: str
    head_ids: bytes
    body: list[bytes]
    tail: str | None
    tail_ids: bytes


class BytePairs:
    """A vocabulary of ranked byte strings and the pattern that splits texts before any merge."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        if sorted(self.ranks.values()) != list(range(len(self.ranks))):
            raise ValueError("ranks must run from 0 without gaps")
        self.raw: list[bytes] = sorted(self.ranks, key=self.ranks.__getitem__)
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("every single byte must have a rank")
        self._single = [self.ranks[bytes([b])] for b in range(256)]
        # What two tokens side by side merge to, by both ranks in one number.
        self._pairs: dict[int, int] = {}
        for rank, token in enumerate(self.raw):
            for cut in range(1, len(token)):
                one, other = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if one is not None and other is not None:
                    self._pairs[one << 32 | other] = rank
        lost = next((t for t in self.raw if self.merge(t) != [self.ranks[t]]), None)
        if lost is not None:
            raise ValueError(f"no merges lead to the entry {lost!r}, so neighbours would not settle an encoding")
        self.matches: Callable[[str], list[str]] = regex.compile(pattern).findall
        self._stable: dict[tuple[int, int], bool] = {}
        self.known = _Matches(self)

    def merge(self, data: bytes) -> list[int]:
        """The plain encoding of a few bytes: the pair of the lowest rank is merged first, the leftmost among equals.
        A list of the pairs' ranks is the agenda; long strings take the heap of ``agenda.merged``."""
        if len(data) > LISTED:
            return list(map(self.ranks.__getitem__, merged([data[i : i + 1] for i in range(len(data))], self.ranks)))
        rank_of, never = self._pairs.get, len(self.raw)
        ids = list(map(self._single.__getitem__, data))
        agenda = [rank_of(a << 32 | b, never) for a, b in zip(ids, ids[1:])]
        while agenda:
            best = min(agenda)
            if best == never:
                break
            i = agenda.index(best)
            ids[i] = best
            del ids[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = rank_of(best << 32 | ids[i + 1], never)
            if i:
                agenda[i - 1] = rank_of(ids[i - 1] << 32 | best, never)
        return ids

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))

    def stable(self, one: int, other: int) -> bool:
        """Whether the two tokens side by side are the encoding of their bytes."""
        found = self._stable.get((one, other))
        if found is None:
            if len(self._stable) >= CACHED_PAIRS:
                self._stable.clear()
            found = self._stable[one, other] = self.merge(self.raw[one] + self.raw[other]) == [one, other]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded byte strings put together. The window about the border doubles until the tokens
        outside are settled: at worst it is the whole."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        size = 1
        while True:
            start, stop = max(0, len(left) - size), min(len(right), size)
            window = self.merge(self.bytes_of(left[start:]) + self.bytes_of(right[:stop]))
            before = start == 0 or self.stable(left[start - 1], window[0])
            after = stop == len(right) or self.stable(window[-1], right[stop])
            if before and after:
                return left[:start] + window + right[stop:]
            size *= 2

    def encode_match(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) <= MATCH_LEAF:
            return self.merge(data)
        half = halved(len(data))
        return self.join(self.encode_match(data[:half]), self.encode_match(data[half:]))

    def encode_matches(self, matches: list[str]) -> bytes:
        return b"".join(map(self.known.__getitem__, matches))

    def _bridge(self, left: str, left_ids: bytes, right: str, right_ids: bytes) -> bytes:
        """The ids of two encoded stretches put together, none of whose joined places is a sure border. Where only
        the match across the border is new, the tokens of its two parts are joined; otherwise matches are encoded."""
        ours, theirs, now = self.matches(left), self.matches(right), self.matches(left + right)
        if now == ours + theirs:
            return left_ids + right_ids
        if now != [*ours[:-1], ours[-1] + theirs[0], *theirs[1:]]:
            return self.encode_matches(now)
        before, after = unpacked(left_ids), unpacked(right_ids)
        start, missing = len(before), len(ours[-1].encode())
        while missing:
            start -= 1
            missing -= len(self.raw[before[start]])
        stop, missing = 0, len(theirs[0].encode())
        while missing:
            missing -= len(self.raw[after[stop]])
            stop += 1
        return packed(before[:start] + self.join(before[start:], after[:stop]) + after[stop:])

    def _leaf(self, text: str) -> Node:
        border = _BORDER.search(text)
        if border is None:
            return Node(text, self.encode_matches(self.matches(text)), [], None, b"")
        first, last = border.start(), text.rindex(" ")
        while text[last - 1].isspace():
            last = text.rindex(" ", 0, last)
        head, body, tail = (self.matches(t) for t in (text[:first], text[first:last], text[last:]))
        return Node(text[:first], self.encode_matches(head), [self.encode_matches(body)], text[last:], self.encode_matches(tail))

    def _joined(self, left: Node, right: Node) -> Node:
        ours, our_ids = (left.head, left.head_ids) if left.tail is None else (left.tail, left.tail_ids)
        across = ours + right.head
        if right.head[:1] == " " and not ours[-1:].isspace():
            ids, closed = (our_ids, right.head_ids), True
        else:
            ids, closed = (self._bridge(ours, our_ids, right.head, right.head_ids),), False
        if left.tail is not None and right.tail is not None:
            left.body.extend([*ids, *right.body])
            return left._replace(tail=right.tail, tail_ids=right.tail_ids)
        if closed:
            if left.tail is None and right.tail is None:
                return Node(ours, our_ids, [], right.head, right.head_ids)
            if left.tail is None:
                return Node(ours, our_ids, [right.head_ids, *right.body], right.tail, right.tail_ids)
            left.body.append(our_ids)
            return left._replace(tail=right.head, tail_ids=right.head_ids)
        if left.tail is None:
            return right._replace(head=across, head_ids=ids[0])
        return left._replace(tail=across, tail_ids=ids[0])

    def _tree(self, text: str) -> Node:
        if len(text) <= TEXT_LEAF:
            return self._leaf(text)
        half = halved(len(text))
        return self._joined(self._tree(text[:half]), self._tree(text[half:]))

    def encode_bytes(self, text: str) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit numbers."""
        node = self._tree(text)
        return b"".join([node.head_ids, *node.body, node.tail_ids])

    def encode(self, text: str) -> list[int]:
        return unpacked(self.encode_bytes(text))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= IDS_LEAF:
            return self.bytes_of(ids)
        half = halved(len(ids))
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of many texts as bytes. Python's search for cycles waits meanwhile: nothing here makes any."""
        searching = gc.isenabled()
        gc.disable()
        try:
            out = [self.encode_bytes(t) for t in texts]
            self.known = self.known.settle()
            return out
        finally:
            if searching:
                gc.enable()


_MODELS: dict[tuple[str, str], BytePairs] = {}


def model_at(path: str | None, pattern: str | None) -> BytePairs:
    """One model a worker process; what it keeps lives as long."""
    key = path or default_ranks(), pattern or default_pattern()
    if key not in _MODELS:
        _MODELS[key] = BytePairs(*key)
    return _MODELS[key]


def _digests(path: str | None, pattern: str | None) -> Callable:
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = model_at(path, pattern)
        for texts in batches:
            rows = []
            for start in range(0, len(texts), 100):
                for ids in model.encode_all([t or "" for t in texts[start : start + 100]]):
                    decoded = model.decode(unpacked(ids))
                    rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            tidy()

    return F.pandas_udf(digest, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _ids(path: str | None, pattern: str | None) -> Callable:
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_at(path, pattern)
        for texts in batches:
            yield pd.Series([np.frombuffer(ids, "<u4").astype("i4") for ids in model.encode_all([t or "" for t in texts])])

    return F.pandas_udf(encode, "array<int>")


def _bytes(path: str | None, pattern: str | None) -> Callable:
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_at(path, pattern)
        for lists in batches:
            yield pd.Series([None if ids is None else model.decode(list(ids)) for ids in lists])

    return F.pandas_udf(decode, "binary")


def encoded(
    docs: DataFrame, path: str | None = None, pattern: str | None = None, text: str = "text", out: str = "ids"
) -> DataFrame:
    """Adds the ids of a text column; a null text has none, like an empty one."""
    ship(docs.sparkSession)
    return docs.withColumn(out, _ids(path, pattern)(F.col(f"`{text}`")))


def decoded(
    rows: DataFrame, path: str | None = None, pattern: str | None = None, ids: str = "ids", out: str = "bytes"
) -> DataFrame:
    """Adds the bytes of an id column; null ids give null."""
    ship(rows.sparkSession)
    return rows.withColumn(out, _bytes(path, pattern)(F.col(f"`{ids}`")))


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), a row per document row.

    Texts are encoded, decoded again and digested batch by batch inside the worker; nothing is shuffled. Null texts
    count as empty: no ids, and the digest of nothing. Repeated rows stay; null ids are passed on; an empty table
    gives no rows; only doc_id and text are read. Very long texts take time and memory in proportion.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", _digests(path, pattern)(F.col("text")).alias("d"))
    return rows.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")
