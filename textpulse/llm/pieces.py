"""Merge-type SentencePiece vocabularies: encoding by a score-ordered agenda, and decoding.

The library gives the vocabulary and checks the work: every part of a text that a worker meets for the first
time is encoded by both, and a difference raises.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.llm.agenda import merged
from textpulse.llm.shipping import ship, tidy

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
# Parts up to this length are kept by a worker, this many in each of two generations.
CACHED_LENGTH = 48
CACHED_PARTS = 120_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def _fields(message: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, message[at : at + size]
        at += size


def _joinable(pieces: Iterable[str]) -> list[set[str]]:
    """Sets of characters that stand side by side in some piece, spaces aside. No merge crosses two characters of
    different sets: its result would be a piece that holds them side by side."""
    group: dict[str, set[str]] = {}
    for piece in pieces:
        bare = piece.lstrip(SPACE)
        for one, other in zip(bare, bare[1:]):
            first, second = group.setdefault(one, {one}), group.setdefault(other, {other})
            if first is not second:
                small, large = sorted((first, second), key=len)
                large |= small
                group.update(dict.fromkeys(small, large))
    return list({id(g): g for g in group.values()}.values())


class _Parts(dict):
    """What is known of the parts of texts: decimal ids joined by spaces, and decoded bytes. A part that is not at
    hand is taken over from the older generation, or merged."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model, self.older, self.fresh = model, {}, {}

    def __missing__(self, part: str) -> tuple[bytes, bytes]:
        found = self.older.get(part)
        if found is None:
            ids = self.fresh[part] = self.model.merge(part)
            found = b" ".join(map(self.model.decimal.__getitem__, ids)), b"".join(map(self.model.raw.__getitem__, ids))
        self[part] = found
        return found

    def settle(self) -> _Parts:
        """Checks what is new. Long parts go; a full generation becomes the older one."""
        self.model.check(self.fresh)
        for part in self.fresh:
            if len(part) > CACHED_LENGTH:
                self.pop(part, None)
        self.fresh = {}
        if len(self) <= CACHED_PARTS:
            return self
        following = _Parts(self.model)
        following.older, self.older = self, {}
        return following


class PieceModel:
    """A vocabulary of merges with byte fallback, identity normalisation and a leading space."""

    def __init__(self, path: str):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        model = dict(_fields(lib.serialized_model_proto()))
        trainer, normalizer = dict(_fields(model[2])), dict(_fields(model[3]))
        # Field numbers of the published model format.
        merges, byte_fallback = trainer.get(3) == 2, trainer.get(35) == 1
        identity = not normalizer.get(2) and normalizer.get(3, 1) == 1 and normalizer.get(4, 1) == 0
        if not (merges and byte_fallback and identity and trainer.get(24, 0) == 0):
            raise ValueError("needs a merge vocabulary with byte fallback, a leading space and no other normalisation")
        size = lib.vocab_size()
        self.end = lib.eos_id()
        self.ids: dict[str, int] = {}
        scores: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.raw: list[bytes] = []
        for i in range(size):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.raw.append(bytes([value]))
            elif lib.is_control(i):
                self.raw.append(b"")
            elif lib.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            else:
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError("a piece goes on after a space, so parts would not be independent")
                self.ids[piece] = i
                scores[piece] = lib.get_score(i)
                self.raw.append(piece.replace(SPACE, " ").encode())
        place = {score: i for i, score in enumerate(sorted(set(scores.values()), reverse=True))}
        # Equal scores share a rank, so that the leftmost pair among them goes first.
        self.ranks = {piece: place[score] for piece, score in scores.items()}
        self.bytes_of = set(self.byte_ids)
        self.leading = {i for piece, i in self.ids.items() if piece.startswith(SPACE)}
        self.decimal = [str(i).encode() for i in range(size)]
        sets = _joinable(self.ids)
        runs = "|".join(f"[{re.escape(''.join(sorted(g)))}]+" for g in sorted(sets, key=len, reverse=True))
        rest = re.escape("".join(sorted(set().union(*sets))))
        self._part = re.compile(f"{SPACE}*(?:{runs + '|' if runs else ''}[^{SPACE}{rest}])|{SPACE}+")
        # Starts the texts that the library is asked for, so that it puts no space before a part.
        self._anchor = next(
            c for c in "\n\t\x00" if not any(c in g for g in sets) and SPACE + c not in self.ids
        )
        self._anchored = len(lib.encode(self._anchor))
        self.known = _Parts(self)

    def merge(self, part: str) -> tuple[int, ...]:
        """Ids of one part: of all adjacent pairs on the agenda the best-scored is merged first, the leftmost among equals."""
        symbols = merged(list(part), self.ranks)
        ids: list[int] = []
        for symbol in symbols:
            found = self.ids.get(symbol)
            if found is None:
                ids.extend(self.byte_ids[b] for b in symbol.encode())
            else:
                ids.append(found)
        return tuple(ids)

    def parts(self, text: str) -> list[str]:
        """Runs of spaces with the joinable characters that follow. No piece goes on after a space that follows
        something else, and none holds characters of two sets, so no merge crosses a part's border."""
        return self._part.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def joined_all(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """For each text its decimal ids joined by spaces, the end id last, and the bytes they decode to.

        Python's search for cycles waits meanwhile: nothing here makes any, and it would walk all lists again and again.
        """
        searching = gc.isenabled()
        gc.disable()
        try:
            out = []
            known, end = self.known.__getitem__, self.decimal[self.end]
            for text in texts:
                found = list(map(known, self.parts(text)))
                ids = [ids for ids, _ in found]
                ids.append(end)
                out.append((b" ".join(ids), b"".join([raw for _, raw in found])[1:]))
            self.known = self.known.settle()
            return out
        finally:
            if searching:
                gc.enable()

    def forget(self) -> None:
        """Drops the parts at hand: a worker goes on to other stages, which need its memory."""
        self.known = _Parts(self)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """All ids of each text, the end id last."""
        return [list(map(int, ids.split())) for ids, _ in self.joined_all(texts)]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def check(self, new: dict[str, tuple[int, ...]]) -> None:
        """Compares with the library, which adds a leading space itself: to a part without one after an anchor that
        merges with nothing. It adds none to an empty text, so a space on its own cannot be asked for."""
        asked = [s for s in new if s != SPACE]
        spaced = [s[0] == SPACE for s in asked]
        texts = [(s[1:] if own else self._anchor + s).replace(SPACE, " ") for s, own in zip(asked, spaced)]
        wanted = self.library.encode(texts, num_threads=1)
        for part, own, ids in zip(asked, spaced, wanted):
            if list(new[part]) != (ids if own else ids[self._anchored :]):
                raise AssertionError(f"the agenda and the library differ on {part!r}: {new[part]} and {ids}")

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces in a row, the space of a first piece dropped, control ids silent; a byte that belongs to
        no character becomes U+FFFD."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = "".join(self._mended(ids))
        first = next((i for i in ids if self.raw[i]), self.end)
        return text[1:] if first in self.leading else text

    def _mended(self, ids: list[int]) -> Iterator[str]:
        at = 0
        while at < len(ids):
            stop = at
            while stop < len(ids) and ids[stop] in self.bytes_of:
                stop += 1
            if stop == at:
                yield self.raw[ids[at]].decode()
                at += 1
                continue
            run, at = b"".join(self.raw[i] for i in ids[at:stop]), stop
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        yield run[:size].decode()
                    except UnicodeDecodeError:
                        continue
                    break
                else:
                    size = 1
                    yield "�"
                run = run[size:]


_MODELS: dict[str, PieceModel] = {}


def model_at(path: str) -> PieceModel:
    """One model a worker process; the parts it keeps live as long as a task."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _digests(path: str | None) -> Callable:
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = model_at(path or default_model())
        for texts in batches:
            values = [t or "" for t in texts]
            rows = []
            for start in range(0, len(values), 100):
                for ids, decoded in model.joined_all(values[start : start + 100]):
                    rows.append(
                        (ids.count(b" ") + 1, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest())
                    )
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            tidy()
        model.forget()
        tidy()

    return F.pandas_udf(digest, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _ids(path: str | None) -> Callable:
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_at(path or default_model())
        for texts in batches:
            yield pd.Series(model.encode_all([t or "" for t in texts]))

    return F.pandas_udf(encode, "array<int>")


def _texts(path: str | None) -> Callable:
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_at(path or default_model())
        for lists in batches:
            yield pd.Series([None if ids is None else model.decode(list(ids)) for ids in lists])

    return F.pandas_udf(decode, "string")


def encoded(docs: DataFrame, path: str | None = None, text: str = "text", out: str = "ids") -> DataFrame:
    """Adds the ids of a text column. A null text encodes like an empty one: the end id alone."""
    ship(docs.sparkSession)
    return docs.withColumn(out, _ids(path)(F.col(f"`{text}`")))


def decoded(rows: DataFrame, path: str | None = None, ids: str = "ids", out: str = "text") -> DataFrame:
    """Adds the text of an id column; null ids give null."""
    ship(rows.sparkSession)
    return rows.withColumn(out, _texts(path)(F.col(f"`{ids}`")))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), a row per document row.

    Ids and decoded texts are made and digested batch by batch inside the worker. Null texts count as empty
    (the end id alone); repeated rows stay; an empty table gives no rows; only doc_id and text are read.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", _digests(path)(F.col("text")).alias("d"))
    return rows.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")
