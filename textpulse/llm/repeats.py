"""Repeated passages by prefix-free parsing.

Rolling-hash triggers cut every text into phrases that overlap, so that each string of LENGTH bytes lies in
exactly one phrase, chosen by its own bytes alone. Equal phrases are one dictionary entry with the first
document of its parse. Phrases whose trigger stands in other phrases too get a suffix array; its runs of
equal LENGTH-byte suffixes, with the parse's document order, give the first document of every string.
Texts are read once and shuffled once; no string of the corpus is ever sorted twice in one place, and
what is shuffled besides is a few bytes a phrase.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textpulse.llm.columns import guarded
from textpulse.llm.shipping import ship, tidy

LENGTH = 50
TRIGGER = 16
SPAN = LENGTH - TRIGGER + 1
# A part of the corpus, and a bucket of its phrases, has about this much text.
LEAST_PART, MOST_PART, PARTS = 4 << 20, 24 << 20, 64
# Phrases to compare take more room than their entries: so many buckets for each part.
SHARES = 4
_BUFFER = 2 << 20
_FLUSH = 8 << 20
# A trigger with more phrases than this in one task, or in all, has its strings dealt out one by one.
HOT_IN_TASK, HOT = 256, 4_096
ENTRY, DONE, EDGE, LOOSE = 0, 1, 2, 3

_MASK = (1 << 64) - 1
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_U64 = np.uint64

# kind: ENTRY (phrase of the parse), DONE (strings known to repeat), EDGE (phrase to compare), LOOSE (string to compare).
_MESSAGE = pa.schema([
    ("bucket", pa.int64()), ("kind", pa.int32()), ("ids", pa.binary()), ("tags", pa.binary()), ("parts", pa.binary()),
    ("ref", pa.binary()), ("lo", pa.binary()), ("size", pa.binary()), ("key", pa.binary()), ("rest", pa.binary()),
])
_MESSAGE_SQL = "bucket long, kind int, ids binary, tags binary, parts binary, ref binary, lo binary, size binary, key binary, rest binary"


def _mixed(values: np.ndarray) -> np.ndarray:
    out = values ^ (values >> _U64(30))
    out *= _U64(0xBF58476D1CE4E5B9)
    out ^= out >> _U64(27)
    out *= _U64(0x94D049BB133111EB)
    out ^= out >> _U64(31)
    return out


def _rolled(octets: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of every run of ``size`` bytes, put together from runs of powers of two."""
    run, width, total, covered = octets.astype(np.uint64) + _U64(1), 1, None, 0
    n = len(octets)
    while True:
        if size & width:
            if total is None:
                total = run
            else:
                m = n - covered - width + 1
                total = total[:m] * _U64(pow(_BASES[0], width, 1 << 64)) + run[covered : covered + m]
            covered += width
        if 2 * width > size:
            return total
        run = run[:-width] * _U64(pow(_BASES[0], width, 1 << 64)) + run[width:]
        width *= 2


def _slid(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` neighbours."""
    width = 1
    while 2 * width <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = span - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def phrases(octets: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, size, trigger hash, phrase hash) of the phrases of texts laid end to end.

    The trigger of a string is its TRIGGER-byte run with the smallest rolling hash; a phrase is a longest run
    of neighbouring strings with one trigger. ``size`` counts its strings, at most SPAN. First and last
    string together cover the phrase, so their hashes and the size stand for it.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if len(octets) < LENGTH:
        return none
    triggers = _mixed(_rolled(octets, TRIGGER))
    places = np.arange(len(triggers), dtype=np.uint64)
    least = _slid((triggers & ~_U64(63)) | (places & _U64(63)), SPAN)
    starts = places[: len(least)]
    anchor = (starts + ((least - starts) & _U64(63))).astype(np.int64)
    whole = np.ones(len(least), bool)
    for stop in stops:  # strings that would cross into the next text
        whole[max(stop - LENGTH + 1, 0) : stop] = False
    new = np.empty(len(least), bool)
    new[0] = True
    new[1:] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(least))
    keep = whole[lo]
    lo, hi = lo[keep], hi[keep]
    strings = _rolled(octets, LENGTH)
    phrase = _mixed(strings[lo] * _U64(3) + _mixed(strings[hi - 1]) + (hi - lo).astype(np.uint64))
    return lo, (hi - lo).astype(np.uint8), triggers[anchor[lo]], phrase


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _joined(lo: np.ndarray, size: np.ndarray, ref: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of strings, neighbouring and overlapping ones of a text made one."""
    order = np.lexsort((lo, ref))
    lo, stop, ref = lo[order].astype(np.int64), (lo + size.astype(np.int64))[order], ref[order].astype(np.int64)
    if not len(lo):
        return lo, lo, ref
    wide = ref << 33
    reach = np.maximum.accumulate(wide + stop)
    new = np.append(True, (wide + lo)[1:] > reach[:-1])
    at = np.flatnonzero(new)
    ends = reach[np.append(at[1:], len(lo)) - 1] - wide[at]
    return lo[at], ends - lo[at], ref[at]


def _packed(values: np.ndarray, kind: str) -> bytes:
    """Bytes of the numbers, all first bytes first, then all second ones: high bytes, mostly zero, compress away."""
    values = np.ascontiguousarray(values, kind)
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unpacked(data: list[bytes], kind: str) -> np.ndarray:
    """The numbers of all messages, end to end."""
    wide = np.dtype(kind).itemsize
    parts = [np.frombuffer(d, np.uint8).reshape(wide, -1).T for d in data if d]
    return np.ascontiguousarray(np.concatenate(parts)).view(kind).ravel() if parts else np.zeros(0, kind)


class _Texts:
    """Ids, tags and parts of the texts that messages refer to by number."""

    def __init__(self, ids=(), tags=(), parts=()):
        self.ids, self.tags, self.parts = np.array(ids, np.int64), np.array(tags, np.uint32), np.array(parts, np.int64)

    @staticmethod
    def of(messages: list[dict]) -> tuple[_Texts, list[int]]:
        out, base = _Texts(), [0]
        for m in messages:
            base.append(base[-1] + len(m["ids"]) // 8)
        out.ids = _unpacked([m["ids"] for m in messages], "<i8")
        out.tags = _unpacked([m["tags"] for m in messages], "<u4")
        out.parts = _unpacked([m["parts"] for m in messages], "<u4").astype(np.int64)
        return out, base

    def message(self, bucket: int, kind: int, ref: np.ndarray, lo: np.ndarray, size=None, key=None, rest=b"") -> dict:
        used, ref = np.unique(ref, return_inverse=True)
        return {
            "bucket": int(bucket), "kind": kind, "ids": _packed(self.ids[used], "<i8"), "tags": _packed(self.tags[used], "<u4"),
            "parts": _packed(self.parts[used], "<u4"), "ref": _packed(np.diff(ref, prepend=0), "<i4"), "lo": _packed(lo, "<u4"),
            "size": b"" if size is None else _packed(size, size.dtype.str), "key": b"" if key is None else key.tobytes(), "rest": rest,
        }

    def by_part(self, kind: int, ref: np.ndarray, lo: np.ndarray, size: np.ndarray, key=None) -> Iterator[dict]:
        """A message for each part of the corpus."""
        parts = self.parts[ref]
        order = np.argsort(parts, kind="stable")
        at = _runs(parts[order]) if len(order) else np.zeros(0, np.int64)
        for a, b in zip(at, np.append(at[1:], len(order))):
            some = order[a:b]
            yield self.message(parts[some[0]], kind, ref[some], lo[some], size[some], None if key is None else key[some])


def _read(messages: list[dict], kind: int, size_type, key_type=None, with_rest=False):
    """The texts and the arrays of all messages of a kind, laid end to end."""
    some = [m for m in messages if m["kind"] == kind]
    texts, base = _Texts.of(some)
    refs = [np.cumsum(_unpacked([m["ref"]], "<i4"), dtype=np.int64) + b for m, b in zip(some, base)]
    ref = np.concatenate(refs) if refs else np.zeros(0, np.int64)
    lo = _unpacked([m["lo"] for m in some], "<u4").astype(np.int64)
    size = _unpacked([m["size"] for m in some], np.dtype(size_type).str)
    key = np.frombuffer(b"".join(m["key"] for m in some), key_type) if key_type else None
    rest = b"".join(m["rest"] for m in some) if with_rest else b""
    return texts, ref, lo, size, key, rest


def _table(rows) -> pa.Table:
    return pa.Table.from_pylist(list(rows), schema=_MESSAGE)


# Key types: high half of the trigger hash with six bytes of the phrase hash; 80 bits of a string's hash.
_PHRASE_KEY = np.dtype([("trigger", "<u4"), ("phrase", "u1", 6)])
_STRING_KEY = np.dtype([("a", "<u8"), ("b", "<u2")])


def _octets(value) -> bytes:
    return b"" if value is None else value.encode("utf-8", "surrogatepass") if isinstance(value, str) else value


def _tag(octets: bytes) -> int:
    """Tells rows of one id apart that hold different texts."""
    return int.from_bytes(hashlib.blake2b(octets, digest_size=4).digest(), "little")


_NO_ID = (1 << 63) - 1


def _parse(buckets: int) -> Callable:
    """Texts to messages: what a task can settle is settled, a phrase is sent once with its first document."""

    def settled(texts: _Texts, ref, lo, size, trigger, phrase) -> Iterator[dict]:
        ids = texts.ids[ref]
        order = np.lexsort((ids, phrase, trigger))
        ref, lo, size, trigger, phrase, ids = (a[order] for a in (ref, lo, size, trigger, phrase, ids))
        at = _runs(trigger, phrase)
        group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(ids))))
        later = ids > ids[at][group]
        if later.any():
            joined = _joined(lo[later], size[later], ref[later])
            yield from texts.by_part(DONE, joined[2], joined[0], joined[1].astype(np.uint32))
        phrases_of = _runs(trigger[at])
        many = np.diff(np.append(phrases_of, len(at))) > HOT_IN_TASK
        crowd = np.repeat(many, np.diff(np.append(phrases_of, len(at))))[group]
        marker = np.zeros(len(ids), bool)
        marker[at[phrases_of]] = True
        loose = crowd & ~marker & ~later
        if loose.any():
            yield from texts.by_part(LOOSE, ref[loose], lo[loose], size[loose])
        sent = np.flatnonzero(~later & ~loose)
        flagged = size | np.where(crowd & marker, 128, 0).astype(np.uint8)
        where = (trigger[sent] % _U64(buckets)).astype(np.int64)
        sent = sent[np.lexsort((lo[sent], ref[sent], where))]
        where = (trigger[sent] % _U64(buckets)).astype(np.int64)
        ends = _runs(where) if len(where) else np.zeros(0, np.int64)
        for a, b in zip(ends, np.append(ends[1:], len(sent))):
            some = sent[a:b]
            key = np.empty(len(some), _PHRASE_KEY)
            key["trigger"] = (trigger[some] >> _U64(32)).astype(np.uint32)
            key["phrase"] = phrase[some].view(np.uint8).reshape(-1, 8)[:, :6]
            yield texts.message(where[a], ENTRY, ref[some], lo[some], flagged[some], key)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        ids, tags, parts, weight = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held[0]:
                texts = _Texts(ids, tags, parts)
                rows = list(settled(texts, *[np.concatenate(h) for h in held]))
                for start in range(0, len(rows), 200):
                    yield from _table(rows[start : start + 200]).to_batches()
            for h in (*held, ids, tags, parts):
                h.clear()
            tidy()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "_part")]
            pending, size = [], 0
            for doc_id, text, part in zip(*columns):
                octets = _octets(text)
                ids.append(_NO_ID if doc_id is None else doc_id)
                tags.append(_tag(octets))
                parts.append(part)
                pending.append((len(ids) - 1, octets))
                size += len(octets)
                if size >= _BUFFER:
                    _add(held, pending)
                    weight += size
                    pending, size = [], 0
                    if weight >= _FLUSH:
                        yield from flush()
                        weight = 0
            _add(held, pending)
            weight += size
            if weight >= _FLUSH:
                yield from flush()
                weight = 0
        yield from flush()

    return parse


def _add(held: list[list], pending: list[tuple[int, bytes]]) -> None:
    """Phrases of some texts. A long text is taken in slices that overlap by a string less a byte."""
    slices = []
    for number, octets in pending:
        for start in range(0, max(len(octets) - LENGTH + 1, 1), _BUFFER):
            slices.append((number, start, octets[start : start + _BUFFER + LENGTH - 1]))
    group, size = [], 0
    for s in [*slices, None]:
        if group and (s is None or size + len(s[2]) > 2 * _BUFFER):
            lengths = np.array([len(g[2]) for g in group])
            stops = np.cumsum(lengths)
            lo, n, trigger, phrase = phrases(np.frombuffer(b"".join(g[2] for g in group), np.uint8), stops)
            which = np.searchsorted(stops, lo, side="right")
            first = np.array([g[1] for g in group]) - (stops - lengths)
            for h, values in zip(held, (np.array([g[0] for g in group])[which], lo + first[which], n, trigger, phrase)):
                h.append(values)
            group, size = [], 0
        if s is not None:
            group.append(s)
            size += len(s[2])


def _dictionary(table: pa.Table) -> pa.Table:
    """Entries of a bucket to messages for the parts: phrases whose first document is an earlier one are DONE;
    of the others those whose trigger has several phrases, from several documents, are EDGE or LOOSE."""
    messages = table.to_pylist()
    out = [{**m, "bucket": int(_unpacked([m["parts"]], "<u4")[0])} for m in messages if m["kind"] != ENTRY]
    texts, ref, lo, size, key, _ = _read(messages, ENTRY, np.uint8, _PHRASE_KEY)
    if not len(ref):
        return _table(out)
    marked, size = size >= 128, size & 127
    ids = texts.ids[ref]
    trigger = key["trigger"].copy()
    phrase = np.zeros((len(ref), 8), np.uint8)
    phrase[:, :6] = key["phrase"]
    phrase = phrase.view(np.uint64).ravel()
    order = np.lexsort((phrase, trigger))
    ref, lo, size, ids, trigger, phrase, marked = (a[order] for a in (ref, lo, size, ids, trigger, phrase, marked))
    at = _runs(trigger, phrase)
    counts = np.diff(np.append(at, len(ids)))
    first = np.minimum.reduceat(ids, at)
    group = np.repeat(np.arange(len(at)), counts)
    done = ids > first[group]
    top = _runs(trigger[at])
    width = np.diff(np.append(top, len(at)))
    several = (width > 1) & (np.minimum.reduceat(first, top) < np.maximum.reduceat(first, top))
    hot = np.add.reduceat(np.add.reduceat(marked.astype(np.int64), at), top) > 0
    compared = np.repeat(several | hot, width)[group] & ~done
    loose = np.repeat(hot | (width > HOT), width)[group]
    if done.any():
        out += texts.by_part(DONE, ref[done], lo[done], size[done].astype(np.uint32))
    edge = compared & ~loose
    if edge.any():
        out += texts.by_part(EDGE, ref[edge], lo[edge], size[edge], trigger[edge])
    if (compared & loose).any():
        some = compared & loose
        out += texts.by_part(LOOSE, ref[some], lo[some], size[some])
    return _table(out)


class _Part:
    """The texts of one part of the corpus, found by id and tag."""

    def __init__(self, table: pa.Table):
        self.octets = [_octets(v) for v in table.column("text").to_pylist()]
        self.ids = [_NO_ID if v is None else v for v in table.column("doc_id").to_pylist()]
        self.tags = [_tag(o) for o in self.octets]
        self.number: dict[tuple[int, int], int] = {}
        self.same: dict[int, int] = {}
        for i, name in enumerate(zip(self.ids, self.tags)):
            self.same[i] = self.number.setdefault(name, i)

    def refs(self, texts: _Texts, ref: np.ndarray) -> np.ndarray:
        found = np.array([self.number[n] for n in zip(texts.ids.tolist(), texts.tags.tolist())], np.int64)
        return found[ref] if len(ref) else ref


def _laid(octets: list[bytes], ref: np.ndarray, lo: np.ndarray, size: np.ndarray) -> bytes:
    """The phrases' bytes end to end."""
    return b"".join(
        octets[r][a : a + n + LENGTH - 1] for r, a, n in zip(ref.tolist(), lo.tolist(), size.tolist())
    )


def _strings(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, place in it, place among the laid bytes) of every string of phrases."""
    size = size.astype(np.int64)
    which = np.repeat(np.arange(len(size)), size)
    step = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
    begin = np.cumsum(size + LENGTH - 1) - (size + LENGTH - 1)
    return which, step, begin[which] + step


def _suffix_array(laid: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the strings, their order by their bytes, the starts of runs of equal ones)."""
    matrix = np.lib.stride_tricks.sliding_window_view(laid, LENGTH)[begin]
    # Big-endian words compare like the bytes they hold; the last word is padded.
    padded = np.zeros((len(matrix), -(-LENGTH // 8) * 8), np.uint8)
    padded[:, :LENGTH] = matrix
    words = padded.view(">u8").astype(np.uint64)
    del padded
    order = np.argsort(words[:, 0], kind="stable")
    head = words[order, 0]
    tied = np.zeros(len(order), bool)
    equal = head[1:] == head[:-1]
    tied[1:] |= equal
    tied[:-1] |= equal
    at = np.flatnonzero(tied)
    some = order[at]
    order[at] = some[np.lexsort(tuple(words[some, c] for c in range(words.shape[1] - 1, -1, -1)))]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in range(words.shape[1]):
        ranked = words[order, c]
        new[1:] |= ranked[1:] != ranked[:-1]
    return matrix, order, np.flatnonzero(new)


def _compare(buckets: int) -> Callable:
    """Joins the messages of a part with its texts. Phrases to compare go on with their bytes, to the bucket of
    their trigger. Strings of hot triggers are sorted here and go on once each, by their own hash."""

    def compare(texts: pa.Table, messages: pa.Table) -> pa.Table:
        rows = messages.to_pylist()
        if not rows:
            return _table([])
        part = _Part(texts)
        number = texts.column("_part")[0].as_py()
        table = _Texts(part.ids, part.tags, [number] * len(part.ids))
        out = []
        known, ref, lo, size, _, _ = _read(rows, DONE, np.uint32)
        done = [(part.refs(known, ref), lo, size.astype(np.int64))]

        known, ref, lo, size, trigger, _ = _read(rows, EDGE, np.uint8, np.uint32)
        ref = part.refs(known, ref)
        where = trigger.astype(np.int64) % buckets
        order = np.lexsort((lo, ref, where))
        ends = _runs(where[order]) if len(order) else np.zeros(0, np.int64)
        for a, b in zip(ends, np.append(ends[1:], len(order))):
            some = order[a:b]
            octets = _laid(part.octets, ref[some], lo[some], size[some])
            out.append(table.message(where[some[0]], EDGE, ref[some], lo[some], size[some], rest=octets))

        known, ref, lo, size, _, _ = _read(rows, LOOSE, np.uint8)
        if len(ref):
            ref = part.refs(known, ref)
            which, step, begin = _strings(size)
            owner, place = ref[which], lo[which] + step
            matrix, order, at = _suffix_array(np.frombuffer(_laid(part.octets, ref, lo, size), np.uint8), begin)
            ids = np.array(part.ids)[owner[order]]
            first = np.minimum.reduceat(ids, at)
            group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(order))))
            later = ids > first[group]
            done.append((owner[order][later], place[order][later], np.ones(later.sum(), np.int64)))
            key = _string_keys(matrix[order[at]])[group[~later]]
            some = order[~later]
            where = (key["a"] % _U64(buckets)).astype(np.int64)
            dealt = np.lexsort((place[some], owner[some], where))
            ends = _runs(where[dealt])
            for a, b in zip(ends, np.append(ends[1:], len(dealt))):
                d = dealt[a:b]
                out.append(table.message(where[d[0]], LOOSE, owner[some[d]], place[some[d]], key=key[d]))
        ref, lo, size = (np.concatenate(c) for c in zip(*done))
        lo, size, ref = _joined(lo, size, ref)
        if len(ref):
            out.append(table.message(number % buckets, DONE, ref, lo, size.astype(np.uint32)))
        return _table(out)

    return compare


def _string_keys(matrix: np.ndarray) -> np.ndarray:
    key = np.empty(len(matrix), _STRING_KEY)
    for name, base in zip("ab", _BASES):
        total = np.zeros(len(matrix), np.uint64)
        for c in range(LENGTH):
            total = total * _U64(base) + matrix[:, c] + _U64(1)
        key[name] = _mixed(total) if name == "a" else _mixed(total) & _U64(0xFFFF)
    return key


def _tidied(function: Callable) -> Callable:
    """The function, after which the worker's freed memory goes back."""

    def run(*tables: pa.Table) -> pa.Table:
        try:
            return function(*tables)
        finally:
            tidy()

    # Spark looks at the number of arguments.
    return (lambda a, b: run(a, b)) if function.__code__.co_argcount == 2 else (lambda a: run(a))


def _resolve(table: pa.Table) -> pa.Table:
    """Suffix arrays of a bucket's phrases: a string is DONE where its run begins in an earlier document."""
    rows = table.to_pylist()
    out = [{**m, "bucket": int(_unpacked([m["parts"]], "<u4")[0])} for m in rows if m["kind"] == DONE]
    texts, ref, lo, size, _, octets = _read(rows, EDGE, np.uint8, with_rest=True)
    found = []
    if len(ref):
        which, step, begin = _strings(size)
        _, order, at = _suffix_array(np.frombuffer(octets, np.uint8), begin)
        found.append((texts, ref[which][order], (lo[which] + step)[order], at))
    texts, ref, lo, _, key, _ = _read(rows, LOOSE, np.uint8, _STRING_KEY)
    if len(ref):
        a, b = key["a"].copy(), key["b"].copy()
        order = np.lexsort((b, a))
        found.append((texts, ref[order], lo[order], _runs(a[order], b[order])))
    for texts, ref, lo, at in found:
        ids = texts.ids[ref]
        group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(ids))))
        later = ids > np.minimum.reduceat(ids, at)[group]
        if later.any():
            lo, size, ref = _joined(lo[later], np.ones(later.sum(), np.int64), ref[later])
            out += texts.by_part(DONE, ref, lo, size.astype(np.uint32))
    return _table(out)


def _cut(names: list[str]) -> Callable:
    """Drops every byte that a repeated string covers."""

    def cut(texts: pa.Table, messages: pa.Table) -> pa.Table:
        part = _Part(texts)
        known, ref, lo, size, _, _ = _read(messages.to_pylist(), DONE, np.uint32)
        lo, size, ref = _joined(lo, size.astype(np.int64) + LENGTH - 1, part.refs(known, ref))
        first = np.searchsorted(ref, np.arange(len(part.ids) + 1))
        kept, removed, spans = [], [], []
        for i, octets in enumerate(part.octets):
            same = part.same[i]
            at, pieces = 0, []
            for k in range(first[same], first[same + 1]):
                pieces.append(octets[at : lo[k]])
                at = lo[k] + size[k]
            pieces.append(octets[at:])
            kept.append(b"".join(pieces))
            removed.append(len(octets) - len(kept[-1]))
            spans.append(int(first[same + 1] - first[same]))
        made = {
            "n_bytes": pa.array([len(o) for o in part.octets], pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            "text": pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()),
        }
        return pa.Table.from_arrays([made[n] if n in made else texts.column(n) for n in names], names=names)

    return cut


def _spread(docs: DataFrame, schema: StructType) -> DataFrame:
    """The plan, from texts to what is left of them; rows have the columns of ``schema``."""
    ship(docs.sparkSession)
    names = schema.names
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // max(LEAST_PART, min(MOST_PART, total // PARTS))))
    # By id and text: many rows of one id, or without any, are dealt over all parts.
    rows = docs.withColumn("_part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("bigint"))
    parsed = rows.select("doc_id", "text", "_part").mapInArrow(_parse(parts), _MESSAGE_SQL)
    settled = parsed.groupBy("bucket").applyInArrow(_tidied(_dictionary), _MESSAGE_SQL)
    by_part = rows.groupBy("_part")
    compared = by_part.cogroup(settled.groupBy("bucket")).applyInArrow(_tidied(_compare(SHARES * parts)), _MESSAGE_SQL)
    resolved = compared.groupBy("bucket").applyInArrow(_tidied(_resolve), _MESSAGE_SQL)
    return by_part.cogroup(resolved.groupBy("bucket")).applyInArrow(_tidied(_cut(names)), schema)


def removal_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), a row per document row.

    A byte goes if a LENGTH-byte string over it also starts in a document with a smaller id, judged on the
    input. Null texts count as empty; texts below LENGTH bytes stay whole; rows of one id do not repeat each
    other; null ids come after all others; an empty table gives no rows; only doc_id and text are read.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _spread(rows, StructType.fromDDL(schema))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with what remains of their texts, and ``n_chars``, if there, counted anew. A character
    of which only some bytes go leaves with them; a null text stays null."""
    table, restored = guarded(docs, "doc_id", "text")
    rows = table.withColumn("_null", F.col("text").isNull())
    kept = restored(_spread(rows, rows.schema).withColumn("text", F.when(~F.col("_null"), F.col("text"))))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept
