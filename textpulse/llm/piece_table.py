"""Fill-in-the-middle documents as piece tables.

A document is a row of descriptors over two buffers that never change: its text and the sentinels. Cutting splits a
descriptor, an arrangement puts descriptors in another order with sentinels between, and the inverse order gives the
text back. Outputs are hashed descriptor by descriptor, so no new text has to be put together for it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse.llm.shipping import ship, tidy

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80
TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_tokens = re.compile(TOKEN).findall
# Which of (prefix, middle, suffix) stands where in an arrangement.
ORDERS = {PSM: (0, 2, 1), SPM: (2, 0, 1)}
_MARKS = (PREFIX, MIDDLE, SUFFIX)


class Piece(NamedTuple):
    """A stretch of a buffer: the text, or the sentinels."""

    sentinel: bool
    start: int
    stop: int


def cut(pieces: list[Piece], at: int) -> list[Piece]:
    """Splits the descriptor that holds the character place ``at``; at a border, one of the halves is empty."""
    out, before = [], 0
    for n, piece in enumerate(pieces):
        size = piece.stop - piece.start
        if before + size >= at:
            place = piece.start + at - before
            return [*out, piece._replace(stop=place), piece._replace(start=place), *pieces[n + 1 :]]
        out.append(piece)
        before += size
    raise ValueError(f"a document of {before} characters has no place {at}")


def _sentinel(mark: str) -> Piece:
    start = SENTINELS.index(mark)
    return Piece(True, start, start + len(mark))


def arrange(parts: list[Piece], form: str) -> list[Piece]:
    """Prefix, middle and suffix in the order of the form, a sentinel before each."""
    return [piece for part in ORDERS[form] for piece in (_sentinel(_MARKS[part]), parts[part])]


def inverse(pieces: list[Piece], form: str) -> list[Piece]:
    """The parts of an arrangement in their old order, sentinels left out."""
    places = sorted(range(3), key=ORDERS[form].__getitem__)
    return [pieces[2 * place + 1] for place in places]


def parsed(output: str, form: str) -> list[Piece]:
    """The descriptors of an output over its own characters. No part holds a sentinel, so the first of each counts."""
    marks = [_MARKS[part] for part in ORDERS[form]]
    if not output.startswith(marks[0]):
        raise ValueError(f"an output of form {form} starts with {marks[0]}")
    second = output.index(marks[1])
    third = output.index(marks[2], second)
    starts = [0, second, third, len(output)]
    pieces = []
    for mark, start, stop in zip(marks, starts, starts[1:]):
        pieces += [_sentinel(mark), Piece(False, start + len(mark), stop)]
    return pieces


def stretches(text: str, pieces: list[Piece]) -> Iterator[str]:
    return ((SENTINELS if p.sentinel else text)[p.start : p.stop] for p in pieces)


def sha256(text: str, pieces: list[Piece]) -> str:
    digest = hashlib.sha256()
    for stretch in stretches(text, pieces):
        digest.update(stretch.encode())
    return digest.hexdigest()


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four repeatable 32-bit numbers of a document; those of a null id are drawn from an empty one."""
    name = "" if doc_id is None else int(doc_id)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


class Document(NamedTuple):
    tokens: int
    form: str
    pieces: list[Piece]
    parts: list[Piece]


def described(doc_id: int | None, text: str, seed: int, fim_percent: int, spm_percent: int) -> Document:
    """Form and descriptors of a document; a plain one is a single descriptor."""
    tokens = _tokens(text)
    n = len(tokens)
    whole = [Piece(False, 0, len(text))]
    one, two, three, four = draws(doc_id, seed)
    if not text or three % 100 >= fim_percent or any(mark in text for mark in _MARKS):
        return Document(n, PLAIN, whole, [])
    form = SPM if four % 100 < spm_percent else PSM
    first, second = sorted((one % (n + 1), two % (n + 1)))
    begin = sum(map(len, tokens[:first]))
    end = begin + sum(map(len, tokens[first:second]))
    prefix, rest = cut(whole, begin)
    parts = [prefix, *cut([rest], end - begin)]
    return Document(n, form, arrange(parts, form), parts)


_REPORT = (
    "n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
)


def _reports(seed: int, fim_percent: int, spm_percent: int) -> Callable:
    def report(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            rows = []
            for doc_id, text in zip(ids, texts):
                text = text or ""
                doc = described(None if pd.isna(doc_id) else doc_id, text, seed, fim_percent, spm_percent)
                digest = sha256(text, doc.pieces)
                if doc.form == PLAIN:
                    rows.append((doc.tokens, doc.form, None, None, digest, digest))
                    continue
                output = "".join(stretches(text, doc.pieces))
                back = sha256(output, inverse(parsed(output, doc.form), doc.form))
                prefix, middle, _ = (p.stop - p.start for p in doc.parts)
                rows.append((doc.tokens, doc.form, prefix, middle, digest, back))
            frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _REPORT.split(", ")])
            yield frame.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})
            tidy()

    return F.pandas_udf(report, _REPORT)


def _descriptors(seed: int, fim_percent: int, spm_percent: int) -> Callable:
    def describe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids, texts in batches:
            docs = [
                described(None if pd.isna(i) else i, t or "", seed, fim_percent, spm_percent) for i, t in zip(ids, texts)
            ]
            pieces = [[{"sentinel": p.sentinel, "start": p.start, "stop": p.stop} for p in d.pieces] for d in docs]
            yield pd.DataFrame({"form": [d.form for d in docs], "pieces": pieces})

    return F.pandas_udf(describe, "form string, pieces array<struct<sentinel:boolean,start:int,stop:int>>")


def arranged(
    docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """The table with columns ``form``, ``pieces`` (descriptors) and ``output`` (the arranged text) in place of any
    it had under these names. Null texts count as empty."""
    ship(docs.sparkSession)
    base = docs.drop("form", "pieces", "output", "_table")
    rows = base.withColumn("_table", _descriptors(seed, fim_percent, spm_percent)(F.col("doc_id"), F.col("text")))
    rows = rows.withColumns({"form": F.col("_table.form"), "pieces": F.col("_table.pieces")}).drop("_table")

    def stretch(piece: Column) -> Column:
        buffer = F.when(piece["sentinel"], F.lit(SENTINELS)).otherwise(F.coalesce("text", F.lit("")))
        return F.substring(buffer, piece["start"] + 1, piece["stop"] - piece["start"])

    return rows.withColumn("output", F.array_join(F.transform("pieces", stretch), ""))


def restored(rows: DataFrame, output: str = "output", form: str = "form", out: str = "restored") -> DataFrame:
    """Adds the text that outputs and forms were made from; null where either is null."""

    def restore(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        texts = []
        for given, kind in zip(outputs, forms):
            if given is None or kind is None or kind == PLAIN:
                texts.append(given if kind is not None else None)
            else:
                texts.append("".join(stretches(given, inverse(parsed(given, kind), kind))))
        return pd.Series(texts, dtype=object)

    ship(rows.sparkSession)
    return rows.withColumn(out, F.pandas_udf(restore, "string")(F.col(f"`{output}`"), F.col(f"`{form}`")))


def fim_report(
    docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256), a row per document row.

    Nothing is shuffled. Null texts count as empty and are plain; texts that hold a sentinel are plain; a null id is
    drawn for like an empty name; repeated rows give equal rows; an empty table gives no rows; only doc_id and text
    are read, so other columns may have any name.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", _reports(seed, fim_percent, spm_percent)(F.col("doc_id"), F.col("text")).alias("d"))
    return rows.select("doc_id", "d.*")


_UNITS = TOKEN.replace("'", "''")
ORACLE = f"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '{_UNITS}') AS u
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS one,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS two,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS three, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS four
  FROM units
), parts AS (
  SELECT doc_id, text, CAST(n AS BIGINT) AS n,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                   OR three >= {FIM_PERCENT} THEN '{PLAIN}' WHEN four < {SPM_PERCENT} THEN '{SPM}' ELSE '{PSM}' END AS form,
         array_to_string(u[1:least(one, two)], '') AS p,
         array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS m,
         array_to_string(u[greatest(one, two) + 1:], '') AS s
  FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> '{PLAIN}' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> '{PLAIN}' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN '{PLAIN}' THEN text WHEN '{PSM}' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
              ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(CASE form WHEN '{PLAIN}' THEN text ELSE p || m || s END) AS restored_sha256
FROM parts
"""
