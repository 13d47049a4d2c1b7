"""Document quality by attention over passages (multiple-instance learning).

A document is a bag of passages. Each passage is encoded, a gated attention learned from document labels
weighs the codes, and the weighted code is scored (Ilse, Tomczak and Welling, 2018).
"""

from __future__ import annotations

import math
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpulse import storage
from textpulse.llm.columns import guarded
from textpulse.llm.shipping import ship

PASSAGE_WORDS = 64
# The fit reads at most this many labelled documents, with all their passages: about a byte of driver memory a word.
SAMPLE_DOCUMENTS = 4_000
FOLDS = 5
THRESHOLD = 0.3
CODE, GATE = 16, 8
ROUNDS = 400
RATE = 0.02
DECAY = 1e-4
SEED = 7
# What a text has shown before is kept as marks in a table of this many places a word, by the hash of a pair.
_PLACES = 8

_UPPER = string.ascii_uppercase.encode()
_LOWER = string.ascii_lowercase.encode()
_DIGITS = string.digits.encode()
_STOPS = b".,;:?"
_SYMBOLS = b"#$%&*@^~+=_/\\"
_BRACKETS = b"<>{}[]()\"'`"
_HIGH = bytes(range(128, 256))
_CLASSES = (_UPPER, _LOWER, _DIGITS, _STOPS, _SYMBOLS, _BRACKETS, b"!", b"|", _HIGH)
FEATURES = len(_CLASSES) + 8


def passages(text: str) -> np.ndarray:
    """Features of every passage of PASSAGE_WORDS words; a text without words is one passage of zeros. Pairs of words
    are told apart by hashes; the table of those seen before grows with the text, so place in a text does not matter."""
    words = text.split()
    total = math.log1p(len(words)) / 10
    codes = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in words), np.uint64, len(words))
    places = 1 << (_PLACES * max(len(words), 128) - 1).bit_length()
    seen = np.zeros(places, bool)
    pair_places = (codes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:]) % np.uint64(places)
    rows = []
    for start in range(0, len(words), PASSAGE_WORDS):
        part = words[start : start + PASSAGE_WORDS]
        raw = " ".join(part).encode("utf-8", "replace")
        n = len(part)
        size = len(raw) - n + 1
        pairs = np.unique(pair_places[start : start + n - 1])
        again = float(seen[pairs].mean()) if len(pairs) else 0.0
        seen[pairs] = True
        row = [(len(raw) - len(raw.translate(None, kind))) / size for kind in _CLASSES]
        row += [
            n / PASSAGE_WORDS, size / n / 10, len(set(part)) / n, len(pairs) / max(n - 1, 1), again,
            min(max(map(len, part)), 100) / 20, sum(len(w) < 3 for w in part) / n, total,
        ]
        rows.append(row)
    return np.array(rows or [[0.0] * FEATURES], np.float32)


def _bag(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages in a row, and where each text's begin."""
    found = [passages(t) for t in texts]
    return np.concatenate(found), np.cumsum([0] + [len(f) for f in found[:-1]])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class AttentionModel:
    """Standardised features, a tanh encoder, a gated attention and a linear head."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def _forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        code = np.tanh(x @ w["E"] + w["e"])
        view, gate = np.tanh(code @ w["V"]), _sigmoid(code @ w["U"])
        energy = (view * gate) @ w["a"]
        energy = np.exp(energy - np.maximum.reduceat(energy, starts)[owner])
        attention = energy / np.add.reduceat(energy, starts)[owner]
        pooled = np.add.reduceat(attention[:, None] * code, starts)
        return {
            "owner": owner, "code": code, "view": view, "gate": gate, "attention": attention,
            "pooled": pooled, "score": _sigmoid(pooled @ w["c"] + w["b"]),
        }

    def scores(self, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """To six digits, in double precision: the last bits would depend on which texts share a batch."""
        exact = replace(self, weights={k: v.astype(np.float64) for k, v in self.weights.items()})
        scaled = (features.astype(np.float64) - self.mean) / self.scale
        return np.round(exact._forward(scaled, starts)["score"], 6)

    def _gradients(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self._forward(x, starts)
        owner, code, attention = f["owner"], f["code"], f["attention"]
        missed = (f["score"] - labels) / len(labels)
        pooled = np.outer(missed, w["c"])[owner]
        pull = (code * pooled).sum(1)
        energy = attention * (pull - np.add.reduceat(attention * pull, starts)[owner])
        product = np.outer(energy, w["a"])
        view = product * f["gate"] * (1 - f["view"] ** 2)
        gate = product * f["view"] * f["gate"] * (1 - f["gate"])
        inner = (attention[:, None] * pooled + view @ w["V"].T + gate @ w["U"].T) * (1 - code**2)
        return {
            "E": x.T @ inner, "e": inner.sum(0), "V": code.T @ view, "U": code.T @ gate,
            "a": (f["view"] * f["gate"]).T @ energy, "c": f["pooled"].T @ missed, "b": missed.sum(keepdims=True),
        }

    @staticmethod
    def fit(features: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> AttentionModel:
        """Cross entropy by Adam over the whole sample; the same sample gives the same model."""
        random = np.random.default_rng(SEED)
        mean, scale = features.mean(0), features.std(0) + 1e-3

        def drawn(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)

        model = AttentionModel(mean, scale, {
            "E": drawn(features.shape[1], CODE), "e": np.zeros(CODE, np.float32), "V": drawn(CODE, GATE),
            "U": drawn(CODE, GATE), "a": drawn(GATE), "c": drawn(CODE), "b": np.zeros(1, np.float32),
        })
        x = (features - mean) / scale
        first = {k: np.zeros_like(v) for k, v in model.weights.items()}
        second = {k: np.zeros_like(v) for k, v in model.weights.items()}
        for step in range(1, ROUNDS + 1):
            for k, g in model._gradients(x, starts, labels).items():
                g = g + DECAY * model.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                model.weights[k] = (model.weights[k] - RATE * move).astype(np.float32)
        return model


def held_out(doc_id: Column) -> Column:
    """Documents kept from the fit. A null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> AttentionModel | None:
    """Fits on the ``sample`` labelled documents with the smallest hashes of their id, held-out ones left
    out; an id labelled twice counts once, by its lowest label, and one with several rows by one of their texts. All
    passages of these documents are read. None without labelled documents."""
    spark = ship(docs.sparkSession)
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.min("quality").cast("double").alias("quality"))
        .join(docs.select(F.col("doc_id").alias("labelled")), "labelled", "left_semi")
        .orderBy(F.xxhash64(F.lit(SEED), "labelled"), "labelled")
        .limit(sample)
    )
    known = storage.materialize(known, storage.fresh_dir(spark, "sample"))

    def featured(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            yield pd.Series([passages(t or "").tobytes() for t in series])

    # One row per labelled id: where ids repeat, that of the text with the smallest hash.
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text").alias("text")))
    rows = (
        docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("labelled"))
        .groupBy("doc_id").agg(least.alias("row"), F.min("quality").alias("quality"))
        .select("doc_id", "quality", F.pandas_udf(featured, "binary")(F.col("row.text")).alias("bag"))
        .toPandas()
    )
    if rows.empty:
        return None
    rows = rows.sort_values("doc_id", ignore_index=True)
    bags = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in rows["bag"]]
    starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
    return AttentionModel.fit(np.concatenate(bags), starts, rows["quality"].to_numpy(np.float32))


def scored(docs: DataFrame, model: AttentionModel | None, out: str = "score") -> DataFrame:
    """Adds the score of ``text``, from whole texts: 0 to 1, higher where label 1 is likelier. A null text
    scores like an empty one; without a model every score is 0.5."""
    if model is None:
        return docs.withColumn(out, F.lit(0.5))
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            texts = [t or "" for t in series]
            done = []
            for start in range(0, len(texts), 500):
                done.append(shared.value.scores(*_bag(texts[start : start + 500])))
            yield pd.Series(np.concatenate(done) if done else np.zeros(0))

    return docs.withColumn(out, F.pandas_udf(score, "double")(F.col("text")))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row per document row.

    Labels, language, source and id never enter a score; the id only picks the sample. Repeated rows score
    alike; an empty table gives no rows; only doc_id and text are read.
    """
    rows = scored(docs.select("doc_id", "text"), learn(docs, labels))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents scored THRESHOLD or more, with the columns they came with."""
    table, restored = guarded(docs, "doc_id", "text")
    return restored(scored(table, learn(table, labels), "_score").where(F.col("_score") >= THRESHOLD))
