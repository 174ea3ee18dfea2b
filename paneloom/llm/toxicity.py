"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)): the factors
learn what pairs of terms mean together, such as an insult beside a group's name, which a sum of single weights
misses. Terms are lower-cased runs of word characters and the starts of longer ones; a text is the
set of its terms that enough sampled texts have, each with x = 1/sqrt(number of terms). Every
``CHECK_EVERY``-th sampled row places the threshold instead of training.

Training uses at most ``TRAIN_ROWS`` labelled rows, those with the smallest hash of doc_id, in one
task; scoring reads every whole text. The model has at most 2^BITS slots (under 50 MB, in practice those
of a few thousand texts), so it is broadcast.

Definitions: null and empty texts have no terms and score sigmoid(w0). Labels of one id count once,
toxic if any says so; null labels and ids are left out. Without labels of both kinds
the model is constant: the share of toxic rows, 0 without any.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.llm.common import CACHES, forget, give_back, lean, text_of

BITS = 20
FACTORS = 8
PREFIXES = (4, 5, 6)
TRAIN_ROWS = 12_000
LEAST_ROWS = 5  # a term counts if so many sampled rows have it
EPOCHS = 6
CHECK_EVERY = 5
RATE = 0.5
DECAY = 2e-5
CACHED_WORDS = 1 << 17
_WORD = re.compile(r"\w+")


class _Slots(dict):
    """Packed slots of a word; starts anew when it holds too many."""

    def __missing__(self, word: str) -> bytes:
        parts = {word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)}
        slots = struct.pack(
            f"{len(parts)}i", *(zlib.crc32(x.encode()) & ((1 << BITS) - 1) for x in parts)
        )
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = slots
        return slots


_SLOTS = CACHES.setdefault("slots", _Slots())


def terms(text: str | None) -> np.ndarray:
    """Slots of the different terms of a whole text, ascending."""
    found = set(_WORD.findall(text.lower())) if text else ()
    return np.unique(np.frombuffer(b"".join(map(_SLOTS.__getitem__, found)), dtype=np.int32))


class FactorizationMachine:
    """``bias``, the known ``slots`` and, for each, its weight and factors in a row of ``table``."""

    def __init__(self, bias: float, slots: np.ndarray, table: np.ndarray):
        self.bias, self.slots, self.table = bias, slots, table
        self.row_of = np.full(1 << BITS, -1, dtype=np.int32)
        self.row_of[slots] = np.arange(len(slots), dtype=np.int32)

    def known(self, slots: np.ndarray) -> np.ndarray:
        rows = self.row_of[slots]
        return rows[rows >= 0]

    def margin(self, rows: np.ndarray) -> float:
        if not len(rows):
            return self.bias
        own = self.table[rows]
        return self.bias + _products(own)[0]

    def score(self, text: str | None) -> float:
        z = self.margin(self.known(terms(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    @classmethod
    def fit(cls, rows: list[np.ndarray], labels: np.ndarray, seed: int = 3) -> FactorizationMachine:
        """Gradient steps on the logistic loss, a row at a time; rarer labels weigh more."""
        share = float(labels.mean()) if len(labels) else 0.0
        bias = float(np.clip(np.log((share + 1e-6) / (1 - share + 1e-6)), -14, 14))
        counts = np.zeros(1 << BITS, np.int32)
        for own in rows:
            np.add.at(counts, own, 1)
        slots = np.flatnonzero(counts >= LEAST_ROWS)
        if share in (0.0, 1.0):
            slots = slots[:0]
        random = np.random.default_rng(seed)
        table = random.normal(0, 0.01, (len(slots), 1 + FACTORS)).astype(np.float32)
        table[:, 0] = 0
        model = cls(bias, slots, table)
        if not len(slots):
            return model
        known = [model.known(r) for r in rows]
        apart = np.arange(len(known)) % CHECK_EVERY == 0  # these place the threshold only
        weights = np.where(labels > 0, min(0.5 / share, 4.0), 1.0)
        for epoch in range(EPOCHS):
            rate = RATE / (1 + epoch)
            for i in random.permutation(np.flatnonzero(~apart)):
                if not len(known[i]):
                    continue
                own = table[known[i]]
                product, sums, x = _products(own)
                z = min(max(model.bias + product, -30.0), 30.0)
                g = weights[i] * (1 / (1 + math.exp(-z)) - labels[i])
                model.bias -= 0.02 * rate * g
                own[:, 0] -= rate * (g * x + DECAY * own[:, 0])
                own[:, 1:] -= rate * (g * x * x * (sums - own[:, 1:]) + DECAY * own[:, 1:])
                table[known[i]] = own
        margins = np.array([model.margin(known[i]) for i in np.flatnonzero(apart)])
        model.bias -= _threshold(margins, labels[apart])
        return model


def _threshold(margins: np.ndarray, labels: np.ndarray) -> float:
    """The margin that parts the labels with the best F1; among equals the middle one, else 0."""
    order = np.argsort(margins)
    z, y = margins[order], labels[order]
    hits = y.sum() - np.concatenate([[0], np.cumsum(y)])  # predicted and toxic, cut before i
    f1 = 2 * hits / np.maximum(len(y) - np.arange(len(y) + 1) + y.sum(), 1)
    cuts = np.concatenate([z[:1], (z[1:] + z[:-1]) / 2, z[-1:]])
    if not len(y) or not f1.max():
        return 0.0
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(cuts[best].mean())


def _products(own: np.ndarray) -> tuple[float, np.ndarray, float]:
    """What the rows of a text add to the bias, their summed factors, and x."""
    x = 1 / math.sqrt(len(own))
    v = own[:, 1:]
    sums = v.sum(axis=0)
    pairs = 0.5 * (float(sums @ sums) - float(np.einsum("ij,ij->", v, v))) * x * x
    return float(own[:, 0].sum()) * x + pairs, sums, x


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text, mod 5, is 0; never a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """(text, label) of at most ``limit`` labelled documents that aren't held out."""
    chosen = (
        labels.select(F.col("doc_id").alias("label_id"), "toxic")
        .where("label_id is not null and toxic is not null")
        .where(~held_out(F.col("label_id")))
        .groupBy("label_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("label"))
        .orderBy(F.xxhash64("label_id"), "label_id")
        .limit(limit)
    )
    return docs.select(F.col("doc_id").alias("own_id"), text_of().alias("text")).join(
        F.broadcast(chosen), F.col("own_id") == F.col("label_id")
    ).select("own_id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> FactorizationMachine:
    """The machine learnt in one task from the bounded sample.

    A labelled id that several rows carry counts with its smallest text.
    """

    @F.pandas_udf("array<int>")
    def slots_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in lean(batches, "slots"):
            yield pd.Series([terms(x) for x in batch], dtype=object)
        forget()  # a worker outlives its tasks

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple[int, np.ndarray, int]] = []
        for batch in lean(batches, "slots"):
            rows += [
                (i, np.asarray([] if s is None else s, dtype=np.int32), y)
                for i, s, y in zip(batch["own_id"], batch["slots"], batch["label"])
            ]
        rows.sort(key=lambda r: r[0])
        model = FactorizationMachine.fit(
            [s for _, s, _ in rows], np.array([y for *_, y in rows], dtype=np.float64)
        )
        del rows
        give_back()
        yield pd.DataFrame(
            {
                "bias": [model.bias],
                "slots": [model.slots.astype(np.int64).tobytes()],
                "rows": [model.table.tobytes()],
            }
        )

    sample = training_rows(docs, labels, limit)
    one = sample.groupBy("own_id", "label").agg(F.min("text").alias("text"))
    models = (
        one.select("own_id", "label", slots_of("text").alias("slots"))
        .repartition(1)
        .mapInPandas(learn, "bias double, slots binary, rows binary")
        .collect()
    )
    if not models:
        return FactorizationMachine.fit([], np.zeros(0))
    (found,) = models
    return FactorizationMachine(
        found["bias"],
        np.frombuffer(found["slots"], dtype=np.int64),
        np.frombuffer(found["rows"], dtype=np.float32).reshape(-1, 1 + FACTORS),
    )


def scorer(docs: DataFrame, model: FactorizationMachine):
    """A function from a text column to its score column."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.slots, model.table))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = FactorizationMachine(*shared.value)
        for batch in lean(batches, "slots"):
            yield pd.Series([own.score(x) for x in batch], dtype="float64")
        forget()  # a worker outlives its tasks

    return score


def score_documents(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    score = scorer(docs, fit(docs, labels, limit))
    return docs.select("doc_id", score(text_of()).alias("score")).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` predicted clean, with their columns."""
    score = scorer(docs, fit(docs, labels, limit))
    return docs.where(score(text_of()) < 0.5)
