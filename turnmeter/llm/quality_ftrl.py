"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal.

A text's features are its words, its pairs of neighbouring words, the shapes of
its words (runs of upper case, lower case, digits, other characters as they
are), and pairs of neighbouring shapes, where a word that follows itself has a
shape of its own. All are hashed into one weight vector. Words and shapes are
each scaled to length 1 with damped counts, so a score is one sparse dot product
whatever the text's length.

Training reads at most ``max_rows`` labelled rows, those with the smallest hash
of their id, and runs follow-the-regularised-leader updates in one task; the
weights (``1 << bits`` floats) are broadcast. Scoring reads every text whole.

Defined cases: null and empty texts have no features and score the bias alone;
a null label is no label; an id labelled twice counts with its lower label, a
labelled id with several texts with the smallest text; where only one class is labelled
the score is that class, and with no labels at all it is 1 (nothing is
rejected without evidence). The score is a column; other columns are untouched.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .word_bpe import Cache

SAME = 0x9E3779B9  # stands for "the word before, again"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape(word: str) -> str:
    kinds = ("U" if c.isupper() else "l" if c.isalpha() else "d" if c.isdigit() else c for c in word)
    return "".join(k for k, _ in itertools.groupby(kinds))


def _word_code(word: str) -> int:
    """Hash of the word above, hash of its shape below."""
    return xxhash.xxh32_intdigest(word) << 31 | xxhash.xxh32_intdigest(_shape(word)) >> 1


class Features:
    """Text to (indices, values), with a bounded memory of words."""

    def __init__(self, bits: int):
        self._shift = np.uint64(64 - bits)
        self._codes = Cache(_word_code)

    def _index(self, keys: np.ndarray, kind: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(4) + np.uint64(kind)) * _MIX >> self._shift).astype(np.int64)

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.float32)
        codes = np.fromiter(map(self._codes.__getitem__, words), np.uint64, len(words))
        word, shape = codes >> np.uint64(31), codes & np.uint64((1 << 31) - 1)
        with np.errstate(over="ignore"):
            pair = word[:-1] * np.uint64(0x85EBCA6B) + word[1:]
            shapes = shape[:-1] * np.uint64(0xC2B2AE35) + shape[1:]
        again = word[:-1] == word[1:]
        shapes = np.where(again, np.uint64(SAME), shapes)
        groups = ((self._index(word, 0), self._index(pair, 1)), (self._index(shape, 2), self._index(shapes, 3)))
        found = [np.unique(np.concatenate(g), return_counts=True) for g in groups]
        damped = [1 + np.log(n) for _, n in found]
        values = [(v / np.sqrt((v * v).sum())).astype(np.float32) for v in damped]
        return np.concatenate([i for i, _ in found]), np.concatenate(values)


def train(rows: Iterable[tuple[str | None, int]], bits: int = 18, epochs: int = 4, alpha: float = 0.5,
          beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> np.ndarray:
    """FTRL-proximal over (text, label): the weights, the bias last."""
    features, size = Features(bits), 1 << bits
    data = [(*features(text), label) for text, label in rows]
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    weights = np.zeros(size + 1)
    labels = {y for *_, y in data}
    if len(labels) < 2:
        weights[size] = 50.0 if labels != {0} else -50.0
        return weights.astype(np.float32)

    def solve(i):
        return np.where(np.abs(z[i]) <= l1, 0.0, (np.sign(z[i]) * l1 - z[i]) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for index, value, label in data:
            i, x = np.append(index, size), np.append(value, np.float32(1))
            w = solve(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            np.add.at(z, i, g - sigma * w)  # words and shapes may share a bucket
            np.add.at(n, i, g * g)
    weights = solve(np.arange(size + 1))
    return weights.astype(np.float32)


def scorer(weights: np.ndarray):
    """A function from text (or None) to the probability of label 1."""
    size = len(weights) - 1
    features = Features(size.bit_length() - 1)

    def score(text: str | None) -> float:
        index, value = features(text)
        return float(1 / (1 + np.exp(-np.clip(float(weights[index] @ value) + float(weights[size]), -35, 35))))
    return score


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000, bits: int = 18, label_col: str = "quality",
        id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Weights learnt from at most ``max_rows`` labelled rows, chosen by the hash of their id."""
    ids = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
           .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    # ids has max_rows rows at most, whatever the size of the tables
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
              .join(F.broadcast(ids), "id").groupBy("id", "label").agg(F.min("text").alias("text")))

    def trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = sorted(((xxhash.xxh64_intdigest(str(i)), t, y) for b in batches
                       for i, t, y in zip(b["id"], b["text"], b["label"])), key=lambda r: r[0])
        yield pd.DataFrame({"weights": [train([(t, y) for _, t, y in rows], bits).tobytes()]})

    found = sample.repartition(1).mapInPandas(trained, "weights binary").collect()
    return np.frombuffer(bytes(found[0].weights), np.float32) if found else train([], bits)


def score_column(docs: DataFrame, weights: np.ndarray, text: Column | str = "text") -> Column:
    """Score of ``text``; the weights are broadcast (4 bytes << bits)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = scorer(shared.value)
        for batch in texts:
            yield pd.Series([score(t) for t in batch], dtype="float64")
    return scored(text)
