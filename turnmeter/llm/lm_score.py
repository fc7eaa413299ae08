"""Log-likelihood of whole documents under a gated recurrent language model.

The output softmax is factored by class: P(word | before) = P(class | before) *
P(word | class). The class is predicted by a recurrent network (``gru``); the
most frequent words are classes of their own, all others share classes by their
last two characters. Inside a class a word's weight is its corpus count plus
one, and one more such weight stands for the class's unseen words, so the
probabilities sum to one over the counted words and one unseen word per class.

Counts come from every training document and grow with the corpus: the count
table is shuffled by word, never collected. Its most frequent words, at most
``HEAD_WORDS``, are broadcast, as most tokens are among them; the rest of the
tokens meet their counts in a join. The network learns from every token of every
training document, whose classes are written once, a byte per token: it is started on a random sample (``SAMPLE_DOCS`` documents,
``SAMPLE_TOKENS`` tokens), then each partition goes on from there over all its
documents, and the weights are averaged by tokens. Only weights reach the driver.

Defined cases: a null text counts as empty, its only token is the end; repeated
rows are counted and scored each; a null id belongs to training; without any
training rows all counts are 0; an empty table gives no rows. Only the named
columns are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_table
from . import gru
from .ascii_words import words_column, words_of
from .word_bpe import Cache

HEAD_WORDS = 200_000
OWN_CLASS = 87       # words that are classes of their own
ENDINGS = 40         # classes of all other words
CLASSES = 1 + OWN_CLASS + ENDINGS
HIDDEN = 24
SAMPLE_DOCS = 4000
SAMPLE_TOKENS = 2_000_000
PIECE = 4096         # tokens of a document learnt in one stretch of state
CHUNK = 2_000_000    # tokens held while a partition is learnt from
RATE = 0.001         # first step size there
AVERAGED = 32        # groups of partitions whose weights are averaged before the driver averages theirs
#: Bins per doubling of the count, by which the frequent words are told apart from the rest.
BINS = 8


def _ending(word: str) -> int:
    return 1 + OWN_CLASS + zlib.crc32(word[-2:].encode()) % ENDINGS


class Vocabulary:
    """Frequent words with their counts; any other word has only the class of its ending."""

    def __init__(self, head: list[tuple[str, int]], in_class: np.ndarray):
        """``head``: (word, count), most frequent first. ``in_class``: weight of each class of endings."""
        self.size = len(head)
        self.classes = np.array([*range(1, min(self.size, OWN_CLASS) + 1)]
                                + [_ending(w) for w, _ in head[OWN_CLASS:]]
                                + list(range(CLASSES)), np.int64)  # after the head: unlisted words, by class
        self.log_count = np.log10([c + 1.0 for _, c in head] + [1.0] * CLASSES)
        # a word that is a class of its own is certain within it
        self.log_class = np.where(self.classes > OWN_CLASS, np.log10(in_class)[self.classes], self.log_count)
        self._words = [w for w, _ in head]
        self._codes: Cache | None = None  # made on first use, on the worker

    def _look_up(self) -> Cache:
        listed = {w.encode(): i for i, w in enumerate(self._words)}
        return Cache(lambda w: listed[w] if w in listed else self.size + _ending(w.decode()))

    def codes(self, text: str | None) -> tuple[list[bytes], np.ndarray]:
        """Words of the text and their places in the arrays of this vocabulary."""
        if self._codes is None:
            self._codes = self._look_up()
        found = words_of(text)
        return found, np.fromiter(map(self._codes.__getitem__, found), np.int64, len(found))

    def class_path(self, codes: np.ndarray) -> np.ndarray:
        return np.append(self.classes[codes], gru.END).astype(np.int16)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts."""
    return (docs.select(F.explode(words_column(F.col(text_col))).alias("word"))
            .groupBy("word").agg(F.count("*").alias("n")))


def _head(counts: DataFrame, limit: int) -> list[tuple[str, int]]:
    """The most frequent words: as many whole bins of counts as hold ``limit`` words at most."""
    bin_of = F.floor(F.log2("n") * BINS).cast("int")
    sizes = sorted(((r.bin, r.words) for r in counts.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("words"))
                    .collect()), reverse=True)  # a row per bin, 64 * BINS at most
    least, total = None, 0
    for b, n in sizes:
        if total + n > limit:
            break
        least, total = b, total + n
    if least is None:
        return []
    rows = counts.where(bin_of >= least).collect()  # limit rows at most
    return sorted(((r.word, r.n) for r in rows), key=lambda x: (-x[1], x[0]))


def _class_counts(counts: DataFrame, head: list[tuple[str, int]], n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens per class, weight per class of endings): endings of all words, less the words with own classes."""
    ending = (F.crc32(F.encode(F.right(F.col("word"), F.lit(2)), "UTF-8")) % ENDINGS).cast("int")
    tokens, weight = np.zeros(CLASSES), np.ones(CLASSES)
    tokens[gru.END] = n_docs
    for r in counts.groupBy(ending.alias("e")).agg(F.sum("n").alias("n"), F.count("*").alias("w")).collect():
        tokens[1 + OWN_CLASS + r.e] += r.n
        weight[1 + OWN_CLASS + r.e] += r.n + r.w
    for i, (w, n) in enumerate(head[:OWN_CLASS]):
        tokens[1 + i] += n
        tokens[_ending(w)] -= n
        weight[_ending(w)] -= n + 1
    return tokens, weight


def _start(sample: DataFrame, vocabulary, tokens: np.ndarray, text_col: str) -> gru.Params:
    """The network that learning starts from, trained in one task on the sample."""
    def trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts = sorted((t or "" for b in batches for t in b["text"]), key=xxhash.xxh64_intdigest)
        documents, left = [], SAMPLE_TOKENS
        for t in texts[:2 * SAMPLE_DOCS]:
            path = vocabulary.value.class_path(vocabulary.value.codes(t)[1])[:left]
            left -= len(path)
            if len(path):
                documents.append(path)
        params = gru.train(gru.initial(tokens, HIDDEN), documents) if documents else gru.initial(tokens, HIDDEN)
        yield pd.DataFrame({"params": [params.to_bytes()]})

    rows = (sample.select(F.col(text_col).alias("text")).repartition(1).mapInPandas(trained, "params binary").collect())
    return gru.Params.from_bytes(bytes(rows[0].params), CLASSES, HIDDEN) if rows else gru.initial(tokens, HIDDEN)


def _average(weights: Iterable[tuple[bytes, int]]) -> tuple[bytes, int]:
    """Mean of the weights, each by its tokens, and the tokens of all."""
    total, n = 0.0, 0
    for raw, tokens in weights:
        total, n = total + np.frombuffer(raw, "<f4").astype(np.float64) * tokens, n + tokens
    return (total / n).astype("<f4").tobytes(), n


CODED = ("row bigint, id bigint, training boolean, n_tokens bigint, known bigint, log_count double, log_class double, "
         "rare array<string>, path binary")  # path: the classes of the tokens, a byte each


def _coded(rows: DataFrame, vocabulary) -> DataFrame:
    """The words of (row, id, training, text) looked up: once for learning and scoring."""
    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known_words = vocabulary.value
        for batch in batches:
            for start in range(0, len(batch), 1000):
                out = []
                for row, i, t, text in zip(*(batch[c].iloc[start:start + 1000] for c in ("row", "id", "training", "text"))):
                    found, codes = known_words.codes(text)
                    rare = [found[k].decode() for k in np.flatnonzero(codes >= known_words.size).tolist()]
                    out.append((row, i, t, len(found) + 1, len(found) - len(rare), float(known_words.log_count[codes].sum()),
                                float(known_words.log_class[codes].sum()), rare,
                                known_words.class_path(codes).astype(np.uint8).tobytes()))
                yield _frame(out, CODED)

    return shared_table(rows.mapInPandas(coded, CODED), "coded")


def _train(learn: DataFrame, vocabulary, start: gru.Params, column: str) -> gru.Params:
    """The network after every training document: each partition learns from ``start``, and the weights are averaged.

    ``column`` has texts, or their paths as written by ``_coded``."""
    given = start.to_bytes()

    def learnt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        params, n = gru.Params.from_bytes(given, CLASSES, HIDDEN), 0
        for pieces in chunks(piece for b in batches for t in b["given"] for piece in _pieces(vocabulary.value, t)):
            params = gru.train(params, pieces, epochs=1, width=256, rate=RATE)
            n += sum(map(len, pieces))
        if n:
            yield pd.DataFrame({"group": [TaskContext.get().partitionId() % AVERAGED], "params": [params.to_bytes()], "n": [n]})

    def averaged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n", "params"])  # one order of adding, whatever came first
        return pd.DataFrame([_average(zip(rows["params"], rows["n"].tolist()))], columns=["params", "n"])

    rows = (learn.select(F.col(column).alias("given")).mapInPandas(learnt, "group int, params binary, n bigint")
            .groupBy("group").applyInPandas(averaged, "params binary, n bigint").collect())  # AVERAGED rows at most
    if not rows:
        return start
    best, _ = _average(sorted(((bytes(r.params), r.n) for r in rows), key=lambda x: (x[1], x[0])))
    return gru.Params.from_bytes(best, CLASSES, HIDDEN)


def _path(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).astype(np.int16)


def _pieces(vocabulary: Vocabulary, given: str | bytes | None) -> Iterator[np.ndarray]:
    path = _path(given) if isinstance(given, bytes) else vocabulary.class_path(vocabulary.codes(given)[1])
    return (path[i:i + PIECE] for i in range(0, len(path), PIECE))


def chunks(pieces: Iterable[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The pieces in lists of about ``CHUNK`` tokens."""
    held, n = [], 0
    for piece in pieces:
        held.append(piece)
        n += len(piece)
        if n >= CHUNK:
            yield held
            held, n = [], 0
    if held:
        yield held


def score_documents(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all documents, learning from those where ``training`` holds.

    Returns ``<id>``, training, n_tokens, n_known, train_tokens, base_score (add-one
    unigram model) and score, both log10 probabilities of the whole text.
    """
    spark = docs.sparkSession
    learn = docs.where(training)
    counts = shared_table(word_counts(learn, text_col), "word-counts")
    n_docs = learn.count()
    head = _head(counts, HEAD_WORDS)
    tokens, weight = _class_counts(counts, head, n_docs)
    total, distinct = int(tokens.sum()), counts.count() + (n_docs > 0)
    vocabulary = spark.sparkContext.broadcast(Vocabulary(head, weight))
    sample = learn.sample(min(1.0, SAMPLE_DOCS / n_docs), 11) if n_docs else learn
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"),
                       F.coalesce(training, F.lit(False)).alias("training"), F.col(text_col).alias("text"))
    coded = _coded(rows, vocabulary)
    params = _train(coded.where("training"), vocabulary, _start(sample, vocabulary, tokens, text_col), "path")

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        facts = {}

        def paths():
            for batch in batches:
                # the longest first, so that no slot is left alone with one in the end
                batch = batch.iloc[np.argsort(-batch["n_tokens"].to_numpy(), kind="stable")]
                for row, i, t, n, known, log_count, log_class, path in zip(*(batch[c] for c in batch.columns)):
                    facts[row] = i, t, n, known, log_count, log_class
                    yield row, _path(path)

        out = []
        for row, natural in gru.score(params, paths()):
            i, t, n, known, log_count, log_class = facts.pop(row)
            out.append((row, i, t, n, known, log_count, natural / math.log(10) - log_class))
            if len(out) >= 1000:
                yield _frame(out, SCORED)
                out = []
        if out:
            yield _frame(out, SCORED)

    rows = coded.select("row", "id", "training", "n_tokens", "known", "log_count", "log_class", "path")
    rows = shared_table(rows.mapInPandas(scored, SCORED), "scored")
    # the tokens that are not among the frequent words meet their counts here
    rare = (coded.select("row", F.explode("rare").alias("word")).join(counts, "word")
            .groupBy("row").agg(F.count("*").alias("rare_known"), F.sum(F.log10(F.col("n") + 1)).alias("rare_count")))
    end = math.log10(n_docs + 1)
    log_count = F.col("log_count") + F.coalesce("rare_count", F.lit(0.0))
    return (rows.select("row", "id", "training", "n_tokens", "known", "log_count", "model").join(rare, "row", "left")
            .select(F.col("id").alias(id_col), "training", "n_tokens",
                    (F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(n_docs > 0))).alias("n_known"),
                    F.lit(total).cast("bigint").alias("train_tokens"),
                    (log_count + F.lit(end) - F.col("n_tokens") * F.lit(math.log10(total + distinct + 1))).alias("base_score"),
                    (log_count + F.col("model")).alias("score")))


SCORED = "row bigint, id bigint, training boolean, n_tokens bigint, known bigint, log_count double, model double"


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    out["id"] = pd.to_numeric(out["id"]).astype("Int64")
    return out
