"""Alignment of two tokenizers over the corpus: which ids stand for the same bytes, and how often.

Tokenizer A is a byte-level BPE file (``tokenizers`` JSON), B a sentencepiece
model with byte fallback. A reads blank + text, B adds the blank itself. Byte
offsets at which tokens of both end cut the tokens into groups; every A token of
a group is linked with every B token of it.

1. Documents are shuffled by their full text, so that each distinct text is
   tokenised and aligned once, however many copies it has. Its links are kept as
   id pairs with the number of times they stand in the text.
2. Pairs are counted in the same pass, each text once per copy, and added up
   inside tasks before they are shuffled. A pair's count says how many documents
   hold it.
3. Each text's links meet the counts. The most frequent pairs, ``HEAD_PAIRS`` at
   most, are broadcast; the links of all others meet their counts in a join.
4. The measures are joined to the documents by the text's SHA-256.

Within a text the work is done per word: at a blank after a character that is
none, a token of either kind ends (A's pattern cuts there, and no piece of B
goes on past it; both are checked when the files are read), so groups end there
as well. What is known of a word is remembered in a bounded cache.

Defined cases: null and empty texts have no tokens; nor have texts whose tokens,
joined, are other bytes than blank + text (U+2581, which B takes for a blank).
Those have zeros and an empty digest. Strings of special tokens are plain text.
Texts of any length are aligned whole; repeated rows count as often as they
stand; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_table
from .word_bpe import byte_symbols

#: Pairs that are broadcast with their counts, at 17 bytes each.
HEAD_PAIRS = 2_000_000
#: Bins per doubling of a count, for finding the most frequent pairs.
BINS = 8
#: Words remembered per worker, none longer than ``LONG_WORD`` characters.
CACHE_WORDS = 240_000
LONG_WORD = 64
#: Links of a group that are kept one by one.
MANY_LINKS = 256
#: Links and pairs that a task holds before it hands them on.
HELD_LINKS = 1 << 20
HELD_PAIRS = 1 << 21

MEASURES = ["n_a", "n_b", "n_groups", "n_links"]
_BLANK = "▁"
#: A blank at which tokens of A may go on.
_OPEN = re.compile(r"\s ")


class Words(dict):
    """What is known of words, in two generations: when the young one is full the old one is forgotten."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self._old = limit, {}

    def unknown(self, words: list[str]) -> list[str]:
        """The distinct ones of ``words`` that are not known; those that are known are in the young generation then."""
        if len(self) >= self.limit:
            self._old = dict(self)
            self.clear()
        new = []
        for word in [w for w in set(words) if w not in self]:
            if word in self._old:
                self[word] = self._old[word]
            else:
                new.append(word)
        return new


class Aligner:
    """Both tokenizers; ``text`` aligns a text."""

    def __init__(self, path_a: str, path_b: str):
        self._a, self.bytes_a = _byte_level(path_a)
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [_piece_bytes(self._b, i) for i in range(self._b.get_piece_size())]
        if any(re.search(f"[^{_BLANK}]{_BLANK}", self._b.id_to_piece(i)) for i in range(self._b.get_piece_size())):
            raise ValueError("a piece goes on past a blank")
        self.size_b = len(self.bytes_b)
        self._lengths_a, self._lengths_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self.words = Words(CACHE_WORDS // 2)

    def ids(self, chunk: str) -> tuple[list[int], list[int]]:
        """Ids of blank + ``chunk`` under both."""
        return self._a.encode_ordinary(" " + chunk), self._b.encode(chunk) if chunk else [self._b.piece_to_id(_BLANK)]

    def chunk(self, chunk: str, b: list[int] | None = None):
        """What is known of a chunk, None if the bytes differ.

        (n_a, n_b, n_groups, n_links, groups as text, links as bytes, more): links are id pairs, each as often as it
        stands, but for those of large groups: ``more`` has their distinct pairs and times.
        """
        a, b = (self._a.encode_ordinary(" " + chunk), b) if b else self.ids(chunk)
        whole = b" " + chunk.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            return None
        size, ends_a = self.size_b, list(accumulate(map(self._lengths_a.__getitem__, a)))
        places = {end: k for k, end in enumerate(accumulate(map(self._lengths_b.__getitem__, b)), 1)}
        text, links, many, n_links, i, j = [], [], [], 0, 0, 0
        for k, end in enumerate(ends_a, 1):
            if end not in places:
                continue
            to = places[end]
            if k - i == to - j == 1:
                text.append(f"{a[i]}|{b[j]}")
                links.append(a[i] * size + b[j])
                n_links += 1
            else:
                xs, ys = a[i:k], b[j:to]
                text.append(f"{','.join(map(str, xs))}|{','.join(map(str, ys))}")
                n_links += len(xs) * len(ys)
                if len(xs) * len(ys) > MANY_LINKS:
                    many.append((xs, ys))
                else:
                    links += [x * size + y for x in xs for y in ys]
            i, j = k, to
        return (len(a), len(b), len(text), n_links, ";".join(text), array("q", links).tobytes(),
                _many(many, size) if many else None)

    def _learn(self, words: list[str]) -> None:
        """Remember the words, but for long ones and those behind which a token may go on past the blank."""
        new = [w for w in self.words.unknown(words) if 0 < len(w) <= LONG_WORD and not w[-1].isspace()]
        if new:
            for word, b in zip(new, self._b.encode(new, num_threads=1)):
                self.words[word] = self.chunk(word, b)

    def text(self, text: str):
        """(n_a, n_b, n_groups, n_links, groups as text, distinct pairs, their times), None if the bytes differ."""
        words = text.split(" ")
        if _OPEN.search(text) or text[0].isspace():
            words = [c[1:] for c in re.split(r"(?<=\S)(?= )", " " + text)]
        self._learn(words)
        try:
            found = list(map(self.words.__getitem__, words))
        except KeyError:
            found = [self.words[w] if 0 < len(w) <= LONG_WORD and not w[-1].isspace() else self.chunk(w) for w in words]
        if None in found:
            return None
        n_a, n_b, n_groups, n_links, groups, links, more = zip(*found)
        pairs, times = np.unique(np.frombuffer(b"".join(links), np.int64), return_counts=True)
        more = [m for m in more if m is not None]
        if more:
            pairs, times = _summed(np.concatenate([pairs, *[m[0] for m in more]]), np.concatenate([times, *[m[1] for m in more]]))
        return sum(n_a), sum(n_b), sum(n_groups), sum(n_links), ";".join(groups), pairs, times


def _many(groups, size_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and their times, of groups that may be large: ids of a group are counted before they are paired."""
    links = Counter()
    for xs, ys in groups:
        times_b = Counter(ys).items()
        for x, times in Counter(xs).items():
            for y, more in times_b:
                links[x * size_b + y] += times * more
    return np.fromiter(links.keys(), np.int64, len(links)), np.fromiter(links.values(), np.int64, len(links))


@functools.cache
def load(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _byte_level(path: str) -> tuple[tiktoken.Encoding, list[bytes]]:
    """The BPE of a byte-level file and the bytes of its ids. Its merges must rank by the ids that they make."""
    with open(path, encoding="utf-8") as f:
        read = json.load(f)
    special = {t["content"] for t in read["added_tokens"]}
    model, split = read["model"], read["pre_tokenizer"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    made = [model["vocab"][m] for m in merged]
    if (read["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]
            or model["ignore_merges"] or made != sorted(made) or made and made[0] < 256):
        raise ValueError(f"{path} is no plain byte-level BPE")
    code = {s: b for b, s in enumerate(byte_symbols())}
    ranks = {bytes(map(code.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}
    of_id = [b""] * (max(model["vocab"].values()) + 1)
    for token, i in ranks.items():
        of_id[i] = token
    return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), of_id


def _piece_bytes(model: sentencepiece.SentencePieceProcessor, i: int) -> bytes:
    piece = model.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if model.IsByte(i) else piece.replace(_BLANK, " ").encode()


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(values, starts)


_ALIGNED = ("key binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
            "pairs array<bigint>, times array<bigint>, counted array<bigint>, counts array<bigint>")


def _align(path_a: str, path_b: str):
    """Rows of texts with their links (counted is null), and rows of pair counts (key is null)."""
    columns = [c.split(" ")[0] for c in _ALIGNED.split(", ")]

    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = load(path_a, path_b)
        rows, n_links, pairs, weights = [], 0, [], []

        def reduced(limit: int):
            nonlocal pairs, weights
            if sum(map(len, pairs)) < 2 * limit:
                return
            p, w = _summed(np.concatenate(pairs), np.concatenate(weights))
            if len(p) > limit:
                for i in range(0, len(p), HELD_LINKS):
                    rows.append((None, 0, 0, 0, 0, None, None, None, p[i:i + HELD_LINKS], w[i:i + HELD_LINKS]))
                pairs, weights = [], []
            else:
                pairs, weights = [p], [w]

        for batch in batches:
            for text, copies in zip(batch["text"], batch["copies"]):
                found = aligner.text(text)
                if found is None:
                    continue
                *sums, groups, p, times = found
                rows.append((hashlib.sha256(text.encode()).digest(), *sums, hashlib.sha256(groups.encode()).hexdigest(),
                             p, times, None, None))
                pairs.append(p)
                weights.append(np.full(len(p), copies, np.int64))
                n_links += len(p)
                if n_links > HELD_LINKS:
                    reduced(HELD_PAIRS)
                    yield pd.DataFrame(rows, columns=columns)
                    rows, n_links = [], 0
        if pairs:
            reduced(0)
        if rows:
            yield pd.DataFrame(rows, columns=columns)
    return aligned


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, count, best): documents that hold a pair; whether no pair of its A id has more."""
    counts = (aligned.select(F.inline(F.arrays_zip(F.col("counted").alias("pair"), F.col("counts").alias("count"))))
              .groupBy("pair").agg(F.sum("count").alias("count")))
    counts = shared_table(counts, "alignment-counts").withColumn("a", F.expr(f"pair DIV {size_b}"))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return shared_table(counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best")),
                        "alignment-pairs")


def _head(counts: DataFrame, limit: int) -> DataFrame:
    """The most frequent pairs: as many whole bins of counts as hold ``limit`` pairs at most."""
    bin_of = F.floor(F.log2("count") * BINS).cast("int")
    sizes = counts.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n")).collect()  # a row per bin, 64 * BINS at most
    least, total = 64 * BINS, 0
    for r in sorted(sizes, key=lambda r: -r.bin):
        total += r.n
        if total > limit:
            break
        least = r.bin
    return counts.where(bin_of >= least)


_SCORED = "key binary, n_best bigint, count_sum bigint, rest array<bigint>, rest_times array<bigint>"


def _score(head):
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts, best = head.value
        for batch in batches:
            for i in range(0, len(batch), 500):
                part = batch.iloc[i:i + 500]
                pairs, times = np.concatenate(list(part["pairs"])), np.concatenate(list(part["times"]))
                starts = np.concatenate([[0], np.cumsum(part["pairs"].map(len))[:-1]])
                at = np.searchsorted(known, pairs)
                at[at == len(known)] = 0
                found = known[at] == pairs if len(known) else np.zeros(len(pairs), dtype=bool)
                count = np.where(found, counts[at], 0) if len(known) else np.zeros(len(pairs), dtype=np.int64)
                top = found & best[at] if len(known) else found
                cuts = np.cumsum(np.add.reduceat(~found, starts, dtype=np.int64))[:-1]
                rest, rest_times = np.split(pairs[~found], cuts), np.split(times[~found], cuts)
                yield pd.DataFrame({"key": list(part["key"]), "n_best": np.add.reduceat(times * top, starts),
                                    "count_sum": np.add.reduceat(times * count, starts), "rest": rest,
                                    "rest_times": rest_times})
    return scored


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                    head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``<id_col>``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    aligned = shared_table(texts.mapInPandas(_align(path_a, path_b), _ALIGNED), "alignment-texts")
    of_texts = aligned.where("key IS NOT NULL")

    counts = pair_counts(aligned.where("counted IS NOT NULL"), load(path_a, path_b).size_b)
    head = _head(counts, head_pairs)
    known = head.orderBy("pair").toPandas()  # head_pairs rows at most
    known = tuple(known[c].to_numpy(t) for c, t in (("pair", np.int64), ("count", np.int64), ("best", bool)))
    scored = of_texts.select("key", "pairs", "times").mapInPandas(_score(spark.sparkContext.broadcast(known)), _SCORED)
    scored = shared_table(scored, "alignment-scores")

    links = F.inline(F.arrays_zip(F.col("rest").alias("pair"), F.col("rest_times").alias("times")))
    rest = (scored.select("key", links).join(counts, "pair").groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("count")).alias("more_sum")))
    zero = F.lit(0).cast("bigint")
    found = (of_texts.select("key", *MEASURES, "groups_sha256").join(scored.drop("rest", "rest_times"), "key").join(rest, "key", "left")
             .select("key", *MEASURES, (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
                     (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"), "groups_sha256"))
    keyed = docs.select("id", F.unhex(F.sha2("text", 256)).alias("key"))
    return keyed.join(found, "key", "left").select(
        F.col("id").alias(id_col), *[F.coalesce(c, zero).alias(c) for c in [*MEASURES, "n_best", "count_sum"]],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
