"""Token counts by heap-and-linked-list byte-pair merging.

Each distinct word is merged once per worker: adjacent pairs wait in a heap by
(rank, place), symbols hang in a doubly linked list, and the lowest pair is
popped until none is left. The count is the number of initial symbols minus the
merges made; no identifier is ever looked up. Counts of words are remembered in
a bounded cache, so a text costs one look-up per word.

Defined cases: null text counts as empty (0 tokens); special strings inside a
text count one token each, as the library does by default; texts of any length
are counted whole; repeated rows count alike; the result is a column, so other
columns of the rows are untouched.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import word_bpe


def merged_length(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many symbols are left after all merges."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    heapq.heapify(heap)
    symbols, merges = list(symbols), 0
    while heap:
        rank, i = heapq.heappop(heap)
        left = symbols[i]
        j = after[i] if left is not None else n
        if j >= n or ranks.get((left, symbols[j])) != rank:
            continue  # one of the two has merged with another since
        symbols[i], symbols[j] = left + symbols[j], None
        merges += 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return n - merges


def counter(bpe: word_bpe.WordBpe):
    """A function from text (or None) to its number of tokens."""
    counts = word_bpe.Cache(lambda w: merged_length(bpe.symbols(w), bpe.ranks))

    def count(text: str | None) -> int:
        if not text:
            return 0
        parts = bpe.parts(text)
        return len(parts) // 2 + sum(sum(map(counts.__getitem__, bpe.words(p))) for p in parts[::2])
    return count


def token_count(text: Column | str, vocabulary: str) -> Column:
    """Number of tokens of ``text`` under the word-level BPE file ``vocabulary``."""
    @F.pandas_udf("long")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(word_bpe.load(vocabulary))
        for batch in texts:
            yield pd.Series([count(t) for t in batch], dtype="int64")
    return counted(text)
