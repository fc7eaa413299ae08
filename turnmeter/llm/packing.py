"""Packing of token sequences into windows: online sum-of-squares placement.

Every input partition packs its own documents as they come. The level array
``N`` counts the partially filled windows at each fill level; a document goes to
the level that makes the sum of the squared counts smallest (Csirik et al.),
which keeps all levels populated so that later documents find a fit. A document
that is longer than a window first fills whole windows; its rest is placed.

Windows wait in memory only while they are open, ``max_open`` at most. When
there are more, and at the end of a partition, they are closed by cutting: the
fullest are topped up with tokens of the emptiest until one partial window is
left. At the end of the partition this one is cut into sequences whose lengths
are powers of two, which need no padding. So every sequence is full or a power
of two long, and all but a few documents per partition lie whole in a window.

Defined cases: a null or empty text is its end token alone; a text of any length
is cut, never shortened; repeated rows are packed once each; an empty table or
partition gives no sequences. Only the two named columns are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import word_bpe

PIECES = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")
WIDTH = 4  # bytes of an id


class LevelArray:
    """Open windows by fill level, with the counts in the form the placement needs."""

    def __init__(self, capacity: int):
        self.capacity, self.open = capacity, 0
        self.windows: dict[int, list[list]] = {}
        # twice the growth of the sum of squares is taken[level + size] - given[level], up to a constant;
        # an empty window counts 1/2 at level 0 and a full one -1/2, as neither is in the sum
        self.given = np.full(capacity + 1, -np.inf)
        self.taken = np.zeros(capacity + 1)
        self.given[0], self.taken[capacity] = 0.5, -0.5

    def best_level(self, size: int) -> int:
        """The level to place ``size`` on; the fullest of equally good ones."""
        growth = self.taken[size:] - self.given[:self.capacity + 1 - size]
        return len(growth) - 1 - int(np.argmin(growth[::-1]))

    def _count(self, level: int, n: int) -> None:
        self.taken[level] = n
        self.given[level] = n if n else -np.inf

    def take(self, level: int) -> list:
        if not level:
            return []
        stack = self.windows[level]
        window = stack.pop()
        self.open -= 1
        self._count(level, len(stack))
        return window

    def put(self, level: int, window: list) -> None:
        stack = self.windows.setdefault(level, [])
        stack.append(window)
        self.open += 1
        self._count(level, len(stack))

    def drain(self) -> list[tuple[int, list]]:
        """All open windows with their levels, fullest first; none is open afterwards."""
        out = [(h, w) for h in sorted(self.windows, reverse=True) for w in self.windows[h]]
        for h in self.windows:
            self._count(h, 0)
        self.windows, self.open = {}, 0
        return out


def _cut(piece: tuple, n: int) -> tuple[tuple, tuple]:
    """A piece (doc_id, start, ids, doc_tokens) as its first ``n`` tokens and the rest."""
    doc, start, ids, total = piece
    return (doc, start, ids[:n * WIDTH], total), (doc, start + n, ids[n * WIDTH:], total)


def _close(windows: list[tuple[int, list]], capacity: int) -> tuple[list[list], list]:
    """Top up the fullest windows with the emptiest; returns full windows and one partial window."""
    full, i, j = [], 0, len(windows) - 1
    while i < j:
        (room, window), (level, donor) = windows[i], windows[j]
        room = capacity - room
        while room and donor:
            piece = donor.pop()
            n = len(piece[2]) // WIDTH
            if n > room:
                piece, rest = _cut(piece, room)
                donor.append(rest)
                n = room
            window.append(piece)
            room -= n
            level -= n
        if room:
            windows[i] = (capacity - room, window)
        else:
            full.append(window)
            i += 1
        windows[j] = (level, donor)
        if not donor:
            j -= 1
    return full, windows[i][1] if i == j else []


def _powers(window: list) -> Iterator[list]:
    """A partial window as sequences whose lengths are its binary digits."""
    left = sum(len(p[2]) for p in window) // WIDTH
    window = window[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            piece = window.pop()
            if len(piece[2]) // WIDTH > room:
                piece, rest = _cut(piece, room)
                window.append(rest)
            out.append(piece)
            room -= len(piece[2]) // WIDTH
        yield out


def pack(documents: Iterator[tuple[int, bytes]], capacity: int, max_open: int) -> Iterator[list[tuple]]:
    """Sequences, each a list of pieces, from (doc_id, ids as little-endian uint32)."""
    levels = LevelArray(capacity)
    for doc, ids in documents:
        total = len(ids) // WIDTH
        size = total % capacity
        for start in range(0, total - size, capacity):
            yield [(doc, start, ids[start * WIDTH:(start + capacity) * WIDTH], total)]
        if size:
            level = levels.best_level(size)
            window = levels.take(level)
            window.append((doc, total - size, ids[(total - size) * WIDTH:], total))
            if level + size == capacity:
                yield window
            else:
                levels.put(level + size, window)
        if levels.open > max_open:
            full, partial = _close(levels.drain(), capacity)
            yield from full
            if partial:
                levels.put(sum(len(p[2]) for p in partial) // WIDTH, partial)
    if levels.open:
        full, partial = _close(levels.drain(), capacity)
        yield from full
        yield from _powers(partial)


def encoder(vocabulary: str, end_id: int):
    """A function from text (or None) to its ids and the end id, as little-endian uint32 bytes."""
    from tokenizers import Tokenizer

    bpe, model = word_bpe.load(vocabulary), Tokenizer.from_file(vocabulary).model

    def as_bytes(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    # the library's own model, once per distinct word; merges never cross words
    of_word = word_bpe.Cache(lambda w: as_bytes([t.id for t in model.tokenize(word_bpe.byte_level(w))]))
    special = {s: as_bytes([i]) for s, i in bpe.special.items()}
    end = as_bytes([end_id])

    def encode(text: str | None) -> bytes:
        out = []
        for i, part in enumerate(bpe.parts(text or "")):
            out.extend([special[part]] if i % 2 else map(of_word.__getitem__, bpe.words(part)))
        out.append(end)
        return b"".join(out)
    return encode


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 2,
                   max_open: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with the sequence and offset of each.

    ``ids`` holds a piece's token ids as little-endian uint32. ``sequence_id``
    is unique: input partition in the upper bits, running number in the lower.
    """
    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary, end_id)
        documents = ((doc, encode(text)) for b in batches for doc, text in zip(b["id"].tolist(), b["text"]))
        sequence, rows = TaskContext.get().partitionId() << 32, []
        for window in pack(documents, capacity, max_open):
            offset = 0
            for doc, start, ids, total in window:
                n = len(ids) // WIDTH
                rows.append((doc, start, n, ids, total, sequence, offset))
                offset += n
            sequence += 1
            if len(rows) >= 2000:
                yield _frame(rows)
                rows = []
        if rows:
            yield _frame(rows)

    named = docs.selectExpr(f"cast(`{id_col}` as bigint) id", f"`{text_col}` text")
    return named.mapInPandas(packed, PIECES).withColumnRenamed("doc_id", id_col)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
    out["doc_id"] = out["doc_id"].astype("Int64")  # a null id stays null
    return out
