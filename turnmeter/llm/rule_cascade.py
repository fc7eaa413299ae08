"""Quality rules as a short-circuit cascade.

A rule rejects a text or lets it pass; a text is kept if every rule lets it
pass. On a random sample each rule is timed alone and its share of rejections
counted, and the cascade tries the rules in order of rejections per cost, so
most junk falls to the first rule and the dear rules see only what is left. The
order changes the work, never the verdict. A text's statistics are computed
when a rule first asks for them and then shared by the rules after it.

Defined cases: a null text has no words; an empty text has ratios of nothing,
which no rule but the minimum length rejects; very long texts are measured
whole; on an empty table the rules keep their given order. Verdicts are
columns; other columns of the rows are untouched.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The characters counted as symbols, and the characters between words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

#: Rows of the random sample on which costs and selectivities are estimated.
SAMPLE_ROWS = 2000


class Text:
    """A text's statistics, each computed once, when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()  # bytes split at ASCII white space only

    @cached_property
    def codes(self) -> np.ndarray:
        """The words as numbers, equal where the words are."""
        seen: dict[bytes, int] = {}
        return np.array([seen.setdefault(w, len(seen)) for w in self.words], np.int64)

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(BLANKS)]

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, BLANKS))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def n_upper(self) -> int:
        """Capital letters A to Z."""
        raw = np.frombuffer(self.text.encode(), np.uint8)
        return int(((raw >= 65) & (raw <= 90)).sum())

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_stutters(self) -> int:
        """Words equal to the word before them."""
        return int((self.codes[1:] == self.codes[:-1]).sum())

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside any three-word window that occurs twice or more."""
        c = self.codes
        if len(c) < 4:
            return 0
        _, pairs = np.unique(c[:-2] * len(c) + c[1:-1], return_inverse=True)
        _, window, times = np.unique(pairs * len(c) + c[2:], return_inverse=True, return_counts=True)
        starts = np.flatnonzero(times[window] > 1)
        inside = np.zeros(len(c), bool)
        for k in range(3):
            inside[starts + k] = True
        return int(inside.sum())


class Rule(NamedTuple):
    name: str
    rejects: Callable[[Text], bool]


MIN_WORDS = Rule("min_words", lambda t: t.n_words < 50)
REPEATED_WINDOWS = Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 50 * t.n_words)

#: The rules in use. Ratios are compared as whole numbers, so no rounding enters.
RULES = (
    MIN_WORDS,
    REPEATED_WINDOWS,
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("shouting", lambda t: 10 * t.n_upper > 3 * t.word_chars),
    Rule("short_words", lambda t: 2 * t.word_chars < 5 * t.n_words),
    Rule("long_words", lambda t: t.word_chars > 12 * t.n_words),
    Rule("duplicate_lines", lambda t: 10 * t.n_dup_lines > 4 * len(t.lines)),
    Rule("stutter", lambda t: 10 * t.n_stutters > 3 * t.n_words),
)


def estimate(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, seed: int = 7,
             text_col: str = "text") -> dict[str, tuple[float, float]]:
    """Each rule's (cost in ns, share of rejections) per text, on about ``sample_rows`` random rows."""
    total = docs.count()
    if not total:
        return {}
    sample = docs.select(F.col(text_col).alias("text")).sample(min(1.0, sample_rows / total), seed)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in rules:
                began = time.perf_counter_ns()
                n = sum(r.rejects(Text(t)) for t in batch["text"])
                out.append((r.name, len(batch), n, time.perf_counter_ns() - began))
            yield pd.DataFrame(out, columns=["rule", "rows", "rejected", "ns"])

    sums = (sample.mapInPandas(measured, "rule string, rows bigint, rejected bigint, ns bigint")
            .groupBy("rule").agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"),
                                 F.sum("ns").alias("ns")).collect())  # a row per rule
    return {r.rule: (r.ns / r.rows, r.rejected / r.rows) for r in sums if r.rows}


def order(rules: Sequence[Rule], found: dict[str, tuple[float, float]]) -> list[Rule]:
    """Rules by rejections per cost, best first; unmeasured ones last, ties in the given order."""
    def gain(r: Rule) -> float:
        cost, share = found.get(r.name, (1.0, -1.0))
        return share / max(cost, 1.0)
    return sorted(rules, key=gain, reverse=True)


def first_rejection(text: Text, rules: Sequence[Rule]) -> tuple[str | None, int]:
    """Name of the first rule that rejects (or None), and how many rules were tried."""
    for tried, r in enumerate(rules, 1):
        if r.rejects(text):
            return r.name, tried
    return None, len(rules)


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def verdict(text: Column | str, rules: Sequence[Rule], statistics: bool = False) -> Column:
    """Struct (kept, rejected_by, tried) of the cascade in the order of ``rules``.

    With ``statistics`` the struct also has the five statistics of ``STATISTICS``
    for every text, rejected or not.
    """
    names = STATISTICS if statistics else ()
    kind = "struct<kept:boolean,rejected_by:string,tried:int" + "".join(f",{n}:bigint" for n in names) + ">"

    @F.pandas_udf(kind)
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for raw in batch:
                t = Text(raw)
                by, tried = first_rejection(t, rules)
                rows.append((by is None, by, tried, *(getattr(t, n) for n in names)))
            yield pd.DataFrame(rows, columns=["kept", "rejected_by", "tried", *names])
    return judged(text)
