"""Secret scan of whole texts, as column expressions only (native).

Base kinds are patterns: keyword assignments, access keys, runs of hex digits.
The entropy scan adds to them: candidate strings are long runs of token
characters; a window slides along each, and the Shannon entropy of the window
is kept up to date from the counts of the one character that leaves and the one
that enters. A candidate is reported from the first to the last window that
reaches the threshold of the window's own character class, unless it is already
inside a base span. The allow-list hides its strings only: no window covers one,
and what stands beside them in the same run is scanned as usual.

Spans are (start, end) in code points, end exclusive. A pattern's places follow
from cutting the text at its matches: each match ends where the lengths up to it
sum to. Sums run in blocks, long candidates are scanned in overlapping blocks,
and base spans meet candidates in one sorted pass, so work grows with the text.

Defined cases: null text counts as empty and has no spans; texts of any length
are scanned whole; the results are columns of the row itself, so repeated rows,
null ids and other columns are of no account.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _either_case(words: str) -> str:
    """A pattern whose letters match in either ASCII case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# The base patterns of the contract.
ASSIGN = "(" + _either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN = 12
ACCESS = "AKIA[A-Z0-9]{14,}"  # runs of 18 characters and more; a shorter run holds no longer one
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")  # also the order of spans that start together

#: Entropy scan: what a candidate is, and the window.
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
BLOCK = 256  # lengths summed at a time, and code points of a text cut at a time
STRETCH = 96  # windows of a candidate scanned at a time
#: Least bits per character of a window by its class; numbers, letters of one case, and words of one case
#: with a digit or two between separators have no class.
HEX_BITS, LETTERS_BITS, ALPHANUMERIC_BITS, BASE64_BITS = 2.9, 3.9, 3.55, 3.85
FEW_DIGITS = 2
#: Harmless strings that look random, with their lengths: identifiers, placeholders, alphabets.
ALLOW = (
    ("[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", 36),
    (_either_case("example"), 7),
    (_either_case("placeholder"), 11),
    (_either_case("your") + "[_-]", 5),
    (_either_case("abcdefghij"), 10),
    (_either_case("klmnopqrst"), 10),
    ("0123456789", 10),
)
#: Digests of packages: how a candidate begins, and the most characters that its prefix and digest take.
DIGESTS = (("^sha1[-_=]", 45), ("^sha256[-_=]", 71), ("^sha384[-_=]", 103), ("^sha512[-_=]", 135))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, op: Callable[[Column, Column], Column], block: int = BLOCK) -> Column:
    """Array of ``op`` over the values up to and with each; ``values`` is a non-empty array of integers from 0 on.

    In blocks, since appending to an array copies it.
    """
    none = F.array().cast("array<int>")

    def append(s: Column, v: Column) -> Column:
        at = op(s["at"], v)
        return F.struct(at.alias("at"), F.concat(s["out"], F.array(at)).alias("out"))

    def scanned(array: Column) -> Column:
        return F.aggregate(array, F.struct(F.lit(0).alias("at"), none.alias("out")), append, lambda s: s["out"])

    def joined(blocks: Column) -> Column:
        until = scanned(F.transform(blocks, lambda b: F.element_at(b, -1)))
        return F.flatten(_bound(until, lambda u: F.transform(blocks, lambda b, i: F.when(i == 0, b).otherwise(
            F.transform(b, lambda v: op(F.get(u, i - 1), v))))))

    def cut(array: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(array), F.lit(block))
        return _bound(F.transform(firsts, lambda i: scanned(F.slice(array, i, block))), joined)

    return _bound(values, cut)


def _cut(text: Column, pattern: str, keep: Column | None = None) -> Column:
    """Array of (start, end, value, kept) of the pattern's matches; ``keep``: per match, whether it counts."""
    p = F.lit(pattern)
    empty = F.array().cast("array<struct<start:int,end:int,value:string,kept:boolean>>")

    def placed(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))  # the last gap has no match after it
        ends = _running(F.zip_with(gaps, hits, lambda g, h: F.length(g) + F.length(h)), lambda a, b: a + b)
        found = F.arrays_zip(ends.alias("end"), hits.alias("value"),
                             (keep if keep is not None else F.transform(hits, lambda h: F.lit(True))).alias("kept"))
        return F.filter(F.transform(found, lambda x: F.struct(
            (x["end"] - F.length(x["value"])).alias("start"), x["end"].alias("end"), x["value"].alias("value"),
            x["kept"].alias("kept"))), lambda x: x["kept"])

    return F.when(F.rlike(text, p), _bound(F.regexp_extract_all(text, p, F.lit(0)), placed)).otherwise(empty)


def _spans(found: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"),
                                                 x["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Array of (start, rank, end) of the base kinds, in order."""
    long_enough = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_MIN)
    return F.sort_array(F.concat(_spans(_cut(text, ASSIGN, long_enough), "assign"),
                                 _spans(_cut(text, ACCESS), "access"), _spans(_cut(text, HEX), "hex")))


def _times(s: Column, c: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, c, F.lit("")))


def _clog(n: int) -> float:
    return n * math.log2(n) if n else 0.0


#: Sorts of characters: digits, letters of hex digits and others in both cases, separators.
_SORTS = {"0": string.digits, "a": "abcdef", "g": string.ascii_lowercase[6:], "A": "ABCDEF",
          "G": string.ascii_uppercase[6:], "-": "+/_=-"}


def _sorts(block: Column) -> Column:
    """The block with each character replaced by its sort."""
    return F.translate(block, "".join(_SORTS.values()), "".join(k * len(v) for k, v in _SORTS.items()))


def _random(sorts: Column, bits: Column) -> Column:
    """Whether ``bits`` reach the threshold of a window's class, from the sorts of its characters."""
    def has(sort: str) -> Column:
        return F.contains(sorts, F.lit(sort))

    lower, upper = has("a") | has("g"), has("A") | has("G")
    both = lower & upper
    least = (F.when(~has("0"), F.when(both, LETTERS_BITS))
             .when(~has("-"), F.when(has("g") | has("G") | both, ALPHANUMERIC_BITS).when(has("a") | has("A"), HEX_BITS))
             .when(both, BASE64_BITS)
             .when((lower | upper) & (_times(sorts, F.lit("0")) > FEW_DIGITS), BASE64_BITS))
    return (bits >= HEX_BITS) & F.coalesce(bits >= least, F.lit(False))


def _block_range(block: Column) -> Column:
    return _bound(_sorts(block), lambda sorts: _range_by_sorts(block, sorts))


def _range_by_sorts(block: Column, sorts: Column) -> Column:
    """(first, last): ends of the first and last windows of the block that reach their thresholds, or nulls."""
    none = F.lit(None).cast("int")
    # what one more occurrence of a character adds to the sum of n * log2(n) over the window's counts n
    gain = F.array(*[F.lit(_clog(n + 1) - _clog(n)) for n in range(WINDOW)])

    def counts(i: Column) -> Column:
        both = F.substring(block, F.greatest(i - WINDOW + 1, F.lit(1)), F.least(i - 1, F.lit(WINDOW - 1)))
        return _bound(both, lambda w: F.struct(
            i.alias("i"), _times(w, F.substring(block, i, F.lit(1))).alias("entering"),
            F.when(i > WINDOW, _times(w, F.substring(block, i - WINDOW, F.lit(1)))).alias("leaving"),
            F.when(i >= WINDOW, F.substring(sorts, i - WINDOW + 1, F.lit(WINDOW))).alias("sorts")))

    def step(s: Column, x: Column) -> Column:
        total = s["sum"] + F.get(gain, x["entering"]) - F.coalesce(F.get(gain, x["leaving"]), F.lit(0.0))
        hot = F.when(x["sorts"].isNotNull(), _random(x["sorts"], F.lit(math.log2(WINDOW)) - total / WINDOW))
        return _bound(hot, lambda h: F.struct(
            total.alias("sum"), F.when(h, F.coalesce(s["first"], x["i"])).otherwise(s["first"]).alias("first"),
            F.when(h, x["i"]).otherwise(s["last"]).alias("last")))

    start = F.struct(F.lit(0.0).alias("sum"), none.alias("first"), none.alias("last"))
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(block)), counts), start, step)


def candidates(text: Column) -> Column:
    """Array of (start, end, value) of the runs to scan: the allow-list is blanked, digests are skipped."""
    blank = text
    for pattern, length in ALLOW:
        blank = F.regexp_replace(blank, pattern, " " * length)

    def undigested(x: Column) -> Column:
        skip = F.lit(0)
        for pattern, length in DIGESTS:
            skip = F.when(F.rlike(x["value"], F.lit(pattern)), F.lit(length)).otherwise(skip)
        return _bound(skip, lambda n: F.struct(
            (x["start"] + n).alias("start"), x["end"].alias("end"),
            F.when(n > 0, F.substring(x["value"], n + 1, F.length(x["value"]))).otherwise(x["value"]).alias("value")))

    runs = F.transform(_bound(blank, lambda t: _cut(t, CANDIDATE)), undigested)
    return F.when(F.rlike(text, F.lit(CANDIDATE)), F.filter(runs, lambda x: x["end"] - x["start"] >= WINDOW)).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string>>"))


def _outside(found: Column, base: Column) -> Column:
    """The candidates that no base span holds: in order of start, none so far ends as late."""
    def reached(rows: Column) -> Column:
        ends = _running(F.transform(rows, lambda x: F.when(x["value"].isNull(), x["end"]).otherwise(F.lit(0))), F.greatest)
        return F.filter(F.zip_with(rows, ends, lambda x, e: F.when(x["value"].isNotNull() & (e < x["end"]), x)),
                        lambda x: x.isNotNull())

    spans = F.transform(base, lambda b: F.struct(b["start"], F.lit(0).alias("kind"), b["end"],
                                                 F.lit(None).cast("string").alias("value")))
    asked = F.transform(found, lambda x: F.struct(x["start"], F.lit(1).alias("kind"), x["end"], x["value"]))
    return F.when(F.size(found) > 0, _bound(F.sort_array(F.concat(spans, asked)), reached)).otherwise(
        F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>"))


def entropy_spans(text: Column, base: Column) -> Column:
    """Array of (start, rank, end) of the strings whose windows reach their class's threshold."""
    def ranged(x: Column) -> Column:
        # blocks overlap by a window less one character, so each window lies whole in one
        blocks = F.regexp_extract_all(x["value"], F.lit(f"(?=(.{{{WINDOW},{STRETCH + WINDOW - 1}}})).{{1,{STRETCH}}}"), F.lit(1))
        ranges = F.transform(blocks, lambda b, k: _bound(_block_range(b), lambda r: F.struct(
            (k * STRETCH + r["first"]).alias("first"), (k * STRETCH + r["last"]).alias("last"))))
        return _bound(ranges, lambda rs: F.struct(
            (x["start"] + F.array_min(F.transform(rs, lambda r: r["first"])) - WINDOW).alias("start"),
            F.lit(KINDS.index("entropy")).alias("rank"),
            (x["start"] + F.array_max(F.transform(rs, lambda r: r["last"]))).alias("end")))

    asked = _bound(candidates(text), lambda found: _outside(found, base))
    return F.filter(F.transform(asked, ranged), lambda s: s["start"].isNotNull())


def as_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("bigint")


def scan(text: Column) -> Column:
    """Struct (base, spans) of a text: the base spans, and all spans, each in order."""
    text = F.coalesce(text, F.lit(""))
    return F.transform(F.array(F.struct(text.alias("text"), base_spans(text).alias("base"))), lambda x: F.struct(
        x["base"].alias("base"),
        F.sort_array(F.concat(x["base"], entropy_spans(x["text"], x["base"]))).alias("spans")))[0]


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by the mask; ``spans`` in order."""
    def masked_text(x: Column) -> Column:
        def between(start: Column, end: Column) -> Column:
            first = F.floor(start / BLOCK).cast("int")
            near = F.slice(x["blocks"], first + 1, F.floor((end - 1) / BLOCK).cast("int") - first + 1)
            return F.when(end > start, F.substring(F.array_join(near, ""), start - first * BLOCK + 1,
                                                   end - start)).otherwise(F.lit(""))

        # a span that starts before an earlier one ends is under that one's mask
        kept = F.zip_with(F.concat(F.array(F.lit(0)), x["until"]), x["spans"], lambda at, s: F.when(
            s.isNull(), between(at, F.length(x["text"]))).when(
            s["start"] >= at, F.concat(between(at, s["start"]), F.lit(mask))).otherwise(F.lit("")))
        return F.array_join(kept, "")

    cut = _bound(F.struct(text.alias("text"), spans.alias("spans")), lambda x: F.struct(
        x["text"].alias("text"), x["spans"].alias("spans"),
        F.regexp_extract_all(x["text"], F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("blocks"),
        F.when(F.size(x["spans"]) > 0, _running(F.transform(x["spans"], lambda s: s["end"]), F.greatest)).alias("until")))
    return _bound(cut, lambda x: F.when(x["until"].isNotNull(), masked_text(x)).otherwise(x["text"]))


def masked(docs: DataFrame, text_col: str = "text", length_col: str | None = None, mask: str = "[SECRET]") -> DataFrame:
    """The rows with secrets masked in the text; ``length_col`` follows the text where it changed."""
    rows = docs.select(F.struct(*docs.columns).alias("d"), scan(F.col(text_col))["spans"].alias("spans"))
    rows = rows.select("d", redact(F.col("d")[text_col], F.col("spans"), mask).alias("new"))
    new_length = F.when(F.col("new").eqNullSafe(F.col("d")[text_col]), F.col("d")[length_col]).otherwise(
        F.length("new")).cast(docs.schema[length_col].dataType) if length_col else None
    new = {text_col: F.col("new"), length_col: new_length}
    return rows.select(*[new.get(c, F.col("d")[c]).alias(c) for c in docs.columns])
