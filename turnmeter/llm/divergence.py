"""How far the sources of one language stand apart in their words.

Documents become exact sparse count vectors by ``CountVectorizer`` (terms in at
least ``MIN_DOCS`` documents, no limit on their number). One fit serves all
languages: what it keeps is all that any language keeps, and the vectors also
count in how many documents of each language a term is, exactly, so that each keeps
its own. A term in that many documents of a sample is in as many of all, so the fit
over all documents counts only the terms that such a first fit did not find; the terms of a
document are written once, in two, and become a vector of either fit. The vectors are summed by (language, source), as ``Summarizer``
sums, but sparse: a group holds only the terms it has. With N the sum of a group's counts
over the V kept terms of its language, a term has the share

    p = 1 + floor(1e9 * (count + 2) / (N + 2 V)),

and two shares differ by ``floor((p - q)**2 / (p + q))``, all in integers.

A fit gathers its vocabulary at the driver. The distinct terms of a sample tell
how many there will be at most; the other terms are then dealt by hash into so many
parts that none gathers much more than ``PART_TERMS``, and fitted part by part.
Parts change no result: a term's counts depend on that term alone.

Pairs are evaluated sparsely. Over a term that neither source has, two shares
differ by an amount that depends on the pair alone, so that is taken V times,
and each term corrects it for those pairs of which one has the term. The
corrections are added up inside tasks; what is shuffled is sums of pairs.

Defined cases: null text, language and source read as ''; a group without terms
and a language without kept terms (V = 0, differences 0) are listed like others;
a language of one source has no pairs; repeated rows count as often as they
stand; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_table

MIN_DOCS = 10
TOP_TERMS = 10
#: Vocabulary terms that one fit may gather, about.
PART_TERMS = 2_000_000
#: Share of the documents from which the number of terms is estimated; this steers memory, not results.
SAMPLE = 1 / 16
SCALE = 1_000_000_000
#: Cells of pair matrices that a task keeps before it hands them on.
CELLS = 1 << 21

#: Terms of the first fit at most, which every task keeps; the second fit finds all others.
FIRST_TERMS = 200_000
_LOWER = bytes(range(256)).lower()  # bytes know the capitals A-Z only
# Fixed value: what stands between terms becomes a blank, A-Z lower case; no byte of a character beyond ASCII changes.
_SPACED = bytes(_LOWER[c] if chr(c).isalpha() or c > 0x7F else 0x20 for c in range(256))


def _by_bytes(text: Column, change) -> Column:
    changed = F.pandas_udf(lambda texts: texts.map(change), "binary")
    return changed(text.cast("binary")).cast("string")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case."""
    return _by_bytes(text, bytes.lower)


def _spaced(text: Column) -> Column:
    """The terms of ``text``, with blanks between them."""
    return _by_bytes(text, lambda t: b" ".join(t.translate(_SPACED).split()))


def _parted(text: Column, known: Broadcast) -> Column:
    """The same in two: ``first`` has the terms among the known ones, which are bytes, ``others`` all others."""
    @F.pandas_udf("first binary, others binary")
    def parted(texts: pd.Series) -> pd.DataFrame:
        found, first, others = known.value, [], []
        for t in texts:
            words = t.translate(_SPACED).split()
            first.append(b" ".join([w for w in words if w in found]))
            others.append(b" ".join([w for w in words if w not in found]))
        return pd.DataFrame({"first": first, "others": others}, dtype=object)
    return parted(text.cast("binary"))


def _terms(spaced: Column) -> Column:
    return F.when(spaced != "", F.split(spaced, " ", -1)).otherwise(F.array().cast("array<string>"))


def _part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(parts))


def count_parts(sample: DataFrame, min_docs: int, part_terms: int) -> int:
    """Into how many parts the vocabulary goes: a term of ``min_docs`` documents is in the sample with this chance at least."""
    seen = sample.select(F.explode("terms").alias("term")).agg(F.approx_count_distinct("term")).first()[0]
    return max(1, math.ceil(seen / (1 - (1 - SAMPLE) ** min_docs) / part_terms))


def _fit(docs: DataFrame, min_docs: int, most: int = 2**31 - 1) -> CountVectorizerModel:
    return CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=most).fit(docs)


def group_counts(docs: DataFrame, min_docs: int = MIN_DOCS, part_terms: int = PART_TERMS) -> tuple[DataFrame, DataFrame]:
    """Tables (lang, term) of the kept terms and (lang, source, term, count) of their counts in the groups.

    ``docs`` has lang, source and text, no nulls.
    """
    spark = docs.sparkSession
    numbers = docs.select("lang", "source").distinct().withColumn("group", F.monotonically_increasing_id())
    numbers = shared_table(numbers, "divergence-numbers")
    sample = shared_table(docs.sample(SAMPLE, 0).select(_spaced(F.col("text")).alias("terms")), "divergence-sample")
    sample = sample.select(_terms(F.col("terms")).alias("terms"))
    parts, first = count_parts(sample, min_docs, part_terms), _fit(sample, min_docs, FIRST_TERMS)
    known = spark.sparkContext.broadcast({t.encode() for t in first.vocabulary})
    parted = docs.select("lang", "source", _parted(F.col("text"), known).alias("p"))
    parted = shared_table(parted.select("lang", "source", *[F.col(f"p.{c}").cast("string").alias(c) for c in ("first", "others")]),
                          "divergence-terms")

    kept, counted = [], []
    for part in range(-1, parts):
        own = parted.select("lang", "source", _terms(F.col("first" if part < 0 else "others")).alias("terms"))
        if part >= 0 and parts > 1:
            own = own.withColumn("terms", F.filter("terms", lambda t: _part(t, parts) == part))
        model = first if part < 0 else _fit(own, min_docs)
        names = pd.DataFrame({"term": pd.Series(model.vocabulary, dtype=object)})
        if not len(names):
            continue
        names["index"] = np.arange(len(names), dtype=np.int32)
        names = spark.createDataFrame(names, "term string, index int")
        vectors = model.transform(own).select("lang", "source", F.unwrap_udt(F.col("vector")).alias("v"))
        cells = vectors.join(numbers, ["lang", "source"]).select(
            "group", F.inline(F.arrays_zip(F.col("v.indices").alias("index"), F.col("v.values").alias("value"))))
        sums = cells.groupBy("index", "group").agg(F.sum("value").cast("bigint").alias("count"), F.count("*").alias("docs"))
        sums = sums.join(numbers, "group").drop("group")
        sums = shared_table(sums, "divergence-sums")
        terms = sums.groupBy("index", "lang").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs")
        terms = shared_table(terms.join(names, "index"), "divergence-terms")
        counted.append(sums.drop("docs").join(terms, ["index", "lang"]).select("lang", "source", "term", "count"))
        kept.append(terms.select("lang", "term"))
    if not kept:
        kept = [spark.createDataFrame([], "lang string, term string")]
        counted = [spark.createDataFrame([], "lang string, source string, term string, count bigint")]
    return reduce(DataFrame.union, kept), reduce(DataFrame.union, counted)


def _share(count: str, total: str, kept: str) -> Column:
    """The share of a count, by decimals: its product may pass a long."""
    return F.expr(f"CASE WHEN {kept} > 0 THEN 1 + (CAST({count} + 2 AS DECIMAL(20, 0)) * {SCALE}) DIV ({total} + 2 * {kept}) END")


def _difference(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV ({p} + {q})")


def difference(p, q):
    d = p - q
    return d * d // (p + q)


def _corrections(at: np.ndarray, offsets: np.ndarray, p: np.ndarray, p0: np.ndarray) -> np.ndarray:
    """How far the pairs' differences over some terms exceed those of absent terms.

    Term k has the shares ``p[offsets[k]:offsets[k + 1]]`` in the sources ``at[...]``, and ``p0`` in the others.
    """
    n, terms = len(p0), len(offsets) - 1
    row = np.repeat(np.arange(terms), np.diff(offsets))
    shares, present = np.tile(p0, (terms, 1)), np.zeros((terms, n), dtype=bool)
    shares[row, at], present[row, at] = p, True
    least = difference(p0[:, None], p0)
    one, both = np.zeros((n, n), dtype=np.int64), np.zeros((n, n), dtype=np.int64)
    for s in np.unique(at):
        rows = present[:, s]
        over = difference(shares[rows, s][:, None], shares[rows]) - least[s]
        one[s] = over.sum(axis=0)
        both[s] = (over * present[rows]).sum(axis=0)
    return one + one.T - both


def _pair_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of corrections by (lang, s, t), s < t, for terms given as (lang, p0, entries)."""
    held: dict[str, np.ndarray] = {}

    def rows():
        for lang, sums in held.items():
            s, t = np.nonzero(np.triu(sums, 1))
            yield pd.DataFrame({"lang": lang, "s": s.astype(np.int32), "t": t.astype(np.int32), "value": sums[s, t]})
        held.clear()

    for batch in batches:
        for lang, own in batch.groupby("lang", sort=False):
            p0 = np.asarray(own["p0"].iloc[0], dtype=np.int64)
            step = max(1, CELLS // len(p0))
            for i in range(0, len(own), step):
                at, p = own["s"].iloc[i:i + step], own["p"].iloc[i:i + step]
                offsets = np.concatenate([[0], np.cumsum(at.map(len))])
                found = _corrections(np.concatenate(list(at)), offsets, np.concatenate(list(p)).astype(np.int64), p0)
                held[lang] = held[lang] + found if lang in held else found
                if sum(m.size for m in held.values()) > CELLS:
                    yield from rows()
    yield from rows()


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS,
          top_terms: int = TOP_TERMS, part_terms: int = PART_TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part 'pair' gives every other source of the language with the difference between the two, part 'term' the
    ``top_terms`` terms by which the source exceeds its language most.
    """
    def named(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(""))

    docs = docs.select(named(lang).alias("lang"), named(source).alias("source"), named(text).alias("text"))
    kept, counts = group_counts(docs, min_docs, part_terms)

    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    by_source = Window.partitionBy("lang").orderBy("source")
    groups = (docs.select("lang", "source").distinct()
              .join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["n", "v"])
              .withColumn("zero", F.lit(0)).withColumn("p0", F.coalesce(_share("zero", "n", "v"), F.lit(0)))
              .withColumn("s", F.row_number().over(by_source) - 1).drop("zero"))
    groups = shared_table(groups, "divergence-groups")
    langs = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.first("v").alias("lang_v"), F.transform(
        F.array_sort(F.collect_list(F.struct("s", "p0"))), lambda g: g["p0"]).alias("p0"))

    shares = counts.join(groups.select("lang", "source", "s", "n", "v"), ["lang", "source"]).withColumn("p", _share("count", "n", "v"))
    terms = shares.groupBy("lang", "term").agg(F.sum("count").alias("total"),
                                               F.collect_list(F.struct("source", "s", "p")).alias("entries"))
    terms = shared_table(terms, "divergence-shares")

    exceeding = (terms.join(langs.drop("p0"), "lang").withColumn("q", _share("total", "lang_n", "lang_v"))
                 .select("lang", "q", F.col("term").alias("item"), F.inline("entries")).where("p > q")
                 .select("lang", "source", F.lit("term").alias("part"), "item", _difference("p", "q").alias("value")))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    exceeding = exceeding.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms)

    corrections = (terms.select("lang", F.col("entries.s").alias("s"), F.col("entries.p").alias("p"))
                   .join(langs.select("lang", "p0"), "lang")
                   .mapInPandas(_pair_sums, "lang string, s int, t int, value bigint")
                   .groupBy("lang", "s", "t").agg(F.sum("value").alias("more")))
    one = groups.select("lang", "v", "source", "s", "p0")
    other = groups.select("lang", F.col("source").alias("item"), F.col("s").alias("t"), F.col("p0").alias("q0"))
    pairs = (one.join(other, "lang").where("s < t").join(corrections, ["lang", "s", "t"], "left")
             .withColumn("value", F.when(F.col("v") > 0, F.col("v") * _difference("p0", "q0") + F.coalesce("more", F.lit(0)))
                         .otherwise(F.lit(0)).cast("bigint")))
    pairs = (pairs.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(
        F.col("item").alias("source"), F.col("source").alias("item")))).alias("x"), "value")
        .select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
        .withColumn("rank", F.row_number().over(by_value)))
    return pairs.unionByName(exceeding)
