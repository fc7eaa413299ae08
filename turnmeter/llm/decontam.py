"""Benchmark decontamination by a prefix-filtered set join (native).

A window is ten consecutive words of an item (all its words, if fewer). Its set
of shingles (three words; the whole window, if shorter) must lie in a document
in full, so it is enough to look for one of them, its prefix: shingles are
ordered by rarity in the corpus and only the rarest of each window is joined.
Three steps, none of which shuffles a document:

1. count, over all documents, the shingles that the benchmark has;
2. join the documents' shingles with the windows' prefixes, under the bounds of
   position and length: the window must lie inside the document;
3. compare the window's words with the document's at that place, in the same
   pass; only true occurrences leave it.

Both joins broadcast the benchmark's side in blocks of ``BLOCK_BYTES`` at most,
measured beforehand; a larger benchmark takes more passes, not more memory. A
window that lacks a shingle in the corpus is out after step 1.

Defined cases: null and empty texts have no words and are never hit; an item
without words has no windows; an item without an id marks words but is neither
counted nor listed; equal items count by id; rows that repeat each get the same
result; a null doc_id is a key like any other; an empty benchmark hits nothing.
Only the named columns are read.
"""

from __future__ import annotations

import math
import string
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_table

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 32 << 20

# Fixed value: what stands between words, after lower-casing A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, SEPARATORS, -1), "")


def _shingles(w: Column, n: int) -> Column:
    """Array of structs of ``n`` neighbouring words, as many as there are words; the last ones have nulls."""
    parts = [w] + [F.slice(w, F.lit(k + 1), F.greatest(F.size(w) - k, F.lit(0))) for k in range(1, n)]
    return F.arrays_zip(*[p.alias(f"w{k}") for k, p in enumerate(parts)])


def _exploded(df: DataFrame, n: int) -> DataFrame:
    """``df`` with a row per shingle of ``n`` words: its place ``at`` and hash ``h``."""
    cols = [F.col(c) for c in df.columns]
    rows = df.select(*cols, F.posexplode(_shingles(F.col("words"), n)).alias("at", "s"))
    return (rows.where(F.col(f"s.w{n - 1}").isNotNull())
            .select(*cols, "at", F.xxhash64(*[F.col(f"s.w{k}") for k in range(n)]).alias("h")))


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Windows of the items: item_id, window (words, space-joined), n (words)."""
    w = (benchmark.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("words"))
         .where(F.size("words") > 0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(1)))
    return (w.select("item_id", F.least(F.size("words"), F.lit(WINDOW)).alias("n"), "words",
                     F.explode(starts).alias("i"))
            .select("item_id", F.array_join(F.slice("words", F.col("i"), F.col("n")), " ").alias("window"), "n")
            .distinct())


def _blocks(df: DataFrame, by: str) -> list[DataFrame]:
    """The table in parts that take ``BLOCK_BYTES`` at most (by an even hash), each marked for broadcast."""
    row = reduce(lambda a, b: a + b, [F.octet_length(c) if t == "string" else F.lit(8) for c, t in df.dtypes])
    total = df.agg(F.sum((row + 48).cast("bigint"))).first()[0] or 0
    k = math.ceil(total / BLOCK_BYTES)
    return [F.broadcast(df.where(F.pmod(F.xxhash64(by), F.lit(k)) == i) if k > 1 else df) for i in range(k)]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def occurrences(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Each place where an item's window stands in a document: key, text_hash, start, end, item_id.

    Places count words from 0, end exclusive. ``key`` and ``text_hash``
    identify the document's row (rows equal in both have equal texts).
    """
    schema = f"key {dict(docs.dtypes)[id_col]}, text_hash bigint, start int, end int, item_id string"
    windows = shared_table(item_windows(benchmark, item_col, item_text_col), "windows")
    doc_words = docs.select(F.col(id_col).alias("key"), F.xxhash64(text_col).alias("text_hash"),
                            words(F.col(text_col)).alias("words"))
    lengths = [r.n for r in windows.select(F.least("n", F.lit(SHINGLE)).alias("n")).distinct().collect()]  # 3 at most
    found = []
    for n in lengths:
        own = windows.where(F.least("n", F.lit(SHINGLE)) == n).select("window", "n").distinct()
        parts = shared_table(_exploded(own.withColumn("words", F.split("window", " ")), n).drop("words"), "shingles")
        hashes = parts.select("h").distinct()
        counts = [_exploded(doc_words.select("words"), n).select("h").join(b, "h").groupBy("h").agg(F.count("*").alias("df"))
                  for b in _blocks(hashes, "h")]
        rarity = shared_table(_union(counts), "rarity")
        # windows of which all shingles occur, each with its rarest one
        need = parts.groupBy("window", "n").agg(F.count("*").alias("parts"))
        prefix = (parts.join(rarity, "h").groupBy("window", "n")
                  .agg(F.count("*").alias("present"), F.min(F.struct("df", "h", "at")).alias("rarest"))
                  .join(need, ["window", "n"]).where(F.col("present") == F.col("parts"))
                  .select("window", F.col("n").alias("n"), F.col("rarest.h").alias("h"), F.col("rarest.at").alias("o")))
        prefix = shared_table(prefix, "prefixes")
        for b in _blocks(prefix, "window"):
            start = F.col("at") - F.col("o")
            inside = (F.col("at") >= F.col("o")) & (start + F.col("n") <= F.size("words"))
            same = F.array_join(F.slice("words", start + 1, F.col("n")), " ") == F.col("window")
            found.append(_exploded(doc_words, n).join(b, "h").where(inside).where(same)
                         .select("key", "text_hash", start.alias("start"), (start + F.col("n")).alias("end"), "window"))
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    places = _union(found).distinct()
    return places.join(windows.select("window", "item_id"), "window").select("key", "text_hash", "start", "end", "item_id")


def _hits(places: DataFrame) -> DataFrame:
    """Per hit text: n_hit (words inside any occurrence) and the sorted ids of the items found."""
    before = Window.partitionBy("key", "text_hash").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max("end").over(before), F.lit(0))
    new = F.greatest(F.col("end") - F.greatest(F.col("start"), covered), F.lit(0))
    n_hit = (places.select("key", "text_hash", "start", "end").distinct().withColumn("new", new)
             .groupBy("key", "text_hash").agg(F.sum("new").alias("n_hit")))
    items = places.groupBy("key", "text_hash").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    same = (F.col("a.key").eqNullSafe(F.col("b.key"))) & (F.col("a.text_hash") == F.col("b.text_hash"))
    return n_hit.alias("a").join(items.alias("b"), same).select("a.key", "a.text_hash", "n_hit", "item_ids")


def _with_hits(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, columns: list[Column],
               how: str) -> DataFrame:
    """The documents' ``columns`` joined with the hits of their rows, the latter written first."""
    hits = shared_table(_hits(shared_table(occurrences(docs, benchmark, id_col, text_col), "places")), "hits").alias("h")
    mine = docs.select(*columns, F.struct(F.col(id_col).alias("key"), F.xxhash64(text_col).alias("text_hash"))
                       .alias("__row")).alias("d")
    same = (F.col("d.__row.key").eqNullSafe(F.col("h.key"))) & (F.col("d.__row.text_hash") == F.col("h.text_hash"))
    return mine.join(hits, same, how)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: its id, n_words, n_hit, item_ids (sorted array; empty where nothing is hit)."""
    n_words = F.size(words(F.col(text_col))).cast("bigint").alias("n_words")
    out = _with_hits(docs, benchmark, id_col, text_col, [F.col(id_col).alias("id"), n_words], "left")
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without any occurrence of a benchmark window, all columns kept."""
    out = _with_hits(docs, benchmark, id_col, text_col, [F.struct(*docs.columns).alias("__doc")], "left_anti")
    return out.select("__doc.*")
