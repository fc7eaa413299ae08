"""SimHash near-duplicates found with pivot distance tables.

A fingerprint's table holds its Hamming distances to fixed reference
fingerprints. By the triangle inequality two fingerprints at most r bits apart
differ by at most r in every coordinate, so a pair whose largest coordinate
difference exceeds r is discarded; survivors are verified bit by bit.

The references are of two kinds. Near ones differ from zero in one bit: the
distance to such a reference, less the distance to zero, is 1 or -1 as the bit
is clear or set. They are dealt into r + k blocks of neighbouring bits. A pair
within r bits has equal coordinates throughout k blocks at least, so an equi-join
on every choice of k blocks meets each such pair, and no other pairs need to be
looked at. k grows with the number of fingerprints, so that chance meetings stay
below one a fingerprint. Far references are pseudo-random; distances to them
discard most chance meetings before verification.

Equal fingerprints are one node. A bucket (equal coordinates in k blocks) is
handed to a task as a sorted run; buckets of more than ``CHUNK`` members are
split, each pair of parts being a run of its own. A run yields one link per
member at most, to its component's smallest member in that run, so the links
grow with the rows, never with the pairs.

Defined cases: null, empty and blank texts have fingerprint 0 and are linked
like any other; texts of any length are hashed whole; rows that repeat share
their component; null ids are allowed and are not chosen as component_id unless
a component has no other; an empty table gives no rows. Only the named columns
are read.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_table
from .ascii_words import words_of
from .components import connected_components

BITS = 64
FAR_REFERENCES = 16
#: Members of a bucket that are compared in one run; of larger buckets, each two parts.
CHUNK = 4096
#: Runs up to this size are compared all at once, by shifts; larger ones member by member.
SMALL_RUN = 64
_SLICE = 1 << 16

_hash = functools.partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of the text's word shingles (A-Z lower-cased, repeats counted), unsigned."""
    words = words_of(text)
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes, ones, total = (map(_hash, grams)), np.zeros(BITS, np.int64), 0
    while len(part := np.fromiter(itertools.islice(hashes, _SLICE), np.uint64)):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.uint32)
        total += len(part)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column | str, shingle: int = 4) -> Column:
    """Fingerprint of ``text`` as a bigint with the same bits."""
    @F.pandas_udf("long")
    def hashed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], np.uint64).view(np.int64))
    return hashed(text)


# ---- pivot tables -----------------------------------------------------------

def far_references(n: int = FAR_REFERENCES) -> np.ndarray:
    return np.array([_hash(b"reference %d" % i) for i in range(n)], np.uint64)


def distance_table(prints: np.ndarray) -> np.ndarray:
    """Distances of fingerprints to the far references, one row each."""
    return np.bitwise_count(prints[:, None] ^ far_references()[None, :]).astype(np.int8)


def blocks_needed(n: int, radius: int) -> int:
    """Least number of equal blocks (3 at least) at which ``n`` fingerprints meet by chance below once each."""
    k = 3
    while k < BITS - radius and n * math.comb(radius + k, k) > 2 ** (BITS * k / (radius + k)):
        k += 1
    return k


def block_masks(radius: int, k: int) -> list[int]:
    """For each choice of k of the radius + k blocks, the mask of the bits of its references (signed)."""
    edges = [round(BITS * i / (radius + k)) for i in range(radius + k + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in itertools.combinations(blocks, k)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


# ---- runs ---------------------------------------------------------------------

def _shifted_pairs(run: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of members of the same run (``run`` sorted), one array per shift."""
    at, shift = np.arange(len(run)), 0
    while len(at):
        shift += 1
        at = at[at + shift < len(run)]
        at = at[run[at + shift] == run[at]]
        yield at, at + shift


def _find(parent: dict, x: int) -> int:
    while (p := parent.get(x, x)) != x:
        parent[x] = parent.get(p, p)
        x = p
    return x


def _links_in_small_runs(run: np.ndarray, prints: np.ndarray, table: np.ndarray, radius: int):
    """(member, smallest member of its component) index pairs over many small runs."""
    parent: dict[int, int] = {}
    for a, b in _shifted_pairs(run):
        near = np.abs(table[a] - table[b]).max(1, initial=0) <= radius
        a, b = a[near], b[near]
        true = np.bitwise_count(prints[a] ^ prints[b]) <= radius
        for x, y in zip(a[true].tolist(), b[true].tolist()):
            x, y = _find(parent, x), _find(parent, y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    return [(x, _find(parent, x)) for x in parent]


def _links_in_large_run(prints: np.ndarray, table: np.ndarray, radius: int):
    """The same for one run, walking each component from its first member; pairs within it are not listed."""
    left, links = np.arange(len(prints)), []
    while len(left):
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            x = queue.pop()
            near = np.flatnonzero(np.abs(table[left] - table[x]).max(1) <= radius)
            near = near[np.bitwise_count(prints[left[near]] ^ prints[x]) <= radius]
            found = left[near]
            left = np.delete(left, near)
            queue.extend(found)
            links.extend((y, root) for y in found)
    return links


def run_links(run: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside whole runs (rows sorted by run): fingerprints of members and of their roots."""
    table = distance_table(prints)
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    sizes = np.diff(np.r_[first, len(run)])
    large = sizes > SMALL_RUN
    small_rows = np.flatnonzero(np.repeat(~large & (sizes > 1), sizes))
    links = [(small_rows[x], small_rows[y]) for x, y in
             _links_in_small_runs(run[small_rows], prints[small_rows], table[small_rows], radius)]
    for at, n in zip(first[large], sizes[large]):
        links += [(at + x, at + y) for x, y in _links_in_large_run(prints[at:at + n], table[at:at + n], radius)]
    a, b = (np.array([x[i] for x in links], np.int64) for i in (0, 1))
    return prints[a], prints[b]


def _linked(radius: int):
    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by run; the last run of a batch may go on in the next."""
        rest = None
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                whole, rest = rest, None
            else:
                rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
                last = (rest["key"] == rest["key"].iloc[-1]) & (rest["parts"] == rest["parts"].iloc[-1]) if len(rest) else []
                cut = len(rest) - int(np.sum(last))
                whole, rest = rest.iloc[:cut], rest.iloc[cut:]
            if whole is None or not len(whole):
                continue
            key, parts = whole["key"].to_numpy(), whole["parts"].to_numpy()
            run = np.cumsum(np.r_[0, (key[1:] != key[:-1]) | (parts[1:] != parts[:-1])])
            u, v = run_links(run, whole["print"].to_numpy().view(np.uint64), radius)
            yield pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})
    return linked


def fingerprint_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (u, v) that connect exactly the fingerprints that are connected by steps of ``radius`` bits.

    ``prints`` has distinct fingerprints in column ``print``.
    """
    masks = block_masks(radius, blocks_needed(prints.count(), radius))
    coordinates = F.array(*[F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    met = prints.select("print", F.explode(coordinates).alias("key"))
    crowded = shared_table(met.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK)
                           .select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("n")), "crowded")
    if crowded.isEmpty():
        runs = met.withColumn("parts", F.lit(0))
    else:
        n = F.coalesce("n", F.lit(1))
        mine, other = F.pmod(F.xxhash64("print"), n).cast("int"), F.col("other")
        runs = (met.join(crowded, "key", "left").select("key", "print", mine.alias("mine"), n.alias("n"),
                                                        F.explode(F.sequence(F.lit(0), n - 1)).alias("other"))
                .select("key", "print", (F.least("mine", other) * F.col("n") + F.greatest("mine", other)).alias("parts")))
    return (runs.repartition("key", "parts").sortWithinPartitions("key", "parts", "print")
            .mapInPandas(_linked(radius), "u bigint, v bigint").distinct())


def _rooted(docs: DataFrame, shingle: int, radius: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, text_hash, print) of the documents, and (print, least, root) of distinct fingerprints."""
    if radius < 0:
        raise ValueError("radius must not be negative")
    rows = shared_table(docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                                    fingerprint_column(F.col(text_col), shingle).alias("print")), "fingerprints")
    distinct = shared_table(rows.groupBy("print").agg(F.min("id").alias("least")), "distinct-fingerprints")
    roots = connected_components(fingerprint_links(distinct.select("print"), radius)).withColumnRenamed("node", "print")
    return rows, shared_table(distinct.join(roots, "print", "left")
                              .select("print", "least", F.coalesce("root", "print").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """A row per document: its id, ``print`` (bigint) and component_id (smallest id reachable)."""
    rows, rooted = _rooted(docs, shingle, radius, id_col, text_col)
    least = shared_table(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    component = shared_table(rooted.join(least, "root").select("print", "component_id"), "component-of")
    return rows.join(component, "print").select(F.col("id").alias(id_col), "print", "component_id")


def deduplicated(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One document of each component, all columns kept: the smallest id, null ids last.

    Of rows that share the id the one with the smaller hash of its text stays,
    of rows equal in id and text any one.
    """
    rows, rooted = _rooted(docs, shingle, radius, id_col, text_col)
    mine = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash")
    of_row = shared_table(rows.join(rooted.select("print", "root"), "print").select("root", mine.alias("row")), "rows-of")
    counted = shared_table(of_row.groupBy("root", "row").agg(F.count("*").alias("n")), "row-counts")
    first = shared_table(counted.groupBy("root").agg(F.min("row").alias("first")), "firsts")
    judged = shared_table(counted.join(first, "root").select("row.id", "row.text_hash", "n",
                                                             (F.col("row") == F.col("first")).alias("stays")), "judged")
    same = (F.col("d")[id_col].eqNullSafe(F.col("x.id"))) & (F.xxhash64(F.col("d")[text_col]) == F.col("x.text_hash"))
    whole = docs.select(F.struct(*docs.columns).alias("d"))
    twice = judged.where("stays and n > 1")
    gone = judged.where("not stays or n > 1").alias("x")
    out = whole.join(gone, same, "left_anti").select("d.*")
    if not twice.isEmpty():
        once = whole.join(twice.alias("x"), same, "left_semi").select("d.*")
        out = out.unionByName(once.dropDuplicates([id_col, text_col]))
    return out
