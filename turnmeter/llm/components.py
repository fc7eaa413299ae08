"""Connected components of a table of edges, by alternating large and small stars.

Each round rewires every node's neighbours to the smallest node near it
(Kiveris et al.), until all edges point at their component's smallest node. The
edges of a round are written to the shared folder, so lineage stays short and a
lost executor costs one round at most. A node with very many neighbours is no
bottleneck: minima are pre-aggregated, and the join that hands them back reads
two written tables, so that skewed keys can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v)."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    both = shared_table(both, "star-edges")
    least = shared_table(both.groupBy("u").agg(F.min("v").alias("m"))
                         .select("u", F.least("u", "m").alias("m")), "star-minima")
    near = both.join(least, "u")
    if large:
        new = near.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return new.where(F.col("u") != F.col("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")))
                 .first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v); root is the smallest node reachable.

    Loops and repeated edges are ignored, rows with a null end are no edges; an
    empty table gives no rows.
    """
    edges = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    edges = shared_table(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state, before = _state(edges), None
    while state != before and state[0]:
        edges = shared_table(_star(_star(edges, True), False), "edges")
        state, before = _state(edges), state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
