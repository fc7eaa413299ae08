"""Keyed write rules as set operations.

The reference applies ``INSERT OR REPLACE`` / ``INSERT OR IGNORE`` one row at a
time. Over a whole event table the surviving row per key is the one with the
greatest (last wins) or smallest (first wins) arrival order. Both are written
as a grouped ``max``/``min`` over a struct whose leading fields are the order
columns and whose tail is the payload: partial aggregation keeps one row per
key per map task before the shuffle, so a key holding a third of all rows
costs no more than any other key. Remaining ties are broken by the payload
itself, so the result never depends on task scheduling.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], agg) -> DataFrame:
    keys = list(keys)
    order = list(order)
    payload = [c for c in df.columns if c not in keys and c not in order]
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    fields += [F.col(c) for c in payload]
    picked = df.groupBy(*keys).agg(agg(F.struct(*fields)).alias("_w"))
    out = [F.col(k) for k in keys]
    out += [F.col(f"_w._o{i}").alias(c) for i, c in enumerate(order)]
    out += [F.col(f"_w.{c}").alias(c) for c in payload]
    return picked.select(*out).select(*df.columns)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the latest by ``order`` (``INSERT OR REPLACE``, S4/W4)."""
    return _pick(df, keys, order, F.max)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the earliest by ``order`` (``INSERT OR IGNORE``, S5/W5)."""
    return _pick(df, keys, order, F.min)


def keep_last_of_few(df: DataFrame, keys: Sequence[str], ts: str, seq: str) -> DataFrame:
    """``keep_last`` for few keys with a large payload.

    The winner is picked on one decimal, ``ts`` and the non-negative ``seq``
    packed, by a hash aggregate that no payload enters; only the winners' rows
    are then fetched (a broadcast join while Spark finds the winners small).
    Rows that tie on (ts, seq) are told apart by their payload, as in ``keep_last``.
    """
    order = (F.col(ts).cast("decimal(38,0)") * F.lit(Decimal(10**19))).cast("decimal(38,0)") + F.col(seq)
    order = order.cast("decimal(38,0)")
    last = (df.select(*keys, order.alias("_order")).groupBy(*keys).agg(F.max("_order").alias("_last"))
            .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_last"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return keep_last(df.join(last, same & (order == F.col("_last")), "left_semi"), keys, [ts, seq])


def first_when(cond: Column, value: Column) -> Column:
    """Aggregate: first value among rows satisfying ``cond``.

    A ``SET f = ? WHERE f IS NULL`` update applied in arrival order keeps the
    earliest value; with ``value`` the arrival timestamp this is a plain
    ``min`` that partially aggregates map-side.
    """
    return F.min(F.when(cond, value))


def union_evolved(frames: Sequence[DataFrame]) -> DataFrame:
    """Additive schema evolution (S8): columns missing in older data read as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_evolved(spark, paths: Sequence[str]) -> DataFrame:
    """Read Parquet written under several schema versions as one table."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)
