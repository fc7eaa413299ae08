"""Per-key ordered scans that survive a hot key (used by J2, J3, T5, T6).

The reference keeps "the latest X of this session/call" in a map and consults
it as events arrive. Over a table that is a scan ordered by (ts, seq) inside
each key: a window partitioned by the key. A counting pass first looks for keys
with more than ``max_rows`` rows. Where there are none, the plain window is the
plan. Hot keys are cut into ``PARTS`` ranges of event time that hold about equal
numbers of rows (approximate percentiles of their own times), and

1. the scan runs inside (key, range) partitions;
2. a one-row-per-(key, range) summary carries the last value of each range;
3. a window over those summaries (``PARTS`` rows a key at most) gives every
   range the value carried in from earlier ranges;
4. the carry is joined back on (key, range) and used where the in-range scan
   has not seen a value yet.

So a task holds a small share of a hot key however narrow its time span; only
rows of one key in one millisecond stay together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a key up to which one task scans it whole.
MAX_ROWS = 1_000_000
#: Ranges that a larger key is cut into.
PARTS = 256


def _ranges(df: DataFrame, keys: Sequence[str], ts_ms: str, max_rows: int) -> DataFrame | None:
    """``df`` with ``_range``, the time range of each row within its key; None if no key is hot."""
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows).select(*keys)
    if hot.isEmpty():
        return None
    cuts = F.percentile_approx(ts_ms, [i / PARTS for i in range(1, PARTS)], F.lit(40 * PARTS))
    bounds = (df.select(*keys, ts_ms).join(hot, list(keys), "left_semi")
              .groupBy(*keys).agg(cuts.alias("_bounds"))
              .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_bounds"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    before = F.size(F.filter("_bounds", lambda x: x < F.col(ts_ms)))
    return (df.join(bounds, same, "left")
            .withColumn("_range", F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(before))
            .drop("_bounds", *[f"_k{i}" for i in range(len(keys))]))


def carry_last_non_null(df: DataFrame, keys: Sequence[str], ts_ms: str, seq: str,
                        value: str | Sequence[str], out: str | Sequence[str],
                        max_rows: int = MAX_ROWS) -> DataFrame:
    """Add ``out`` = last non-NULL ``value`` at or before each row, per key.

    Order is (``ts_ms``, ``seq``); ``value`` may be any type (use a struct to
    carry several fields together). Several independent columns can be
    carried in one pass by giving lists for ``value`` and ``out``.
    Equivalent to ``last(value, ignorenulls)`` over
    ``partitionBy(keys).orderBy(ts_ms, seq)`` with an unbounded-preceding
    frame.
    """
    keys = list(keys)
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out)
    b, d = "_range", _ranges(df, keys, ts_ms, max_rows)
    up_to_now = (Window.unboundedPreceding, Window.currentRow)
    if d is None:
        whole = Window.partitionBy(*keys).orderBy(ts_ms, seq).rowsBetween(*up_to_now)
        return df.withColumns({o: F.last(F.col(v), ignorenulls=True).over(whole) for v, o in zip(values, outs)})
    w_in = Window.partitionBy(*keys, b).orderBy(ts_ms, seq).rowsBetween(*up_to_now)
    for i, v in enumerate(values):
        d = d.withColumn(f"_in{i}", F.last(F.col(v), ignorenulls=True).over(w_in))

    # one row per (key, range) that has rows; NULL where the range has no value
    order = F.struct(F.col(ts_ms), F.col(seq))
    summary = d.groupBy(*keys, b).agg(*[
        F.max_by(F.col(v), F.when(F.col(v).isNotNull(), order)).alias(f"_last{i}")
        for i, v in enumerate(values)])
    w_b = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, b, *[F.last(f"_last{i}", ignorenulls=True).over(w_b).alias(f"_carry{i}")
                                       for i in range(len(values))])
    d = d.join(carry, [*keys, b], "left")
    for i, o in enumerate(outs):
        d = d.withColumn(o, F.coalesce(F.col(f"_in{i}"), F.col(f"_carry{i}")))
    return d.drop(b, *[f"_in{i}" for i in range(len(values))], *[f"_carry{i}" for i in range(len(values))])


def previous_row(df: DataFrame, keys: Sequence[str], ts_ms: str, seq: str,
                 value: str, out: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """Add ``out`` = ``value`` of the previous row of the same key (``lag``).

    Order is (``ts_ms``, ``seq``); NULL for a key's first row. ``value`` must
    be non-NULL on every row (wrap fields in a struct).
    """
    keys = list(keys)
    b, d = "_range", _ranges(df, keys, ts_ms, max_rows)
    if d is None:
        return df.withColumn(out, F.lag(F.col(value)).over(Window.partitionBy(*keys).orderBy(ts_ms, seq)))
    w_in = Window.partitionBy(*keys, b).orderBy(ts_ms, seq)
    d = d.withColumn("_in", F.lag(F.col(value)).over(w_in))

    summary = (d.groupBy(*keys, b)
               .agg(F.max_by(F.col(value), F.struct(F.col(ts_ms), F.col(seq))).alias("_last")))
    w_b = Window.partitionBy(*keys).orderBy(b)
    carry = (summary.withColumn("_carry", F.lag("_last").over(w_b))
             .select(*keys, b, "_carry"))
    return (d.join(carry, [*keys, b], "left")
            .withColumn(out, F.coalesce(F.col("_in"), F.col("_carry")))
            .drop("_in", "_carry", b))
