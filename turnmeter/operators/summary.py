"""Per-session summary rows.

The reference reads six filtered aggregates for one session and writes one
row. Here every fact table is aggregated by session once (partial + final
hash aggregation), and the requested (task, session, strategy) rows pick up
their aggregates with left joins, so one job summarises all sessions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

RUN_COLUMNS = ["task_id", "session_id", "strategy", "total_input_tokens", "total_output_tokens",
               "total_cost", "total_tool_calls", "total_fetched_tokens", "total_referenced_tokens",
               "precision_score", "avg_relevance", "avg_ttft_ms", "avg_tool_duration_ms",
               "total_session_ms", "avg_query_ms", "p50_query_ms", "p95_query_ms"]


def step_totals(step_metrics: DataFrame) -> DataFrame:
    """A1: input/output tokens and cost per session (0 when none)."""
    return step_metrics.groupBy("session_id").agg(
        F.coalesce(F.sum("tokens_input"), F.lit(0)).cast("bigint").alias("total_input"),
        F.coalesce(F.sum("tokens_output"), F.lit(0)).cast("bigint").alias("total_output"),
        F.coalesce(F.sum("cost"), F.lit(0.0)).alias("total_cost"))


def tool_totals(tool_calls: DataFrame) -> DataFrame:
    """A2: completed calls, fetched tokens (0 default) and mean duration per session."""
    return (tool_calls.where(F.col("status") == "completed")
            .groupBy("session_id").agg(
                F.count(F.lit(1)).alias("total_calls"),
                F.coalesce(F.sum("output_estimated_tokens"), F.lit(0)).cast("bigint").alias("total_fetched"),
                F.avg("duration_ms").alias("avg_dur")))


def relevance_totals(relevance: DataFrame) -> DataFrame:
    """A3: referenced tokens (0 default) and mean ratio per session."""
    return relevance.groupBy("session_id").agg(
        F.coalesce(F.sum("referenced_tokens"), F.lit(0)).cast("bigint").alias("total_referenced"),
        F.avg("relevance_ratio").alias("avg_relevance"))


def precision(total_fetched: Column, total_referenced: Column) -> Column:
    """A4: min(1, referenced / fetched); NULL when nothing was fetched."""
    return F.when(total_fetched > 0, F.least(F.lit(1.0), total_referenced / total_fetched))


def timing_totals(streaming_timing: DataFrame) -> DataFrame:
    """Mean time to first token and first-sent to last-completed span."""
    return streaming_timing.groupBy("session_id").agg(
        F.avg("time_to_first_token_ms").alias("avg_ttft"),
        F.min("request_sent").alias("first_sent"),
        F.max("message_completed").alias("last_done"))


def _value_range(value: Column) -> Column:
    """A coarse order-preserving code of a number: sign and a sixteenth of an octave, 4100 codes at most."""
    size = F.floor(F.log2(F.abs(value)) * 16).cast("int") + 20_000
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0))


def nearest_rank(values: DataFrame, keys: Sequence[str], value: str,
                 percentiles: dict[str, float]) -> DataFrame:
    """Exact nearest-rank percentiles per key: ``sorted[max(0, ceil(p*n) - 1)]``.

    Values are counted per (key, value) with map-side partial aggregation. A
    running count over a key's value ranges (a bounded number of rows) finds the
    range that holds each rank; only the distinct values of that range, a small
    share of a hot key's, are then ranked, each range in a task of its own.
    """
    counts = (values.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")))
    return nearest_rank_of_counts(counts, keys, percentiles)


def nearest_rank_of_counts(counts: DataFrame, keys: Sequence[str], percentiles: dict[str, float]) -> DataFrame:
    """:func:`nearest_rank` of values ``_v`` that are counted already, ``_c`` times each."""
    keys = list(keys)
    counts = counts.withColumn("_r", _value_range(F.col("_v")))
    ranges = counts.groupBy(*keys, "_r").agg(F.sum("_c").alias("_c"))
    running = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = (ranges.withColumn("_upto", F.sum("_c").over(running))
              .withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys))))
    ranks = F.array(*[F.struct(F.lit(name).alias("name"), F.greatest(F.lit(1), F.ceil(F.lit(float(p)) * F.col("_n")))
                               .alias("rank")) for name, p in percentiles.items()])
    before = F.col("_upto") - F.col("_c")
    wanted = (ranges.select(*keys, "_r", "_upto", before.alias("_before"), F.inline(ranks))
              .where((F.col("rank") > F.col("_before")) & (F.col("rank") <= F.col("_upto")))
              .select(*keys, "_r", "name", (F.col("rank") - F.col("_before")).alias("_left")))
    inside = (Window.partitionBy(*keys, "_r", "name").orderBy("_v")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    same = reduce(lambda a, b: a & b, [F.col(f"c.{k}").eqNullSafe(F.col(f"w.{k}")) for k in [*keys, "_r"]])
    found = (counts.alias("c").join(wanted.alias("w"), same).select("w.*", "_v", "_c")
             .withColumn("_upto", F.sum("_c").over(inside)).where(F.col("_upto") >= F.col("_left")))
    return found.groupBy(*keys).agg(*[F.min(F.when(F.col("name") == n, F.col("_v"))).alias(n) for n in percentiles])


def latency_stats(latency: DataFrame) -> DataFrame:
    """Rounded mean and nearest-rank p50/p95 of phase 'total' durations."""
    total = latency.where(F.col("phase") == "total").select("session_id", "duration_ms")
    means = total.groupBy("session_id").agg(
        tx.js_round(F.avg("duration_ms")).cast("bigint").alias("avg_query_ms"),
        F.count(F.lit(1)).alias("n_queries"))
    pct = nearest_rank(total, ["session_id"], "duration_ms",
                       {"p50_query_ms": 0.5, "p95_query_ms": 0.95})
    return means.join(pct, "session_id")


def benchmark_runs(requests: DataFrame, step_metrics: DataFrame, tool_calls: DataFrame,
                   relevance: DataFrame, streaming_timing: DataFrame,
                   latency: DataFrame) -> DataFrame:
    """One ``benchmark_runs`` row per requested (task_id, session_id, strategy)."""
    # each fact collapses to one row per session (partial + final aggregation)
    # before it meets the request list, so the joins only move small rows
    j = (requests
         .join(step_totals(step_metrics), "session_id", "left")
         .join(tool_totals(tool_calls), "session_id", "left")
         .join(relevance_totals(relevance), "session_id", "left")
         .join(timing_totals(streaming_timing), "session_id", "left")
         .join(latency_stats(latency), "session_id", "left"))
    return _run_rows(j)


def _run_rows(j: DataFrame) -> DataFrame:
    """``benchmark_runs`` rows of requests that have met their session's totals."""
    zero_l = F.lit(0).cast("bigint")
    fetched = F.coalesce(F.col("total_fetched"), zero_l)
    referenced = F.coalesce(F.col("total_referenced"), zero_l)
    return j.select(
        "task_id", "session_id", "strategy",
        F.coalesce(F.col("total_input"), zero_l).alias("total_input_tokens"),
        F.coalesce(F.col("total_output"), zero_l).alias("total_output_tokens"),
        F.coalesce(F.col("total_cost"), F.lit(0.0)).alias("total_cost"),
        F.coalesce(F.col("total_calls"), zero_l).alias("total_tool_calls"),
        F.nullif(fetched, zero_l).alias("total_fetched_tokens"),
        F.nullif(referenced, zero_l).alias("total_referenced_tokens"),
        precision(fetched, referenced).alias("precision_score"),
        F.col("avg_relevance"),
        tx.js_round(F.col("avg_ttft")).cast("bigint").alias("avg_ttft_ms"),
        tx.js_round(F.col("avg_dur")).cast("bigint").alias("avg_tool_duration_ms"),
        (F.col("last_done") - F.col("first_sent")).alias("total_session_ms"),
        "avg_query_ms", "p50_query_ms", "p95_query_ms",
    )


# ---- summaries that follow the tables they sum up (A1-A8) -----------------------------------------

#: What a session's summary needs of each fact table: per measure the condition and the value.
MEASURES: dict[str, dict[str, str]] = {
    "step_metrics": {"step": "1", "tokens_input": "tokens_input", "tokens_output": "tokens_output", "cost": "cost"},
    "tool_calls": {"call": "if(status = 'completed', 1, null)",
                   "fetched": "if(status = 'completed', output_estimated_tokens, null)",
                   "call_ms": "if(status = 'completed', duration_ms, null)"},
    "relevance": {"scored": "1", "referenced": "referenced_tokens", "ratio": "relevance_ratio"},
    "streaming_timing": {"ttft_ms": "time_to_first_token_ms", "sent": "request_sent", "done": "message_completed"},
    "latency": {"query_ms": "if(phase = 'total', duration_ms, null)"},
}
VALUE_COUNTS = "session_id string, measure string, value double, n long"


def value_counts(fact: str, rows: DataFrame, sign: int = 1) -> DataFrame:
    """Rows of a fact table as counts of values (``VALUE_COUNTS``): what any summary of a session needs, exactly.

    Counts add up, and with ``sign`` -1 take away what a replaced row had brought, so sums, means, extremes and
    percentiles stay exact when rows change. Integers are exact up to 2**53.
    """
    own = F.array(*[F.struct(F.lit(m).alias("measure"), F.expr(v).cast("double").alias("value"))
                    for m, v in MEASURES[fact].items()])
    return (rows.select("session_id", F.inline(own)).where("value IS NOT NULL").groupBy("session_id", "measure", "value")
            .agg((F.count("*") * sign).alias("n")))


def add_counts(old: DataFrame, more: DataFrame) -> DataFrame:
    """The sum of two tables of counts; what comes to nothing goes."""
    return (old.unionByName(more).groupBy("session_id", "measure", "value").agg(F.sum("n").alias("n"))
            .where(F.col("n") != 0))


def runs_of_counts(requests: DataFrame, counts: DataFrame) -> DataFrame:
    """``benchmark_runs`` from value counts (A8): the rows that :func:`benchmark_runs` gives."""
    def total(measure: str) -> Column:
        return F.sum(F.when(F.col("measure") == measure, F.col("value") * F.col("n")))

    def count(measure: str) -> Column:
        return F.sum(F.when(F.col("measure") == measure, F.col("n")))

    summed = {m for of in MEASURES.values() for m in of}
    totals = counts.groupBy("session_id").agg(
        *[total(m).alias(f"t_{m}") for m in sorted(summed)], *[count(m).alias(f"n_{m}") for m in sorted(summed)],
        F.min(F.when(F.col("measure") == "sent", F.col("value"))).cast("bigint").alias("first_sent"),
        F.max(F.when(F.col("measure") == "done", F.col("value"))).cast("bigint").alias("last_done"))
    percentiles = nearest_rank_of_counts(
        counts.where(F.col("measure") == "query_ms").select("session_id", F.col("value").cast("bigint").alias("_v"), F.col("n").alias("_c")),
        ["session_id"], {"p50_query_ms": 0.5, "p95_query_ms": 0.95})
    t = F.col
    sums = totals.select(
        "session_id", t("t_tokens_input").cast("bigint").alias("total_input"), t("t_tokens_output").cast("bigint").alias("total_output"),
        t("t_cost").alias("total_cost"), t("n_call").alias("total_calls"), t("t_fetched").cast("bigint").alias("total_fetched"),
        (t("t_call_ms") / t("n_call_ms")).alias("avg_dur"), t("t_referenced").cast("bigint").alias("total_referenced"),
        (t("t_ratio") / t("n_ratio")).alias("avg_relevance"), (t("t_ttft_ms") / t("n_ttft_ms")).alias("avg_ttft"),
        "first_sent", "last_done", tx.js_round(t("t_query_ms") / t("n_query_ms")).cast("bigint").alias("avg_query_ms"))
    return _run_rows(requests.join(sums, "session_id", "left").join(percentiles, "session_id", "left"))
