"""Named queries over the driver tables: one per operator group of SURVEY section 2.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; column names
match the oracle SQL in :mod:`turnmeter.plans.oracle`. Doubles that come
from sums or divisions are rounded to 9 places on both sides; wall-clock
columns of the reference (``Date.now()`` stamps) are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tokens as tk
from ..operators import messages as msg
from ..operators import relevance as rel
from ..operators import summary as sm
from ..operators import tools
from ..operators.upsert import keep_first, keep_last, keep_last_of_few, read_evolved, union_evolved
from ..sources import bindings as b
from ..sources import hooks
from ..session import checkpoint_dir
from ..sources.tables import append, epoch_ms, read_table

DIGITS = 9


def _r(col: str, digits: int = DIGITS):
    return F.round(F.col(col), digits).alias(col)


# ---- P1-P8, P11, P13 -------------------------------------------------------

def token_count_heuristic(spark: SparkSession, d: str) -> DataFrame:
    docs = (b.documents(spark, d).select("doc_id", "text", b.model_for("doc_id").alias("model_id"))
            .withColumn("family", tk.model_family("model_id"))
            .withColumn("ratio", tk.token_ratio("model_id", "family")))
    m, t = F.col("model_id"), F.col("text")
    return docs.select("doc_id", "model_id", "family", "ratio", tk.utf8_bytes(t).cast("bigint").alias("n_bytes"),
                       tk.tokens_at_ratio(t, "ratio").alias("token_count"), tk.token_method(t, m).alias("method"),
                       tk.token_warning(t, m).alias("warning"))


def _word_tokenizers() -> dict[str, Callable[[str], int]]:
    """Tokenizers of our own for the query below: words between ASCII blanks; one that gives up on long texts."""
    def short_only(text: str) -> int:
        if len(text) > 1000:
            raise ValueError("too long")
        return len(text.encode().split())
    return {"openai": lambda t: len(t.encode().split()), "claude": lambda t: len(t.encode().split()), "deepseek": short_only}


def token_count_by_tokenizer(spark: SparkSession, d: str) -> DataFrame:
    docs = b.documents(spark, d).select("doc_id", "text", b.model_for("doc_id").alias("model_id"))
    return tk.with_token_counts(docs, "text", "model_id", _word_tokenizers).select(
        "doc_id", "model_id", "token_count", "token_method", "token_warning")


def cost_estimate(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                           "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    u = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                  F.floor("l_extendedprice").alias("input_tokens"),
                  F.floor(F.col("l_quantity") * 40).alias("output_tokens"),
                  (F.col("l_linenumber") * 10).cast("bigint").alias("reasoning_tokens"),
                  F.floor(F.col("l_extendedprice") * F.col("l_discount")).alias("cache_read_tokens"),
                  F.floor(F.col("l_extendedprice") * F.col("l_tax")).alias("cache_write_tokens"))
    r = {k: F.lit(v) for k, v in b.RATES.items()}
    return u.select("*",
                    tk.total_tokens("input_tokens", "output_tokens", "reasoning_tokens", "cache_read_tokens",
                                    "cache_write_tokens").alias("total_tokens"),
                    F.round(tk.estimate_cost("input_tokens", "output_tokens", "cache_read_tokens",
                                             "cache_write_tokens", r["input"], r["output"], r["cache_read"],
                                             r["cache_write"]), DIGITS).alias("estimated_cost"))


def large_output_flag(spark: SparkSession, d: str) -> DataFrame:
    docs = b.documents(spark, d)
    m = b.model_for("doc_id")
    return docs.select("doc_id", tk.utf8_bytes("text").cast("bigint").alias("output_size_bytes"),
                       tk.is_large_output("text").alias("output_compressed"),
                       tk.estimate_tokens("text", m).alias("output_estimated_tokens"))


# ---- P9, P10, U2, S5 -------------------------------------------------------

def system_prompt_dedup(spark: SparkSession, d: str) -> DataFrame:
    return msg.system_prompts(b.system_prompt_events(spark, d))


# ---- S4 / W4 ---------------------------------------------------------------

def tool_calls_upsert(spark: SparkSession, d: str) -> DataFrame:
    return keep_last(b.lineitem_rows(spark, d), ["l_orderkey", "l_linenumber"], ["ship_ms"])


# ---- J1, P11-P15, P23 ------------------------------------------------------

def tool_call_pairing(spark: SparkSession, d: str) -> DataFrame:
    return tools.tool_calls(b.tool_start_events(spark, d), b.tool_end_events(spark, d))


def _sized_calls(spark: SparkSession, d: str) -> DataFrame:
    """The tool-call table without its texts, for aggregates that read sizes only."""
    return tools.tool_calls(b.tool_start_events(spark, d), b.tool_end_events(spark, d), with_text=False)


# ---- J2, S10, F3 -----------------------------------------------------------

def tool_latency_total(spark: SparkSession, d: str) -> DataFrame:
    return tools.tool_latency_total(b.tool_hook_events(spark, d))


# ---- S6, S10: append-only phases with metadata --------------------------------

def latency_phases(spark: SparkSession, d: str) -> DataFrame:
    """Totals and free-form phases appended to one table, read back whole."""
    path = f"{checkpoint_dir(spark)}/tables/latency-{uuid.uuid4().hex[:12]}"
    append(tool_latency_total(spark, d), path)
    append(tools.latency_phases(b.phase_rows(spark, d)), path)
    return spark.read.parquet(path)


# ---- S7: field updates --------------------------------------------------------

def timing_updates(spark: SparkSession, d: str) -> DataFrame:
    return msg.timing_from_updates(*b.timing_updates(spark, d))


# ---- J3, W2, O1 ------------------------------------------------------------

def latest_model_asof(spark: SparkSession, d: str) -> DataFrame:
    looked = tools.latest_params_asof(b.non_param_events(spark, d), b.chat_params(spark, d),
                                      ["id", "model_id", "context_limit"])
    return looked.select("event_id", "session_id", "event_type", F.col("ts_ms").alias("timestamp"),
                         F.col("asof.id").alias("params_id"), F.col("asof.model_id").alias("model_id"),
                         F.col("asof.context_limit").alias("context_limit"))


# ---- S3, S4 ----------------------------------------------------------------

def chat_params_upsert(spark: SparkSession, d: str) -> DataFrame:
    return msg.chat_params_table(b.chat_requests(spark, d)).withColumn("temperature", _r("temperature"))


# ---- W1, J5, A13, F1, F5 ---------------------------------------------------

def cost_share(spark: SparkSession, d: str) -> DataFrame:
    li = tool_calls_upsert(spark, d)
    o = read_table(spark, d, "orders", ["o_orderkey", "o_orderpriority"])
    calls = (li.join(o, li.l_orderkey == o.o_orderkey)
             .select(F.concat(F.col("l_orderkey").cast("string"), F.lit(":"),
                              F.col("l_linenumber").cast("string")).alias("call_id"),
                     F.col("l_orderkey").cast("string").alias("message_id"),
                     F.when(F.col("l_linestatus") == "F", F.lit("completed")).otherwise(F.lit("pending")).alias("status"),
                     F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("bigint"))
                     .otherwise(F.floor("l_quantity")).alias("output_size_bytes")))
    shares = tools.cost_shares(calls, b.orders_steps(spark, d))
    # (bytes / total) * cost is the same IEEE operation sequence in the oracle: no rounding
    return shares.select("call_id", "message_id", "status", "output_size_bytes", "cost_share")


def cost_share_asof(spark: SparkSession, d: str) -> DataFrame:
    starts, ends, steps = b.session_cost_events(spark, d)
    return tools.cost_shares_asof(starts, ends, steps)


# ---- T2, T3, W3, J8, F4, F6 (batch twin) -----------------------------------

def streaming_milestones(spark: SparkSession, d: str) -> DataFrame:
    parts, completions = b.part_events(spark, d)
    return msg.streaming_timing(parts, completions)


# ---- U1, P8 ----------------------------------------------------------------

def token_estimates(spark: SparkSession, d: str) -> DataFrame:
    requests, finished = b.token_events(spark, d)
    return msg.token_estimates(requests, finished).withColumn("estimated_cost", _r("estimated_cost"))


# ---- T4, S4 (batch twin) ---------------------------------------------------

def step_metrics_upsert(spark: SparkSession, d: str) -> DataFrame:
    return msg.step_metrics(b.step_events(spark, d)).withColumn("cost", _r("cost"))


# ---- A9, P19, P20 ----------------------------------------------------------

def context_snapshot(spark: SparkSession, d: str) -> DataFrame:
    snaps, parts = b.context_inputs(spark, d)
    out = msg.context_snapshots(snaps, parts).drop("timestamp")
    return out.select(*[_r(c) if c.endswith("_pct") or c == "context_utilization" else F.col(c)
                        for c in out.columns])


def context_windows(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots of nested windows under the session's latest params; the last window per params id stays."""
    windows, params = b.nested_windows(spark, d)
    base, parts = msg.explode_parts(windows)
    out = msg.context_snapshots(msg.resolve_windows(base, params), parts)
    return out.select(*[_r(c) if c.endswith("_pct") or c == "context_utilization" else F.col(c)
                        for c in out.columns])


# ---- A10-A12, J4, J7, P16-P18, F2, F7, F9, F10 -----------------------------

def _relevance(spark: SparkSession, d: str, method: str) -> DataFrame:
    scored = rel.score_tool_calls(b.finished_conversations(spark, d), b.conversation_calls(spark, d), method)
    return scored.drop("timestamp").withColumn("relevance_ratio", _r("relevance_ratio"))


def line_overlap(spark: SparkSession, d: str) -> DataFrame:
    return _relevance(spark, d, "line-overlap")


def substring_match(spark: SparkSession, d: str) -> DataFrame:
    return _relevance(spark, d, "substring-match")


def relevance_scoring(spark: SparkSession, d: str) -> DataFrame:
    return _relevance(spark, d, "auto")


# ---- A1-A8, J6 -------------------------------------------------------------

def facts(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "step_metrics": step_metrics_upsert(spark, d),
        "tool_calls": _sized_calls(spark, d),
        "relevance": relevance_scoring(spark, d),
        "streaming_timing": streaming_milestones(spark, d),
        "latency": tool_latency_total(spark, d),
    }


def session_totals(spark: SparkSession, d: str) -> DataFrame:
    return sm.step_totals(step_metrics_upsert(spark, d)).withColumn("total_cost", _r("total_cost"))


def tool_aggregates(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.text import js_round
    t = sm.tool_totals(_sized_calls(spark, d))
    return t.select("session_id", "total_calls", "total_fetched",
                    js_round(F.col("avg_dur")).cast("bigint").alias("avg_tool_duration_ms"))


def relevance_aggregates(spark: SparkSession, d: str) -> DataFrame:
    return sm.relevance_totals(relevance_scoring(spark, d)).withColumn("avg_relevance", _r("avg_relevance"))


def precision(spark: SparkSession, d: str) -> DataFrame:
    t = sm.tool_totals(_sized_calls(spark, d)).select("session_id", "total_fetched")
    r = sm.relevance_totals(relevance_scoring(spark, d)).select("session_id", "total_referenced")
    j = t.join(r, "session_id", "left").withColumn(
        "total_referenced", F.coalesce(F.col("total_referenced"), F.lit(0).cast("bigint")))
    return j.select("session_id", "total_fetched", "total_referenced",
                    F.round(sm.precision(F.col("total_fetched"), F.col("total_referenced")), DIGITS)
                    .alias("precision_score"))


def ttft_and_wall(spark: SparkSession, d: str) -> DataFrame:
    t = sm.timing_totals(streaming_milestones(spark, d))
    from ..functions.text import js_round
    return t.select("session_id", js_round(F.col("avg_ttft")).cast("bigint").alias("avg_ttft_ms"),
                    (F.col("last_done") - F.col("first_sent")).alias("total_session_ms"))


def latency_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return sm.latency_stats(tool_latency_total(spark, d)).select(
        "session_id", "n_queries", "avg_query_ms", "p50_query_ms", "p95_query_ms")


def benchmark_run_summary(spark: SparkSession, d: str) -> DataFrame:
    f = facts(spark, d)
    runs = sm.benchmark_runs(b.benchmark_requests(spark, d), f["step_metrics"], f["tool_calls"],
                             f["relevance"], f["streaming_timing"], f["latency"])
    return runs.select(*[_r(c) if c in ("total_cost", "precision_score", "avg_relevance") else F.col(c)
                         for c in runs.columns])


# ---- raw events to tables: S1, S2, J3 into J1, F4, P22 ----------------------

def _raw(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, d: str) -> DataFrame:
        out = hooks.telemetry(b.raw_events(spark, d), [table])[table]
        return out.select(*[_r(c) if c in ("cost", "estimated_cost", "relevance_ratio") else F.col(c) for c in out.columns])
    query.__name__ = f"raw_{table}"
    return query


def _from_lines(spark: SparkSession, d: str, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw events written as JSON lines, damaged ones among them, and read again: (events, quarantine)."""
    path = f"{checkpoint_dir(spark)}/tables/events-{uuid.uuid4().hex[:12]}"
    hooks.write_events(raw, path)
    b.damaged_lines(spark, d).write.mode("append").text(path)
    return hooks.read_events(spark, path)


def _lines(table: str, binding: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A table from JSON lines."""
    def query(spark: SparkSession, d: str) -> DataFrame:
        events = hooks.parsed_once(_from_lines(spark, d, binding(spark, d))[0], table)
        out = hooks.telemetry(events, [table])[table]
        rounded = ("cost", "estimated_cost", "cost_share", "temperature", "context_utilization", "tool_output_token_pct",
                   "conversation_token_pct")
        return out.select(*[_r(c) if c in rounded else F.col(c) for c in out.columns])
    query.__name__ = f"raw_{table}"
    return query


def raw_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Lines set aside, by reason."""
    lines = _from_lines(spark, d, b.raw_events(spark, d))[1]
    return lines.groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct("line").alias("n_different"))


def raw_cost_shares(spark: SparkSession, d: str) -> DataFrame:
    """W1, J5 over the raw events: calls of all kinds of sessions, each step seeing the table as it was."""
    starts, ends, steps = hooks.cost_events(b.raw_events(spark, d))
    shares = tools.cost_shares_asof(starts.drop("session_id"), ends.drop("session_id"), steps.drop("session_id"))
    return shares.select("call_id", "message_id", _r("cost_share"))


def first_parts(spark: SparkSession, d: str) -> DataFrame:
    """First part of each kind per message."""
    items = b.part_items(spark, d).where("item IS NOT NULL")
    return keep_first(items, ["session_id", "item"], ["ts_ms", "seq"])


# ---- S9 --------------------------------------------------------------------

def benchmark_task_upsert(spark: SparkSession, d: str) -> DataFrame:
    docs = b.documents(spark, d)
    tasks = docs.select(F.col("source").alias("id"), F.col("text").alias("description"),
                        F.nullif(F.col("lang"), F.lit("en")).alias("expected_output_hint"),
                        F.col("doc_id").alias("created_at"), F.col("doc_id").alias("seq"))
    return keep_last_of_few(tasks, ["id"], "created_at", "seq").drop("seq")


# ---- S8 --------------------------------------------------------------------

SCHEMA_CUTOVER = "1995-01-01"


def _orders_by_version(spark: SparkSession, d: str) -> list[DataFrame]:
    """Orders as two schema versions: the older one has no priority."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                        "o_orderdate", "o_orderpriority"])
    o = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                 epoch_ms("o_orderdate").alias("order_ms"), "o_orderpriority", "o_orderdate")
    cut = F.lit(SCHEMA_CUTOVER).cast("timestamp_ntz")
    new = F.coalesce(F.col("o_orderdate") >= cut, F.lit(False))  # an undated order counts as old
    return [o.where(~new).drop("o_orderpriority", "o_orderdate"), o.where(new).drop("o_orderdate")]


def schema_evolution_union(spark: SparkSession, d: str) -> DataFrame:
    return union_evolved(_orders_by_version(spark, d))


def schema_evolution_files(spark: SparkSession, d: str) -> DataFrame:
    """The same table from files: each version written by itself, the folders read as one."""
    path = f"{checkpoint_dir(spark)}/tables/orders-{uuid.uuid4().hex[:12]}"
    versions = _orders_by_version(spark, d)
    for i, rows in enumerate(versions, 1):
        rows.write.parquet(f"{path}/v{i}")
    return read_evolved(spark, [f"{path}/v1", f"{path}/v2"]).select(*versions[1].columns)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "token_count_heuristic": token_count_heuristic,
    "token_count_by_tokenizer": token_count_by_tokenizer,
    "cost_estimate": cost_estimate,
    "system_prompt_dedup": system_prompt_dedup,
    "large_output_flag": large_output_flag,
    "tool_calls_upsert": tool_calls_upsert,
    "tool_call_pairing": tool_call_pairing,
    "tool_latency_total": tool_latency_total,
    "latency_phases": latency_phases,
    "timing_updates": timing_updates,
    "latest_model_asof": latest_model_asof,
    "chat_params_upsert": chat_params_upsert,
    "cost_share": cost_share,
    "cost_share_asof": cost_share_asof,
    "streaming_milestones": streaming_milestones,
    "token_estimates": token_estimates,
    "step_metrics_upsert": step_metrics_upsert,
    "context_snapshot": context_snapshot,
    "context_windows": context_windows,
    "raw_tool_calls": _raw("tool_calls"),
    "raw_streaming_timing": _raw("streaming_timing"),
    "raw_token_estimates": _raw("token_estimates"),
    "raw_retrieval_relevance": _raw("retrieval_relevance"),
    "raw_chat_params": _lines("chat_params", b.raw_requests),
    "raw_system_prompts": _lines("system_prompts", b.raw_prompts),
    "raw_context_snapshots": _lines("context_snapshots", b.raw_windows),
    "raw_step_metrics": _lines("step_metrics", b.raw_events),
    "raw_tool_latency_breakdown": _lines("tool_latency_breakdown", b.raw_events),
    "raw_tool_cost_shares": _lines("tool_cost_shares", b.raw_events),
    "raw_quarantine": raw_quarantine,
    "raw_cost_shares": raw_cost_shares,
    "first_parts": first_parts,
    "line_overlap": line_overlap,
    "substring_match": substring_match,
    "relevance_scoring": relevance_scoring,
    "session_totals": session_totals,
    "tool_aggregates": tool_aggregates,
    "relevance_aggregates": relevance_aggregates,
    "precision": precision,
    "ttft_and_wall": ttft_and_wall,
    "latency_percentiles": latency_percentiles,
    "benchmark_run_summary": benchmark_run_summary,
    "benchmark_task_upsert": benchmark_task_upsert,
    "schema_evolution_union": schema_evolution_union,
    "schema_evolution_files": schema_evolution_files,
}
