"""Stored tables that follow a stream, and their registered queries.

Where ``twins`` logs events and derives a table when it is read, these streams
keep the table itself: keyed state (``state``) or mergeable rows hold what later events
need, every micro-batch is merged into a ``sources.store`` table under its batch number, and a
read costs the table's rows, not its history. Folders outlive the run: given
the ``base`` of an earlier run, a stream goes on from its checkpoint.

The stream takes events as they arrive; its files must hold them in arrival order.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import messages as msg
from ..operators import summary as sm
from ..plans import catalog
from ..session import shared_table
from ..sources import bindings as b
from ..sources import hooks
from ..sources.store import AppendTable, KeyedTable, StoredTable, first_wins, last_wins
from . import state
from .twins import ESTIMATE_LOG as ESTIMATE_STATE
from .twins import PROMPT_LOG as PROMPT_STATE
from .twins import STEP_LOG as STEP_STATE
from .twins import run_to_end, stream_dir, table_stream

Sink = Callable[[DataFrame, int], None]

CHAT_STATE = ("id string, session_id string, timestamp long, model_id string, provider_id string, agent string, "
              "temperature double, top_p double, top_k double, max_output_tokens long, model_context_limit long, "
              "model_output_limit long, cost_input double, cost_output double, cost_cache_read double, "
              "cost_cache_write double, options_json string, seq long")


#: Batches without data would follow each other without end where state has a time to live; expiry waits for the next data.
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def follow(stream: DataFrame, base: str, sink: Sink):
    """Bring what ``sink`` writes up to date with the stream: read what is new, then stop. Returns the ended query."""
    conf = stream.sparkSession.conf
    before = conf.get(NO_DATA)
    conf.set(NO_DATA, "false")
    try:
        query = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", os.path.join(base, "_checkpoint"))
                 .trigger(availableNow=True).start())
    finally:
        conf.set(NO_DATA, before)
    run_to_end(query)
    return query


def _persisted(sink: Sink) -> Sink:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            sink(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def timing_table(events: DataFrame, base: str) -> KeyedTable:
    """Timing states of messages (``messages.TIMING_STATE``), merged per micro-batch.

    ``events``: message_id, session_id, ts_ms, seq, part_type, tool_status, done. Only messages that a
    micro-batch names, and those in their buckets, are read and rewritten.
    """
    table = KeyedTable(events.sparkSession, os.path.join(base, "timing"), msg.TIMING_STATE, ["message_id"])
    follow(events, base, table.sink(lambda x: x, msg.merge_timing, "timing"))
    return table


def upsert_table(rows: DataFrame, base: str, keys: list[str], order: list[str], first: bool = False) -> KeyedTable:
    """The stream's rows, the last (or first) one per key by ``order``."""
    table = KeyedTable(rows.sparkSession, os.path.join(base, "table"), rows.schema, keys)
    rule = (first_wins if first else last_wins)(keys, order)
    empty = table.read(0)
    # rows of one micro-batch are reduced before they meet the table
    follow(rows, base, table.sink(lambda x: rule(empty, x), rule, "upsert"))
    return table


def latency_table(hook_events: DataFrame, base: str) -> AppendTable:
    """T5: 'total' latency rows, each written once, from keyed state."""
    state.use_rocksdb(hook_events.sparkSession)
    table = AppendTable(hook_events.sparkSession, os.path.join(base, "latency"), state.LATENCY)
    follow(state.pair_calls(hook_events), base, table.sink(lambda x: x, "latency"))
    return table


def model_table(events: DataFrame, params: DataFrame, base: str, stored: DataFrame | None = None) -> AppendTable:
    """Events with the params in force, from keyed state that starts with ``stored``."""
    state.use_rocksdb(events.sparkSession)
    looked = state.latest_params(events, params, stored)
    table = AppendTable(events.sparkSession, os.path.join(base, "models"), looked.schema)
    follow(looked, base, table.sink(lambda x: x, "models"))
    return table


def share_table(starts: DataFrame, ends: DataFrame, steps: DataFrame, base: str, idle: DataFrame | None = None) -> KeyedTable:
    """The cost share of every call that has started, as of its message's last step."""
    state.use_rocksdb(starts.sparkSession)
    shares = state.share_costs(starts, ends, steps, idle)
    table = KeyedTable(starts.sparkSession, os.path.join(base, "shares"), state.SHARES, ["session_id", "call_id"])
    rule = last_wins(["session_id", "call_id"], ["ts_ms", "seq"])
    follow(shares, base, table.sink(lambda x: x, rule, "shares"))
    return table


def prompt_table(prompts: DataFrame, base: str) -> KeyedTable:
    """The first prompt per (session, content hash).

    ``prompts``: columns of ``messages.PROMPT_COLUMNS`` and seq. Repeats are dropped by keyed state that holds
    no content; a prompt that comes again after its state expired is found in the table, by its key.
    """
    state.use_rocksdb(prompts.sparkSession)
    once = state.first_of_keys(prompts.withColumnRenamed("timestamp", "ts_ms"), ["session_id", "content_hash"])
    once = once.withColumnRenamed("ts_ms", "timestamp")
    table = KeyedTable(prompts.sparkSession, os.path.join(base, "prompts"), once.schema, ["session_id", "content_hash"])
    follow(once, base, _persisted(lambda batch, i: table.insert(batch, i, "prompts")))
    return table


def firsts_table(items: DataFrame, base: str, delay: str = "1 hour", quiet_ms: int = state.DAY_MS) -> KeyedTable:
    """The first row per (session, item) of a stream whose idle rows (item null) end sessions."""
    state.use_rocksdb(items.sparkSession)
    table = KeyedTable(items.sparkSession, os.path.join(base, "firsts"), state.SEEN, ["session_id", "item"])
    rule = first_wins(["session_id", "item"], ["ts_ms", "seq"])
    follow(state.seen_once(items, delay, quiet_ms), base, table.sink(lambda x: x, rule, "firsts"))
    return table


def raw_tables(lines: DataFrame, base: str) -> dict[str, StoredTable]:
    """A stream of JSON lines routed to stored tables; lines that are no events to ``quarantine``.

    One source and one checkpoint; a micro-batch that is replayed after a crash changes only the tables that it had
    not reached. ``lines`` has the column value.
    """
    spark, order = lines.sparkSession, ["timestamp", "seq"]
    prompts = KeyedTable(spark, os.path.join(base, "system_prompts"), PROMPT_STATE, ["session_id", "content_hash"])
    keyed = {"chat_params": (["id"], CHAT_STATE, lambda e: msg.chat_params_rows(hooks.chat_requests(e))),
             "step_metrics": (["id"], STEP_STATE, lambda e: hooks.step_rows(e).withColumnRenamed("ts_ms", "timestamp")),
             "token_estimates": (["message_id", "approach"], ESTIMATE_STATE,
                                 lambda e: msg.token_estimate_rows(hooks.asked(e), hooks.finished(e)))}
    tables = {name: KeyedTable(spark, os.path.join(base, name), schema, keys) for name, (keys, schema, _) in keyed.items()}
    quarantine = AppendTable(spark, os.path.join(base, "quarantine"), "line string, reason string")

    def write(batch: DataFrame, batch_id: int) -> None:
        events, damaged = hooks.parse_events(batch)
        for name, (keys, _, rows) in keyed.items():
            rule = last_wins(keys, order)
            table = tables[name]
            table.sink(lambda e, rows=rows, names=table.schema.names: rows(e).select(*names), rule, "raw")(events, batch_id)
        first = msg.first_prompts(hooks.system_events(events))
        _persisted(lambda x, i: prompts.insert(x, i, "raw"))(first.select(*prompts.schema.names), batch_id)
        quarantine.append(damaged, batch_id, "raw")

    follow(lines, base, _persisted(write))
    return {**tables, "system_prompts": prompts, "quarantine": quarantine}


class SessionSummary:
    """Value counts per session (``summary.VALUE_COUNTS``) that follow stored fact tables.

    ``follow_table`` takes in what has changed in a fact table since it was last called: rows of the buckets that differ
    are counted in and, as they were before, out. The version taken in is published with the counts, so a call after a
    crash or a repeated call adds nothing twice.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.table = KeyedTable(spark, os.path.join(base, "summary"), sm.VALUE_COUNTS, ["session_id", "measure", "value"])

    def follow_table(self, fact: str, table: StoredTable) -> bool:
        since, now = self.table.version().writers.get(fact, 0), table.version().number
        if now == since:
            return False
        old, new = table.changes(since, now)
        delta = sm.add_counts(sm.value_counts(fact, new), sm.value_counts(fact, old, -1)).persist()
        try:
            return self.table.merge(delta, sm.add_counts, now, fact)
        finally:
            delta.unpersist()

    def runs(self, requests: DataFrame) -> DataFrame:
        """``benchmark_runs`` rows of the requested sessions, as of now."""
        return sm.runs_of_counts(requests, self.table.read())


# ---- registered queries: the driver's tables as streams ---------------------------------------------

def timing_events(spark: SparkSession, d: str, raw: DataFrame) -> DataFrame:
    """Part events and completions as one stream (``messages.merge_timing``)."""
    parts, done = b.part_events(spark, d, raw)
    none = F.lit(None).cast("string")
    return parts.withColumn("done", F.lit(False)).unionByName(done.select(
        "message_id", none.alias("session_id"), "ts_ms", "seq", none.alias("part_type"), none.alias("tool_status"),
        F.lit(True).alias("done")))


def table_milestones(spark: SparkSession, d: str, max_files: int | None = None, base: str | None = None) -> DataFrame:
    """Milestones from the merged timing states."""
    raw = table_stream(spark, d, "events", max_files)
    table = timing_table(timing_events(spark, d, raw), base or stream_dir(spark, "table-milestones"))
    return msg.timing_of_states(table.read())


def table_tool_latency(spark: SparkSession, d: str, max_files: int | None = None, base: str | None = None) -> DataFrame:
    """T5: latency rows of the start and end pairing."""
    raw = table_stream(spark, d, "events", max_files)
    return latency_table(b.tool_hook_events(spark, d, raw), base or stream_dir(spark, "table-latency")).read()


def table_latest_model(spark: SparkSession, d: str, max_files: int | None = None, base: str | None = None) -> DataFrame:
    """Every event with the params in force."""
    raw = table_stream(spark, d, "events", max_files)
    return model_table(b.non_param_events(spark, d, raw), b.chat_params(spark, d, raw),
                       base or stream_dir(spark, "table-models")).read()


def table_step_metrics(spark: SparkSession, d: str, max_files: int | None = None, base: str | None = None) -> DataFrame:
    """The last write of every step."""
    steps = b.step_events(spark, d, table_stream(spark, d, "events", max_files)).withColumnRenamed("ts_ms", "timestamp")
    table = upsert_table(steps.select(*msg.STEP_COLUMNS, "seq"), base or stream_dir(spark, "table-steps"),
                         ["id"], ["timestamp", "seq"])
    return table.read().select(*msg.STEP_COLUMNS).withColumn("cost", F.round("cost", 9))


def table_token_estimates(spark: SparkSession, d: str, max_files: int | None = None, base: str | None = None) -> DataFrame:
    """The last estimate per (message, approach)."""
    raw = table_stream(spark, d, "events", max_files)
    rows = msg.token_estimate_rows(*b.token_events(spark, d, raw))
    table = upsert_table(rows, base or stream_dir(spark, "table-estimates"), ["message_id", "approach"], ["timestamp", "seq"])
    return table.read().select(*msg.ESTIMATE_COLUMNS).withColumn("estimated_cost", F.round("estimated_cost", 9))


def table_system_prompts(spark: SparkSession, d: str, max_files: int | None = None, base: str | None = None) -> DataFrame:
    """The first prompt per (session, content hash)."""
    events = b.system_prompt_events(spark, d, table_stream(spark, d, "documents", max_files))
    table = prompt_table(msg.prompt_rows(events), base or stream_dir(spark, "table-prompts"))
    return table.read().select(*msg.PROMPT_COLUMNS)


def table_first_parts(spark: SparkSession, d: str, max_files: int | None = None, base: str | None = None) -> DataFrame:
    """First part of each kind per message, by state that idle events clear."""
    items = b.part_items(spark, d, table_stream(spark, d, "events", max_files))
    table = firsts_table(items, base or stream_dir(spark, "table-firsts"))
    return table.read().select("session_id", "item", "ts_ms", "seq")


def table_cost_shares(spark: SparkSession, d: str, max_files: int | None = None, base: str | None = None) -> DataFrame:
    """Cost shares of the raw events' calls, given when a step arrives."""
    raw = b.raw_events(spark, d, table_stream(spark, d, "events", max_files))
    starts, ends, steps = hooks.cost_events(raw)
    table = share_table(starts, ends, steps, base or stream_dir(spark, "table-shares"))
    return table.read().select("call_id", "message_id", F.round("cost_share", 9).alias("cost_share"))


def table_benchmark_runs(spark: SparkSession, d: str, batches: int = 2, base: str | None = None) -> DataFrame:
    """Run summaries kept up to date while the fact tables come in, here in two batches each."""
    base = base or stream_dir(spark, "table-runs")
    summary = SessionSummary(spark, base)
    for fact, rows in catalog.facts(spark, d).items():
        rows = shared_table(rows, f"fact-{fact}")
        table = AppendTable(spark, os.path.join(base, fact), rows.schema)
        part = F.pmod(F.xxhash64(*rows.columns), F.lit(batches))
        for i in range(batches):
            table.append(rows.where(part == i), i)
            summary.follow_table(fact, table)
    runs = summary.runs(b.benchmark_requests(spark, d))
    return runs.select(*[F.round(c, 9).alias(c) if c in ("total_cost", "precision_score", "avg_relevance") else F.col(c)
                         for c in runs.columns])


def _twin(fn, batch_name: str):
    fn.batch_twin = batch_name
    return fn


TABLE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "table_milestones": _twin(table_milestones, "streaming_milestones"),
    "table_tool_latency": _twin(table_tool_latency, "tool_latency_total"),
    "table_latest_model": _twin(table_latest_model, "latest_model_asof"),
    "table_step_metrics": _twin(table_step_metrics, "step_metrics_upsert"),
    "table_token_estimates": _twin(table_token_estimates, "token_estimates"),
    "table_system_prompts": _twin(table_system_prompts, "system_prompt_dedup"),
    "table_first_parts": _twin(table_first_parts, "first_parts"),
    "table_cost_shares": _twin(table_cost_shares, "raw_cost_shares"),
}
#: Over the stored fact tables, which come from more tables than the events.
SUMMARY_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "table_benchmark_runs": _twin(table_benchmark_runs, "benchmark_run_summary"),
}
