"""Structured Streaming operators and their registered twins.

Sources are file streams over the event tables (new files = new events). Every
micro-batch appends the events an operator needs, narrowed to its columns, to a
Parquet log in the session's checkpoint folder, as its own ``_batch=<id>``
partition (a replayed batch overwrites its own, so the log is exactly-once). The
table itself is a view: the batch operator over the log. So

* no per-key state is held and none has to be released or expire (T7, T8);
* the result depends on event order (ts, seq) alone, not on how events were cut
  into batches, and late events take their place;
* hot keys are treated as in the batch operators;
* a later run given the same folder continues where the last one stopped.

Each registered twin runs its stream to completion (``availableNow``), then
returns the view as a batch DataFrame; its oracle is the batch twin's SQL.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import messages as msg
from ..operators import tools
from ..operators.upsert import keep_first, keep_last
from ..session import checkpoint_dir
from ..sources import bindings as b
from ..sources.tables import table_path


# ---- sources and sinks -----------------------------------------------------

def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over a table's Parquet files.

    The path is given as a glob so a single-file table also works; on a
    cluster point it at the directory the producers append to.
    """
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    is_folder = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jpath).isDirectory()
    return reader.parquet(path if is_folder else path[:-1] + "[" + path[-1] + "]")


def stream_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for logs and the query checkpoint; pass it again as ``base`` to go on from there."""
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def run_to_end(query) -> None:
    """Wait for an ``availableNow`` query, however long its backlog takes; raises its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def route(handlers: dict[str, Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """One source, one checkpoint, several tables written per micro-batch.

    The batch is persisted once so every handler reads it without re-reading
    the source; handlers must be idempotent per batch id (log sinks are).
    """
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for handler in handlers.values():
                handler(batch, batch_id)
        finally:
            batch.unpersist()
    return on_batch


def log_sink(path: str, build: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """Write ``build(batch)`` as partition ``_batch=<id>`` of the log at ``path``.

    Each micro-batch overwrites only its own partition, so a batch replayed
    after a failure replaces its earlier output: the log is exactly-once, and
    readers see the batch id as the ``_batch`` partition column.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        build(batch).write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")
    return write


def _start(df: DataFrame, base: str, name: str, sink: Callable[[DataFrame, int], None]):
    return (df.writeStream.queryName(f"{name}_{uuid.uuid4().hex[:6]}")
            .foreachBatch(sink)
            .option("checkpointLocation", os.path.join(base, "_checkpoint"))
            .trigger(availableNow=True)
            .start())


def run_logs(raw: DataFrame, base: str, name: str, logs: dict[str, Callable[[DataFrame], DataFrame]]) -> dict[str, str]:
    """Bring the logs under ``base`` up to date with the stream ``raw``; returns their paths.

    One source and one checkpoint feed all logs. The checkpoint lies beside
    them, so a later call with the same ``base`` reads only what is new.
    """
    paths = {log: os.path.join(base, log) for log in logs}
    run_to_end(_start(raw, base, name, route({log: log_sink(paths[log], build) for log, build in logs.items()})))
    return paths


def compact_log(spark: SparkSession, path: str, schema: str, keys: list[str], order: list[str], to: str) -> None:
    """Write the surviving rows of a keyed log to ``to``: one batch that stands for all so far."""
    view = keep_last(_read_log(spark, path, schema).drop("_batch"), keys, order)
    view.write.mode("overwrite").parquet(f"{to}/_batch=0")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of ``path`` (local or cluster storage)."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def _read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.parquet(path).withColumn("_batch", F.col("_batch").cast("bigint"))
    return spark.createDataFrame([], schema + ", _batch long")


# ---- registered twins --------------------------------------------------------

PART_LOG = ("message_id string, session_id string, ts_ms long, seq long, part_type string, tool_status string")
DONE_LOG = "message_id string, ts_ms long, seq long"
HOOK_LOG = "call_id string, session_id string, kind string, ts_ms long, seq long"
EVENT_LOG = "event_id long, session_id string, event_type string, ts_ms long, seq long"
PARAMS_LOG = "id string, session_id string, ts_ms long, seq long, model_id string, context_limit long"
STEP_LOG = ("id string, session_id string, message_id string, timestamp long, reason string, cost double, "
            "tokens_input long, tokens_output long, tokens_reasoning long, tokens_cache_read long, "
            "tokens_cache_write long, seq long")
ESTIMATE_LOG = ("message_id string, session_id string, approach string, model_id string, input_tokens long, "
                "output_tokens long, cache_read_tokens long, cache_write_tokens long, total_tokens long, "
                "estimated_cost double, timestamp long, seq long")
PROMPT_LOG = ("session_id string, model_id string, timestamp long, content_hash string, content string, "
              "token_count long, seq long")


def stream_milestones(spark: SparkSession, d: str, max_files_per_trigger: int | None = None,
                      base: str | None = None) -> DataFrame:
    """Milestones of every message over the logged parts and completions."""
    raw = table_stream(spark, d, "events", max_files_per_trigger)
    logs = run_logs(raw, base or stream_dir(spark, "milestones"), "milestones",
                    {"parts": lambda x: b.part_events(spark, d, x)[0], "done": lambda x: b.part_events(spark, d, x)[1]})
    return msg.streaming_timing(_read_log(spark, logs["parts"], PART_LOG).drop("_batch"),
                                _read_log(spark, logs["done"], DONE_LOG).drop("_batch"))


def stream_tool_latency(spark: SparkSession, d: str, max_files_per_trigger: int | None = None,
                        base: str | None = None) -> DataFrame:
    """T5: 'total' latency rows over the logged hook events; an append table without a key."""
    raw = table_stream(spark, d, "events", max_files_per_trigger)
    logs = run_logs(raw, base or stream_dir(spark, "latency"), "latency",
                    {"hooks": lambda x: b.tool_hook_events(spark, d, x)})
    return tools.tool_latency_total(_read_log(spark, logs["hooks"], HOOK_LOG).drop("_batch"))


def stream_latest_model(spark: SparkSession, d: str, max_files_per_trigger: int | None = None,
                        base: str | None = None) -> DataFrame:
    """Every logged event with the latest chat params of its session."""
    raw = table_stream(spark, d, "events", max_files_per_trigger)
    logs = run_logs(raw, base or stream_dir(spark, "asof"), "asof",
                    {"events": lambda x: b.non_param_events(spark, d, x), "params": lambda x: b.chat_params(spark, d, x)})
    looked = tools.latest_params_asof(_read_log(spark, logs["events"], EVENT_LOG).drop("_batch"),
                                      _read_log(spark, logs["params"], PARAMS_LOG).drop("_batch"),
                                      ["id", "model_id", "context_limit"])
    return looked.select("event_id", "session_id", "event_type", F.col("ts_ms").alias("timestamp"),
                         F.col("asof.id").alias("params_id"), F.col("asof.model_id").alias("model_id"),
                         F.col("asof.context_limit").alias("context_limit"))


def _step_log(spark: SparkSession, d: str) -> Callable[[DataFrame], DataFrame]:
    def steps(batch: DataFrame) -> DataFrame:
        s = b.step_events(spark, d, batch).withColumnRenamed("ts_ms", "timestamp")
        return keep_last(s.select(*msg.STEP_COLUMNS, "seq"), ["id"], ["timestamp", "seq"])
    return steps


def _estimate_log(spark: SparkSession, d: str) -> Callable[[DataFrame], DataFrame]:
    return lambda batch: msg.token_estimate_rows(*b.token_events(spark, d, batch))


def stream_step_metrics(spark: SparkSession, d: str, max_files_per_trigger: int | None = None,
                        base: str | None = None) -> DataFrame:
    """T4: the last write of every step over the logged batches."""
    raw = table_stream(spark, d, "events", max_files_per_trigger)
    logs = run_logs(raw, base or stream_dir(spark, "steps"), "steps", {"steps": _step_log(spark, d)})
    view = keep_last(_read_log(spark, logs["steps"], STEP_LOG), ["id"], ["timestamp", "seq"]).select(*msg.STEP_COLUMNS)
    return view.withColumn("cost", F.round("cost", 9))


def stream_token_estimates(spark: SparkSession, d: str, max_files_per_trigger: int | None = None,
                           base: str | None = None) -> DataFrame:
    """The router's log of estimates, last write per (message, approach); steps are logged alongside."""
    raw = table_stream(spark, d, "events", max_files_per_trigger)
    logs = run_logs(raw, base or stream_dir(spark, "router"), "router",
                    {"steps": _step_log(spark, d), "estimates": _estimate_log(spark, d)})
    log = _read_log(spark, logs["estimates"], ESTIMATE_LOG)
    view = keep_last(log.drop("_batch"), ["message_id", "approach"], ["timestamp", "seq"])  # U1 across batches
    return view.select(*msg.ESTIMATE_COLUMNS).withColumn("estimated_cost", F.round("estimated_cost", 9))


def stream_system_prompts(spark: SparkSession, d: str, max_files_per_trigger: int | None = None,
                          base: str | None = None) -> DataFrame:
    """First prompt per (session, content hash); a batch logs each of its prompts once."""
    raw = table_stream(spark, d, "documents", max_files_per_trigger)
    logs = run_logs(raw, base or stream_dir(spark, "prompts"), "prompts",
                    {"prompts": lambda x: msg.first_prompts(b.system_prompt_events(spark, d, x))})
    log = _read_log(spark, logs["prompts"], PROMPT_LOG).drop("_batch")
    return keep_first(log, ["session_id", "content_hash"], ["timestamp", "seq"]).select(*msg.PROMPT_COLUMNS)


def _twin(fn, batch_name: str):
    fn.batch_twin = batch_name
    return fn


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_milestones": _twin(stream_milestones, "streaming_milestones"),
    "stream_tool_latency": _twin(stream_tool_latency, "tool_latency_total"),
    "stream_latest_model": _twin(stream_latest_model, "latest_model_asof"),
    "stream_step_metrics": _twin(stream_step_metrics, "step_metrics_upsert"),
    "stream_token_estimates": _twin(stream_token_estimates, "token_estimates"),
    "stream_system_prompts": _twin(stream_system_prompts, "system_prompt_dedup"),
}
