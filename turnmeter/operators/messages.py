"""Message-level operators: streaming milestones, token estimates, step
metrics, context snapshots and system prompts (SURVEY T2-T4 batch twins, W3,
J8, F4, F6, U1, P8, A9, P19, P20, P9, P10, U2, S4, S5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import tokens as tk
from .tools import latest_params_asof
from .upsert import first_when, keep_first, keep_last

TIMING_COLUMNS = ["message_id", "session_id", "request_sent", "first_part_received",
                  "first_text_received", "first_tool_call", "message_completed",
                  "time_to_first_token_ms", "total_streaming_ms"]


def streaming_timing(parts: DataFrame, completions: DataFrame) -> DataFrame:
    """``streaming_timing`` rows from part and completion events.

    ``parts``: message_id, session_id, ts_ms, seq, part_type, tool_status --
    every ``message.part.updated`` event (no role filter).
    ``completions``: message_id, ts_ms, seq -- finished assistant messages
    (F4 applied by the caller or by :func:`finished_messages`).

    The first part seeds the row (request_sent = first_part_received); the
    first text part and first pending tool part fill their fields; a
    completion only counts when it arrives after the seed. Derived timings are
    computed at each completion, so time to first token exists only if the
    first text arrived before the last completion.
    """
    text_first = F.when(F.col("part_type") == "text", F.struct("ts_ms", "seq"))
    tool_first = (F.col("part_type") == "tool") & (F.col("tool_status") == "pending")
    seeds = (parts.groupBy("message_id")
             .agg(F.min(F.struct("ts_ms", "seq", "session_id")).alias("_seed"),
                  F.min(text_first).alias("_ft"),
                  first_when(tool_first, F.col("ts_ms")).alias("first_tool_call")))

    # seeds keep all their columns through the join, so that parts are read and aggregated once
    after_seed = (F.col("c_ms") > F.col("_seed.ts_ms")) | (
        (F.col("c_ms") == F.col("_seed.ts_ms")) & (F.col("c_seq") > F.col("_seed.seq")))
    done = completions.select(F.col("message_id").alias("c_message"), F.col("ts_ms").alias("c_ms"),
                              F.col("seq").alias("c_seq"))
    j = (seeds.join(done, (F.col("message_id") == F.col("c_message")) & after_seed, "left")
         .groupBy("message_id", "_seed", "_ft", "first_tool_call")
         .agg(F.min("c_ms").alias("message_completed"),
              F.max(F.struct(F.col("c_ms").alias("ts_ms"), F.col("c_seq").alias("seq"))).alias("_last_done")))
    seed_ts = F.col("_seed.ts_ms")
    ft_before_last = (F.col("_ft.ts_ms") < F.col("_last_done.ts_ms")) | (
        (F.col("_ft.ts_ms") == F.col("_last_done.ts_ms")) & (F.col("_ft.seq") < F.col("_last_done.seq")))
    completed = F.col("message_completed").isNotNull()
    return j.select(
        "message_id",
        F.col("_seed.session_id").alias("session_id"),
        seed_ts.alias("request_sent"),
        seed_ts.alias("first_part_received"),
        F.col("_ft.ts_ms").alias("first_text_received"),
        "first_tool_call",
        "message_completed",
        F.when(completed & F.col("_ft").isNotNull() & ft_before_last,
               F.col("_ft.ts_ms") - seed_ts).alias("time_to_first_token_ms"),
        F.when(completed, F.col("message_completed") - seed_ts).alias("total_streaming_ms"),
    )


#: What a stored timing row keeps: enough to take in further events, and to derive ``TIMING_COLUMNS``.
TIMING_STATE = ("message_id string, seed struct<ts_ms:bigint,seq:bigint,session_id:string>, "
                "first_text struct<ts_ms:bigint,seq:bigint>, first_tool_call bigint, "
                "first_done struct<ts_ms:bigint,seq:bigint>, last_done struct<ts_ms:bigint,seq:bigint>")


def merge_timing(old: DataFrame, events: DataFrame) -> DataFrame:
    """Timing states of ``old``, brought up to date with a batch of events.

    ``old``: rows of ``TIMING_STATE``; ``events``: message_id, session_id,
    ts_ms, seq, part_type, tool_status, done -- part events, and completions
    (``done`` true). Firsts are minima and the last completion a maximum, so
    events of a batch are aggregated before they meet the stored rows, and the
    order of batches does not matter, with one exception, which is the
    reference's own rule: a completion that comes in when its message has no
    earlier part is lost, also if such a part follows in a later batch.
    """
    at = F.struct("ts_ms", "seq")
    part = ~F.col("done")
    fresh = events.where(part).groupBy("message_id").agg(
        F.min(F.struct("ts_ms", "seq", "session_id")).alias("seed"),
        F.min(F.when(F.col("part_type") == "text", at)).alias("first_text"),
        first_when((F.col("part_type") == "tool") & (F.col("tool_status") == "pending"), F.col("ts_ms")).alias("first_tool_call"))
    seeds = old.unionByName(fresh, allowMissingColumns=True).groupBy("message_id").agg(
        F.min("seed").alias("seed"), F.min("first_text").alias("first_text"), F.min("first_tool_call").alias("first_tool_call"),
        F.min("first_done").alias("first_done"), F.max("last_done").alias("last_done"))
    done = (events.where("done").join(seeds.select("message_id", "seed"), "message_id")
            .where(at > F.struct("seed.ts_ms", "seed.seq"))
            .groupBy("message_id").agg(F.min(at).alias("_first"), F.max(at).alias("_last")))
    return seeds.join(done, "message_id", "left").select(
        "message_id", "seed", "first_text", "first_tool_call", F.least("first_done", "_first").alias("first_done"),
        F.greatest("last_done", "_last").alias("last_done"))


def timing_of_states(states: DataFrame) -> DataFrame:
    """``streaming_timing`` rows of stored states: as :func:`streaming_timing` gives them."""
    sent, done = F.col("seed.ts_ms"), F.col("first_done").isNotNull()
    return states.select(
        "message_id", F.col("seed.session_id").alias("session_id"), sent.alias("request_sent"),
        sent.alias("first_part_received"), F.col("first_text.ts_ms").alias("first_text_received"), "first_tool_call",
        F.col("first_done.ts_ms").alias("message_completed"),
        F.when(done & (F.col("first_text") < F.col("last_done")), F.col("first_text.ts_ms") - sent).alias("time_to_first_token_ms"),
        F.when(done, F.col("first_done.ts_ms") - sent).alias("total_streaming_ms"))


TIMING_FIELDS = ["first_part_received", "first_text_received", "first_tool_call", "message_completed"]


def timing_from_updates(starts: DataFrame, updates: DataFrame) -> DataFrame:
    """``streaming_timing`` from explicit row starts and field updates.

    ``starts``: message_id, session_id, ts_ms, seq -- the first start of a
    message inserts the row with request_sent = ts_ms (later ones are ignored).
    ``updates``: message_id, field, ts_ms, seq -- ``SET field = ts WHERE
    field IS NULL``; updates arriving before the row exists change nothing.
    Each ``message_completed`` update recomputes the derived columns from the
    fields present at that moment, so the last completion decides them.
    """
    seeds = starts.groupBy("message_id").agg(F.min(F.struct("ts_ms", "seq", "session_id")).alias("_seed"))
    anchors = seeds.select("message_id", F.col("_seed.ts_ms").alias("_s_ts"), F.col("_seed.seq").alias("_s_seq"))
    at_or_after = (F.col("ts_ms") > F.col("_s_ts")) | \
        ((F.col("ts_ms") == F.col("_s_ts")) & (F.col("seq") >= F.col("_s_seq")))
    first = {f: F.min(F.when(F.col("field") == f, F.struct("ts_ms", "seq"))).alias(f) for f in TIMING_FIELDS}
    u = (updates.select("message_id", "field", "ts_ms", "seq").join(anchors, "message_id").where(at_or_after)
         .groupBy("message_id")
         .agg(*first.values(),
              F.max(F.when(F.col("field") == "message_completed", F.struct("ts_ms", "seq"))).alias("_last_done")))
    j = seeds.join(u, "message_id", "left")

    def before_last(f: str):
        a, b_ = F.col(f), F.col("_last_done")
        return a.isNotNull() & ((a["ts_ms"] < b_["ts_ms"]) | ((a["ts_ms"] == b_["ts_ms"]) & (a["seq"] < b_["seq"])))

    done = F.col("message_completed").isNotNull()
    sent = F.col("_seed.ts_ms")
    return j.select(
        "message_id", F.col("_seed.session_id").alias("session_id"), sent.alias("request_sent"),
        *[F.col(f"{f}.ts_ms").alias(f) for f in TIMING_FIELDS],
        F.when(done & before_last("first_text_received"),
               F.col("first_text_received.ts_ms") - sent).alias("time_to_first_token_ms"),
        F.when(done & before_last("first_part_received"),
               F.col("message_completed.ts_ms") - F.col("first_part_received.ts_ms")).alias("total_streaming_ms"),
    )


CHAT_PARAMS_COLUMNS = ["id", "session_id", "timestamp", "model_id", "provider_id", "agent", "temperature",
                       "top_p", "top_k", "max_output_tokens", "model_context_limit", "model_output_limit",
                       "cost_input", "cost_output", "cost_cache_read", "cost_cache_write", "options_json"]


def chat_params_table(requests: DataFrame) -> DataFrame:
    """``chat_params`` (S3, S4): the rows of :func:`chat_params_rows`, last wins per id."""
    return keep_last(chat_params_rows(requests), ["id"], ["timestamp", "seq"]).select(*CHAT_PARAMS_COLUMNS)


def chat_params_rows(requests: DataFrame) -> DataFrame:
    """Nested request fields flattened (S3), with ``seq``.

    ``requests``: message_id, session_id, ts_ms, seq, model struct<id,
    cost struct<input, output, cache struct<read, write>>, limit
    struct<context, output>>, provider_id, agent, temperature, top_p, top_k,
    max_output_tokens, options (a map, or its JSON). Provider defaults to '';
    options are kept as JSON, and only when there are any.
    """
    opts = F.col("options")
    if dict(requests.dtypes)["options"] == "string":
        options = F.when(~opts.isin("", "{}", "null"), opts)
    else:
        options = F.when(opts.isNotNull() & (F.size(opts) > 0), F.to_json(opts))
    return requests.select(
        F.col("message_id").alias("id"), "session_id", F.col("ts_ms").alias("timestamp"), "seq",
        F.col("model.id").alias("model_id"), F.coalesce(F.col("provider_id"), F.lit("")).alias("provider_id"),
        "agent", "temperature", "top_p", "top_k", "max_output_tokens",
        F.col("model.limit.context").alias("model_context_limit"),
        F.col("model.limit.output").alias("model_output_limit"),
        F.col("model.cost.input").alias("cost_input"), F.col("model.cost.output").alias("cost_output"),
        F.col("model.cost.cache.read").alias("cost_cache_read"),
        F.col("model.cost.cache.write").alias("cost_cache_write"),
        options.alias("options_json"))


def finished_messages(messages: DataFrame) -> DataFrame:
    """Assistant messages with a truthy finish reason."""
    return messages.where((F.col("role") == "assistant") & F.col("finish").isNotNull()
                          & (F.col("finish") != ""))


ESTIMATE_COLUMNS = ["message_id", "session_id", "approach", "model_id", "input_tokens",
                    "output_tokens", "cache_read_tokens", "cache_write_tokens", "total_tokens",
                    "estimated_cost", "timestamp"]


def token_estimate_rows(requests: DataFrame, finished: DataFrame) -> DataFrame:
    """All ``token_estimates`` writes (with ``seq``) before the unique-key rule."""
    return _estimate_rows(requests, finished)


def token_estimates(requests: DataFrame, finished: DataFrame) -> DataFrame:
    """``token_estimates`` (U1, P8): unique (message_id, approach), last wins.

    ``requests``: message_id, session_id, model_id, ts_ms, seq -- one zero
    'char-ratio' placeholder per chat request.
    ``finished``: message_id, session_id, model_id, ts_ms, seq, tokens_input,
    tokens_output, tokens_reasoning, tokens_cache_read, tokens_cache_write,
    cost -- the host's own counts ('opencode') per finished message.
    """
    return keep_last(_estimate_rows(requests, finished), ["message_id", "approach"],
                     ["timestamp", "seq"]).select(*ESTIMATE_COLUMNS)


def _estimate_rows(requests: DataFrame, finished: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    placeholder = requests.select(
        "message_id", "session_id", F.lit("char-ratio").alias("approach"), "model_id",
        zero.alias("input_tokens"), zero.alias("output_tokens"), zero.alias("cache_read_tokens"),
        zero.alias("cache_write_tokens"), zero.alias("total_tokens"),
        F.lit(0.0).alias("estimated_cost"), F.col("ts_ms").alias("timestamp"), "seq")
    actual = finished.select(
        "message_id", "session_id", F.lit("opencode").alias("approach"), "model_id",
        F.col("tokens_input").alias("input_tokens"), F.col("tokens_output").alias("output_tokens"),
        F.col("tokens_cache_read").alias("cache_read_tokens"),
        F.col("tokens_cache_write").alias("cache_write_tokens"),
        tk.total_tokens("tokens_input", "tokens_output", "tokens_reasoning", "tokens_cache_read",
                        "tokens_cache_write").alias("total_tokens"),
        F.col("cost").cast("double").alias("estimated_cost"), F.col("ts_ms").alias("timestamp"), "seq")
    return placeholder.unionByName(actual)


STEP_COLUMNS = ["id", "session_id", "message_id", "timestamp", "reason", "cost", "tokens_input",
                "tokens_output", "tokens_reasoning", "tokens_cache_read", "tokens_cache_write"]


def step_metrics(steps: DataFrame) -> DataFrame:
    """``step_metrics`` (T4 batch twin, S4): one row per step id, last wins.

    ``steps``: id, session_id, message_id, ts_ms, seq, reason, cost, tokens_*.
    """
    s = steps.withColumnRenamed("ts_ms", "timestamp")
    return keep_last(s.select(*STEP_COLUMNS, "seq"), ["id"], ["timestamp", "seq"]).select(*STEP_COLUMNS)


SNAPSHOT_COLUMNS = ["id", "session_id", "timestamp", "message_count", "total_parts", "tool_parts",
                    "text_parts", "estimated_tokens", "context_utilization", "system_token_pct",
                    "tool_output_token_pct", "conversation_token_pct"]


def explode_parts(snapshots: DataFrame) -> DataFrame:
    """Nested ``messages`` arrays (ev_messages) to one row per part.

    Adds ``message_count`` = size(messages) to the snapshot row and returns
    (snapshots_without_messages, parts) where parts carry ``snapshot_key``,
    part_type, text, tool_output.
    """
    base = snapshots.withColumn("message_count", F.size("messages").cast("bigint"))
    parts = (base.select("snapshot_key", F.explode("messages").alias("m"))
             .select("snapshot_key", F.explode("m.parts").alias("p"))
             .select("snapshot_key", F.col("p.type").alias("part_type"),
                     F.col("p.text").alias("text"), F.col("p.state.output").alias("tool_output")))
    return base.drop("messages"), parts


def resolve_windows(windows: DataFrame, params: DataFrame) -> DataFrame:
    """Context windows with their session's latest chat params, as rows to snapshot.

    ``windows``: snapshot_key, session_id, ts_ms, seq, message_count;
    ``params``: id, session_id, ts_ms, seq, model_id, context_limit. Empty
    windows, windows without a session and those of a session that has no params
    yet make no snapshot; the params' id is the snapshot's id, and of the windows
    that share it the last one stays.
    """
    asked = windows.where((F.col("message_count") > 0) & (F.coalesce("session_id", F.lit("")) != ""))
    found = (latest_params_asof(asked, params, ["id", "model_id", "context_limit"])
             .where(F.col("asof").isNotNull())
             .select("snapshot_key", "session_id", "ts_ms", "seq", "message_count",
                     "asof.id", "asof.model_id", "asof.context_limit"))
    return keep_last(found, ["id"], ["ts_ms", "seq"])


def context_snapshots(snapshots: DataFrame, parts: DataFrame) -> DataFrame:
    """``context_snapshots`` (A9, P19, P20), last wins per id.

    ``snapshots``: snapshot_key, id, session_id, ts_ms, seq, message_count,
    model_id, context_limit (as-of params resolved, see :func:`resolve_windows`).
    ``parts``: snapshot_key, part_type, text, tool_output -- one row per part.
    Only byte lengths of the parts meet the snapshots; counters are summed per
    snapshot with map-side partial aggregation.
    """
    snapshots = keep_last(snapshots.where(F.col("message_count") > 0), ["id"], ["ts_ms", "seq"])
    # the bytes-per-token ratio is matched once per snapshot, not per part
    ratio = snapshots.select("snapshot_key", tk.token_ratio("model_id").alias("_ratio"))
    is_tool = F.col("part_type") == "tool"
    is_text = F.col("part_type") == "text"
    sizes = parts.select("snapshot_key", is_tool.alias("_tool"), is_text.alias("_text"),
                         F.when(is_tool, tk.utf8_bytes("tool_output")).when(is_text, tk.utf8_bytes("text")).alias("_bytes"))
    part_tokens = tk.tokens_of_bytes("_bytes", "_ratio")
    counts = (sizes.join(ratio, "snapshot_key").groupBy("snapshot_key")
              .agg(F.count(F.lit(1)).alias("total_parts"),
                   F.count_if("_tool").alias("tool_parts"),
                   F.count_if("_text").alias("text_parts"),
                   F.sum(F.when(F.col("_tool"), part_tokens)).alias("_tool_tok"),
                   F.sum(F.when(F.col("_text"), part_tokens)).alias("_conv_tok")))
    j = snapshots.join(counts, "snapshot_key", "left")
    zero = F.lit(0).cast("bigint")
    tool_tok = F.coalesce(F.col("_tool_tok"), zero)
    conv_tok = F.coalesce(F.col("_conv_tok"), zero)
    est = tool_tok + conv_tok
    denom = F.when(est == 0, F.lit(1)).otherwise(est)
    limit = F.col("context_limit")
    return j.select(
        "id", "session_id", F.col("ts_ms").alias("timestamp"), "message_count",
        F.coalesce(F.col("total_parts"), zero).alias("total_parts"),
        F.coalesce(F.col("tool_parts"), zero).alias("tool_parts"),
        F.coalesce(F.col("text_parts"), zero).alias("text_parts"),
        est.alias("estimated_tokens"),
        F.when(limit.isNotNull() & (limit > 0), est / limit).alias("context_utilization"),
        F.lit(None).cast("double").alias("system_token_pct"),
        (tool_tok / denom).alias("tool_output_token_pct"),
        (conv_tok / denom).alias("conversation_token_pct"),
    )


PROMPT_COLUMNS = ["session_id", "model_id", "timestamp", "content_hash", "content", "token_count"]


def system_prompts(events: DataFrame) -> DataFrame:
    """``system_prompts``: the rows of :func:`first_prompts` without their arrival number."""
    return first_prompts(events).select(*PROMPT_COLUMNS)


def prompt_rows(events: DataFrame) -> DataFrame:
    """Prompt rows (P9, P10, P2), one per event with any prompt, with ``seq``.

    ``events``: session_id, model_id, ts_ms, seq, system (array<string>).
    """
    content = tx.join_system("system")
    rows = (events
            .select(F.coalesce(F.col("session_id"), F.lit("")).alias("session_id"),
                    F.coalesce(F.col("model_id"), F.lit("unknown")).alias("model_id"),
                    F.col("ts_ms").alias("timestamp"), "seq", content.alias("content"))
            .where(F.col("content") != "")
            .withColumn("content_hash", tx.content_hash("content"))
            .withColumn("token_count", tk.estimate_tokens("content", "model_id")))
    return rows.select(*PROMPT_COLUMNS, "seq")


def first_prompts(events: DataFrame) -> DataFrame:
    """The first prompt row per (session, content hash) (U2, S5), with ``seq``."""
    return keep_first(prompt_rows(events), ["session_id", "content_hash"], ["timestamp", "seq"])
