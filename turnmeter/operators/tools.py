"""Tool-call operators.

Inputs are event DataFrames with an event-time column ``ts_ms`` (epoch ms)
and an arrival tie-break ``seq``; outputs are the telemetry tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import tokens as tk
from .sequence import MAX_ROWS, carry_last_non_null, previous_row
from .upsert import keep_last


def args_json(args) -> "F.Column":
    """Tool arguments serialised to JSON text."""
    return F.to_json(F.col(args) if isinstance(args, str) else args)


def truncated_from_metadata(meta_json) -> "F.Column":
    """``metadata.truncated === true`` from JSON text.

    Only a JSON boolean true counts: the string "true" or the number 1 do
    not, so the value's variant type is checked before reading it. Text
    without the literal ``true`` cannot hold a JSON true and skips parsing.
    """
    m = F.col(meta_json) if isinstance(meta_json, str) else meta_json
    v = F.variant_get(F.try_parse_json(m), "$.truncated", "variant")
    is_true = (F.schema_of_variant(v) == F.lit("BOOLEAN")) & F.variant_get(v, "$", "boolean")
    return F.when(m.contains("true"), F.coalesce(is_true, F.lit(False))).otherwise(F.lit(False))


def e_struct_type(df: DataFrame, fields: list[str]) -> T.StructType:
    """Struct type of ``fields`` of ``df`` (for typed NULL placeholders in a union)."""
    return T.StructType([T.StructField(c, df.schema[c].dataType) for c in fields])


def tool_calls(starts: DataFrame, ends: DataFrame, with_text: bool = True) -> DataFrame:
    """Build ``tool_calls`` from start and end events.

    ``starts``: call_id, session_id, message_id, tool, model_id, ts_ms, seq, input_json.
    ``ends``: call_id, ts_ms, seq, status, output_text, title, truncated
    (optionally error_text, and model_id; the latter defaults to the start's model).

    A repeated start replaces the row (back to pending, outputs cleared); an
    end updates the row only if the row exists when it arrives, so only ends
    after the surviving start count and the last of them wins. Ends without a
    start produce no row. Sizes are taken before the shuffle; with
    ``with_text=False`` the columns input_json, output_text, title and
    error_text are left out and no text is sorted or shuffled.
    """
    # The last end is the surviving one exactly when it arrives after the last
    # start (otherwise no end follows the surviving start), so both sides are
    # one grouped max per call: a single shuffle, partially aggregated.
    starts = starts.withColumn("input_size_bytes", tk.utf8_bytes("input_json").cast("bigint"))
    ends = ends.withColumn("output_size_bytes", tk.utf8_bytes("output_text").cast("bigint"))
    if "error_text" not in ends.columns:
        ends = ends.withColumn("error_text", F.lit(None).cast("string"))
    start_fields = ["ts_ms", "seq", "session_id", "message_id", "tool", "model_id", "input_size_bytes"]
    end_fields = ["ts_ms", "seq", "status", "output_size_bytes", "truncated"]
    if with_text:
        start_fields += ["input_json"]
        end_fields += ["output_text", "title", "error_text"]
    if "model_id" in ends.columns:
        end_fields.append("model_id")
    s_struct = F.struct(*[F.col(c) for c in start_fields])
    e_struct = F.struct(*[F.col(c) for c in end_fields])
    both = (starts.select("call_id", s_struct.alias("_s"), F.lit(None).cast(e_struct_type(ends, end_fields)).alias("_e"))
            .unionByName(ends.select("call_id", F.lit(None).cast(e_struct_type(starts, start_fields)).alias("_s"),
                                     e_struct.alias("_e"))))
    g = both.groupBy("call_id").agg(F.max("_s").alias("_s"), F.max("_e").alias("_e")).where(F.col("_s").isNotNull())
    end_after = (F.col("_e.ts_ms") > F.col("_s.ts_ms")) | (
        (F.col("_e.ts_ms") == F.col("_s.ts_ms")) & (F.col("_e.seq") > F.col("_s.seq")))
    j = g.select("call_id", *[F.col(f"_s.{c}").alias(c) for c in start_fields],
                 *[F.when(end_after, F.col(f"_e.{c}")).alias(f"end_{c}") for c in end_fields])
    j = j.withColumn("_in_ratio", tk.token_ratio("model_id"))
    has_end = F.col("end_ts_ms").isNotNull()
    if "end_model_id" in j.columns:
        out_ratio = F.when(F.col("end_model_id").isNull(), F.col("_in_ratio")).otherwise(tk.token_ratio("end_model_id"))
    else:
        out_ratio = F.col("_in_ratio")
    out_bytes = F.col("end_output_size_bytes")
    out_tokens = F.when(has_end, tk.tokens_of_bytes(out_bytes, out_ratio))
    large = out_bytes >= tk.COMPRESS_THRESHOLD_BYTES
    texts = {c: [F.col(f"end_{c}").alias(c)] if with_text else [] for c in ("output_text", "title", "error_text")}

    return j.select(
        F.col("call_id").alias("id"),
        "session_id", "message_id", "tool",
        F.col("ts_ms").alias("timestamp_start"),
        F.col("end_ts_ms").alias("timestamp_end"),
        (F.col("end_ts_ms") - F.col("ts_ms")).alias("duration_ms"),
        F.when(has_end, F.col("end_status")).otherwise(F.lit("pending")).alias("status"),
        *(["input_json"] if with_text else []),
        "input_size_bytes",
        tk.tokens_of_bytes("input_size_bytes", "_in_ratio").alias("input_estimated_tokens"),
        *texts["output_text"],
        F.when(has_end, large).otherwise(F.lit(False)).alias("output_compressed"),
        out_bytes.alias("output_size_bytes"),
        out_tokens.alias("output_estimated_tokens"),
        *texts["title"],
        F.when(has_end, F.coalesce(F.col("end_truncated"), F.lit(False))).otherwise(F.lit(False))
        .alias("truncated"),
        *texts["error_text"],
        out_tokens.alias("next_turn_token_impact"),
    )


def tool_latency_total(events: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """'total' latency rows.

    ``events``: call_id, session_id, kind ('before' | 'after'), ts_ms, seq.
    A start time is kept per call and consumed by the next end, so an end
    yields a row exactly when the previous event of its call is a start.
    """
    ev = events.select("call_id", "session_id", "kind", "ts_ms", "seq",
                       F.struct("kind", "ts_ms").alias("_ev"))
    ev = previous_row(ev, ["call_id"], "ts_ms", "seq", "_ev", "_prev", max_rows)
    return (ev.where((F.col("kind") == "after") & (F.col("_prev.kind") == "before"))
            .select(F.col("call_id").alias("tool_call_id"), "session_id",
                    F.lit("total").alias("phase"),
                    (F.col("ts_ms") - F.col("_prev.ts_ms")).alias("duration_ms"),
                    F.lit(None).cast("string").alias("metadata_json"),
                    F.col("ts_ms").alias("timestamp")))


def latency_phases(rows: DataFrame) -> DataFrame:
    """Latency rows of any phase (S10): metadata, a map or struct, is kept as JSON, NULL where absent.

    ``rows``: tool_call_id, session_id, phase, duration_ms, metadata, timestamp.
    The table has no key: every row is kept.
    """
    return rows.select("tool_call_id", "session_id", "phase", F.col("duration_ms").cast("bigint").alias("duration_ms"),
                       F.to_json("metadata").alias("metadata_json"), "timestamp")


def latest_params_asof(events: DataFrame, params: DataFrame, fields: list[str],
                       max_rows: int = MAX_ROWS) -> DataFrame:
    """As-of lookup of the session's latest chat params.

    ``events``: session_id, ts_ms, seq, ...; ``params``: session_id, ts_ms, seq
    and ``fields``. Adds a struct column ``asof`` holding ``fields`` of the
    latest params row at or before each event (NULL when none).
    """
    ev_cols = events.columns
    p = params.select("session_id", "ts_ms", "seq", F.struct(*fields).alias("_p"))
    e = events.withColumn("_p", F.lit(None).cast(p.schema["_p"].dataType)).withColumn("_is_event", F.lit(True))
    for c in ev_cols:
        if c not in ("session_id", "ts_ms", "seq"):
            p = p.withColumn(c, F.lit(None).cast(events.schema[c].dataType))
    p = p.withColumn("_is_event", F.lit(False))
    both = e.unionByName(p)
    filled = carry_last_non_null(both, ["session_id"], "ts_ms", "seq", "_p", "asof", max_rows)
    return filled.where("_is_event").select(*ev_cols, "asof")


def cost_shares(calls: DataFrame, steps: DataFrame) -> DataFrame:
    """Proportional cost allocation of a message's step cost.

    ``calls``: call_id, message_id, status, output_size_bytes (state of the
    tool_calls table when the step arrives); ``steps``: message_id, ts_ms,
    seq, cost. The last positive-cost step of a message sets the shares of its
    completed calls: bytes / sum(bytes) * cost, or cost / n when the byte sum
    is 0. Other calls keep a NULL share.
    """
    last_step = (keep_last(steps.where(F.col("cost") > 0).select("message_id", "ts_ms", "seq", "cost"),
                           ["message_id"], ["ts_ms", "seq"])
                 .select("message_id", F.col("cost").alias("_cost")))
    done = F.col("status") == "completed"
    # conditional sums, not a filter: both uses of the calls can then read the same shuffle
    totals = calls.groupBy("message_id").agg(
        F.coalesce(F.sum(F.when(done, F.coalesce(F.col("output_size_bytes"), F.lit(0)))), F.lit(0)).alias("_total_bytes"),
        F.count_if(done).alias("_n"))
    j = calls.join(totals, "message_id", "left").join(last_step, "message_id", "left")
    bytes_ = F.coalesce(F.col("output_size_bytes"), F.lit(0))
    share = F.when(F.col("_total_bytes") == 0, F.col("_cost") / F.col("_n")) \
        .otherwise((bytes_ / F.col("_total_bytes")) * F.col("_cost"))
    return j.withColumn("cost_share", F.when(done & F.col("_cost").isNotNull(), share)) \
        .drop("_total_bytes", "_n", "_cost")


def _before(ts, seq, than_ts, than_seq) -> "F.Column":
    """(ts, seq) strictly before another point of the arrival order."""
    ts, seq, than_ts, than_seq = (F.col(c) for c in (ts, seq, than_ts, than_seq))
    return (ts < than_ts) | ((ts == than_ts) & (seq < than_seq))


def cost_shares_asof(starts: DataFrame, ends: DataFrame, steps: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Cost shares replayed against the tool-call table as it was at each step (W1, J5, trap 5).

    ``starts``: call_id, message_id, ts_ms, seq; ``ends``: call_id, ts_ms,
    seq, output_size_bytes; ``steps``: message_id, ts_ms, seq, cost.

    The last positive-cost step T of a message overwrites the shares of the
    calls that, at T, belong to the message and are completed: the call's
    latest start before T names the message, and an end between that start
    and T completes it (its bytes are the latest such end's). A start after T
    resets the row, so the share survives only if the call's final start is
    the one that was current at T. Returns call_id, message_id (of the final
    start), cost_share.

    Each start knows the call's next one (a previous-row scan in reverse order,
    which splits hot calls), so whether it was current at T is a test on its own
    row; at most one start per call and message then meets the call's ends.
    """
    last_step = (keep_last(steps.where(F.col("cost") > 0).select("message_id", "ts_ms", "seq", "cost"),
                           ["message_id"], ["ts_ms", "seq"])
                 .select("message_id", F.col("ts_ms").alias("t_ms"), F.col("seq").alias("t_seq"), "cost"))
    s = starts.select("call_id", "message_id", "ts_ms", "seq", (-F.col("ts_ms")).alias("_back_ms"),
                      (-F.col("seq")).alias("_back_seq"), F.struct("ts_ms", "seq").alias("_at"))
    s = (previous_row(s, ["call_id"], "_back_ms", "_back_seq", "_at", "_next", max_rows)
         .select("call_id", "message_id", "ts_ms", "seq", "_next"))
    current = s.join(last_step, "message_id").where(
        _before("ts_ms", "seq", "t_ms", "t_seq")
        & (F.col("_next").isNull() | ~_before("_next.ts_ms", "_next.seq", "t_ms", "t_seq")))
    e = ends.select("call_id", F.col("ts_ms").alias("e_ms"), F.col("seq").alias("e_seq"),
                    F.coalesce("output_size_bytes", F.lit(0)).cast("bigint").alias("bytes"))
    completed = (current.join(e, "call_id")
                 .where(_before("ts_ms", "seq", "e_ms", "e_seq") & _before("e_ms", "e_seq", "t_ms", "t_seq"))
                 .groupBy("call_id", "message_id", "cost", F.col("_next").isNull().alias("final"))
                 .agg(F.max(F.struct("e_ms", "e_seq", "bytes"))["bytes"].alias("bytes")))
    totals = completed.groupBy("message_id").agg(F.sum("bytes").alias("_tb"), F.count(F.lit(1)).alias("_n"))
    # no filter on "final" here: both uses of the completed calls then read the same shuffles
    share = F.when(F.col("_tb") == 0, F.col("cost") / F.col("_n")).otherwise((F.col("bytes") / F.col("_tb")) * F.col("cost"))
    shares = (completed.join(totals, "message_id")
              .select("call_id", "message_id", F.when(F.col("final"), share).alias("cost_share")))
    return (s.where(F.col("_next").isNull()).select("call_id", "message_id")
            .join(shares, ["call_id", "message_id"], "left").select("call_id", "message_id", "cost_share"))
