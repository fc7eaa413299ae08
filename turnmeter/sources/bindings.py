"""Telemetry-shaped event views over the driver tables.

The driver ships TPC-H-like tables, an ``events`` stream table and text
tables, not agent telemetry. Each function here re-reads one of them as a
telemetry event dataset -- always the whole table, only projected and renamed
-- so every operator's work grows with the data. Keys used as sessions
(customer key, user id, conversation id) share one string namespace.

Binding constants (invented for the bindings, not reference values):
``MODEL_IDS`` spreads rows over all model families; ``RATES`` are per-token
prices used by the cost example.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import epoch_ms, read_table

MODEL_IDS = ["gpt-4o", "claude-sonnet-4.7", "deepseek-v3", "gemini-2.5-pro",
             "glm-4.6", "llama-3.3-70b", "kimi-k2", "grok-4"]
RATES = {"input": 3e-06, "output": 1.5e-05, "cache_read": 3e-07, "cache_write": 3.75e-06}
WEEK_MS = 7 * 86_400_000
DAY_MS = 86_400_000


def model_for(key) -> Column:
    """A model id picked deterministically from an integer key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.element_at(F.array(*[F.lit(m) for m in MODEL_IDS]), (F.pmod(k, F.lit(len(MODEL_IDS))) + 1).cast("int"))


def _s(col: str) -> Column:
    return F.col(col).cast("string")


# ---- events table: sessions = users ---------------------------------------

def events(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    """The events table (or a stream with its schema, ``raw``) as telemetry events."""
    e = raw if raw is not None else read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return e.select("event_id", _s("user_id").alias("session_id"), "event_type", "value",
                    epoch_ms("ts").alias("ts_ms"), F.col("event_id").alias("seq"))


def message_of(session: str = "session_id", ts_ms: str = "ts_ms") -> Column:
    """A message per (session, week of event time)."""
    return F.concat(F.col(session), F.lit(":"), F.floor(F.col(ts_ms) / F.lit(WEEK_MS)).cast("string"))


def part_events(spark: SparkSession, d: str, raw: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(parts, completions): view = text part, click = pending tool part,
    signup/purchase = other parts; error = finished assistant message."""
    e = events(spark, d, raw).withColumn("message_id", message_of())
    parts = (e.where(F.col("event_type") != "error")
             .select("message_id", "session_id", "ts_ms", "seq",
                     F.when(F.col("event_type") == "view", F.lit("text"))
                     .when(F.col("event_type") == "click", F.lit("tool"))
                     .when(F.col("event_type") == "signup", F.lit("step-start"))
                     .otherwise(F.lit("step-finish")).alias("part_type"),
                     F.when(F.col("event_type") == "click", F.lit("pending")).alias("tool_status")))
    completions = e.where(F.col("event_type") == "error").select("message_id", "ts_ms", "seq")
    return parts, completions


def part_items(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    """Parts as items (message and kind of part) of their session, as rows for first occurrences; a
    purchase of 90 and more ends the session (item null)."""
    e = events(spark, d, raw).where(F.col("event_type") != "error")
    idle = (F.col("event_type") == "purchase") & (F.col("value") >= 90)
    return e.select("session_id", F.when(~idle, F.concat(message_of(), F.lit("/"), "event_type")).alias("item"), "ts_ms", "seq")


def tool_hook_events(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    """click = tool.execute.before, view = tool.execute.after; call = user."""
    e = events(spark, d, raw).where(F.col("event_type").isin("click", "view"))
    return e.select(F.col("session_id").alias("call_id"), "session_id",
                    F.when(F.col("event_type") == "click", F.lit("before")).otherwise(F.lit("after")).alias("kind"),
                    "ts_ms", "seq")


def phase_rows(spark: SparkSession, d: str) -> DataFrame:
    """Every lineitem as a latency phase of its order's call: phase = return flag, metadata = line status
    (none for small items)."""
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_shipdate", "l_quantity", "l_returnflag", "l_linestatus"])
    return li.select(_s("l_orderkey").alias("tool_call_id"), F.lit("lineitem").alias("session_id"),
                     F.concat(F.lit("phase-"), "l_returnflag").alias("phase"),
                     F.floor("l_quantity").alias("duration_ms"),
                     F.when(F.col("l_quantity") >= 10, F.struct(F.col("l_linestatus").alias("state"))).alias("metadata"),
                     epoch_ms("l_shipdate").alias("timestamp"))


def timing_updates(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(starts, updates): signup starts the (user, week) message's row, other events set one field each."""
    e = events(spark, d).withColumn("message_id", message_of())
    starts = e.where(F.col("event_type") == "signup").select("message_id", "session_id", "ts_ms", "seq")
    field = (F.when(F.col("event_type") == "click", F.lit("first_part_received"))
             .when(F.col("event_type") == "view", F.lit("first_text_received"))
             .when(F.col("event_type") == "purchase", F.lit("first_tool_call")).otherwise(F.lit("message_completed")))
    return starts, e.where(F.col("event_type") != "signup").select("message_id", field.alias("field"), "ts_ms", "seq")


def _value_tokens(v: Column) -> dict[str, Column]:
    return {"tokens_input": F.floor(v * 100), "tokens_output": F.floor(v * 10),
            "tokens_reasoning": F.floor(v), "tokens_cache_read": F.floor(v * 50),
            "tokens_cache_write": F.floor(v * 5)}


def chat_params(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    """signup = chat.params of the session: model and limits from the value."""
    e = events(spark, d, raw).where(F.col("event_type") == "signup")
    level = F.floor(F.col("value"))
    return e.select(F.col("event_id").cast("string").alias("id"), "session_id", "ts_ms", "seq",
                    model_for(level).alias("model_id"),
                    ((level + 1) * 1000).cast("bigint").alias("context_limit"))


def chat_requests(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    """signup = chat.params hook call with nested model info (S3 input).

    The request's message id is (user, day), so repeated requests of one
    message exercise last-wins; ``props`` JSON is the options map.
    """
    e = (raw if raw is not None else read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type",
                                                                      "value", "props"]))
    e = e.where(F.col("event_type") == "signup")
    level = F.floor(F.col("value"))
    ts_ms = epoch_ms("ts")
    model = F.struct(
        model_for(level).alias("id"),
        F.struct(F.lit(RATES["input"]).alias("input"), F.lit(RATES["output"]).alias("output"),
                 F.struct(F.lit(RATES["cache_read"]).alias("read"),
                          F.lit(RATES["cache_write"]).alias("write")).alias("cache")).alias("cost"),
        F.struct(((level + 1) * 1000).cast("bigint").alias("context"),
                 F.lit(4096).cast("bigint").alias("output")).alias("limit"))
    from ..functions.tokens import model_family
    return e.select(
        F.concat(_s("user_id"), F.lit(":"), F.floor(ts_ms / F.lit(DAY_MS)).cast("string")).alias("message_id"),
        _s("user_id").alias("session_id"), ts_ms.alias("ts_ms"), F.col("event_id").alias("seq"), model.alias("model"),
        F.when(level >= 100, model_family(model_for(level))).alias("provider_id"),
        F.lit("build").alias("agent"), (F.col("value") / 100).alias("temperature"),
        F.lit(None).cast("double").alias("top_p"), F.lit(None).cast("double").alias("top_k"),
        (level * 10).cast("bigint").alias("max_output_tokens"),
        F.from_json(F.col("props"), "map<string,bigint>").alias("options"))


def non_param_events(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    e = events(spark, d, raw).where(F.col("event_type") != "signup")
    return e.select("event_id", "session_id", "event_type", "ts_ms", "seq")


def token_events(spark: SparkSession, d: str, raw: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(requests, finished): signup = request placeholder, error = finished message."""
    e = events(spark, d, raw)
    model = model_for(F.floor(F.col("value")))
    requests = (e.where(F.col("event_type") == "signup")
                .select(F.col("event_id").cast("string").alias("message_id"), "session_id",
                        model.alias("model_id"), "ts_ms", "seq"))
    toks = _value_tokens(F.col("value"))
    finished = (e.where(F.col("event_type") == "error")
                .select(message_of().alias("message_id"), "session_id", model.alias("model_id"),
                        "ts_ms", "seq", *[c.alias(n) for n, c in toks.items()],
                        (F.col("value") / 100).alias("cost")))
    return requests, finished


def step_events(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    """purchase = step-finish part; step id = (user, day)."""
    e = events(spark, d, raw).where(F.col("event_type") == "purchase")
    toks = _value_tokens(F.col("value"))
    return e.select(
        F.concat(F.col("session_id"), F.lit(":"), F.floor(F.col("ts_ms") / F.lit(DAY_MS)).cast("string")).alias("id"),
        "session_id", message_of().alias("message_id"), "ts_ms", "seq",
        F.when(F.col("value") >= 50, F.lit("tool-calls")).otherwise(F.lit("stop")).alias("reason"),
        (F.col("value") / 1000).alias("cost"), *[c.alias(n) for n, c in toks.items()])


def raw_events(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    """The events table as raw nested events (``sources.hooks``), every row one event.

    signup = chat.params; click and view = tool hooks on even ids (three calls a user, named
    like the user's message), pending tool and text parts on odd ones; purchase = step-finish;
    error = message.updated, by the user on ids divisible by 5, unfinished on ids divisible by 3.
    """
    e = raw if raw is not None else read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    e = e.select("event_id", _s("user_id").alias("session_id"), "event_type", "value", epoch_ms("ts").alias("ts_ms"),
                 F.floor("value").alias("level"), _s("event_id").alias("id"))
    even, kind = F.col("event_id") % 2 == 0, F.col("event_type")
    call = F.concat(F.col("session_id"), F.lit("#"), (F.floor(F.col("event_id") / 2) % 3).cast("string"))
    n = F.col("level").cast("bigint")
    tokens = F.struct((n * 100).alias("input"), (n * 10).alias("output"), n.alias("reasoning"), (n * 50).alias("cache_read"),
                      (n * 5).alias("cache_write"))
    none = F.lit(None)
    return e.select(
        F.when(kind == "signup", F.lit("chat.params"))
        .when((kind == "click") & even, F.lit("tool.execute.before"))
        .when((kind == "view") & even, F.lit("tool.execute.after"))
        .when(kind == "error", F.lit("message.updated")).otherwise(F.lit("message.part.updated")).alias("kind"),
        "session_id", "ts_ms", F.col("event_id").alias("seq"),
        F.struct(F.col("id").alias("message_id"), model_for("level").alias("model_id"),
                 ((n + 1) * 1000).alias("context_limit")).alias("chat_params"),
        F.struct(call.alias("call_id"), message_of().alias("message_id"),
                 F.when(n % 2 == 0, F.lit("read")).otherwise(F.lit("grep")).alias("tool"),
                 F.create_map(F.lit("level"), _s("level")).alias("args")).alias("tool_before"),
        F.struct(call.alias("call_id"), F.concat(F.lit("reply "), F.repeat(F.lit("to "), (n % 9).cast("int")), "id").alias("output"),
                 none.cast("string").alias("title"), F.create_map(F.lit("truncated"), n % 7 == 0).alias("metadata"),
                 F.when(n % 11 == 0, F.lit("exit 1")).alias("error")).alias("tool_after"),
        F.struct(message_of().alias("message_id"),
                 F.when(kind == "view", F.lit("text")).when(kind == "click", F.lit("tool")).otherwise(F.lit("step-finish"))
                 .alias("type"), F.when(kind == "click", F.lit("pending")).alias("status"), F.col("id").alias("step_id"),
                 F.lit("stop").alias("reason"), (F.col("value") / 1000).alias("cost"), tokens.alias("tokens")).alias("part"),
        F.struct(message_of().alias("message_id"),
                 F.when(F.col("event_id") % 5 == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
                 F.when(F.col("event_id") % 3 == 0, F.lit("")).when(F.col("event_id") % 3 == 1, F.lit("stop")).alias("finish"),
                 model_for("level").alias("model_id"), (F.col("value") / 100).alias("cost"), tokens.alias("tokens"),
                 F.array(*[F.struct(F.lit(t).alias("type"), x.alias("text")) for t, x in
                           (("text", F.concat(F.lit("reply "), "id")), ("tool", F.lit("no")), ("text", none.cast("string")),
                            ("text", F.lit("to to")))]).alias("parts")).alias("message"))


def raw_requests(spark: SparkSession, d: str) -> DataFrame:
    """``chat_requests`` as raw events."""
    r = chat_requests(spark, d)
    m = F.col("model")
    return r.select(F.lit("chat.params").alias("kind"), "session_id", "ts_ms", "seq", F.struct(
        "message_id", m["id"].alias("model_id"), m["limit"]["context"].alias("context_limit"),
        m["limit"]["output"].alias("output_limit"), "provider_id", "agent", "temperature", "top_p", "top_k", "max_output_tokens",
        F.struct(m["cost"]["input"].alias("input"), m["cost"]["output"].alias("output"),
                 m["cost"]["cache"]["read"].alias("cache_read"), m["cost"]["cache"]["write"].alias("cache_write")).alias("cost"),
        "options").alias("chat_params"))


def raw_prompts(spark: SparkSession, d: str) -> DataFrame:
    """``system_prompt_events`` as raw events."""
    return system_prompt_events(spark, d).select(
        F.lit("experimental.chat.system.transform").alias("kind"), "session_id", "ts_ms", "seq",
        F.struct("model_id", "system").alias("system"))


def raw_windows(spark: SparkSession, d: str) -> DataFrame:
    """``nested_windows`` as raw events: params and context windows of conversations."""
    windows, params = nested_windows(spark, d)
    asked = params.select(F.lit("chat.params").alias("kind"), "session_id", "ts_ms", "seq", F.struct(
        F.col("id").alias("message_id"), "model_id", "context_limit").alias("chat_params"))
    return asked.unionByName(windows.select(
        F.lit("experimental.chat.messages.transform").alias("kind"), "session_id", "ts_ms", "seq",
        F.struct("messages").alias("window")), allowMissingColumns=True)


def damaged_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines that are no events, three kinds and blank ones, made of the events table's rows."""
    e = read_table(spark, d, "events", ["event_id", "event_type", "value"])
    i = F.col("event_id")
    line = (F.when(i % 4 == 0, F.concat(F.lit('{"kind": "chat.params", "seq": '), i))
            .when(i % 4 == 1, F.to_json(F.struct(F.concat(F.lit("x."), "event_type").alias("kind"), i.alias("ts_ms"), i.alias("seq"))))
            .when(i % 4 == 2, F.to_json(F.struct(F.lit("message.updated").alias("kind"), i.alias("ts_ms"), i.alias("seq"))))
            .otherwise(F.lit("  ")))
    return e.where(i % 3 == 0).select(line.alias("value"))


# ---- orders / lineitem: sessions = customers, messages = orders ------------

def lineitem_rows(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", epoch_ms("l_shipdate").alias("ship_ms"),
                     "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                     "l_tax", "l_returnflag", "l_linestatus")


def tool_start_events(spark: SparkSession, d: str) -> DataFrame:
    """orders = tool.execute.before; the args object is serialised to JSON."""
    from ..operators.tools import args_json
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                        "o_orderpriority"])
    return o.select(
        _s("o_orderkey").alias("call_id"), epoch_ms("o_orderdate").alias("ts_ms"),
        F.lit(0).cast("bigint").alias("seq"), _s("o_custkey").alias("session_id"),
        _s("o_orderkey").alias("message_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("read"))
        .when(F.col("o_orderstatus") == "O", F.lit("grep")).otherwise(F.lit("bash")).alias("tool"),
        model_for("o_custkey").alias("model_id"),
        args_json(F.struct(F.col("o_orderpriority").alias("priority"))).alias("input_json"))


def tool_end_events(spark: SparkSession, d: str) -> DataFrame:
    """lineitem = tool.execute.after; the hook's metadata JSON says truncated
    (JSON true) for returned items, the string "true" for accepted ones."""
    from ..operators.tools import truncated_from_metadata
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity",
                                           "l_returnflag", "l_linestatus"])
    flag = (F.when(F.col("l_returnflag") == "R", F.lit("true"))
            .when(F.col("l_returnflag") == "A", F.lit('"true"')).otherwise(F.lit("false")))
    metadata = F.concat(F.lit('{"truncated": '), flag, F.lit("}"))
    failed = F.col("l_quantity") >= 49  # the largest items' ends are errors
    return li.select(
        _s("l_orderkey").alias("call_id"), epoch_ms("l_shipdate").alias("ts_ms"),
        F.col("l_linenumber").cast("bigint").alias("seq"),
        F.when(failed, F.lit("error")).otherwise(F.lit("completed")).alias("status"),
        F.repeat(F.concat("l_returnflag", "l_linestatus"), F.col("l_quantity").cast("int")).alias("output_text"),
        F.lit(None).cast("string").alias("title"), truncated_from_metadata(metadata).alias("truncated"),
        F.when(failed, F.concat(F.lit("failed "), "l_returnflag")).alias("error_text"))


def session_cost_events(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(starts, ends, steps) with message = customer: each order is a tool call
    started at its order date, its lineitems are the call's end events, and
    every order is also a step of the customer's message costing its price.
    At equal timestamps a start precedes ends, which precede steps."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_quantity"])
    starts = o.select(_s("o_orderkey").alias("call_id"), _s("o_custkey").alias("message_id"),
                      epoch_ms("o_orderdate").alias("ts_ms"), F.lit(0).cast("bigint").alias("seq"))
    ends = (li.select(_s("l_orderkey").alias("call_id"), epoch_ms("l_shipdate").alias("ts_ms"),
                      F.col("l_linenumber").cast("bigint").alias("seq"),
                      (F.floor("l_quantity") * 2).alias("output_size_bytes"))
            .groupBy("call_id", "ts_ms", "seq").agg(F.max("output_size_bytes").alias("output_size_bytes")))
    steps = o.select(_s("o_custkey").alias("message_id"), epoch_ms("o_orderdate").alias("ts_ms"),
                     F.lit(100).cast("bigint").alias("seq"), F.col("o_totalprice").alias("cost"))
    return starts, ends, steps


def orders_steps(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])
    return o.select(_s("o_orderkey").alias("message_id"), epoch_ms("o_orderdate").alias("ts_ms"),
                    F.lit(0).cast("bigint").alias("seq"), F.col("o_totalprice").alias("cost"))


# ---- conversations: sessions = messages = conversations ---------------------

def conversation_rows(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "conversations", ["conv_id", "turn", "role", "text"])
    return c.select("conv_id", "turn", "role", "text", _s("conv_id").alias("session_id"),
                    model_for("conv_id").alias("model_id"))


def finished_conversations(spark: SparkSession, d: str) -> DataFrame:
    """Every assistant turn is a finished message whose single text part is
    the turn's text; no rows are collected per conversation."""
    from ..functions.text import response_text
    c = conversation_rows(spark, d).where(F.col("role") == "assistant")
    parts = F.array(F.struct(F.lit("text").alias("type"), F.col("text").alias("text")))
    return c.select(F.concat(_s("conv_id"), F.lit(":"), _s("turn")).alias("message_id"), "session_id", "model_id",
                    response_text(parts).alias("response_text"), F.col("turn").alias("ts_ms"))


def conversation_calls(spark: SparkSession, d: str) -> DataFrame:
    """User and system turns as completed tool calls of the next turn's message."""
    from ..functions.tokens import estimate_tokens
    c = conversation_rows(spark, d).where(F.col("role") != "assistant")
    return c.select(
        F.concat(_s("conv_id"), F.lit(":"), _s("turn")).alias("id"),
        F.concat(_s("conv_id"), F.lit(":"), (F.col("turn") + 1).cast("string")).alias("message_id"),
        "session_id",
        F.when(F.col("text").contains("\n"), F.lit("read")).otherwise(F.lit("grep")).alias("tool"),
        F.lit("completed").alias("status"), F.col("text").alias("output_text"),
        estimate_tokens("text", "model_id").alias("output_estimated_tokens"))


def context_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(snapshots, parts): one context window per conversation, one part per turn.
    user -> tool part (text is its output), assistant -> text part, system -> other."""
    c = conversation_rows(spark, d)
    snaps = (c.groupBy("conv_id", "session_id", "model_id")
             .agg(F.count(F.lit(1)).alias("message_count"))
             .select(F.col("conv_id").alias("snapshot_key"), _s("conv_id").alias("id"), "session_id",
                     F.col("conv_id").alias("ts_ms"), F.lit(0).cast("bigint").alias("seq"),
                     "message_count", "model_id", (F.col("conv_id") + 1000).cast("bigint").alias("context_limit")))
    parts = c.select(F.col("conv_id").alias("snapshot_key"),
                     F.when(F.col("role") == "user", F.lit("tool"))
                     .when(F.col("role") == "assistant", F.lit("text")).otherwise(F.lit("reasoning")).alias("part_type"),
                     F.when(F.col("role") == "assistant", F.col("text")).alias("text"),
                     F.when(F.col("role") == "user", F.col("text")).alias("tool_output"))
    return snaps, parts


def nested_windows(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(windows, params): a system turn is a chat.params event of its conversation, any other
    turn a context window of two nested messages: the turn's text, and a tool part whose output
    is the role (a user turn) or nothing. Windows of turns divisible by 5 are empty."""
    c = conversation_rows(spark, d).select("*", F.col("turn").cast("bigint").alias("at"))
    key = F.concat("session_id", F.lit(":"), _s("turn"))
    params = c.where(F.col("role") == "system").select(
        key.alias("id"), "session_id", F.col("at").alias("ts_ms"), F.lit(0).cast("bigint").alias("seq"), "model_id",
        (F.octet_length("text") + 100).cast("bigint").alias("context_limit"))
    none = F.lit(None).cast("string")

    def part(kind: str, text: Column, output: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), text.alias("text"), F.struct(output.alias("output")).alias("state"))

    said = F.struct(F.array(part("text", F.col("text"), none)).alias("parts"))
    tool = F.struct(F.array(part("tool", none, F.when(F.col("role") == "user", F.col("role"))),
                            part("reasoning", F.lit("thinking"), none)).alias("parts"))
    windows = c.where(F.col("role") != "system").select(
        key.alias("snapshot_key"), "session_id", F.col("at").alias("ts_ms"), F.lit(0).cast("bigint").alias("seq"),
        F.when(F.col("at") % 5 == 0, F.array().cast("array<struct<parts:array<struct<type:string,text:string,"
                                                    "state:struct<output:string>>>>>"))
        .otherwise(F.array(said, tool)).alias("messages"))
    return windows, params


# ---- documents ---------------------------------------------------------------

def documents(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    return raw if raw is not None else read_table(spark, d, "documents", ["doc_id", "text", "lang", "source"])


def system_prompt_events(spark: SparkSession, d: str, raw: DataFrame | None = None) -> DataFrame:
    """Each document is a system-prompt hook call of session = lang."""
    doc = documents(spark, d, raw)
    return doc.select(F.col("lang").alias("session_id"), model_for("doc_id").alias("model_id"),
                      F.col("doc_id").alias("ts_ms"), F.col("doc_id").alias("seq"),
                      F.split(F.col("text"), "\n\n").alias("system"))


def benchmark_requests(spark: SparkSession, d: str) -> DataFrame:
    """Summary requests: every customer as a session, plus a session id
    without any facts for each customer (the empty-session case)."""
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    task = F.concat(F.lit("task-"), _s("c_nationkey"))
    real = c.select(task.alias("task_id"), _s("c_custkey").alias("session_id"),
                    F.lower("c_mktsegment").alias("strategy"))
    empty = c.select(task.alias("task_id"), F.concat(F.lit("-"), _s("c_custkey")).alias("session_id"),
                     F.lit("baseline").alias("strategy"))
    return real.unionByName(empty)
