"""From raw hook and stream events to the telemetry tables, for all sessions at once.

A raw event has its kind, its session, its place in the arrival order (``ts_ms``,
``seq``) and one filled struct, that of its kind. Hosts write them as JSON lines:
``read_events`` (or ``parse_events`` over a stream of lines) reads those under one
schema and sets aside lines that are no events, with the reason, so that a
damaged line costs no other (S1). ``telemetry`` routes the kinds (S2) and
derives every table with the batch operators; the model that sizes a tool
call's input is the session's latest at the call's start, the one that sizes its
output the latest at its end (J3 feeding J1).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..operators import messages as msg
from ..operators import relevance as rel
from ..operators import tools
from ..session import shared_table
from .tables import route

TOKENS = "struct<input:bigint,output:bigint,reasoning:bigint,cache_read:bigint,cache_write:bigint>"

#: Raw events: the columns of every event, and one struct per kind.
RAW_SCHEMA = f"""kind string, session_id string, ts_ms bigint, seq bigint,
chat_params struct<message_id:string,model_id:string,context_limit:bigint,output_limit:bigint,provider_id:string,agent:string,
temperature:double,top_p:double,top_k:double,max_output_tokens:bigint,
cost:struct<input:double,output:double,cache_read:double,cache_write:double>,options:string>,
system struct<model_id:string,system:array<string>>,
window struct<messages:array<struct<parts:array<struct<type:string,text:string,state:struct<output:string>>>>>>,
tool_before struct<call_id:string,message_id:string,tool:string,args:map<string,string>>,
tool_after struct<call_id:string,output:string,title:string,metadata:map<string,boolean>,error:string>,
part struct<message_id:string,type:string,status:string,step_id:string,reason:string,cost:double,tokens:{TOKENS}>,
message struct<message_id:string,role:string,finish:string,model_id:string,cost:double,tokens:{TOKENS},
parts:array<struct<type:string,text:string>>>"""

#: The struct that an event of each kind fills; an idle event has none.
BODIES = {
    "chat.params": "chat_params",
    "experimental.chat.system.transform": "system",
    "experimental.chat.messages.transform": "window",
    "tool.execute.before": "tool_before",
    "tool.execute.after": "tool_after",
    "message.part.updated": "part",
    "message.updated": "message",
    "session.idle": None,
}
KINDS = tuple(BODIES)


def parse_events(lines: DataFrame, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """(events, quarantine) of JSON lines, batch or stream.

    Events have the columns of ``RAW_SCHEMA``; quarantine has line, reason and what other columns ``lines`` has.
    A line is set aside if it is no JSON object, has a field of another type ('damaged'), if it lacks its kind, its place in the
    order or its body ('incomplete'), or if its kind is not one of ``KINDS`` ('unknown kind'). Blank lines are none;
    fields that the schema does not name are ignored.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_damaged"}
    read = F.from_json(F.col(line), f"{RAW_SCHEMA}, _damaged string", options)
    # a row of its own: as a plain column, the parser would run once for every use of it
    parsed = lines.where(F.trim(F.col(line)) != "").select("*", F.explode(F.array(read)).alias("_e"))
    e = F.col("_e")
    body = F.lit(False)
    for kind, name in BODIES.items():
        body = body | ((e["kind"] == kind) & (e[name].isNotNull() if name else F.lit(True)))
    reason = (F.when(e.isNull() | e["_damaged"].isNotNull(), F.lit("damaged"))
              .when(e["kind"].isNull() | e["ts_ms"].isNull() | e["seq"].isNull(), F.lit("incomplete"))
              .when(~e["kind"].isin(*KINDS), F.lit("unknown kind")).when(~body, F.lit("incomplete")))
    parsed = parsed.withColumn("_reason", reason)
    others = [c for c in lines.columns if c != line]
    return (parsed.where("_reason IS NULL").select("_e.*").drop("_damaged"),
            parsed.where("_reason IS NOT NULL").select(F.col(line).alias("line"), F.col("_reason").alias("reason"), *others))


def read_events(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(events, quarantine) of the JSON lines under ``path``; quarantined lines name their file."""
    return parse_events(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")))


def write_events(raw: DataFrame, path: str) -> None:
    """Raw events as JSON lines."""
    raw.select(F.to_json(F.struct(*raw.columns)).alias("value")).write.mode("append").text(path)


def complete(raw: DataFrame) -> DataFrame:
    """``raw`` with all columns and struct fields of ``RAW_SCHEMA``, null where it has none."""
    have, out = raw.schema, []
    for field in T.StructType.fromDDL(RAW_SCHEMA):
        if field.name not in have.names:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif isinstance(field.dataType, T.StructType):
            own, column = have[field.name].dataType.names, F.col(field.name)
            filled = F.struct(*[(column[f.name] if f.name in own else F.lit(None)).cast(f.dataType).alias(f.name)
                                for f in field.dataType])
            out.append(F.when(column.isNotNull(), filled).alias(field.name))
        else:
            out.append(F.col(field.name))
    return raw.select(*out)


def _tokens(column: str) -> list:
    return [F.col(f"{column}.tokens.{k}").alias(f"tokens_{k}")
            for k in ("input", "output", "reasoning", "cache_read", "cache_write")]


def chat_params(raw: DataFrame) -> DataFrame:
    """Chat params events: id, session, model and context limit."""
    return route(raw, "kind", ["chat.params"])["chat.params"].select(
        F.col("chat_params.message_id").alias("id"), "session_id", "ts_ms", "seq", "chat_params.model_id",
        "chat_params.context_limit")


def chat_requests(raw: DataFrame) -> DataFrame:
    """Chat params events as requests for ``messages.chat_params_table`` (S3)."""
    c = F.col("chat_params")
    cost = c["cost"]
    model = F.struct(c["model_id"].alias("id"), F.struct(
        cost["input"].alias("input"), cost["output"].alias("output"),
        F.struct(cost["cache_read"].alias("read"), cost["cache_write"].alias("write")).alias("cache")).alias("cost"),
        F.struct(c["context_limit"].alias("context"), c["output_limit"].alias("output")).alias("limit"))
    return route(raw, "kind", ["chat.params"])["chat.params"].select(
        "chat_params.message_id", "session_id", "ts_ms", "seq", model.alias("model"), "chat_params.provider_id", "chat_params.agent",
        "chat_params.temperature", "chat_params.top_p", "chat_params.top_k", "chat_params.max_output_tokens", "chat_params.options")


def system_events(raw: DataFrame) -> DataFrame:
    """System prompt events for ``messages.system_prompts``."""
    kind = "experimental.chat.system.transform"
    return route(raw, "kind", [kind])[kind].select("session_id", "system.model_id", "ts_ms", "seq", "system.system")


def snapshots(raw: DataFrame) -> DataFrame:
    """``context_snapshots`` of the context windows, each under its session's latest chat params."""
    kind = "experimental.chat.messages.transform"
    windows = route(raw, "kind", [kind])[kind].select(
        F.struct("session_id", "ts_ms", "seq").alias("snapshot_key"), "session_id", "ts_ms", "seq", "window.messages")
    base, parts = msg.explode_parts(windows)
    return msg.context_snapshots(msg.resolve_windows(base, chat_params(raw)), parts)


def tool_events(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(starts, ends) of tool calls, each under the model that is current when it arrives ('' before any)."""
    kinds = ["tool.execute.before", "tool.execute.after"]
    used = raw.where(F.col("kind").isin(kinds)).select("kind", "session_id", "ts_ms", "seq", "tool_before", "tool_after")
    looked = (tools.latest_params_asof(used, chat_params(raw), ["model_id"])
              .withColumn("model_id", F.coalesce("asof.model_id", F.lit(""))))
    before, after = route(looked, "kind", kinds).values()
    starts = before.select("tool_before.call_id", "ts_ms", "seq", "session_id",
                           F.coalesce("tool_before.message_id", F.lit("")).alias("message_id"), "tool_before.tool",
                           "model_id", tools.args_json("tool_before.args").alias("input_json"))
    ends = after.select("tool_after.call_id", "ts_ms", "seq",
                        F.when(F.col("tool_after.error").isNull(), F.lit("completed")).otherwise(F.lit("error"))
                        .alias("status"),
                        F.coalesce("tool_after.output", F.lit("")).alias("output_text"), "tool_after.title",
                        F.coalesce(F.try_element_at("tool_after.metadata", F.lit("truncated")), F.lit(False)).alias("truncated"),
                        F.col("tool_after.error").alias("error_text"), "model_id")
    return starts, ends


def cost_events(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(starts, completed ends, steps) for cost shares (W1, J5); ends that report an error complete nothing."""
    before, after = route(raw, "kind", ["tool.execute.before", "tool.execute.after"]).values()
    parts = route(raw, "kind", ["message.part.updated"])["message.part.updated"]
    starts = before.select("session_id", "tool_before.call_id", F.coalesce("tool_before.message_id", F.lit("")).alias("message_id"),
                           "ts_ms", "seq")
    ends = after.where("tool_after.error IS NULL").select(
        "session_id", "tool_after.call_id", "ts_ms", "seq",
        F.octet_length(F.coalesce("tool_after.output", F.lit(""))).cast("bigint").alias("output_size_bytes"))
    steps = parts.where("part.type = 'step-finish' AND part.cost > 0").select("session_id", "part.message_id", "ts_ms", "seq", "part.cost")
    return starts, ends, steps


def finished(raw: DataFrame) -> DataFrame:
    """Finished assistant messages (F4) with their response text, its text parts joined."""
    m = route(raw, "kind", ["message.updated"])["message.updated"]
    m = m.select("message.message_id", "session_id", "ts_ms", "seq", "message.role", "message.finish", "message.model_id",
                 "message.cost", *_tokens("message"), tx.response_text("message.parts").alias("response_text"))
    return msg.finished_messages(m)


def step_rows(raw: DataFrame) -> DataFrame:
    """Finished steps for ``messages.step_metrics``."""
    parts = route(raw, "kind", ["message.part.updated"])["message.part.updated"]
    return parts.where(F.col("part.type") == "step-finish").select(
        F.col("part.step_id").alias("id"), "session_id", "part.message_id", "ts_ms", "seq", "part.reason", "part.cost",
        *_tokens("part"))


def asked(raw: DataFrame) -> DataFrame:
    """Chat params events as requests for ``messages.token_estimates``."""
    return chat_params(raw).select(F.col("id").alias("message_id"), "session_id", "model_id", "ts_ms", "seq")


def _hook_pairs(raw: DataFrame) -> DataFrame:
    kinds = F.when(F.col("kind") == "tool.execute.before", F.lit("before")).otherwise(F.lit("after"))
    return raw.where(F.col("kind").isin("tool.execute.before", "tool.execute.after")).select(
        F.coalesce("tool_before.call_id", "tool_after.call_id").alias("call_id"), "session_id", kinds.alias("kind"),
        "ts_ms", "seq")


def _timing(raw: DataFrame) -> DataFrame:
    parts = route(raw, "kind", ["message.part.updated"])["message.part.updated"]
    return msg.streaming_timing(
        parts.select("part.message_id", "session_id", "ts_ms", "seq", F.col("part.type").alias("part_type"),
                     F.col("part.status").alias("tool_status")), finished(raw).select("message_id", "ts_ms", "seq"))


#: Each table as made of raw events.
TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "chat_params": lambda raw: msg.chat_params_table(chat_requests(raw)),
    "system_prompts": lambda raw: msg.system_prompts(system_events(raw)),
    "context_snapshots": snapshots,
    "tool_calls": lambda raw: tools.tool_calls(*tool_events(raw)),
    "tool_cost_shares": lambda raw: tools.cost_shares_asof(*[x.drop("session_id") for x in cost_events(raw)]),
    "tool_latency_breakdown": lambda raw: tools.tool_latency_total(_hook_pairs(raw)),
    "step_metrics": lambda raw: msg.step_metrics(step_rows(raw)),
    "streaming_timing": _timing,
    "token_estimates": lambda raw: msg.token_estimates(asked(raw), finished(raw)),
    "retrieval_relevance": lambda raw: rel.score_tool_calls(finished(raw), tools.tool_calls(*tool_events(raw))),
}


#: Kinds of events that a table reads, for tables that read their events several times.
READ_AGAIN = {
    "context_snapshots": ("experimental.chat.messages.transform", "chat.params"),
    "tool_cost_shares": ("tool.execute.before", "tool.execute.after", "message.part.updated"),
    "tool_latency_breakdown": ("tool.execute.before", "tool.execute.after"),
}


def parsed_once(events: DataFrame, name: str) -> DataFrame:
    """``events`` of ``parse_events`` for the table ``name``: stored, if each of its several reads would parse all lines anew."""
    if name not in READ_AGAIN:
        return events
    kinds = READ_AGAIN[name]
    used = events.where(F.col("kind").isin(*kinds)).select("kind", "session_id", "ts_ms", "seq", *[BODIES[k] for k in kinds])
    return shared_table(used, f"events-{name}")


def telemetry(raw: DataFrame, names: Iterable[str] = tuple(TABLES)) -> dict[str, DataFrame]:
    """The telemetry tables of raw events with columns of ``RAW_SCHEMA``, or those in ``names``."""
    raw = complete(raw)
    return {name: TABLES[name](raw) for name in names}
