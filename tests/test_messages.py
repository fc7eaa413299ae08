"""Message operators: timings, estimates, steps, context windows, prompts, chat parameters."""

import math
import random

import pytest

from turnmeter.operators import messages as msg
from helpers import rows

PARTS = "message_id string, session_id string, ts_ms long, seq long, part_type string, tool_status string"
DONE = "message_id string, ts_ms long, seq long"


def replay_timing(parts, done):
    """The timing row of each message after all events, in arrival order."""
    table = {}
    for kind, e in sorted([("p", (p[2], p[3], p)) for p in parts] + [("d", (d[1], d[2], d)) for d in done],
                          key=lambda x: x[1][:2]):
        ts, _, e = e
        row = table.get(e[0])
        if kind == "p":
            row = table.setdefault(e[0], dict(session_id=e[1], request_sent=ts, first_part_received=ts,
                                              first_text_received=None, first_tool_call=None, message_completed=None,
                                              time_to_first_token_ms=None, total_streaming_ms=None))
            field = "first_text_received" if e[4] == "text" else \
                "first_tool_call" if (e[4], e[5]) == ("tool", "pending") else None
            if field and row[field] is None:
                row[field] = ts
        elif row:
            if row["message_completed"] is None:
                row["message_completed"] = ts
            if row["first_text_received"] is not None:
                row["time_to_first_token_ms"] = row["first_text_received"] - row["request_sent"]
            row["total_streaming_ms"] = row["message_completed"] - row["request_sent"]
    return table


@pytest.mark.parametrize("seed", range(4))
def test_timing_equals_a_replay(spark, seed):
    rng, parts, done = random.Random(seed), [], []
    for seq in range(200):
        m, ts = f"verse{rng.randrange(30)}", rng.randrange(500)
        if rng.random() < 0.3:
            done.append((m, ts, seq))
        else:
            kind = rng.choice(["text", "tool", "reasoning", "step-finish"])
            parts.append((m, "song-" + m, ts, seq, kind, rng.choice(["pending", "running"]) if kind == "tool" else None))
    want = replay_timing(parts, done)
    got = msg.streaming_timing(spark.createDataFrame(parts, PARTS), spark.createDataFrame(done, DONE)).collect()
    assert {r.message_id: {k: r[k] for k in want[r.message_id]} for r in got} == want


def test_explicit_updates_fill_each_field_once(spark):
    starts = spark.createDataFrame([("ode", "song", 40, 2), ("ode", "song", 90, 8)], PARTS.partition(", part_type")[0])
    updates = spark.createDataFrame([
        ("ode", "first_text_received", 30, 1),   # before the row exists
        ("ode", "first_part_received", 55, 3), ("ode", "first_part_received", 56, 4),
        ("ode", "message_completed", 70, 5), ("ode", "first_text_received", 75, 6), ("ode", "message_completed", 99, 9),
        ("lost", "message_completed", 1, 0)], "message_id string, field string, ts_ms long, seq long")
    [r] = msg.timing_from_updates(starts, updates).collect()
    assert (r.request_sent, r.first_part_received, r.first_text_received, r.message_completed) == (40, 55, 75, 70)
    assert (r.time_to_first_token_ms, r.total_streaming_ms) == (35, 15)


ASKED = "message_id string, session_id string, model_id string, ts_ms long, seq long"
COUNTS = ", ".join(f"tokens_{k} long" for k in ("input", "output", "reasoning", "cache_read", "cache_write"))


def test_estimates_are_unique_per_approach(spark):
    asked = spark.createDataFrame([("ode", "song", "kimi-k2", 3, 1), ("lay", "song", None, 4, 2)], ASKED)
    finished = spark.createDataFrame([("ode", "song", "kimi-k2", 9, 6, 100, 40, 3, 20, 1, 0.25),
                                      ("ode", "song", "kimi-k2", 9, 5, 7, 7, 7, 7, 7, 9.0)], f"{ASKED}, {COUNTS}, cost double")
    got = rows(msg.token_estimates(asked, finished), "message_id", "approach", "total_tokens", "estimated_cost", "timestamp")
    assert got == [("lay", "char-ratio", 0, 0.0, 4), ("ode", "char-ratio", 0, 0.0, 3), ("ode", "opencode", 164, 0.25, 9)]


def test_finished_messages_are_the_assistants_with_a_reason(spark):
    df = spark.createDataFrame([(1, "assistant", "stop"), (2, "assistant", ""), (3, "assistant", None), (4, "user", "stop")],
                               "i int, role string, finish string")
    assert rows(msg.finished_messages(df), "i") == [(1,)]


def test_last_write_of_a_step_stays(spark):
    steps = spark.createDataFrame([("bar", "song", "ode", 8, 2, "length", 0.5, 1, 1, 1, 1, 1),
                                   ("bar", "song", "ode", 8, 3, "stop", 0.75, 2, 2, 2, 2, 2),
                                   ("bar", "song", "ode", 6, 9, "tool-calls", 4.0, 3, 3, 3, 3, 3)],
                                  "id string, session_id string, message_id string, ts_ms long, seq long, "
                                  f"reason string, cost double, {COUNTS}")
    assert rows(msg.step_metrics(steps), "id", "reason", "cost", "tokens_cache_write") == [("bar", "stop", 0.75, 2)]


def tokens(text):
    return math.ceil(len(text.encode()) / 3.8) if text else 0


WINDOW = ("snapshot_key long, session_id string, ts_ms long, seq long, messages array<struct<parts:array<struct<"
          "type:string,text:string,state:struct<output:string>>>>>")
PARAMS = "id string, session_id string, ts_ms long, seq long, model_id string, context_limit long"


def test_context_windows(spark):
    """Snapshots take the session's params as they were; empty, homeless and early windows make none."""
    rng = random.Random(4)

    def window():
        kinds = [("text", "chorus " * rng.randrange(9), None), ("tool", None, ("né" * rng.randrange(30),)), ("tool", None, None),
                 ("reasoning", "hm", None), ("text", None, None)]
        return [([rng.choice(kinds) for _ in range(rng.randrange(4))],) for _ in range(rng.randrange(1, 6))]

    params = [("set-a", "song", 10, 1, None, 50), ("set-b", "song", 20, 2, None, None), ("set-c", "hymn", 5, 3, None, 0)]
    windows = [(1, "song", 9, 0, window()),                                     # before any params
               (2, "song", 11, 5, window()), (3, "song", 15, 6, window()),      # both under set-a: the later stays
               (4, "song", 18, 7, []),                                          # empty: no snapshot, takes no place
               (5, "song", 25, 8, window()), (6, "hymn", 30, 9, window()),
               (7, "psalm", 30, 9, window()), (8, "", 31, 10, window()), (9, None, 32, 11, window())]
    base, parts = msg.explode_parts(spark.createDataFrame(windows, WINDOW))
    got = {r.id: r for r in msg.context_snapshots(
        msg.resolve_windows(base, spark.createDataFrame(params, PARAMS)), parts).collect()}
    assert {k: r.timestamp for k, r in got.items()} == {"set-a": 15, "set-b": 25, "set-c": 30}
    for key, at, limit in (("set-a", 2, 50), ("set-b", 4, None), ("set-c", 5, 0)):
        r, said = got[key], [p for m in windows[at][4] for p in m[0]]
        tool = sum(tokens(p[2][0]) for p in said if p[0] == "tool" and p[2])
        text = sum(tokens(p[1]) for p in said if p[0] == "text")
        assert (r.message_count, r.total_parts) == (len(windows[at][4]), len(said))
        assert (r.tool_parts, r.text_parts) == tuple(sum(p[0] == k for p in said) for k in ("tool", "text"))
        assert r.estimated_tokens == tool + text and r.system_token_pct is None
        assert r.tool_output_token_pct == tool / ((tool + text) or 1)
        assert r.conversation_token_pct == text / ((tool + text) or 1)
        assert r.context_utilization == ((tool + text) / limit if limit else None)


def test_snapshots_with_one_id_and_without_messages(spark):
    snaps = spark.createDataFrame([(1, "x", "song", 5, 1, 2, None, 100), (2, "x", "song", 5, 2, 1, None, 100),
                                   (3, "y", "song", 9, 3, 0, None, 100)],
                                  "snapshot_key long, id string, session_id string, ts_ms long, seq long, "
                                  "message_count long, model_id string, context_limit long")
    parts = spark.createDataFrame([(1, "text", "a" * 38, None), (2, "text", "a" * 19, None)],
                                  "snapshot_key long, part_type string, text string, tool_output string")
    assert rows(msg.context_snapshots(snaps, parts), "id", "estimated_tokens") == [("x", 5)]


def test_first_prompt_of_a_session_stays(spark):
    ev = spark.createDataFrame([("song", "kimi-k2", 7, 4, ["sing", "softly"]), ("song", "grok-4", 7, 3, ["sing", "softly"]),
                                ("song", "grok-4", 2, 9, ["sing"]), ("hymn", None, 1, 1, ["sing", "softly"]),
                                ("hymn", None, 1, 2, []), (None, None, 8, 8, ["hum"])],
                               "session_id string, model_id string, ts_ms long, seq long, system array<string>")
    assert rows(msg.system_prompts(ev), "session_id", "model_id", "timestamp", "content") == [
        ("", "unknown", 8, "hum"), ("hymn", "unknown", 1, "sing\n\nsoftly"), ("song", "grok-4", 2, "sing"),
        ("song", "grok-4", 7, "sing\n\nsoftly")]


def test_chat_params_are_flattened(spark):
    schema = ("message_id string, session_id string, ts_ms long, seq long, model struct<id:string, "
              "cost:struct<input:double,output:double,cache:struct<read:double,write:double>>, "
              "limit:struct<context:bigint,output:bigint>>, provider_id string, agent string, temperature double, "
              "top_p double, top_k double, max_output_tokens bigint, options map<string,string>")
    model = ("m-large", (0.5, 0.25, (0.125, 0.0625)), (64_000, 2048))
    asked = spark.createDataFrame([("ode", "song", 4, 2, model, "east", "plan", 0.1, 0.2, 0.3, 7, {"tempo": "slow"}),
                                   ("ode", "song", 4, 1, None, None, None, None, None, None, None, None),
                                   ("lay", "song", 1, 0, model, None, "plan", 0.1, None, None, None, {})], schema)
    got = {r.id: r for r in msg.chat_params_table(asked).collect()}
    r = got["ode"]
    assert (r.cost_input, r.cost_output, r.cost_cache_read, r.cost_cache_write) == (0.5, 0.25, 0.125, 0.0625)
    assert (r.model_context_limit, r.model_output_limit, r.provider_id) == (64_000, 2048, "east")
    assert (r.temperature, r.top_p, r.top_k, r.max_output_tokens, r.options_json) == (0.1, 0.2, 0.3, 7, '{"tempo":"slow"}')
    assert (got["lay"].provider_id, got["lay"].options_json, got["lay"].model_id) == ("", None, "m-large")
