"""Raw events as JSON lines: nothing is lost to damaged lines, and every kind reaches its table."""

import json

from turnmeter.plans import catalog
from turnmeter.sources import bindings as b
from turnmeter.sources import hooks
from turnmeter.streaming import tables
from turnmeter.streaming.twins import stream_dir
from helpers import rows

SF = "/root/testdata/sf0.001"


def event(kind, seq, session="s", **body):
    return json.dumps({"kind": kind, "session_id": session, "ts_ms": 1000 + seq, "seq": seq, **body})


GOOD = [
    event("chat.params", 1, chat_params={"message_id": "m", "model_id": "gpt-4o", "context_limit": 100, "options": {"b": [1, "x"], "a": 2}}),
    event("experimental.chat.system.transform", 2, system={"model_id": "gpt-4o", "system": ["You are", "helpful"]}),
    event("experimental.chat.messages.transform", 3, window={"messages": [{"parts": [
        {"type": "text", "text": "hello"}, {"type": "tool", "state": {"output": "out put"}}]}]}),
    event("tool.execute.before", 4, tool_before={"call_id": "c", "message_id": "m", "tool": "read", "args": {"path": "a.py"}}),
    event("tool.execute.after", 5, tool_after={"call_id": "c", "output": "some line of output", "metadata": {"truncated": True}}),
    event("message.part.updated", 6, part={"message_id": "m", "type": "text"}),
    event("message.part.updated", 7, part={"message_id": "m", "type": "step-finish", "step_id": "st", "cost": 2.5, "tokens": {"input": 3}}),
    event("message.updated", 8, message={"message_id": "m", "role": "assistant", "finish": "stop", "cost": 1.0, "tokens": {"input": 3},
                                         "parts": [{"type": "text", "text": "some line of output\nmore"}]}),
    event("session.idle", 9),
]
BAD = [('{"kind": "chat.par', "damaged"), ("no json", "damaged"), ("[1, 2]", "damaged"),
       (event("message.updated", 10, message="text"), "damaged"), ('{"kind": "session.idle", "ts_ms": "soon", "seq": 3}', "damaged"),
       ('{"kind": "session.idle"}', "incomplete"), ('{"ts_ms": 1, "seq": 2}', "incomplete"),
       (event("message.updated", 11), "incomplete"), (event("host.other", 12), "unknown kind")]


def test_every_kind_reaches_its_table(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    lines = [x for pair in zip(GOOD, [bad for bad, _ in BAD]) for x in pair] + ["", "   "]
    (path / "events.jsonl").write_text("\n".join(lines))
    events, quarantine = hooks.read_events(spark, str(path))
    assert rows(quarantine, "line", "reason") == sorted(BAD)
    assert all(r.file.endswith("events.jsonl") for r in quarantine.collect())
    assert sorted(r.seq for r in events.collect()) == list(range(1, 10))
    t = {name: df.collect() for name, df in hooks.telemetry(events).items()}
    assert {n: len(r) for n, r in t.items()} == {
        "chat_params": 1, "system_prompts": 1, "context_snapshots": 1, "tool_calls": 1, "tool_cost_shares": 1,
        "tool_latency_breakdown": 1, "step_metrics": 1, "streaming_timing": 1, "token_estimates": 2, "retrieval_relevance": 1}
    assert json.loads(t["chat_params"][0].options_json) == {"b": [1, "x"], "a": 2}
    assert t["system_prompts"][0].content == "You are\n\nhelpful" and t["context_snapshots"][0].total_parts == 2
    assert t["tool_cost_shares"][0].cost_share == 2.5 and t["tool_calls"][0].truncated
    assert t["retrieval_relevance"][0].referenced_lines == 1 and t["streaming_timing"][0].time_to_first_token_ms == 0


def test_lines_give_the_events_that_were_written(spark, tmp_path):
    for binding in (b.raw_events, b.raw_requests, b.raw_prompts, b.raw_windows):
        raw, path = binding(spark, SF), str(tmp_path / binding.__name__)
        hooks.write_events(raw, path)
        events, quarantine = hooks.read_events(spark, path)
        assert quarantine.count() == 0
        assert rows(events, "kind", "session_id", "ts_ms", "seq") == rows(raw, "kind", "session_id", "ts_ms", "seq")


def test_stream_of_lines(spark, tmp_path):
    """Damaged lines of a stream go to their own table, once, and the others to theirs."""
    path, base = tmp_path / "in", stream_dir(spark, "lines")
    path.mkdir()
    (path / "a.jsonl").write_text("\n".join(GOOD[:4] + [BAD[0][0]]))

    def run():
        lines = spark.readStream.text(str(path))
        return tables.raw_tables(lines, base)
    run()
    (path / "b.jsonl").write_text("\n".join([x for x, _ in BAD[1:]] + GOOD[4:]))
    done = run()
    assert rows(done["quarantine"].read(), "line", "reason") == sorted(BAD)
    events, _ = hooks.read_events(spark, str(path))
    want = hooks.telemetry(events)
    for name in ("chat_params", "system_prompts", "step_metrics", "token_estimates"):
        got = done[name].read()
        assert rows(got, *want[name].columns) == rows(want[name]), name


def test_empty_file(spark, tmp_path):
    (tmp_path / "none.jsonl").write_text("")
    events, quarantine = hooks.read_events(spark, str(tmp_path))
    assert events.collect() == [] and quarantine.collect() == []
    assert set(catalog.QUERIES) >= {f"raw_{t}" for t in hooks.telemetry(events)}


def test_lines_are_parsed_once_however_often_a_table_reads_them(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "events.jsonl").write_text("\n".join(GOOD))
    events, _ = hooks.read_events(spark, str(path))
    for name in hooks.TABLES:
        once = hooks.parsed_once(events, name)
        df = hooks.telemetry(once, [name])[name]
        assert rows(df) == rows(hooks.telemetry(events, [name])[name])
        if name in ("context_snapshots", "tool_cost_shares", "tool_latency_breakdown"):
            assert "from_json" not in df._jdf.queryExecution().optimizedPlan().toString()
    # the filters on what was parsed do not parse again
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
