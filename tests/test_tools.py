"""Tool-call operators against a plain replay of the same events in arrival order."""

import math
import random

import pytest

from turnmeter.operators import tools
from helpers import rows

START = ("call_id string, ts_ms long, seq long, session_id string, message_id string, tool string, "
         "model_id string, input_json string")
END = ("call_id string, ts_ms long, seq long, status string, output_text string, title string, truncated boolean, "
       "error_text string")


def tokens(text):
    return math.ceil(len(text.encode()) / 3.8) if text else 0


def replay(starts, ends):
    """The table after all events, one row at a time."""
    table = {}
    for kind, e in sorted([("s", s) for s in starts] + [("e", e) for e in ends], key=lambda x: (x[1][1], x[1][2])):
        call, ts = e[0], e[1]
        if kind == "s":
            table[call] = dict(timestamp_start=ts, status="pending", tool=e[5], input_json=e[7], timestamp_end=None,
                               output_text=None, title=None, truncated=False, error_text=None)
        elif call in table:
            table[call].update(timestamp_end=ts, status=e[3], output_text=e[4], title=e[5], truncated=bool(e[6]),
                               error_text=e[7])
    return table


def events(seed, n=150):
    rng, starts, ends = random.Random(seed), [], []
    for seq in range(n):
        call, ts = f"job{rng.randrange(25)}", rng.randrange(40) * 10
        if rng.random() < 0.4:
            starts.append((call, ts, seq, "pier", "m", rng.choice(["glob", "view"]), "", '{"depth":%d}' % seq))
        else:
            bad = rng.random() < 0.3
            ends.append((call, ts, seq, "error" if bad else "completed", rng.choice([None, "", "tide " * rng.randrange(9),
                                                                                    "ø" * 5200]),
                         rng.choice([None, "low water"]), rng.choice([None, True, False]), "aground" if bad else None))
    return starts, ends


@pytest.mark.parametrize("seed", range(4))
def test_tool_calls_equal_a_replay(spark, seed):
    starts, ends = events(seed)
    s, e = spark.createDataFrame(starts, START), spark.createDataFrame(ends, END)
    want = replay(starts, ends)
    got = {r.id: r for r in tools.tool_calls(s, e).collect()}
    assert got.keys() == want.keys()
    for call, w in want.items():
        r, text = got[call], w["output_text"]
        assert all(r[k] == v for k, v in w.items())
        ended = w["timestamp_end"] is not None
        assert r.duration_ms == (w["timestamp_end"] - w["timestamp_start"] if ended else None)
        assert r.input_size_bytes == len(w["input_json"]) and r.input_estimated_tokens == tokens(w["input_json"])
        assert r.output_size_bytes == (None if text is None else len(text.encode()))
        assert r.output_estimated_tokens == (tokens(text) if ended else None) == r.next_turn_token_impact
        assert bool(r.output_compressed) == (text is not None and len(text.encode()) >= 10_240)
    narrow = tools.tool_calls(s, e, with_text=False)
    assert not {"input_json", "output_text", "title", "error_text"} & set(narrow.columns)
    assert rows(narrow) == rows(tools.tool_calls(s, e), *narrow.columns)


def test_an_end_may_have_a_model_of_its_own(spark):
    s = spark.createDataFrame([("job", 1, 1, "pier", "m", "glob", "", "{}")], START)
    e = spark.createDataFrame([("job", 2, 2, "completed", "x" * 400, None, None, None, "claude-3.5")], END + ", model_id string")
    assert tools.tool_calls(s, e).first()["output_estimated_tokens"] != tokens("x" * 400)


@pytest.mark.parametrize("max_rows", [10**6, 30])
def test_latency_pairs_equal_a_replay(spark, max_rows):
    rng, ev = random.Random(5), []
    for seq in range(400):
        call = "busy" if rng.random() < 0.6 else f"job{rng.randrange(6)}"
        ev.append((call, "pier", rng.choice(["before", "after"]), rng.randrange(300), seq))
    open_, want = {}, []
    for call, _, kind, ts, _ in sorted(ev, key=lambda x: (x[3], x[4])):
        if kind == "before":
            open_[call] = ts
        elif call in open_:
            want.append((call, ts - open_.pop(call), ts))
    df = spark.createDataFrame(ev, "call_id string, session_id string, kind string, ts_ms long, seq long")
    got = rows(tools.tool_latency_total(df, max_rows=max_rows), "tool_call_id", "duration_ms", "timestamp")
    assert got == sorted(want, key=lambda t: tuple(map(str, t)))


def test_phases_keep_their_metadata(spark):
    df = spark.createDataFrame([("job", "pier", "rerank", 7, {"top": "9"}, 50), ("job", "pier", "rerank", 7, {"top": "9"}, 50),
                                ("job", "pier", "fetch", 3, None, 51)],
                               "tool_call_id string, session_id string, phase string, duration_ms long, "
                               "metadata map<string,string>, timestamp long")
    assert rows(tools.latency_phases(df), "phase", "duration_ms", "metadata_json") == [
        ("fetch", 3, None), ("rerank", 7, '{"top":"9"}'), ("rerank", 7, '{"top":"9"}')]


@pytest.mark.parametrize("max_rows", [10**6, 20])
def test_asof_equals_a_replay(spark, max_rows):
    rng, ev, params = random.Random(6), [], []
    for seq in range(300):
        session = "busy" if rng.random() < 0.7 else f"bay{rng.randrange(4)}"
        if rng.random() < 0.2:
            params.append((f"set{seq}", session, rng.randrange(100), seq, rng.choice(["kimi", None])))
        else:
            ev.append((seq, session, rng.randrange(100), seq))
    want = []
    for i, session, ts, seq in ev:
        known = [(p[2], p[3], p[0], p[4]) for p in params if p[1] == session and (p[2], p[3]) <= (ts, seq)]
        want.append((i, *(max(known)[2:] if known else (None, None))))
    out = tools.latest_params_asof(
        spark.createDataFrame(ev, "event_id long, session_id string, ts_ms long, seq long"),
        spark.createDataFrame(params, "id string, session_id string, ts_ms long, seq long, model_id string"),
        ["id", "model_id"], max_rows=max_rows).selectExpr("event_id", "asof.id AS pid", "asof.model_id AS model")
    assert rows(out) == sorted(want, key=lambda t: tuple(map(str, t)))


CALLS = "call_id string, message_id string, status string, output_size_bytes long"
STEPS = "message_id string, ts_ms long, seq long, cost double"


def test_cost_shares_follow_bytes_or_split_evenly(spark):
    calls = spark.createDataFrame([("p", "north", "completed", 1), ("q", "north", "completed", 7), ("r", "north", "error", 5),
                                   ("s", "south", "completed", None), ("t", "south", "completed", 0),
                                   ("u", "south", "completed", None), ("v", "west", "completed", 9)], CALLS)
    steps = spark.createDataFrame([("north", 1, 1, 9.0), ("north", 3, 2, 4.0), ("north", 4, 3, 0.0), ("south", 2, 1, 6.0),
                                   ("west", 2, 2, -1.0)], STEPS)
    got = dict(rows(tools.cost_shares(calls, steps), "call_id", "cost_share"))
    assert got == {"p": 0.5, "q": 3.5, "r": None, "s": 2.0, "t": 2.0, "u": 2.0, "v": None}


def replay_shares(starts, ends, steps):
    """Shares written at every positive-cost step, rows reset by every start."""
    table = {}
    order = [("s", x) for x in starts] + [("e", x) for x in ends] + [("c", x) for x in steps]
    at = {"s": (2, 3), "e": (1, 2), "c": (1, 2)}
    for kind, x in sorted(order, key=lambda o: tuple(o[1][i] for i in at[o[0]])):
        if kind == "s":
            table[x[0]] = dict(message=x[1], bytes=None, done=False, share=None)
        elif kind == "e":
            if x[0] in table:
                table[x[0]].update(done=True, bytes=x[3])
        elif x[3] > 0:
            done = [c for c in table.values() if c["message"] == x[0] and c["done"]]
            total = sum(c["bytes"] or 0 for c in done)
            for c in done:
                c["share"] = x[3] / len(done) if total == 0 else (c["bytes"] or 0) / total * x[3]
    return table


@pytest.mark.parametrize("seed, max_rows", [(1, 10**6), (2, 10**6), (3, 15)])
def test_cost_shares_asof_equal_a_replay(spark, seed, max_rows):
    rng, starts, ends, steps = random.Random(seed), [], [], []
    times = rng.sample(range(10_000), 400)
    for seq, ts in enumerate(times):
        call = "busy" if rng.random() < 0.3 else f"job{rng.randrange(40)}"
        kind = rng.random()
        if kind < 0.35:
            starts.append((call, f"turn{rng.randrange(8)}", ts, seq))
        elif kind < 0.8:
            ends.append((call, ts, seq, rng.choice([None, 0, rng.randrange(500)])))
        else:
            steps.append((f"turn{rng.randrange(8)}", ts, seq, rng.choice([0.0, rng.randrange(1, 99) / 8])))
    # only the last step of a message counts, so that earlier ones leave no share behind
    last = {}
    for s in sorted(steps, key=lambda s: (s[1], s[2])):
        if s[3] > 0:
            last[s[0]] = s
    want = replay_shares(starts, ends, list(last.values()))
    out = tools.cost_shares_asof(
        spark.createDataFrame(starts, "call_id string, message_id string, ts_ms long, seq long"),
        spark.createDataFrame(ends, "call_id string, ts_ms long, seq long, output_size_bytes long"),
        spark.createDataFrame(steps, STEPS), max_rows=max_rows)
    got = {r.call_id: (r.message_id, r.cost_share) for r in out.collect()}
    assert got.keys() == want.keys()
    for call, (message, share) in got.items():
        assert message == want[call]["message"]
        assert share == (None if want[call]["share"] is None else pytest.approx(want[call]["share"]))


def test_only_a_json_true_is_truncated(spark):
    texts = ['{"truncated":true}', '{"a":1,"truncated": true }', '{"truncated":"true"}', '{"truncated":1}',
             '{"truncated":false}', '{"truncated":{"x":true}}', '{"other":true}', "[true]", "true", "{true", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, m string").coalesce(1)
    got = [r.t for r in df.select("i", tools.truncated_from_metadata("m").alias("t")).orderBy("i").collect()]
    assert got == [True, True] + [False] * 9 + [False]


def test_arguments_become_json(spark):
    df = spark.createDataFrame([({"glob": "*.nc", "depth": "3"},)], "a map<string,string>")
    assert df.select(tools.args_json("a").alias("j")).first()["j"] == '{"glob":"*.nc","depth":"3"}'
