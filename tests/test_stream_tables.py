"""Streams that keep their tables: equal to the batch operators however events are cut into micro-batches,
across restarts, with state that ends when it should."""

import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from turnmeter.operators import messages as msg
from turnmeter.operators import tools
from turnmeter.plans import catalog
from turnmeter.streaming import state, tables
from turnmeter.streaming.twins import stream_dir
from helpers import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def split_events(spark, tmp_path_factory):
    """The events table as 3 files in arrival order."""
    d = str(tmp_path_factory.mktemp("events_split"))
    ev = spark.read.parquet(os.path.join(SF, "events.parquet"))
    lo, hi = ev.approxQuantile("event_id", [0.3, 0.7], 0.0)
    for part in (ev.where(F.col("event_id") <= lo), ev.where((F.col("event_id") > lo) & (F.col("event_id") <= hi)),
                 ev.where(F.col("event_id") > hi)):
        part.coalesce(1).write.mode("append").parquet(os.path.join(d, "events.parquet"))
        time.sleep(1.1)  # distinct modification times keep the file order
    return d


@pytest.mark.parametrize("name", sorted(set(tables.TABLE_QUERIES) - {"table_system_prompts"}))
def test_equal_to_batch_over_three_batches(spark, split_events, name):
    query = tables.TABLE_QUERIES[name]
    want = catalog.QUERIES[query.batch_twin](spark, SF)
    assert rows(query(spark, split_events, 1), *want.columns) == rows(want)


class Feed:
    """A folder of files that a stream reads one by one; each ``add`` is a file."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema

    def add(self, data):
        self.spark.createDataFrame(data, self.schema).coalesce(1).write.mode("append").parquet(self.path)
        time.sleep(1.1)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)

    def all(self):
        return self.spark.read.schema(self.schema).parquet(self.path)


HOOK = "call_id string, session_id string, kind string, ts_ms long, seq long"


def progress(run):
    """Run ``run(follow)`` and collect the progress of the streams that it followed."""
    seen, follow = [], tables.follow

    def watched(*args, **kwargs):
        seen.append(follow(*args, **kwargs))
        return seen[-1]
    tables.follow = watched
    try:
        out = run()
    finally:
        tables.follow = follow
    return out, [p for q in seen for p in q.recentProgress]


def test_a_pair_split_by_a_restart(spark, tmp_path):
    """T5: start before, end after the restart; the second run reads new events only, and closed calls leave no state."""
    feed, base = Feed(spark, tmp_path / "in", HOOK), stream_dir(spark, "pairs")
    feed.add([("a", "s", "before", 100, 1), ("b", "s", "before", 110, 2), ("b", "s", "after", 120, 3), ("c", "s", "after", 130, 4)])
    first = tables.latency_table(feed.stream(), base)
    assert rows(first.read(), "tool_call_id", "duration_ms") == [("b", 10)]
    feed.add([("a", "s", "after", 250, 5), ("a", "s", "after", 260, 6), ("c", "s", "before", 270, 7)])
    feed.add([("c", "s", "before", 300, 8), ("c", "s", "after", 310, 9), (None, "s", "before", 1, 1), (None, "s", "after", 5, 2)])
    second, seen = progress(lambda: tables.latency_table(feed.stream(), base))
    assert rows(second.read()) == rows(tools.tool_latency_total(feed.all()))
    assert sum(p["numInputRows"] for p in seen) == 7
    assert [p for p in seen if p["stateOperators"]][-1]["stateOperators"][0]["numRowsTotal"] == 0


def test_a_call_that_outlives_its_time(spark, tmp_path):
    """The start has expired when the end comes."""
    feed, base = Feed(spark, tmp_path / "in", HOOK), stream_dir(spark, "expired")
    feed.add([("a", "s", "before", 100, 1)])
    state.use_rocksdb(spark)
    table = tables.AppendTable(spark, os.path.join(base, "t"), state.LATENCY)
    for data in (None, [("a", "s", "after", 200, 2)]):
        if data:
            time.sleep(1)
            feed.add(data)
        tables.follow(state.pair_calls(feed.stream(), ttl_ms=500), base, table.sink(lambda x: x, "w"))
    assert table.read().collect() == []


PARAM = "id string, session_id string, ts_ms long, seq long, model_id string, context_limit long"
EVENT = "event_id long, session_id string, event_type string, ts_ms long, seq long, model_id string, context_limit long"


def test_cold_start_from_a_stored_table(spark, tmp_path):
    """A stream that begins late knows the params of before from a table, and late params change nothing."""
    stored = spark.createDataFrame([("p1", "s", 10, 1, "m1", 5), ("p2", "s", 20, 2, "m2", None), ("p3", "t", 5, 3, "m3", 7)], PARAM)
    feed = Feed(spark, tmp_path / "in", EVENT)
    feed.add([(11, "s", "view", 30, 11, None, None), (12, "t", "signup", 31, 12, "m4", 9), (13, "t", "view", 32, 13, None, None),
              (14, "u", "view", 33, 14, None, None), (15, "t", "view", 30, 12, None, None)])
    feed.add([(16, "t", "signup", 4, 16, "late", 1), (17, "t", "view", 40, 17, None, None), (18, None, "view", 41, 18, None, None)])

    def parts(df):
        return (df.where("event_type <> 'signup'").select("event_id", "session_id", "event_type", "ts_ms", "seq"),
                df.where("event_type = 'signup'").select(F.col("event_id").cast("string").alias("id"), *PARAM_COLUMNS[1:]))
    got = tables.model_table(*parts(feed.stream()), stream_dir(spark, "cold"), stored).read()
    events, params = parts(feed.all())
    want = tools.latest_params_asof(events, params.unionByName(stored), ["id", "model_id", "context_limit"]).select(
        "event_id", "session_id", "asof.id", "asof.model_id", "asof.context_limit")
    assert rows(got, "event_id", "session_id", "params_id", "model_id", "context_limit") == rows(want)


PARAM_COLUMNS = [c.split(" ")[0] for c in PARAM.split(", ")]


def test_idle_events_clear_a_session(spark, tmp_path):
    """What a session has seen is gone after its idle event; the table keeps its first rows."""
    feed, base = Feed(spark, tmp_path / "in", state.SEEN), stream_dir(spark, "idle")
    feed.add([("s", "m1", 10, 1), ("s", "m1", 11, 2), ("s", "m2", 12, 3), ("t", "m9", 12, 4)])
    feed.add([("s", "m1", 20, 5), ("s", None, 21, 6), ("t", "m9", 22, 7), ("t", None, 23, 8), (None, "m", 24, 9)])
    feed.add([("s", "m1", 30, 10), ("s", "m3", 31, 11), ("s", None, 32, 12), (None, None, 33, 13)])
    table, seen = progress(lambda: tables.firsts_table(feed.stream(), base))
    assert rows(table.read()) == [(None, "m", 24, 9), ("s", "m1", 10, 1), ("s", "m2", 12, 3), ("s", "m3", 31, 11), ("t", "m9", 12, 4)]
    assert [p["stateOperators"][0]["numRowsTotal"] for p in seen if p["stateOperators"]][-1] == 0


def test_a_quiet_session_ends_by_the_watermark(spark, tmp_path):
    """Without an idle event, event time that passes takes the state away."""
    feed, base = Feed(spark, tmp_path / "in", state.SEEN), stream_dir(spark, "quiet")
    hour = 3_600_000
    for data in ([("s", "m1", hour, 1)], [("t", "x", 100 * hour, 2)], [("t", "y", 101 * hour, 3)], [("t", None, 102 * hour, 4)]):
        feed.add(data)
    table, seen = progress(lambda: tables.firsts_table(feed.stream(), base, "1 hour", 2 * hour))
    assert table.read().count() == 3
    assert [p["stateOperators"][0]["numRowsTotal"] for p in seen if p["stateOperators"]][-1] == 0


PROMPT = "session_id string, model_id string, timestamp long, content_hash string, content string, token_count long, seq long"


def test_prompts_once_over_batches_and_restarts(spark, tmp_path):
    """Repeats in a batch, in the next, after a restart, and a late one; nulls are keys."""
    feed, base = Feed(spark, tmp_path / "in", PROMPT), stream_dir(spark, "prompts")

    def prompt(session, content, ts, seq):
        return session, "m", ts, f"h{content}", content, 1, seq
    feed.add([prompt("s", "A", 5, 2), prompt("s", "A", 4, 1), prompt("s", "B", 6, 3), prompt(None, "A", 7, 4)])
    feed.add([prompt("s", "A", 8, 5), prompt("t", "A", 9, 6), prompt("s", "B", 1, 0)])
    tables.prompt_table(feed.stream(), base)
    feed.add([prompt("s", "B", 20, 7), prompt("s", "C", 21, 8), prompt(None, "A", 22, 9)])
    table = tables.prompt_table(feed.stream(), base)
    assert rows(table.read(), "session_id", "content", "timestamp") == [
        (None, "A", 7), ("s", "A", 4), ("s", "B", 6), ("s", "C", 21), ("t", "A", 9)]


RAW = "kind string, session_id string, call_id string, message_id string, bytes long, cost double, ts_ms long, seq long"


def test_cost_shares_with_restarts(spark, tmp_path):
    """A step sees the calls as they are when it comes, in whatever batch."""
    feed = Feed(spark, tmp_path / "in", RAW)
    feed.add([("start", "s", "c1", "m", None, None, 1, 1), ("start", "s", "c2", "m", None, None, 2, 2),
              ("end", "s", "c1", None, 30, None, 3, 3), ("step", "s", None, "m", None, 1.0, 4, 4)])
    feed.add([("end", "s", "c2", None, 10, None, 5, 5), ("step", "s", None, "m", None, 0.0, 6, 6),
              ("start", "s", "c3", "m", None, None, 6, 7), ("end", "s", "c9", None, 10, None, 6, 8)])
    feed.add([("step", "s", None, "m", None, 8.0, 7, 9), ("start", "s", "c1", "other", None, None, 8, 10),
              ("start", "t", "d1", "z", None, None, 9, 11), ("end", "t", "d1", None, 0, None, 10, 12), ("step", "t", None, "z", None, 3.0, 11, 13)])

    def parts(df):
        return (df.where("kind = 'start'").select("session_id", "call_id", "message_id", "ts_ms", "seq"),
                df.where("kind = 'end'").select("session_id", "call_id", "ts_ms", "seq", F.col("bytes").alias("output_size_bytes")),
                df.where("kind = 'step'").select("session_id", "message_id", "ts_ms", "seq", "cost"))
    got = tables.share_table(*parts(feed.stream()), stream_dir(spark, "shares")).read()
    want = tools.cost_shares_asof(*[x.drop("session_id") for x in parts(feed.all())])
    assert rows(got, "call_id", "message_id", "cost_share") == rows(want) == [
        ("c1", "other", None), ("c2", "m", 2.0), ("c3", "m", None), ("d1", "z", 3.0)]


def test_timing_rows_merge_in_any_cut(spark):
    """The batch operator's rows, whether events come at once or one by one."""
    events = [("m", "s", 10, 1, "step-start", None, False), ("m", "s", 12, 2, "text", None, False), ("m", None, 15, 3, None, None, True),
              ("m", "s", 16, 4, "tool", "pending", False), ("m", None, 20, 5, None, None, True), ("n", None, 5, 6, None, None, True),
              ("n", "s", 7, 7, "tool", "running", False), ("n", "s", 8, 8, "text", None, False), ("o", None, 9, 9, None, None, True)]
    schema = "message_id string, session_id string, ts_ms long, seq long, part_type string, tool_status string, done boolean"
    whole = spark.createDataFrame(events, schema)
    want = rows(msg.streaming_timing(whole.where("NOT done").drop("done"), whole.where("done").select("message_id", "ts_ms", "seq")))
    for cut in ([9], [3, 6], [1, 2, 4, 5, 8]):
        states = spark.createDataFrame([], msg.TIMING_STATE)
        for lo, hi in zip([0, *cut], [*cut, 9]):
            if hi > lo:
                states = msg.merge_timing(states, spark.createDataFrame(events[lo:hi], schema))
        assert rows(msg.timing_of_states(states)) == want


class Trips:
    """State of one key in memory, as a map or a value; counts the calls, each of which would be a round trip."""

    def __init__(self):
        self.rows, self.calls = {}, []

    def __getattr__(self, name):
        def call(*args):
            self.calls.append(name)
            if name in ("updateValue", "update"):
                self.rows[args[0] if len(args) > 1 else "value"] = args[-1]
            elif name == "clear":
                self.rows.clear()
            return {"exists": bool(self.rows), "containsKey": args[0] in self.rows if args else None,
                    "get": self.rows.get("value")}.get(name)
        return call


class Handle:
    """A stateful processor's handle over ``Trips``."""

    def __init__(self):
        self.maps, self.values, self.timers = [], [], []

    def getMapState(self, *args):
        self.maps.append(Trips())
        return self.maps[-1]

    def getValueState(self, *args):
        self.values.append(Trips())
        return self.values[-1]

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class NoWatermark:
    def getCurrentWatermarkInMs(self):
        return 0


def test_a_session_asks_its_state_only_for_what_it_may_hold():
    """Items of a session that holds none are not looked up one by one; later ones are, once each."""
    seen, handle = state.SeenOnce(100), Handle()
    seen.init(handle)

    def give(*items):
        part = pd.DataFrame([(i, t, t) for t, i in items], columns=["item", "ts_ms", "seq"])
        return [r for out in seen.handleInputRows(("s",), iter([part.iloc[:2], part.iloc[2:]]), NoWatermark())
                for r in out[["item", "ts_ms"]].itertuples(index=False, name=None)]
    assert give((3, "b"), (1, "a"), (2, "a"), (4, None), (6, "c"), (5, "a")) == [("a", 1), ("b", 3), ("a", 5), ("c", 6)]
    calls = handle.maps[0].calls
    assert "containsKey" not in calls and set(handle.maps[0].rows) == {("a",), ("c",)} and handle.timers == [106]
    assert give((7, "a"), (8, "a"), (9, "d")) == [("d", 9)]
    assert calls.count("containsKey") == 2 and handle.timers == [109]
    assert give((10, None)) == [] and not handle.maps[0].rows and handle.timers == []


def test_many_keys_come_in_one_call():
    """A call answers for all keys of its bucket at once, with the earliest row of each."""
    first, handle = state.FirstOfKey(["session_id", "content_hash"], None, 1000), Handle()
    first.init(handle)

    def give(*rows):
        part = pd.DataFrame(rows, columns=["session_id", "content_hash", "ts_ms", "seq"])
        out = list(first.handleInputRows((0,), iter([part.iloc[:2], part.iloc[2:]]), None))
        assert len(out) <= 1
        return [tuple(r) for o in out for r in o[["content_hash", "ts_ms"]].itertuples(index=False, name=None)]
    many = [(None if i % 2 else "s", f"h{i}", 50 + i, i) for i in range(100)]
    assert give(*many, ("s", "h0", 7, 1)) == [("h0", 7), *[(f"h{i}", 50 + i) for i in range(1, 100)]]
    assert "containsKey" not in handle.maps[0].calls
    assert give(("s", "h0", 1, 1), (None, "h1", 1, 1), ("s", "h1", 300, 1)) == [("h1", 300)]
