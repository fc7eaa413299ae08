"""Streaming twins equal their batch twins when events arrive over many micro-batches."""

import os
import time

import pytest
from pyspark.sql import functions as F

from turnmeter.plans import catalog
from turnmeter.streaming import twins
from helpers import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def split_events(spark, tmp_path_factory):
    """The events table rewritten as 4 files in arrival order (oldest first)."""
    d = str(tmp_path_factory.mktemp("events_split"))
    ev = spark.read.parquet(os.path.join(SF, "events.parquet"))
    bounds = ev.approxQuantile("event_id", [0.25, 0.5, 0.75], 0.0)
    edges = [None, *bounds, None]
    for lo, hi in zip(edges, edges[1:]):
        part = ev
        if lo is not None:
            part = part.where(F.col("event_id") > lo)
        if hi is not None:
            part = part.where(F.col("event_id") <= hi)
        part.coalesce(1).write.mode("append").parquet(os.path.join(d, "events.parquet"))
        time.sleep(1.1)  # distinct modification times keep the file order
    return d


@pytest.mark.parametrize("stream_name,batch_name", [
    ("stream_milestones", "streaming_milestones"),
    ("stream_tool_latency", "tool_latency_total"),
    ("stream_latest_model", "latest_model_asof"),
    ("stream_step_metrics", "step_metrics_upsert"),
    ("stream_token_estimates", "token_estimates"),
])
def test_stream_equals_batch_over_many_batches(spark, split_events, stream_name, batch_name):
    got = twins.STREAM_QUERIES[stream_name](spark, split_events, max_files_per_trigger=1)
    want = catalog.QUERIES[batch_name](spark, SF)
    assert rows(got, *want.columns) == rows(want)


def test_prompt_stream_equals_batch(spark):
    got = twins.STREAM_QUERIES["stream_system_prompts"](spark, SF)
    want = catalog.QUERIES["system_prompt_dedup"](spark, SF)
    assert rows(got, *want.columns) == rows(want)


def test_log_sink_replay_overwrites(spark, tmp_path):
    """A micro-batch written again under the same id (replay after a failure) replaces itself."""
    path = str(tmp_path / "log")
    sink = twins.log_sink(path, lambda x: x)
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    sink(first, 0)
    sink(spark.createDataFrame([("c", 3)], "k string, v long"), 1)
    sink(first, 0)  # replay of batch 0
    log = twins._read_log(spark, path, "k string, v long")
    assert rows(log, "k", "v", "_batch") == [("a", 1, 0), ("b", 2, 0), ("c", 3, 1)]


EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _event_files(spark, folder, batches):
    """Write each batch of (event_id, ms, user, type) as one more file of the events table."""
    import datetime
    for batch in batches:
        data = [(i, datetime.datetime(2024, 1, 1) + datetime.timedelta(milliseconds=ms), user, kind, 3.5, "{}")
                for i, ms, user, kind in batch]
        spark.createDataFrame(data, EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
        time.sleep(1.1)


CLICK, VIEW, SIGNUP = "click", "view", "signup"
#: Two pairs that end within one millisecond, a repeated event id, an event that comes a file late.
BATCHES = [[(1, 100, 7, CLICK), (2, 200, 7, VIEW), (3, 200, 7, CLICK), (4, 200, 7, VIEW), (5, 50, 8, SIGNUP)],
           [(6, 300, 8, VIEW), (6, 300, 8, VIEW), (7, 40, 8, CLICK)],
           [(8, 310, 8, VIEW), (9, 60, 8, SIGNUP), (10, 400, 7, "purchase")]]


@pytest.mark.parametrize("stream_name,batch_name,at_least", [("stream_tool_latency", "tool_latency_total", 3),
                                                             ("stream_latest_model", "latest_model_asof", 9),
                                                             ("stream_milestones", "streaming_milestones", 2)])
def test_repeated_and_late_events_equal_batch(spark, tmp_path, stream_name, batch_name, at_least):
    _event_files(spark, str(tmp_path), BATCHES)
    got = twins.STREAM_QUERIES[stream_name](spark, str(tmp_path), max_files_per_trigger=1)
    want = catalog.QUERIES[batch_name](spark, str(tmp_path))
    assert rows(got, *want.columns) == rows(want) and got.count() >= at_least


def test_a_second_run_goes_on_where_the_first_stopped(spark, tmp_path):
    base = twins.stream_dir(spark, "resumed")
    stream = twins.STREAM_QUERIES["stream_tool_latency"]
    _event_files(spark, str(tmp_path), BATCHES[:1])
    assert stream(spark, str(tmp_path), base=base).count() == 2
    _event_files(spark, str(tmp_path), BATCHES[1:])
    got = stream(spark, str(tmp_path), base=base)
    assert rows(got) == rows(catalog.QUERIES["tool_latency_total"](spark, str(tmp_path)))
    assert spark.read.parquet(f"{base}/hooks").select("_batch").distinct().count() == 2


def test_a_compacted_log_gives_the_same_view(spark, tmp_path):
    path, schema = str(tmp_path / "log"), "k string, t long, v long"
    sink = twins.log_sink(path, lambda x: x)
    for i, data in enumerate([[("a", 1, 1), ("b", 1, 2)], [("a", 2, 3)], [("b", 0, 4)]]):
        sink(spark.createDataFrame(data, schema), i)
    twins.compact_log(spark, path, schema, ["k"], ["t"], str(tmp_path / "compact"))
    assert rows(twins._read_log(spark, str(tmp_path / "compact"), schema)) == [("a", 2, 3, 0), ("b", 1, 2, 0)]
