"""Replay properties: results depend only on (ts, seq), never on input order or
partitioning, and the hot-key-safe scans equal plain per-key windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from turnmeter.operators import sequence, tools
from turnmeter.plans import catalog
from helpers import rows

SF = "/root/testdata/sf0.001"


def _events(spark, n, hot_share, seed):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if rnd.random() < hot_share else f"k{rnd.randrange(20)}"
        ts = rnd.randrange(0, 10 * 86_400_000)
        val = rnd.choice([None, None, f"v{i}"])
        data.append((key, ts, i, val))
    return spark.createDataFrame(data, "key string, ts_ms long, seq long, v string")


@pytest.mark.parametrize("seed,hot,limit", [(1, 0.0, 10**6), (2, 0.34, 100), (3, 0.9, 20)])
def test_carry_equals_plain_window(spark, seed, hot, limit):
    df = _events(spark, 600, hot, seed)
    w = Window.partitionBy("key").orderBy("ts_ms", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("out", F.last("v", ignorenulls=True).over(w))
    got = sequence.carry_last_non_null(df, ["key"], "ts_ms", "seq", "v", "out", max_rows=limit)
    assert rows(got, "key", "seq", "out") == rows(want, "key", "seq", "out")


@pytest.mark.parametrize("seed,hot,limit", [(4, 0.34, 10**6), (5, 0.9, 20)])
def test_previous_row_equals_lag(spark, seed, hot, limit):
    df = _events(spark, 600, hot, seed).withColumn("s", F.struct("seq", "ts_ms"))
    w = Window.partitionBy("key").orderBy("ts_ms", "seq")
    want = df.withColumn("out", F.lag("s").over(w))
    got = sequence.previous_row(df, ["key"], "ts_ms", "seq", "s", "out", max_rows=limit)
    assert rows(got, "key", "seq", "out") == rows(want, "key", "seq", "out")


def test_a_hot_key_within_one_day_is_cut_by_rows(spark):
    """90 % of the rows on one key, within one second: no range holds more than a hundredth of them."""
    df = spark.range(30_000).selectExpr("IF(id % 10 = 0, concat('k', id % 7), 'hot') AS key",
                                        "(id * 7919) % 1000 + 86400000 AS ts_ms", "id AS seq",
                                        "IF(id % 3 = 0, concat('v', id), NULL) AS v")
    cut = sequence._ranges(df, ["key"], "ts_ms", 5_000)
    sizes = {(r.key, r._range): r["count"] for r in cut.groupBy("key", "_range").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert sum(hot) == 27_000 and max(hot) < 270 and all(n == 0 for k, n in sizes if k != "hot")
    w = Window.partitionBy("key").orderBy("ts_ms", "seq").rowsBetween(Window.unboundedPreceding, 0)
    got = sequence.carry_last_non_null(df, ["key"], "ts_ms", "seq", "v", "out", max_rows=5_000)
    want = df.withColumn("out", F.last("v", ignorenulls=True).over(w))
    assert got.select("key", "seq", "out").exceptAll(want.select("key", "seq", "out")).isEmpty()
    assert got.count() == 30_000


def _reshuffle(spark, d, tmp_path, name):
    """Copy a driver table with rows in random order across 5 files."""
    out = str(tmp_path / name)
    spark.read.parquet(f"{d}/{name}.parquet").orderBy(F.rand(7)).repartition(5).write.parquet(
        f"{out}/{name}.parquet")
    return out


@pytest.mark.parametrize("query", ["streaming_milestones", "tool_latency_total", "latest_model_asof",
                                   "token_estimates", "step_metrics_upsert"])
def test_event_queries_ignore_input_order(spark, tmp_path, query):
    d2 = _reshuffle(spark, SF, tmp_path, "events")
    fn = catalog.QUERIES[query]
    assert rows(fn(spark, d2)) == rows(fn(spark, SF))


def test_upsert_ignores_input_order(spark, tmp_path):
    d2 = _reshuffle(spark, SF, tmp_path, "lineitem")
    fn = catalog.QUERIES["tool_calls_upsert"]
    assert rows(fn(spark, d2)) == rows(fn(spark, SF))
    assert tools is not None
