"""Summary rows against plain Python over random facts; percentiles against sorting."""

import math
import random

import pytest

from turnmeter.operators import summary as sm

FACTS = {
    "steps": "session_id string, tokens_input long, tokens_output long, cost double",
    "calls": "session_id string, status string, output_estimated_tokens long, duration_ms long",
    "relevance": "session_id string, referenced_tokens long, relevance_ratio double",
    "timing": "session_id string, request_sent long, message_completed long, time_to_first_token_ms long",
    "latency": "session_id string, phase string, duration_ms long",
}
SESSIONS = ["fjord", "delta", "lagoon", "nothing"]


def facts(seed):
    rng = random.Random(seed)
    n = lambda top: rng.randrange(top)
    out = {k: [] for k in FACTS}
    for s in SESSIONS[:3]:
        out["steps"] += [(s, n(900), n(90), n(1000) / 1024) for _ in range(n(6))]
        out["calls"] += [(s, rng.choice(["completed", "pending", "error"]), rng.choice([None, n(700)]), n(5000))
                         for _ in range(n(8))]
        out["relevance"] += [(s, n(400), n(64) / 64) for _ in range(n(5))]
        out["timing"] += [(s, a := n(9000), rng.choice([None, a + n(3000)]), rng.choice([None, n(500)])) for _ in range(n(5))]
        out["latency"] += [(s, rng.choice(["total", "total", "embedding"]), n(4000)) for _ in range(n(30))]
    return out


def mean(values):
    return sum(values) / len(values) if values else None


def rounded(x):
    return None if x is None else math.floor(x + 0.5)


def rank(values, p):
    return sorted(values)[max(0, math.ceil(p * len(values) / 100) - 1)] if values else None


def expected(f, s):
    of = {k: [r[1:] for r in rows if r[0] == s] for k, rows in f.items()}
    done = [r for r in of["calls"] if r[0] == "completed"]
    fetched, referenced = sum(r[1] or 0 for r in done), sum(r[0] for r in of["relevance"])
    ended = [r[1] for r in of["timing"] if r[1] is not None]
    total = [d for phase, d in of["latency"] if phase == "total"]
    return dict(
        total_input_tokens=sum(r[0] for r in of["steps"]), total_output_tokens=sum(r[1] for r in of["steps"]),
        total_cost=sum(r[2] for r in of["steps"]), total_tool_calls=len(done),
        total_fetched_tokens=fetched or None, total_referenced_tokens=referenced or None,
        precision_score=min(1, referenced / fetched) if fetched else None,
        avg_relevance=mean([r[1] for r in of["relevance"]]),
        avg_ttft_ms=rounded(mean([r[2] for r in of["timing"] if r[2] is not None])),
        avg_tool_duration_ms=rounded(mean([r[2] for r in done])),
        total_session_ms=max(ended) - min(r[0] for r in of["timing"]) if ended else None,
        avg_query_ms=rounded(mean(total)), p50_query_ms=rank(total, 50), p95_query_ms=rank(total, 95))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_summary_equals_the_model(spark, seed):
    f = facts(seed)
    tables = {k: spark.createDataFrame(rows, FACTS[k]) for k, rows in f.items()}
    asked = spark.createDataFrame([(f"job-{i}", s, "plain") for i, s in enumerate(SESSIONS)] + [("again", "delta", "other")],
                                  "task_id string, session_id string, strategy string")
    got = sm.benchmark_runs(asked, tables["steps"], tables["calls"], tables["relevance"], tables["timing"],
                            tables["latency"]).collect()
    assert len(got) == 5
    for r in got:
        for name, want in expected(f, r.session_id).items():
            assert r[name] == (want if want is None else pytest.approx(want)), (r.session_id, name)


@pytest.mark.parametrize("n, top", [(1, 5), (2, 5), (19, 7), (20, 1000), (400, 40), (400, 10**9)])
def test_nearest_rank_equals_sorting(spark, n, top):
    rng = random.Random(n * top)
    groups = {k: [rng.randrange(-top // 4, top) for _ in range(n + i)] for i, k in enumerate(["x", "y", None])}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in [*vs, None]], "k string, v long")
    got = sm.nearest_rank(df, ["k"], "v", {"low": 0.05, "mid": 0.5, "high": 0.95})
    assert {r.k: (r.low, r.mid, r.high) for r in got.collect()} == {
        k: tuple(rank(vs, p) for p in (5, 50, 95)) for k, vs in groups.items()}


def test_a_hot_session_is_ranked_in_parts(spark):
    """One session, all durations distinct: the windows run over ranges, not over the session."""
    df = spark.range(20_000).selectExpr("'hot' AS k", "id + 1 AS v")
    got = sm.nearest_rank(df, ["k"], "v", {"p": 0.5})
    assert got.first()["p"] == 10_000
    codes = df.select(sm._value_range(df["v"]).alias("r")).groupBy("r").count().collect()
    assert max(r["count"] for r in codes) < 0.06 * 20_000
