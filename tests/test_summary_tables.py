"""Session summaries that follow stored fact tables: equal to the batch summary after every batch, also when rows are replaced."""

from turnmeter.operators import summary as sm
from turnmeter.sources.store import AppendTable, KeyedTable, last_wins
from turnmeter.streaming.tables import SessionSummary
from turnmeter.streaming.twins import stream_dir
from helpers import rows

STEP = "id string, session_id string, ts long, tokens_input long, tokens_output long, cost double"
CALL = "id string, session_id string, ts long, status string, output_estimated_tokens long, duration_ms long"
REL = "session_id string, referenced_tokens long, relevance_ratio double"
TIME = "message_id string, session_id string, ts long, time_to_first_token_ms long, request_sent long, message_completed long"
LAT = "session_id string, phase string, duration_ms long"

BATCHES = {
    "step_metrics": (STEP, [[("a", "s", 1, 10, 1, 0.5), ("b", "s", 1, 20, 2, 0.25), ("c", "t", 1, None, 3, None)],
                            [("a", "s", 2, 7, 1, 0.125), ("c", "t", 0, 99, 9, 9.0), ("d", None, 1, 1, 1, 1.0)], [("b", "u", 3, 20, 2, 0.25)]]),
    "tool_calls": (CALL, [[("c1", "s", 1, "pending", None, None), ("c2", "s", 1, "completed", 40, 12)],
                          [("c1", "s", 2, "completed", 30, -5), ("c3", "t", 1, "error", 5, 3)], [("c2", "s", 3, "pending", None, None)]]),
    "relevance": (REL, [[("s", 5, 0.5), ("s", 0, 0.0)], [], [("t", 7, 1.0), ("s", 3, 0.25)]]),
    "streaming_timing": (TIME, [[("m", "s", 1, None, 100, None)], [("m", "s", 2, 7, 100, 150), ("n", "s", 1, 10, 90, 95)],
                                [("n", "s", 2, 10, 95, 96)]]),
    "latency": (LAT, [[("s", "total", 5), ("s", "total", 5), ("s", "other", 500)], [("s", "total", -3), ("t", "total", 0)],
                      [("s", "total", 1_000_000)]]),
}
KEYS = {"step_metrics": "id", "tool_calls": "id", "streaming_timing": "message_id"}


def test_summaries_follow_their_tables(spark):
    base = stream_dir(spark, "summary")
    summary = SessionSummary(spark, base)
    requests = spark.createDataFrame([("k", s, "x") for s in ("s", "t", "u", "none")], "task_id string, session_id string, strategy string")
    tables = {f: KeyedTable(spark, f"{base}/{f}", schema, [KEYS[f]], 2) if f in KEYS else AppendTable(spark, f"{base}/{f}", schema)
              for f, (schema, _) in BATCHES.items()}
    for i in range(3):
        for fact, (schema, batches) in BATCHES.items():
            batch = spark.createDataFrame(batches[i], schema)
            if fact in KEYS:
                tables[fact].merge(batch, last_wins([KEYS[fact]], ["ts"]), i)
            else:
                tables[fact].append(batch, i)
            assert summary.follow_table(fact, tables[fact]) and not summary.follow_table(fact, tables[fact])
        if i != 1:
            want = sm.benchmark_runs(requests, *[t.read() for t in tables.values()])
            assert rows(summary.runs(requests)) == rows(want)
    assert summary.table.read().where("n <= 0").count() == 0


def test_a_compacted_table_changes_nothing(spark):
    base = stream_dir(spark, "compacted")
    summary, table = SessionSummary(spark, base), AppendTable(spark, f"{base}/l", LAT)
    for i in (1, 2):
        table.append(spark.createDataFrame([("s", "total", i)], LAT), i)
    summary.follow_table("latency", table)
    before = rows(summary.table.read())
    table.compact()
    summary.follow_table("latency", table)
    assert rows(summary.table.read()) == before and len(before) == 2
