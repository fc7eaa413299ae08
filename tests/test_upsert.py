"""First-wins / last-wins upserts and schema evolution."""

from turnmeter.operators.upsert import first_when, keep_first, keep_last, union_evolved
from pyspark.sql import functions as F

from helpers import rows


def test_keep_last(spark):
    df = spark.createDataFrame([("t", "v1", 1, 0), ("t", "v2", 2, 0), ("u", "x", 5, 1), ("u", "y", 5, 2)],
                               "id string, description string, ts long, seq long")
    assert rows(keep_last(df, ["id"], ["ts", "seq"]), "id", "description") == [("t", "v2"), ("u", "y")]


def test_keep_first(spark):
    df = spark.createDataFrame([("s1", "h", "a", 1), ("s1", "h", "b", 2), ("s2", "h", "c", 3)],
                               "session_id string, content_hash string, content string, ts long")
    assert rows(keep_first(df, ["session_id", "content_hash"], ["ts"]), "session_id", "content") == [
        ("s1", "a"), ("s2", "c")]


def test_keep_last_ties_are_deterministic(spark):
    df = spark.createDataFrame([("k", "a", 1), ("k", "b", 1)], "id string, v string, ts long")
    assert rows(keep_last(df, ["id"], ["ts"]), "v") == [("b",)]


def test_first_when(spark):
    df = spark.createDataFrame([("m", "text", 1100), ("m", "text", 9999), ("m", "tool", 50)],
                               "m string, kind string, ts long")
    got = df.groupBy("m").agg(first_when(F.col("kind") == "text", F.col("ts")).alias("f")).first()["f"]
    assert got == 1100


def test_union_evolved(spark):
    v1 = spark.createDataFrame([(1,)], "id long")
    v2 = spark.createDataFrame([(2, "x")], "id long, extra string")
    assert rows(union_evolved([v1, v2]), "id", "extra") == [(1, None), (2, "x")]


def test_read_evolved_parquet(spark, tmp_path):
    from turnmeter.operators.upsert import read_evolved
    spark.createDataFrame([(1,)], "id long").write.parquet(str(tmp_path / "v1"))
    spark.createDataFrame([(2, "x")], "id long, extra string").write.parquet(str(tmp_path / "v2"))
    got = read_evolved(spark, [str(tmp_path / "v1"), str(tmp_path / "v2")])
    assert rows(got, "id", "extra") == [(1, None), (2, "x")]
