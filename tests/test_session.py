"""The shared checkpoint folder comes from the session; lineage cuts land there."""

from turnmeter.session import checkpoint_dir, cut_lineage


def test_checkpoint_dir_from_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    got = checkpoint_dir(spark)
    assert configured and configured.rstrip("/").split("/")[-1] in got


def test_cut_lineage_is_reliable_checkpoint(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS v")
    cut = cut_lineage(df)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "Range" not in plan
    assert sorted(r.v for r in cut.collect()) == [i * 2 for i in range(10)]
