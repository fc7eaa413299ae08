"""SparkSession construction and the shared checkpoint folder.

Everything in the library takes a ``SparkSession`` from the caller; this module
only offers a builder with the settings the operators are tuned for (AQE with
skew-join splitting, UTC session time zone, Arrow transfer) and a resolver for
the folder used to cut lineage and hold streaming state.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "turnmeter", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones at runtime).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Epoch-millisecond conversions of TIMESTAMP_NTZ columns assume UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def prepare(spark: SparkSession) -> None:
    """Session settings every query relies on: UTC for epoch-millisecond conversions."""
    ensure_utc(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, sink tables and streaming state.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Where it is unset
    a private folder is created and registered, but only for a ``local`` master
    (tests, bench); on any other master that would be machine-local, so the
    call fails and asks for the setting.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="turnmeter-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    current = sc._jsc.sc().getCheckpointDir()
    return current.get() if current.isDefined() else configured


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used where one intermediate feeds several branches of a plan: every
    branch then reads the checkpoint instead of re-running the scans and
    joins upstream, and a lost executor re-reads files instead of
    recomputing. Never a local (executor-memory) checkpoint.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_table(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage like ``cut_lineage`` and keeps the table columnar, so later
    branches read only the columns they name and the planner knows its size.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
