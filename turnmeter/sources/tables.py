"""Sources and sinks.

Tables are Parquet; reads name their columns so Catalyst prunes the scan, and
filters written on the returned DataFrame reach the Parquet reader.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def epoch_ms(col: str):
    """Epoch milliseconds of a TIMESTAMP / TIMESTAMP_NTZ column (session time zone UTC)."""
    return F.unix_millis(F.col(col).cast("timestamp"))


def route(events: DataFrame, kind_col: str, kinds: list[str]) -> dict[str, DataFrame]:
    """Demultiplex one event source by kind (S2): one filtered view per kind."""
    return {k: events.where(F.col(kind_col) == k) for k in kinds}


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append sink (S6) for append-only tables (relevance, latency, runs)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
