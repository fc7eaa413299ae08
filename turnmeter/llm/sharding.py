"""Sharding by jump consistent hashing (native).

``jump_shard`` maps a stable key to a shard with no ring table. Lamping and
Veach's algorithm draws a chain of jumps 0 = j0 < j1 < j2 < ... from a generator
seeded by the key; the shard is the last jump below the shard count. The chain
does not depend on the count, so one more shard takes rows only into itself,
about 1/(n+1) of them. The draws here are ``xxhash64(key, step)``, so no
arithmetic overflows and the whole map is one SQL expression.

``assign_shards`` adds the slot of each row within its shard. A shard may hold
any share of the rows, so slots are numbered inside (shard, input partition)
and shifted by the running sum of a small table of counts; no task sees a whole
shard, and a key that repeats without end is spread over all input partitions.

Defined cases: a null key hashes like any other value (one fixed shard); a null
text has size 16 and the checksum of no bytes; repeated rows share a shard and
take one slot each; an empty table gives no rows. Only the named columns are
read; others, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_table

#: Jumps tried before the full-length chain is walked (about 2 + ln(n) are needed).
SHORT_CHAIN = 16
#: Bytes that each row's header takes in a shard file.
ROW_OVERHEAD = 16


def _chain(key_hash: Column, n: int, steps: int) -> Column:
    """The jump chain after ``steps`` draws: next jump, last below n - 1, last below n."""
    def step(s: Column, i: Column) -> Column:
        draw = F.shiftrightunsigned(F.xxhash64(key_hash, i), 33) + F.lit(1)
        jump = F.floor((s["jump"] + 1) * F.lit(float(1 << 31)) / draw).cast("bigint")
        moved = F.struct(jump.alias("jump"),
                         F.when(s["jump"] < n - 1, s["jump"]).otherwise(s["fewer"]).alias("fewer"),
                         s["jump"].alias("shard"))
        return F.when(s["jump"] < n, moved).otherwise(s)

    start = F.struct(F.lit(0).cast("bigint").alias("jump"), F.lit(0).cast("bigint").alias("fewer"),
                     F.lit(0).cast("bigint").alias("shard"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)


def jump_shards(key: Column, n: int) -> Column:
    """Struct (shard, grown): the shards of ``key`` among ``n`` and among ``n + 1``."""
    h = F.xxhash64(key)
    steps = min(SHORT_CHAIN, n + 1)
    s = _chain(h, n + 1, steps)
    if steps < n + 1:
        s = F.when(s["jump"] > n, s).otherwise(_chain(h, n + 1, n + 1))
    return F.struct(s["fewer"].cast("int").alias("shard"), s["shard"].cast("int").alias("grown"))


def assign_shards(docs: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's shard among ``n_shards``, with its gapless slot there.

    Returns ``<key>``, size, text_crc32, law, shard, slot, grown_shard.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    raw = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    placed = (docs.select(F.col(key).alias("key"),
                          (F.octet_length(raw) + F.lit(ROW_OVERHEAD)).cast("bigint").alias("size"),
                          F.crc32(raw).alias("text_crc32"),
                          jump_shards(F.col(key), n_shards).alias("s"),
                          F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
              .select("key", "size", "text_crc32", "s.shard", "s.grown", "part", "row"))
    # written once: partition and row numbers must not change between the two uses below
    placed = shared_table(placed, "shards")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
               .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    return (placed.withColumn("inside", inside).join(offsets, ["shard", "part"])
            .select(F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("offset") + F.col("inside")).cast("bigint").alias("slot"),
                    F.col("grown").alias("grown_shard")))


def write_shards(docs: DataFrame, n_shards: int, path: str, key: str = "doc_id") -> None:
    """Write every row, all columns kept, as Parquet folders ``shard=<n>`` under ``path``.

    The rows of one shard come from many tasks, each adding its own file, so a
    shard of any size is written in parallel. A column of the rows' own that is
    named ``shard`` is refused, since the folder would hide it.
    """
    if "shard" in [c.lower() for c in docs.columns]:
        raise ValueError("the rows already have a column named shard")
    docs.withColumn("shard", jump_shards(F.col(key), n_shards)["shard"]).write.partitionBy("shard").parquet(path)
