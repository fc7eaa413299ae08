import struct
import zlib

import xxhash
from pyspark.sql import functions as F

from turnmeter.llm.sharding import SHORT_CHAIN, assign_shards, jump_shards

SCHEMA = "doc_id bigint, text string, shard string, slot string"


def _hash(raw: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(raw, seed=seed)


def brute(key: int, n: int) -> int:
    """Jump hash by its definition, one draw per jump."""
    h = _hash(struct.pack("<q", key), 42)
    key_hash, b, j, step = struct.pack("<Q", h), -1, 0, 1
    while j < n:
        b = j
        draw = (_hash(struct.pack("<i", step), _hash(key_hash, 42)) >> 33) + 1
        j = int((b + 1) * float(1 << 31) / draw)
        step += 1
    return b


def test_jump_matches_brute_force(spark):
    for n in (1, 2, 7, 40, 1000):
        got = {r.id: (r.s.shard, r.s.grown)
               for r in spark.range(400).select("id", jump_shards(F.col("id"), n).alias("s")).collect()}
        for k, (shard, grown) in got.items():
            assert shard == brute(k, n) and grown == brute(k, n + 1)
            assert grown in (shard, n)


def test_long_chains_are_walked_to_the_end(spark):
    # with so many shards some keys need more draws than the short chain has
    got = spark.range(3000).select("id", jump_shards(F.col("id"), 300)["shard"].alias("s")).collect()
    assert all(r.s == brute(r.id, 300) for r in got)
    assert SHORT_CHAIN < 300


def test_slots_nulls_repeats_and_clashing_columns(spark):
    data = [(i % 50, "x" * (i % 7), "a", "b") for i in range(300)]
    data += [(None, "n", None, None)] * 3 + [(7, None, "a", "b"), (8, "", "a", "b"), (1009, "é" * 3, "a", "b")]
    data += [(5, "same", "a", "b")] * 200
    out = assign_shards(spark.createDataFrame(data, SCHEMA).repartition(5), 6).collect()
    assert len(out) == len(data)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert {r.shard for r in out if r.doc_id is None}.__len__() == 1
    assert [(r.size, r.text_crc32) for r in out if r.doc_id == 1009] == [(22, zlib.crc32("ééé".encode()))]
    assert (16, 0) in {(r.size, r.text_crc32) for r in out if r.doc_id == 7}
    assert {r.law for r in out} == {"key"}


def test_empty_table(spark):
    assert assign_shards(spark.createDataFrame([], SCHEMA), 4).collect() == []
