"""Stored tables: upserts against a replay, replays of batches, crashes between write and publish, readers."""

import random

import pytest

from turnmeter.sources import store
from turnmeter.sources.store import AppendTable, Conflict, KeyedTable, first_wins, last_wins
from helpers import rows

SCHEMA = "k string, t long, s long, v string"


def made_up_batches(seed, n):
    rng = random.Random(seed)
    return [[(rng.choice([None, "a", "b", "c", "hot", "hot", "hot", str(rng.randrange(30))]), rng.randrange(50), b * 1000 + i,
              f"v{b}.{i}") for i in range(40)] for b in range(n)]


def replay(batches, wins):
    """Row by row, as an upsert would: the greater or smaller (t, s) stays."""
    table = {}
    for batch in batches:
        for k, t, s, v in batch:
            if k not in table or wins((t, s), table[k][:2]):
                table[k] = (t, s, v)
    return sorted(((k, *x) for k, x in table.items()), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("rule, wins", [(last_wins, lambda a, b: a > b), (first_wins, lambda a, b: a < b)])
@pytest.mark.parametrize("buckets", [1, 8])
def test_merges_against_replay(spark, tmp_path, rule, wins, buckets):
    batches = made_up_batches(3, 4)
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets)
    assert table.read().collect() == []
    for i, data in enumerate(batches):
        batch = spark.createDataFrame(data, SCHEMA)
        assert table.merge(batch, rule(["k"], ["t", "s"]), i, "stream")
        assert rows(table.read()) == replay(batches[:i + 1], wins)
        assert not table.merge(batch, rule(["k"], ["t", "s"]), i, "stream")  # replayed: known
    assert table.version().number == len(batches)
    assert rows(table.read(2)) == replay(batches[:2], wins)  # earlier versions stay readable


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], 16)
    rule = last_wins(["k"], ["t", "s"])
    table.merge(spark.createDataFrame([(str(i), 1, i, "x") for i in range(200)], SCHEMA), rule)
    before = table.version().folders
    table.merge(spark.createDataFrame([("7", 2, 0, "y")], SCHEMA), rule)
    after = table.version().folders
    assert len(before) == 16 and sum(before[b] != after[b] for b in before) == 1
    assert ("7", 2, 0, "y") in rows(table.read()) and table.read().count() == 200


def test_crash_between_write_and_publish(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], 4)
    rule = last_wins(["k"], ["t", "s"])
    first, second = ([(k, t, 0, "x") for k in "abc"] for t in (1, 2))
    table.merge(spark.createDataFrame(first, SCHEMA), rule, 0, "w")
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.merge(spark.createDataFrame(second, SCHEMA), rule, 1, "w")
    again = KeyedTable(spark, table.path, SCHEMA, ["k"], 4)
    assert rows(again.read()) == first
    assert again.merge(spark.createDataFrame(second, SCHEMA), rule, 1, "w")
    assert rows(again.read()) == second
    assert len(again.vacuum()) == 2 and rows(again.read()) == second  # the first version's folder and the orphan


def test_two_writers_of_one_version(spark, tmp_path):
    one, two = (KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], 4) for _ in range(2))
    rule = last_wins(["k"], ["t", "s"])
    stale = two.version()
    one.merge(spark.createDataFrame([("a", 1, 1, "x")], SCHEMA), rule, 0, "one")
    two.version = lambda number=None: stale
    with pytest.raises(Conflict):
        two.merge(spark.createDataFrame([("b", 1, 1, "y")], SCHEMA), rule, 0, "two")
    del two.version
    assert two.merge(spark.createDataFrame([("b", 1, 1, "y")], SCHEMA), rule, 0, "two")
    assert rows(one.read(), "k") == [("a",), ("b",)]


def test_a_rule_may_take_rows_away(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], 1)
    batch = spark.createDataFrame([("a", 1, 1, "x")], SCHEMA)
    table.merge(batch, last_wins(["k"], ["t", "s"]))
    table.merge(batch, lambda old, new: old.limit(0))
    assert table.read().collect() == []


def test_insert_adds_absent_keys_and_rewrites_nothing(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], 4)
    table.insert(spark.createDataFrame([("a", 1, 1, "x"), (None, 1, 2, "x")], SCHEMA), 0, "w")
    first = table.version().folders
    again = spark.createDataFrame([("a", 0, 0, "y"), ("b", 2, 2, "y"), (None, 0, 0, "y")], SCHEMA)
    assert table.insert(again, 1, "w") and not table.insert(again, 1, "w")
    assert rows(table.read()) == [(None, 1, 2, "x"), ("a", 1, 1, "x"), ("b", 2, 2, "y")]
    assert all(table.version().folders[b][:len(f)] == f for b, f in first.items())


def test_append_once_and_compact(spark, tmp_path):
    table = AppendTable(spark, str(tmp_path / "log"), "v long")
    for i in (0, 1, 1, 0, 2):  # replays among them
        table.append(spark.createDataFrame([(i,), (i,)], "v long"), i, "w")
    assert rows(table.read()) == [(0,), (0,), (1,), (1,), (2,), (2,)]
    table.compact()
    assert rows(table.read()) == [(0,), (0,), (1,), (1,), (2,), (2,)] and len(table.version().folders) == 1
    table.append(spark.createDataFrame([(3,)], "v long"), 3, "w")
    assert len(table.vacuum()) == 3 and table.read().count() == 7
    assert isinstance(table, store.StoredTable)
