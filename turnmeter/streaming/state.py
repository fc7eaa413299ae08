"""Keyed streaming state: what a stream must remember between micro-batches.

Each processor holds for one key only what later events need, in RocksDB (call
``use_rocksdb`` before a stream starts), and lets go of it: when it is used up, when its
session ends, or when its time is over. The rows of a key come unordered, a few
Arrow batches per micro-batch; they are sorted by (ts_ms, seq) within the
micro-batch and handled as columns, not row by row.

Order and late rows. Micro-batches are taken as they arrive. A row that is
older than what its key has already seen is late; each processor says what it
does with late rows. Events that come in order, however cut into micro-batches,
give what the batch operators give.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

DAY_MS = 86_400_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State on disk beside the executor, checkpointed to the stream's folder: keys may outgrow memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The rows of one key in this micro-batch, by (ts_ms, seq)."""
    rows = list(rows)
    whole = pd.concat(rows, ignore_index=True) if len(rows) != 1 else rows[0]
    return whole.sort_values(["ts_ms", "seq"], kind="stable", ignore_index=True)


# ---- T5: start and end of a call ------------------------------------------------------------

LATENCY = "tool_call_id string, session_id string, phase string, duration_ms long, metadata_json string, timestamp long"


class PairCalls(StatefulProcessor):
    """Latency of calls: a start is kept until the call's next end, which consumes it.

    State is the open start of a call, nothing of calls that are closed. It expires ``ttl_ms`` after
    it was written (T8); an end that comes later than that finds no start and gives no row. A late
    row pairs with what is open when it comes.
    """

    def __init__(self, ttl_ms: int):
        self._ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._open = handle.getValueState("open", "ts_ms long", self._ttl)

    def handleInputRows(self, key, rows, timerValues):
        rows = _in_order(rows)
        was_open = self._open.exists()
        kind = rows["kind"]
        previous, started = kind.shift(), rows["ts_ms"].shift()
        if was_open:
            previous.iloc[0], started.iloc[0] = "before", self._open.get()[0]
        ends = (kind == "after") & (previous == "before")
        if kind.iloc[-1] == "before":
            self._open.update((int(rows["ts_ms"].iloc[-1]),))
        elif was_open:
            self._open.clear()
        if ends.any():
            found = rows[ends]
            yield pd.DataFrame({"tool_call_id": key[0], "session_id": found["session_id"], "phase": "total",
                                "duration_ms": found["ts_ms"] - started[ends].astype("int64"), "metadata_json": None,
                                "timestamp": found["ts_ms"]})


def pair_calls(events: DataFrame, ttl_ms: int = 30 * DAY_MS) -> DataFrame:
    """'total' latency rows of a stream of hook events (call_id, session_id, kind, ts_ms, seq)."""
    return events.groupBy("call_id").transformWithStateInPandas(
        PairCalls(ttl_ms), LATENCY, "Append", "ProcessingTime")


# ---- T6: latest parameters of a session -------------------------------------------------------

PARAMS = "id string, model_id string, context_limit long"
_PARAM_FIELDS = ["id", "model_id", "context_limit"]


class LatestParams(StatefulProcessor):
    """Each event with its session's latest chat params (T6, J3); one row of state per session.

    The state starts from a stored table, so that a new stream knows what came before it. Late
    params do not replace later ones; a late event gets the params that are in force when it comes.
    A session's state expires ``ttl_ms`` after its last params (T8).
    """

    def __init__(self, ttl_ms: int):
        self._ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._params = handle.getValueState("params", f"{PARAMS}, ts_ms long, seq long", self._ttl)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        last = _in_order([initialState]).iloc[-1]
        self._params.update(_values(last, [*_PARAM_FIELDS, "ts_ms", "seq"]))

    def handleInputRows(self, key, rows, timerValues):
        rows = _in_order(rows)
        known = self._params.get() if self._params.exists() else None
        if known is not None:  # late params are no params
            late = rows["is_params"] & ((rows["ts_ms"] < known[3]) | ((rows["ts_ms"] == known[3]) & (rows["seq"] <= known[4])))
            rows = rows[~late].reset_index(drop=True)
        at = pd.Series(rows.index, index=rows.index).where(rows["is_params"]).ffill()
        events = ~rows["is_params"]
        found = rows.loc[events, ["event_id", "session_id", "event_type", "ts_ms"]].rename(columns={"ts_ms": "timestamp"})
        source = at[events]
        for name, i in (("params_id", 0), ("model_id", 1), ("context_limit", 2)):
            column = rows[_PARAM_FIELDS[i]]
            values = [known[i] if known is not None else None] * len(found)
            for k, j in enumerate(source):
                if j == j:
                    values[k] = column.iat[int(j)]
            found[name] = pd.array(values, dtype="Int64") if name == "context_limit" else values
        if rows["is_params"].any():
            self._params.update(_values(rows[rows["is_params"]].iloc[-1], [*_PARAM_FIELDS, "ts_ms", "seq"]))
        if len(found):
            yield found


def _values(row: pd.Series, columns: list[str]) -> tuple:
    return tuple(None if pd.isna(v) else int(v) if c in ("ts_ms", "seq", "context_limit") else v
                 for c, v in ((c, row[c]) for c in columns))


def latest_params(events: DataFrame, params: DataFrame, stored: DataFrame | None = None, ttl_ms: int = 30 * DAY_MS) -> DataFrame:
    """Events of a stream (event_id, session_id, event_type, ts_ms, seq) with the params in force.

    ``params``: id, session_id, ts_ms, seq, model_id, context_limit, of the same stream. ``stored``: such rows
    of a table, from before the stream began; its latest row per session is the state that the stream starts with.
    """
    p = params.select("session_id", "ts_ms", "seq", F.lit(True).alias("is_params"), F.lit(None).cast("long").alias("event_id"),
                      F.lit(None).cast("string").alias("event_type"), *_PARAM_FIELDS)
    e = events.select("session_id", "ts_ms", "seq", F.lit(False).alias("is_params"), "event_id", "event_type",
                      F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("model_id"),
                      F.lit(None).cast("long").alias("context_limit"))
    out = ("event_id long, session_id string, event_type string, timestamp long, params_id string, model_id string, "
           "context_limit long")
    seed = None
    if stored is not None:
        last = stored.groupBy("session_id").agg(F.max(F.struct("ts_ms", "seq", *_PARAM_FIELDS)).alias("p"))
        seed = last.select("session_id", "p.*").groupBy("session_id")
    return e.unionByName(p).groupBy("session_id").transformWithStateInPandas(
        LatestParams(ttl_ms), out, "Append", "ProcessingTime", initialState=seed)


# ---- T10: first row of a key ---------------------------------------------------------------------

class FirstOfKey(StatefulProcessor):
    """The first row of each key, whole; of what it holds, only its time is kept as state.

    The keys come in buckets, so that a call has many of them at a time. Of the rows that come in one micro-batch
    the earliest stands; rows that come after it, late or not, are dropped. A key expires ``ttl_ms`` after
    its row (T8) and may then come again.
    """

    def __init__(self, keys: list[str], key_schema: StructType, ttl_ms: int):
        self._keys, self._schema, self._ttl = keys, key_schema, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._first = handle.getMapState("first", self._schema, "ts_ms long", self._ttl)

    def _firsts(self, rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values(["ts_ms", "seq"], kind="stable", ignore_index=True).drop_duplicates(self._keys)

    def handleInputRows(self, key, rows, timerValues):
        # a row per key is held of each part, however many come
        first = self._firsts(pd.concat([self._firsts(part) for part in rows], ignore_index=True))
        keys = [tuple(None if pd.isna(v) else v for v in k) for k in first[self._keys].itertuples(index=False, name=None)]
        if self._first.exists():
            new = [not self._first.containsKey(k) for k in keys]
            first, keys = first[new], [k for k, n in zip(keys, new) if n]
        for k, ts in zip(keys, first["ts_ms"]):
            self._first.updateValue(k, (int(ts),))
        if keys:
            yield first


def first_of_keys(rows: DataFrame, keys: list[str], ttl_ms: int = DAY_MS, buckets: int = 1024) -> DataFrame:
    """The first row per key of a stream with columns ts_ms and seq. ``buckets`` is fixed when the stream is made."""
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    once = FirstOfKey(list(keys), rows.select(*keys).schema, ttl_ms)
    return dealt.groupBy("_bucket").transformWithStateInPandas(once, rows.schema, "Append", "ProcessingTime")


# ---- T7-T9: what a session has seen, until it ends ----------------------------------------------

SEEN = "session_id string, item string, ts_ms long, seq long"


class SeenOnce(StatefulProcessor):
    """First occurrence of an item in its session; items are let go when the session ends.

    An 'idle' row (item null) ends its session: the items seen are cleared. So do ``quiet_ms`` of
    event time without any row, by a timer, where no idle row comes (T8). An item that comes again
    after its session ended is handed on again; the table behind, where the first wins, ignores it.
    Rows that the watermark has passed are dropped by Spark before they get here.
    """

    def __init__(self, quiet_ms: int):
        self._quiet = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._seen = handle.getMapState("seen", "item string", "ts_ms long")
        self._until = handle.getValueState("until", "ts_ms long")

    def _end(self) -> None:
        self._seen.clear()
        if self._until.exists():
            self._handle.deleteTimer(self._until.get()[0])
            self._until.clear()

    def handleInputRows(self, key, rows, timerValues):
        rows = sorted((r for part in rows for r in zip(part["ts_ms"].tolist(), part["seq"].tolist(), part["item"].tolist())),
                      key=lambda r: r[:2])
        stored = self._seen.exists()  # each question to the state is a round trip
        known, fresh, last, ended, out = set(), [], None, False, []
        for ts, seq, item in rows:
            if pd.isna(item):
                stored, known, fresh, last, ended = False, set(), [], None, True
                continue
            last = ts
            if item not in known:
                known.add(item)
                if not (stored and self._seen.containsKey((item,))):
                    fresh.append((item, ts))
                    out.append((key[0], item, ts, seq))
        if ended:
            self._end()
        for item, ts in fresh:
            self._seen.updateValue((item,), (int(ts),))
        if last is not None:
            self._wait(max(int(last), timerValues.getCurrentWatermarkInMs()) + self._quiet)
        if out:
            yield pd.DataFrame(out, columns=["session_id", "item", "ts_ms", "seq"])

    def _wait(self, until: int) -> None:
        if self._until.exists():
            if self._until.get()[0] >= until:
                return
            self._handle.deleteTimer(self._until.get()[0])
        self._handle.registerTimer(until)
        self._until.update((until,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._end()
        return iter([])


def seen_once(items: DataFrame, delay: str = "1 hour", quiet_ms: int = DAY_MS) -> DataFrame:
    """First rows (session_id, item, ts_ms, seq) per session and item of a stream with idle rows (item null).

    Only keys are kept as state; what an item stands for is fetched from the micro-batch by (session_id, ts_ms, seq).
    """
    timed = items.select(*[c.split(" ")[0] for c in SEEN.split(", ")], F.timestamp_millis("ts_ms").alias("at"))
    return timed.withWatermark("at", delay).groupBy("session_id").transformWithStateInPandas(
        SeenOnce(quiet_ms), SEEN, "Append", "EventTime")


# ---- W1, J5: cost shares when a step arrives ---------------------------------------------------

SHARES = "session_id string, call_id string, message_id string, cost_share double, ts_ms long, seq long"


class ShareCosts(StatefulProcessor):
    """Shares of a step's cost among the calls of its message that are completed when it arrives.

    State per session: its calls, each with the message of its last start, and its bytes once it is
    completed. A step of positive cost gives the completed calls of its message their shares; a
    start sets its call back to pending and its share to null. A late row takes effect when it comes. Calls are
    let go when an 'idle' row ends the session (T7), or ``ttl_ms`` after they were last written (T8).
    """

    def __init__(self, ttl_ms: int):
        self._ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._calls = handle.getMapState("calls", "call_id string", "message_id string, bytes long", self._ttl)

    def handleInputRows(self, key, rows, timerValues):
        rows, out = _in_order(rows), []
        calls, changed, ended = {}, set(), False
        if (rows["kind"] == "step").any():
            calls = {k[0]: tuple(v) for k, v in self._calls.iterator()}
        else:
            calls = {c: tuple(self._calls.getValue((c,))) for c in rows["call_id"].dropna().unique()
                     if self._calls.containsKey((c,))}
        columns = ["kind", "call_id", "message_id", "bytes", "cost", "ts_ms", "seq"]
        for kind, call, message, size, cost, ts, seq in rows[columns].itertuples(index=False, name=None):
            if kind == "start":
                calls[call] = (message, None)
                out.append((call, message, None, ts, seq))
            elif kind == "end" and call in calls:
                calls[call] = (calls[call][0], int(size))
            elif kind == "step" and cost > 0:
                done = {c: n for c, (m, n) in calls.items() if m == message and n is not None}
                total = sum(done.values())
                out += [(c, message, cost / len(done) if total == 0 else n / total * cost, ts, seq) for c, n in done.items()]
            elif kind == "idle":
                calls, changed, ended = {}, set(), True
            if kind in ("start", "end") and call in calls:
                changed.add(call)
        if ended:
            self._calls.clear()
        for call in changed:
            self._calls.updateValue((call,), calls[call])
        if out:
            out = pd.DataFrame(out, columns=["call_id", "message_id", "cost_share", "ts_ms", "seq"])
            out.insert(0, "session_id", key[0])
            yield out.astype({"cost_share": "float64"})


def share_costs(starts: DataFrame, ends: DataFrame, steps: DataFrame, idle: DataFrame | None = None,
                ttl_ms: int = 30 * DAY_MS) -> DataFrame:
    """Rows of ``SHARES``: what each start and each step does to the share of a call; the last one stands.

    ``starts``: session_id, call_id, message_id, ts_ms, seq; ``ends``: session_id, call_id, ts_ms, seq,
    output_size_bytes; ``steps``: session_id, message_id, ts_ms, seq, cost; ``idle``: session_id, ts_ms, seq; all of one stream.
    """
    fields = {"call_id": "string", "message_id": "string", "bytes": "long", "cost": "double"}

    def rows(df: DataFrame, kind: str, **have) -> DataFrame:
        return df.select("session_id", F.lit(kind).alias("kind"), "ts_ms", "seq",
                         *[have.get(c, F.lit(None)).cast(t).alias(c) for c, t in fields.items()])

    size = F.coalesce(F.col("output_size_bytes"), F.lit(0))
    both = (rows(starts, "start", call_id=F.col("call_id"), message_id=F.col("message_id"))
            .unionByName(rows(ends, "end", call_id=F.col("call_id"), bytes=size))
            .unionByName(rows(steps, "step", message_id=F.col("message_id"), cost=F.col("cost"))))
    if idle is not None:
        both = both.unionByName(rows(idle, "idle"))
    return both.groupBy("session_id").transformWithStateInPandas(ShareCosts(ttl_ms), SHARES, "Append", "ProcessingTime")
