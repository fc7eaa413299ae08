"""Stored tables that a stream, or a batch job, brings up to date.

A table is a folder of immutable Parquet folders and numbered versions. A
version is a small JSON file that names the Parquet folders in force and, per
writer, the last batch it took in. Publishing a version is one rename that
fails if the number is taken, as Spark's own stream checkpoints do it, so

* readers see a version whole, never one half written;
* a crash before the rename leaves the old version in force, and folders that
  no version names (``vacuum`` takes them away);
* a batch that is replayed under its number is known and changes nothing;
* of two writers that started from one version, one publishes and the other
  gets :class:`Conflict` and can merge again.

``KeyedTable`` deals its rows to buckets by a hash of the key. A merge reads
and rewrites only the buckets that the batch touches: what they hold and the
batch go through a rule, which gives the new rows. ``AppendTable`` adds a folder
per batch.

The folder must be on a file system with an atomic rename, shared by all
executors. A version lists a path per bucket, or per appended batch
(``AppendTable.compact`` folds those).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import keep_first, keep_last

Rule = Callable[[DataFrame, DataFrame], DataFrame]


class Conflict(RuntimeError):
    """Another writer has published this version."""


@dataclass
class Version:
    """Which folders are in force, by bucket or batch, and how far each writer has come."""
    number: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    writers: dict[str, int] = field(default_factory=dict)


class _Files:
    """The Hadoop file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._path, self._gateway, self._conf = jvm.org.apache.hadoop.fs.Path, spark.sparkContext._gateway, spark._jsc.hadoopConfiguration()
        self._fs = self._path(path).getFileSystem(self._conf)
        self._rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        self._io = jvm.org.apache.commons.io.IOUtils

    def names(self, folder: str) -> list[str]:
        where = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Write ``text`` to a new file ``path`` at once, or fail if there is one."""
        temporary = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self._fs.create(self._path(temporary), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            self._context.rename(self._path(temporary), self._path(path), self._gateway.new_array(self._rename, 0))
        except Exception as e:
            self._fs.delete(self._path(temporary), False)
            if self._fs.exists(self._path(path)):
                raise Conflict(path) from e
            raise

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class StoredTable:
    """Versions and folders under ``path``; rows have the columns of ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType):
        self.spark, self.path = spark, path
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self._files = _Files(spark, path)

    def version(self, number: int | None = None) -> Version:
        """The version in force, or an earlier one."""
        if number is None:
            number = max((int(n[:-5]) for n in self._files.names(f"{self.path}/versions") if n.endswith(".json")), default=0)
        if number == 0:
            return Version()
        return Version(**json.loads(self._files.read(f"{self.path}/versions/{number}.json")))

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of the version in force, or of an earlier one."""
        return self._rows(self.version(number).folders.values())

    def _rows(self, folders: Iterable[list[str]]) -> DataFrame:
        paths = [f"{self.path}/{f}" for own in folders for f in own]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def changes(self, since: int, until: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(rows before, rows after) of the buckets or batches in which two versions differ; others are not read."""
        old, new = self.version(since).folders, self.version(until).folders
        differ = [k for k in {**old, **new} if old.get(k) != new.get(k)]
        return self._rows(old.get(k, []) for k in differ), self._rows(new.get(k, []) for k in differ)

    def _taken(self, version: Version, writer: str, batch_id: int | None) -> bool:
        return batch_id is not None and batch_id <= version.writers.get(writer, -1)

    def _publish(self, old: Version, folders: dict[str, list[str]], writer: str, batch_id: int | None) -> Version:
        writers = old.writers if batch_id is None else {**old.writers, writer: batch_id}
        new = Version(old.number + 1, folders, writers)
        self._files.publish(f"{self.path}/versions/{new.number}.json", json.dumps(vars(new)))
        return new

    def vacuum(self, keep: int = 1) -> list[str]:
        """Take away folders that none of the last ``keep`` versions names, and older versions.

        Not while a writer is at work, and not before those who follow the table (``changes``) have taken the versions in.
        """
        last = self.version().number
        kept = range(max(1, last - keep + 1), last + 1)
        used = {f.split("/")[1] for n in kept for own in self.version(n).folders.values() for f in own}
        gone = [f for f in self._files.names(f"{self.path}/data") if f not in used]
        for f in gone:
            self._files.delete(f"{self.path}/data/{f}")
        for name in self._files.names(f"{self.path}/versions"):
            if not name.endswith(".json") or int(name[:-5]) not in kept:
                self._files.delete(f"{self.path}/versions/{name}")
        return gone


def last_wins(keys: list[str], order: list[str]) -> Rule:
    """``INSERT OR REPLACE`` (S4): the latest row of a key by ``order``, of the table's and the batch's."""
    return lambda old, batch: keep_last(old.unionByName(batch), keys, order)


def first_wins(keys: list[str], order: list[str]) -> Rule:
    """``INSERT OR IGNORE`` (S5): the earliest row of a key by ``order``."""
    return lambda old, batch: keep_first(old.unionByName(batch), keys, order)


class KeyedTable(StoredTable):
    """One row per key, in ``buckets`` buckets; the number is fixed when the table is made.

    A bucket is rewritten by one task, so take enough of them to keep a bucket within a task's memory.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, keys: list[str], buckets: int = 64):
        super().__init__(spark, path, schema)
        self.keys, self.buckets = list(keys), buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def merge(self, batch: DataFrame, rule: Rule, batch_id: int | None = None, writer: str = "batch") -> bool:
        """Bring the table up to date with ``batch``; False if this batch of ``writer`` is in it already.

        ``rule(old, batch)`` gives all rows of the touched buckets: ``old`` are the rows they have, ``batch`` any
        rows with the key columns. It must give one row per key and keep keys that the batch does not name.
        """
        return self._change(batch, rule, batch_id, writer, add=False)

    def insert(self, batch: DataFrame, batch_id: int | None = None, writer: str = "batch") -> bool:
        """Add the rows of ``batch`` (one per key) whose keys the table lacks (S5); nothing is rewritten.

        Of the touched buckets the key columns are read, no others; a bucket gets one more folder.
        """
        def absent(old: DataFrame, new: DataFrame) -> DataFrame:
            same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.keys]
            return new.alias("n").join(old.select(*self.keys).alias("o"), reduce(Column.__and__, same), "left_anti")
        return self._change(batch, absent, batch_id, writer, add=True)

    def _change(self, batch: DataFrame, rule: Rule, batch_id: int | None, writer: str, add: bool) -> bool:
        version = self.version()
        if self._taken(version, writer, batch_id):
            return False
        touched = [r[0] for r in batch.select(self._bucket()).distinct().collect()]  # ``buckets`` rows at most
        folders = dict(version.folders)
        if touched:
            old = self._rows(folders.get(str(b), []) for b in touched)
            new = rule(old, batch).select(*self.schema.names).withColumn("_bucket", self._bucket())
            data = f"data/{version.number + 1}-{uuid.uuid4().hex[:12]}"
            new.repartition(len(touched), "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{data}")
            written = set(self._files.names(f"{self.path}/{data}"))
            for b in touched:
                own = [f"{data}/_bucket={b}"] if f"_bucket={b}" in written else []
                folders[str(b)] = folders.get(str(b), []) + own if add else own
        self._publish(version, folders, writer, batch_id)
        return True

    def sink(self, build: Callable[[DataFrame], DataFrame], rule: Rule, writer: str) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` handler that merges ``build(batch)``."""
        def write(batch: DataFrame, batch_id: int) -> None:
            built = build(batch).persist()
            try:
                self.merge(built, rule, batch_id, writer)
            finally:
                built.unpersist()
        return write


class AppendTable(StoredTable):
    """Rows without a key: every batch adds its own (S6), once."""

    def append(self, batch: DataFrame, batch_id: int | None = None, writer: str = "batch") -> bool:
        version = self.version()
        if self._taken(version, writer, batch_id):
            return False
        data = f"data/{version.number + 1}-{uuid.uuid4().hex[:12]}"
        batch.select(*self.schema.names).write.parquet(f"{self.path}/{data}")
        self._publish(version, {**version.folders, str(version.number + 1): [data]}, writer, batch_id)
        return True

    def compact(self) -> None:
        """The rows of all batches in one folder."""
        version = self.version()
        data = f"data/{version.number + 1}-{uuid.uuid4().hex[:12]}"
        self._rows(version.folders.values()).write.parquet(f"{self.path}/{data}")
        self._publish(version, {str(version.number + 1): [data]}, "", None)

    def sink(self, build: Callable[[DataFrame], DataFrame], writer: str) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` handler that appends ``build(batch)``."""
        return lambda batch, batch_id: self.append(build(batch), batch_id, writer) and None
