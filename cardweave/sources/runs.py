"""Stored tables kept by key: bucketed runs under one snapshot.

A batch adds a run, a folder bucketed by the table's key, to each table. When a level
has ``fanout`` runs, they are merged into one run of the next level, so a table of n
batches has at most ``fanout`` runs for each power of ``fanout`` in n, and a row is
rewritten once a level. Reading by key joins every run in its own buckets: the stored
side is not shuffled.

A snapshot is one small file that lists the runs of all tables and the last batch that
is whole. It is written last, under a new number and by renaming, so all that a batch
wrote becomes visible at once; folders that no snapshot lists do not count.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class KeyedTable:
    """Schema, key and layout of a stored table. ``newest`` reduces merged rows, which have ``batch_id``."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    buckets: int = 64
    fanout: int = 8
    newest: Callable[[DataFrame], DataFrame] | None = None

    def buckets_of(self, level: int) -> int:
        """Buckets grow with the rows of a level; a batch is no larger than a few files."""
        return max(1, self.buckets // self.fanout ** max(0, 2 - level))


@dataclass(frozen=True)
class Run:
    path: str
    level: int
    buckets: int
    batch: int | None = None    # of a run that one batch wrote; merged runs have a column


@dataclass(frozen=True)
class Snapshot:
    """``batch``: the last whole batch. ``retired``: folders of runs that were merged away."""

    version: int = 0
    batch: int = -1
    runs: dict[str, tuple[Run, ...]] = field(default_factory=dict)
    retired: tuple[str, ...] = ()


class Store:
    """The tables of a folder, in any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, root: str, tables: Sequence[KeyedTable]):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), {t.name: t for t in tables}
        self.folder = f"{self.root}/_snapshots"

    def _file(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _versions(self) -> list[int]:
        files, folder = self._file(self.folder)
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self) -> Snapshot:
        """The newest snapshot; without one, nothing is stored."""
        versions = self._versions()
        if not versions:
            return Snapshot()
        text = self.spark.read.text(f"{self.folder}/{versions[-1]:012d}.json", wholetext=True).first()[0]
        found = json.loads(text)
        runs = {name: tuple(Run(**r) for r in own) for name, own in found["runs"].items()}
        return Snapshot(versions[-1], found["batch"], runs, tuple(found["retired"]))

    def commit(self, snapshot: Snapshot) -> None:
        """Make a snapshot the newest. Runs retired two snapshots ago are deleted, as nobody reads them."""
        text = json.dumps({"batch": snapshot.batch, "retired": snapshot.retired,
                           "runs": {name: [vars(r) for r in own] for name, own in snapshot.runs.items()}})
        files, draft = self._file(f"{self.folder}/{uuid.uuid4().hex}.draft")
        out = files.create(draft, True)
        out.write(bytearray(text, "utf-8"))
        out.close()
        _, target = self._file(f"{self.folder}/{snapshot.version:012d}.json")
        if files.exists(target) or not files.rename(draft, target):
            raise RuntimeError(f"snapshot {snapshot.version} is there already: another writer is at work")
        for version in self._versions()[:-2]:
            files.delete(self._file(f"{self.folder}/{version:012d}.json")[1], False)

    def write_run(self, table: KeyedTable, rows: DataFrame, path: str, level: int, batch: int | None) -> Run:
        """Rows to one folder, bucketed by the key; what an attempt before left there goes."""
        files, at = self._file(path)
        files.delete(at, True)
        buckets, name = table.buckets_of(level), f"cardweave_new_{uuid.uuid4().hex}"
        (rows.repartition(buckets, *table.key).write.bucketBy(buckets, *table.key).sortBy(*table.key)
         .format("parquet").option("path", path).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")
        return Run(path, level, buckets, batch)

    def add(self, snapshot: Snapshot, batch: int, rows: dict[str, DataFrame]) -> Snapshot:
        """Write the batch's runs. They count once the snapshot that is returned is committed."""
        runs = dict(snapshot.runs)
        for name, df in rows.items():
            run = self.write_run(self.tables[name], df, f"{self.root}/{name}/batch_id={batch}", 0, batch)
            runs[name] = (*runs.get(name, ()), run)
        return replace(snapshot, version=snapshot.version + 1, batch=batch, runs=runs)

    def compact(self, snapshot: Snapshot) -> Snapshot:
        """Merge every level that is full; the snapshot itself where none is."""
        runs, retired = dict(snapshot.runs), []
        for name, table in self.tables.items():
            level = 0
            while any(r.level >= level for r in runs.get(name, ())):
                full = [r for r in runs[name] if r.level == level]
                if len(full) >= table.fanout:
                    rows = self.read(name, full)
                    rows = table.newest(rows) if table.newest else rows
                    path = f"{self.root}/_merged/{name}-{level + 1}-{uuid.uuid4().hex}"
                    merged = self.write_run(table, rows, path, level + 1, None)
                    runs[name] = (merged, *[r for r in runs[name] if r not in full])
                    retired += [r.path for r in full]
                level += 1
        if not retired:
            return snapshot
        for path in snapshot.retired:
            files, at = self._file(path)
            files.delete(at, True)
        return replace(snapshot, version=snapshot.version + 1, runs=runs, retired=tuple(retired))

    def _table(self, table: KeyedTable, run: Run) -> DataFrame:
        """A run as a bucketed table of the session."""
        name = "cardweave_run_" + hashlib.md5(f"{run.path} {run.buckets}".encode()).hexdigest()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._kept(table, run))
        keys = ", ".join(f"`{k}`" for k in table.key)
        location = run.path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                       f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {run.buckets} BUCKETS LOCATION '{location}'")
        rows = self.spark.read.table(name)
        return rows if run.batch is None else rows.withColumn("batch_id", F.lit(run.batch).cast("long"))

    def read(self, name: str, runs: Sequence[Run] | None = None) -> DataFrame:
        """All rows of a table as of the newest snapshot, with ``batch_id``."""
        table = self.tables[name]
        runs = self.snapshot().runs.get(name, ()) if runs is None else runs
        if not runs:
            return self.spark.createDataFrame([], T.StructType([*table.schema, T.StructField("batch_id", T.LongType())]))
        return reduce(DataFrame.unionByName, [self._rows(table, r) for r in runs])

    @staticmethod
    def _kept(table: KeyedTable, run: Run) -> T.StructType:
        return table.schema if run.batch is not None else T.StructType([*table.schema, T.StructField("batch_id", T.LongType())])

    def _rows(self, table: KeyedTable, run: Run) -> DataFrame:
        """A run as plain files, whose layout promises nothing."""
        rows = self.spark.read.schema(self._kept(table, run)).parquet(run.path)
        return rows if run.batch is None else rows.withColumn("batch_id", F.lit(run.batch).cast("long"))

    def asked(self, snapshot: Snapshot, name: str) -> Asked:
        return Asked(self, self.tables[name], snapshot.runs.get(name, ()))


@dataclass(frozen=True)
class Asked:
    """A table as of a snapshot that is read by key only."""

    store: Store
    table: KeyedTable
    runs: tuple[Run, ...]

    def rows(self, keys: DataFrame) -> DataFrame:
        """Rows under the given keys (columns of the table's key), without ``batch_id``.

        Each run is joined in its own buckets; equal numbers of buckets share the
        shuffle of the keys. What was found is dealt by key, so that nothing that
        follows relies on the layout of several runs put together.
        """
        wanted = keys.select(*self.table.key)
        if not self.runs:
            return self.store.read(self.table.name, ()).drop("batch_id")
        parts = [self.store._table(self.table, run).join(wanted, list(self.table.key), "left_semi") for run in self.runs]
        found = reduce(DataFrame.unionByName, parts).repartition(*self.table.key)
        return (self.table.newest(found) if self.table.newest else found).drop("batch_id")


def rows_under(table: DataFrame | Asked, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of a stored table under the given keys."""
    return table.rows(keys) if isinstance(table, Asked) else table.join(keys, list(on), "left_semi")
