"""Tables in version folders, published by one manifest per export.

Under an output folder, the tables of a run go to a folder of their own,
``_versions/<export>/<version>/<table>``, where no reader looks.  One small
file, ``_commits/<export>/<number>.json``, then names the version of each
table, and that publishes all of them together: a reader takes the newest whole
manifest, so it sees all tables of one run or all of the run before.  Nothing is
renamed or replaced, so this holds on stores without an atomic rename; a
manifest that was cut off does not parse and counts as not written.

A table that a run leaves alone (no rows, ``on_empty="keep"``) keeps the version
that it had.  The manifests of the newest ``KEEP`` commits and their versions
stay, so a reader that opened a table just before goes on; older ones are
removed, and so are versions that were never published, a day later.

One publisher per export at a time: creating the manifest fails if its number
is taken, where the store can tell.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sinks import _checked, filesystem

KEEP = 2
ORPHAN_HOURS = 24


@dataclass(frozen=True)
class Manifest:
    number: int
    tables: dict[str, str]                    # table -> its folder below the export's versions
    columns: dict[str, str] = field(default_factory=dict)   # table -> schema as JSON


class Store:
    """The tables under one output folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.fs, self._path = filesystem(spark, self.root)

    # -- layout
    def _commits(self, export: str) -> str:
        return f"{self.root}/_commits/{export}"

    def _versions(self, export: str) -> str:
        return f"{self.root}/_versions/{export}"

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(e.getPath().getName() for e in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def exports(self) -> list[str]:
        return self._names(f"{self.root}/_commits")

    # -- manifests
    def _read(self, export: str, name: str) -> Manifest | None:
        path = self._path(f"{self._commits(export)}/{name}")
        stream = self.fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            said = json.loads(text)
            return Manifest(int(name.removesuffix(".json")), said["tables"], said["columns"])
        except (ValueError, KeyError):        # cut off
            return None

    def _numbers(self, export: str) -> list[str]:
        return [n for n in self._names(self._commits(export)) if n.endswith(".json") and n[0] != "."]

    def manifests(self, export: str) -> list[Manifest]:
        """The whole manifests, newest first."""
        return [m for m in (self._read(export, n) for n in reversed(self._numbers(export))) if m]

    def current(self, export: str) -> Manifest | None:
        for name in reversed(self._numbers(export)):
            if m := self._read(export, name):
                return m
        return None

    # -- reading
    def location(self, export: str, table: str) -> str | None:
        m = self.current(export)
        return f"{self._versions(export)}/{m.tables[table]}" if m and table in m.tables else None

    def read(self, export: str, table: str) -> DataFrame:
        m = self.current(export)
        if m is None or table not in m.tables:
            raise FileNotFoundError(f"{self.root}: {export} has published no table {table!r}")
        declared = StructType.fromJson(json.loads(m.columns[table]))
        return self.spark.read.schema(declared).parquet(f"{self._versions(export)}/{m.tables[table]}")

    def schema(self, export: str, table: str) -> StructType:
        """The schema of a table, or of one written in parts."""
        m = self.current(export)
        return StructType.fromJson(json.loads(m.columns[table]))

    def locations(self) -> dict[str, str]:
        """table -> folder of its published version, of all exports."""
        return {t: f"{self._versions(e)}/{v}" for e in self.exports() for t, v in (
            self.current(e) or Manifest(0, {})).tables.items()}

    # -- writing
    def begin(self, export: str) -> "Version":
        return Version(self, export, f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}")

    def _publish(self, export: str, tables: dict[str, str], columns: dict[str, str]) -> Manifest:
        numbers = self._numbers(export)
        number = int(numbers[-1].removesuffix(".json")) + 1 if numbers else 1
        text = json.dumps({"tables": tables, "columns": columns})
        stream = self.fs.create(self._path(f"{self._commits(export)}/{number:012d}.json"), False)   # fails if it exists
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return Manifest(number, tables, columns)

    def expire(self, export: str) -> None:
        """Remove what no manifest that is kept names."""
        whole = self.manifests(export)
        kept = {v.partition("/")[0] for m in whole[:KEEP] for v in m.tables.values()}
        published = {v.partition("/")[0] for m in whole for v in m.tables.values()}
        old = (time.time() - ORPHAN_HOURS * 3600) * 1000
        for v in self._names(self._versions(export)):
            if v not in kept and (v in published or int(v.partition("-")[0]) < old):
                self.fs.delete(self._path(f"{self._versions(export)}/{v}"), True)
        least = whole[KEEP - 1].number if len(whole) >= KEEP else 0
        for n in self._numbers(export):
            if int(n.removesuffix(".json")) < least:
                self.fs.delete(self._path(f"{self._commits(export)}/{n}"), False)


class Version:
    """The tables of one run, until they are published."""

    def __init__(self, store: Store, export: str, name: str) -> None:
        self.store, self.export, self.name = store, export, name
        self.folders: dict[str, str] = {}
        self.parts: set[str] = set()          # names of parts of tables
        self.rows: dict[str, int] = {}
        self.columns: dict[str, str] = {}

    def path(self, table: str) -> str:
        return f"{self.store._versions(self.export)}/{self.folders.get(table, f'{self.name}/{table}')}"

    def add(self, table: str, df: DataFrame) -> int:
        """Compute ``df`` once, into this version; the number of its rows."""
        rows = Observation(f"rows-{uuid.uuid4().hex}")
        df.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(self.path(table))
        self.rows[table], self.columns[table] = rows.get["n"], df.schema.json()
        return self.rows[table]

    def add_split(self, rows: DataFrame, tag: str, counts: Callable[[], dict[str, int]], schemas: dict[str, StructType]) -> None:
        """Write tagged rows of several tables in one job, a folder for each
        tag; ``counts`` tells the rows of each, as observed on the way."""
        spark, writers = self.store.spark, "spark.sql.maxConcurrentOutputFileWriters"
        before = spark.conf.get(writers, None)
        spark.conf.set(writers, str(len(schemas) + 1))      # a file open for each table, instead of a sort by table
        try:
            rows.write.mode("overwrite").partitionBy(tag).parquet(f"{self.store._versions(self.export)}/{self.name}/split")
        finally:
            spark.conf.unset(writers) if before is None else spark.conf.set(writers, before)
        for table, schema in schemas.items():
            self.rows[table], self.columns[table] = counts()[table], schema.json()
            if self.rows[table]:
                self.folders[table] = f"{self.name}/split/{tag}={table}"
            else:
                spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(self.path(table))

    def folder(self, table: str) -> str:
        return f"{self.store._versions(self.export)}/{self.name}/{table}"

    def add_parts(self, table: str, rows: DataFrame, by: str, parts: list[tuple[str, str]], gathered: bool = False) -> None:
        """Write a table in parts, a folder for each value of the column
        ``by``; ``parts`` are the names that the manifest gives the parts, with
        their values.  A part without rows has no folder and is dropped.
        ``gathered`` rows are partitioned by ``by`` already."""
        (rows if gathered else rows.repartition(by)).write.mode("overwrite").partitionBy(by).parquet(self.folder(table))
        there = set(self.store._names(self.folder(table)))
        schema = StructType([f for f in rows.schema.fields if f.name != by])
        self.columns[table] = schema.json()
        for name, value in parts:
            self.parts.add(name)
            self.rows[name] = 1 if f"{by}={value}" in there else 0
            self.folders[name] = f"{self.name}/{table}/{by}={value}"

    def publish(self, on_empty: str = "keep", always: tuple[str, ...] = ()) -> dict[str, bool]:
        """Make all tables of the run current at once; by table, whether it was
        replaced.  Empty ones stay as they were if ``on_empty`` is ``keep``, but
        for those named in ``always``."""
        _checked(on_empty)
        before = self.store.current(self.export) or Manifest(0, {})
        new = {t: on_empty == "replace" or n > 0 or t in always for t, n in self.rows.items()}
        tables = before.tables | {t: self.folders.get(t, f"{self.name}/{t}") for t, yes in new.items() if yes}
        tables = {t: f for t, f in tables.items() if t not in self.rows or self.rows[t] or t not in self.parts}
        columns = before.columns | {t: s for t, s in self.columns.items() if new.get(t, True) and t not in self.parts}
        if any(new.values()):
            self.store._publish(self.export, tables, columns)
            self.store.expire(self.export)
        else:
            self.discard()
        return new

    def discard(self) -> None:
        self.store.fs.delete(self.store._path(f"{self.store._versions(self.export)}/{self.name}"), True)
