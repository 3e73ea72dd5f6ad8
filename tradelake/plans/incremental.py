"""O9 as keyed state: further files of an export update its tables in place.

The state of an export is its surviving documents with their lists, spread over
``BUCKETS`` buckets by the hash of their key.  A batch of documents is
de-duplicated by itself; then only the buckets that it touches are read, merged
with it (the first in record order wins, whichever came first) and written
anew, together with the buckets of the child tables: a child's rows are in the
bucket of their document, so they are built from the merged documents of that
bucket alone.  One manifest publishes all of them at once
(:mod:`..sources.versions`), so a reader sees each batch whole or not at all.

Record order is (``_ord``, file, place in the file), so it does not depend on
how files are put together to batches: any split of an export gives the tables
that a single run gives, and a file that is applied again changes nothing.

Exports whose tables de-duplicate nothing (visits) have no state: the rows of a
batch are a part of their own.  There a file must not be applied twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import keep_first
from ..session import checkpoint_root, tune_session
from ..sources import jsonsrc
from ..sources.versions import Store, Version
from .build import build_with_refs, lists_of, loses_rows, output_columns
from .specs import PIPELINES, SPEC_BY_NAME, SPECS, TableSpec

BUCKETS = 64
STATE = "state"
BUCKET = "bucket"


def _root(source: str) -> TableSpec:
    """The table of the export's documents."""
    return next(s for s in SPECS if s.source == source and s.path == "")


def keyed(source: str) -> bool:
    """Are the documents de-duplicated by a key that all tables carry?"""
    root = _root(source)
    return root.key is not None and all(
        name == root.name or set(root.key) <= set(SPEC_BY_NAME[name].inherited) for name in PIPELINES[source])


def _bucket(key: tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _part(table: str, bucket: int | str) -> str:
    return f"{table}/{BUCKET}={bucket}"


class Incremental:
    """The tables of an export under ``root``, updated batch by batch."""

    def __init__(self, spark: SparkSession, source: str, root: str, buckets: int = BUCKETS) -> None:
        tune_session(spark)
        self.spark, self.source, self.buckets = spark, source, buckets
        self.store = Store(spark, root)
        self.by_key = keyed(source)
        if not self.by_key and any(loses_rows(SPEC_BY_NAME[n]) for n in PIPELINES[source]):
            raise ValueError(f"{source}: tables de-duplicate by other keys than their documents'; refresh it whole")

    # -- reading
    def _parts(self, table: str, buckets: set[int] | None = None) -> list[str]:
        current = self.store.current(self.source)
        found = []
        for name, folder in (current.tables if current else {}).items():
            of, _, bucket = name.rpartition(f"/{BUCKET}=")
            if of == table and (buckets is None or int(bucket) in buckets):
                found.append(f"{self.store._versions(self.source)}/{folder}")
        return sorted(found)

    def read(self, table: str) -> DataFrame | None:
        """The table as it is now; None before the first batch with rows."""
        paths = self._parts(table)
        if not paths:
            return None
        return self.spark.read.schema(self.store.schema(self.source, table)).parquet(*paths)

    # -- updating
    def apply(self, docs: DataFrame) -> list[int]:
        """Update the tables by the documents ``docs`` (as the readers of
        :mod:`..sources.jsonsrc` give them); the buckets that changed."""
        bronze = f"{checkpoint_root(self.spark).rstrip('/')}/incremental/{uuid.uuid4().hex}"
        jsonsrc.in_order(docs).write.option("compression", "zstd").parquet(f"{bronze}/docs")     # the places of the rows are fixed here
        docs = self.spark.read.parquet(f"{bronze}/docs")
        export = jsonsrc.flatten(self.source, docs)
        version = self.store.begin(self.source)
        if not self.by_key:
            return self._append(export, version)
        root = _root(self.source)
        new, refs = build_with_refs(export, root.name, {}, lists_of(export, root.name))
        new = new.withColumn(BUCKET, _bucket(root.key, self.buckets))
        new.write.option("compression", "zstd").parquet(f"{bronze}/new")
        new = self.spark.read.schema(new.schema).parquet(f"{bronze}/new")
        touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())     # BUCKETS numbers at most
        if not touched:
            return []
        before = self._parts(STATE, set(touched))
        rows = new
        if before:
            columns = [c for c in new.columns if c != BUCKET]
            old = self.spark.read.schema(new.select(columns).schema).parquet(*before)
            rows = rows.unionByName(old.withColumn(BUCKET, _bucket(root.key, self.buckets)))
            # a key is in one bucket: shuffled once, by bucket, they are merged and written
            rows = keep_first(rows.repartition(BUCKET), [BUCKET, *root.key], refs)
        self._write(version, STATE, rows, touched, gathered=bool(before))
        state = self.spark.read.schema(new.schema).parquet(version.folder(STATE))
        memo = {root.name: (state.drop(BUCKET), refs)}
        for name in PIPELINES[self.source]:
            table = build_with_refs(export, name, memo)[0].select(*output_columns(name))
            self._write(version, name, table.withColumn(BUCKET, _bucket(root.key, self.buckets)), touched)
        version.publish("replace")
        return touched

    def _write(self, version: Version, table: str, rows: DataFrame, touched: list[int], gathered: bool = False) -> None:
        version.add_parts(table, rows, BUCKET, [(_part(table, b), str(b)) for b in touched], gathered)

    def _append(self, export, version: Version) -> list[int]:
        number = (self.store.current(self.source).number if self.store.current(self.source) else 0) + 1
        for name in PIPELINES[self.source]:
            table = build_with_refs(export, name, {})[0].select(*output_columns(name))
            self._write(version, name, table.withColumn(BUCKET, F.lit(number)), [number])
        version.publish("replace")
        return [number]
