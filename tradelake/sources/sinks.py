"""Sinks: full-refresh table write (S6/S7) and the per-table file copy.

The reference drops and recreates each table, and keeps the previous table when
a run produced no rows.  Here the table is computed **once**: it is staged
beside the target while an ``observe``d counter counts its rows, then swapped
in (or dropped when empty).  The swap moves the previous table aside before the
new one takes its place, so at no moment is there no copy of it: a run that is
killed in between is completed by the next :func:`recover` (every write starts
with one, and :func:`read_table` reads whichever copy is whole).  On an object
store, where a rename copies, use a catalog table (``table=``) of a format that
replaces atomically.

The spreadsheet copy is re-aimed to a distributed CSV directory with a header
(one file per task, no single-writer bottleneck).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

STAGING, PREVIOUS = ".__staging", ".__previous"


def filesystem(spark: SparkSession, path: str):
    """(Hadoop FileSystem, Path class) for ``path``."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    return jpath(path).getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def _checked(on_empty: str) -> None:
    if on_empty not in ("keep", "replace"):
        raise ValueError(on_empty)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a swap that was interrupted: without a table at ``path`` the one
    moved aside comes back; beside a table it is left over and goes."""
    fs, jpath = filesystem(spark, path)
    target, previous = jpath(path), jpath(path.rstrip("/") + PREVIOUS)
    if fs.exists(previous):
        if fs.exists(target):
            fs.delete(previous, True)
        else:
            _move(fs, previous, target)


def _move(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"could not move {source} to {target}")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``, also while a swap is under way."""
    fs, jpath = filesystem(spark, path)
    aside = path.rstrip("/") + PREVIOUS
    return spark.read.format(fmt).load(path if fs.exists(jpath(path)) or not fs.exists(jpath(aside)) else aside)


@dataclass
class Staged:
    """A table that is computed and written, but not swapped in yet."""
    spark: SparkSession
    path: str
    rows: int

    def commit(self, on_empty: str = "keep") -> bool:
        """Swap it in; with no rows and ``on_empty="keep"`` keep the old one."""
        _checked(on_empty)
        fs, jpath = filesystem(self.spark, self.path)
        base = self.path.rstrip("/")
        target, staged, previous = jpath(self.path), jpath(base + STAGING), jpath(base + PREVIOUS)
        if self.rows == 0 and on_empty == "keep":
            fs.delete(staged, True)
            return False
        if fs.exists(target):
            _move(fs, target, previous)
        _move(fs, staged, target)
        fs.delete(previous, True)
        return True

    def discard(self) -> None:
        fs, jpath = filesystem(self.spark, self.path)
        fs.delete(jpath(self.path.rstrip("/") + STAGING), True)


def stage_table(df: DataFrame, path: str, fmt: str = "parquet") -> Staged:
    spark = df.sparkSession
    recover(spark, path)
    rows = Observation(f"rows-{uuid.uuid4().hex}")
    (df.observe(rows, F.count(F.lit(1)).alias("n"))
       .write.mode("overwrite").format(fmt).save(path.rstrip("/") + STAGING))
    return Staged(spark, path, rows.get["n"])


def _scratch(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written once to the shared scratch folder, and its row count."""
    path = f"{checkpoint_root(df.sparkSession).rstrip('/')}/sink/{uuid.uuid4().hex}"
    rows = Observation(f"rows-{uuid.uuid4().hex}")
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), rows.get["n"]


def write_table(df: DataFrame, path: str | None = None, *, table: str | None = None,
                on_empty: str = "keep", fmt: str = "parquet") -> bool:
    """S6 + S7.  Returns True when something was written.

    ``on_empty="keep"`` leaves the previous output in place when ``df`` has no
    rows (the reference's rule); ``"replace"`` writes the empty table."""
    _checked(on_empty)
    if table is None:
        return stage_table(df, path, fmt).commit(on_empty)
    if on_empty == "keep":
        df, n = _scratch(df)
        if n == 0:
            return False
    df.write.mode("overwrite").format(fmt).saveAsTable(table)
    return True


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               on_empty: str = "keep", connections: int = 8, batch_size: int = 10_000) -> bool:
    """S7 for a relational target: drop-and-recreate through JDBC, with at most
    ``connections`` parallel writers.  The rows are computed once, to the
    shared scratch folder.  Needs the driver jar on the classpath."""
    _checked(on_empty)
    df, n = _scratch(df)
    if n == 0 and on_empty == "keep":
        return False
    (df.write.mode("overwrite").option("numPartitions", connections).option("batchsize", batch_size)
       .jdbc(url, table, properties=properties or {}))
    return True


def write_csv_copy(df: DataFrame, path: str) -> None:
    """Human-readable copy of a table (header row, written even when empty)."""
    df.write.mode("overwrite").option("header", True).csv(path)
