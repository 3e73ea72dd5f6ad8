"""Helpers every operator here uses: column picking, written intermediates and
native word splitting."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.session import checkpoint_root, settings

#: Runs of these characters separate words (space, tab to carriage return).
BLANKS = r"[\x20\x09-\x0D]+"


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns renamed by position, and the original names.
    Names that clash (also by case alone) can then be told apart."""
    names = df.columns
    return df.toDF(*[f"_in{i}" for i in range(len(names))]), names


def column_of(names: list[str], wanted: str) -> str:
    """The positional name of ``wanted``: the exact name first, then one that
    differs by case only."""
    for same in (lambda n: n == wanted, lambda n: n.lower() == wanted.lower()):
        for i, n in enumerate(names):
            if same(n):
                return f"_in{i}"
    raise ValueError(f"no column {wanted!r} among {names}")


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns, as ``new_name="column"``, by exact name."""
    pos, names = positional(df)
    return pos.select(*[F.col(column_of(names, src)).alias(new) for new, src in wanted.items()])


#: Scratch tables made since each open scope began, the innermost scope last.
_SCOPES: list[list[str]] = []


@contextmanager
def scope() -> Iterator[list[str]]:
    """The paths of the scratch tables that are made inside, for :func:`sweep`."""
    _SCOPES.append([])
    try:
        yield _SCOPES[-1]
    finally:
        _SCOPES.pop()


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back.  The lineage is cut, so a lost executor costs only tasks over the
    written files, and the shuffle files of the job that made it go at once.
    The table stays until :func:`drop`, until the :func:`sweep` of the scope it
    was made in (not with ``keep``), or until the cluster cleans that folder."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.option("compression", "zstd").parquet(path)
    if _SCOPES and not keep:
        _SCOPES[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def drop(*tables: DataFrame) -> None:
    """Remove written tables whose results have been written in turn."""
    for t in tables:
        for held in _SCOPES:
            if t.scratch_path in held:
                held.remove(t.scratch_path)
        _delete(t.sparkSession, t.scratch_path)


def sweep(spark: SparkSession, paths: list[str]) -> None:
    """Remove the tables of a scope.  Only for callers that know that all
    results built on them have been written."""
    while paths:
        _delete(spark, paths.pop())


def words_of(text: Column) -> Column:
    """The words of a text as an array (null text: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), "")
