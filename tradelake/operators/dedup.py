"""De-duplication operators.

Keep-first (O9) needs record order, which Spark does not have after a shuffle,
so every row carries its reference columns (``_ord`` + positions) and "first"
means smallest reference tuple.  ``row_number() = 1`` over the key is planned
by Catalyst as a ``WindowGroupLimit``: a partial top-1 per key runs *before* the
shuffle, so a hot key (or the NULL key, which groups like any value) ships at
most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``key`` (NULLs equal each other), the first by ``order``."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Whole-row de-duplication over ``columns`` (partial aggregation
    map-side, so duplicates collapse before the shuffle)."""
    return df.dropDuplicates(list(columns))


def drop_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``columns`` is NULL (after coercion)."""
    return df.dropna(subset=list(columns)) if columns else df
