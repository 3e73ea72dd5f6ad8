"""Landed JSON exports (S1, S2, S3, S5) -> nested documents -> :class:`Export`.

* JSON Lines (S1/S2): one document per line; splittable, so the scan
  parallelises by file split.
* Envelope (S3): one response object per file with the records under a key,
  read in byte ranges (:mod:`.envelope`).

Nothing that fails to parse passes as data: a broken line, a broken envelope or
a value of the wrong type (a number where a list holds objects) leaves its text
in ``_corrupt_record``.  The pipelines count these and refuse the export.

Record order is (``_ord`` if the documents have it, file, place of the split in
the file, place in the split), so it is defined without ``_ord``, and files
that each count from 1 do not get mixed up.  A child list stays an array column
of its document and is exploded from the surviving row; list elements that are
NULL are dropped (they would explode to all-NULL rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from .envelope import read_records
from .export import Export, Frame
from .registry import ENVELOPE_KEYS, document_schema, line_schema

CORRUPT = "_corrupt_record"

# Where an export's documents hold the date that a refresh window
# asks for (S5), as list field and field of its elements.
WINDOW_DATES = {"visit": ("visit_headers", "visit_date")}
WINDOW_DAYS = 7


def _reader(spark: SparkSession, schema: StructType):
    return (spark.read.schema(StructType([*schema.fields]).add(CORRUPT, StringType()))
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))


def read_lines(spark: SparkSession, source: str, path: str | list[str]) -> DataFrame:
    """JSON Lines with a declared nested schema.  Spark does not read a file
    for its broken lines alone, so their text comes with (nothing of) ``_ord``."""
    raw = _reader(spark, line_schema(source)).json(path)
    nothing = F.substring(F.coalesce(F.col("_ord").cast("string"), F.lit("")), 0, 0)
    raw = raw.withColumn(CORRUPT, F.concat(F.col(CORRUPT), nothing))
    return raw.select("*", F.col("_metadata.file_path").alias("_ord_f"),
                      F.col("_metadata.file_block_start").alias("_ord_g"))


def read_envelopes(spark: SparkSession, source: str, path: str) -> DataFrame:
    """S3: the records of response envelopes, whatever their size: a file is
    read in byte ranges.  What is broken stays as a row with its text."""
    return read_records(spark, path, ENVELOPE_KEYS[source], document_schema(source), CORRUPT)


def in_order(docs: DataFrame) -> DataFrame:
    """Give every row its place in its split.  Call it on the rows as read,
    after any filter; the place is fixed once the rows are written."""
    if "_ord_g" not in docs.columns or "_ord_h" in docs.columns:
        return docs
    return docs.withColumn("_ord_h", F.monotonically_increasing_id())


def _between(day: Column, as_of: str, days: int) -> Column:
    last = F.current_date() if as_of == "today" else F.to_date(F.lit(as_of))
    return (day >= F.date_sub(last, days)) & (day <= last)


def date_window(df: DataFrame, column: str, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    """Keep documents with ``column`` in [as_of - days, as_of] (``as_of``: a
    date or ``today``).  On a landing partitioned by ``column`` this is a
    partition filter (pruned at planning)."""
    return df.where(_between(F.try_to_date(F.col(column)), as_of, days))


def window(df: DataFrame, source: str, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    """S5 for an export that is asked for by date (others pass as they are): a
    document is kept if one of its headers has a date in the window.  A landing
    that is partitioned by the date is pruned by it instead.  Rows that did not
    parse are kept: they have to be reported."""
    if source not in WINDOW_DATES:
        return df
    headers, column = WINDOW_DATES[source]
    if column in df.columns:
        return date_window(df, column, as_of, days)
    inside = F.exists(F.col(headers), lambda h: _between(F.try_to_date(h[column]), as_of, days))
    return df.where(inside | F.col(CORRUPT).isNotNull()) if CORRUPT in df.columns else df.where(inside)


def flatten(source: str, docs: DataFrame, refs: tuple[str, ...] | None = None) -> Export:
    """Nested documents -> one frame per nesting path, each with its lists."""
    refs = refs or tuple(sorted(c for c in docs.columns if c.startswith("_ord")))
    if CORRUPT in docs.columns:
        docs = docs.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    exp = Export(source)

    def walk(df: DataFrame, st: StructType, path: str, rf: tuple[str, ...], depth: int):
        scalars = [f.name for f in st.fields if not isinstance(f.dataType, ArrayType)]
        arrays = [f for f in st.fields if isinstance(f.dataType, ArrayType)]
        exp.frames[path] = Frame(df.select(*rf, *scalars, *[a.name for a in arrays]), rf,
                                 tuple(a.name for a in arrays))
        for a in arrays:
            pos = f"_p{depth + 1}"
            child = (df.select(*rf, F.posexplode(F.col(a.name)).alias(pos, "_e"))
                       .where(F.col("_e").isNotNull())
                       .select(*rf, pos, "_e.*"))
            walk(child, a.dataType.elementType, f"{path}.{a.name}" if path else a.name,
                 rf + (pos,), depth + 1)

    walk(docs, document_schema(source), "", refs, 0)
    return exp


def land_json(spark: SparkSession, source: str, path: str, envelope: bool = False) -> Export:
    docs = read_envelopes(spark, source, path) if envelope else read_lines(spark, source, path)
    return flatten(source, in_order(docs))
