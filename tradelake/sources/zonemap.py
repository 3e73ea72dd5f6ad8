"""Zone map of a landing: the first and last date of each file.

An export that is asked for by date (visits) lands in files that are not
partitioned by it.  Beside the landing, in ``_zones``, a short row per file keeps
the first and last date of its documents, and whether anything in it did not
parse.  A window then opens only files that overlap it, and those with broken
records, which have to be reported.

Rows hold for a file of the same path, size and modification time; files that
are new or have changed are read once, by the run that first meets them.
Listing reads no file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from . import jsonsrc
from .registry import line_schema
from .sinks import filesystem

ZONES = "_zones"
_SCHEMA = "file string, size long, modified timestamp, first date, last date, corrupt long"
_SAME = ["file", "size", "modified"]


def _files(spark: SparkSession, landing: str) -> DataFrame:
    """The files of the landing; their content is not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                    F.col("_metadata.file_modification_time").alias("modified")))


def _scan(spark: SparkSession, source: str, files: DataFrame, paths: list[str]) -> DataFrame:
    """A row of the zone map for each of ``files``."""
    headers, column = jsonsrc.WINDOW_DATES[source]
    docs = jsonsrc.read_lines(spark, source, paths)
    days = F.transform(F.col(headers), lambda h: F.try_to_date(h[column]))
    seen = docs.groupBy(F.col("_ord_f").alias("file")).agg(
        F.min(F.array_min(days)).alias("first"), F.max(F.array_max(days)).alias("last"),
        F.count_if(F.col(jsonsrc.CORRUPT).isNotNull()).alias("corrupt"))
    return files.join(seen, "file", "left").select(*_SAME, "first", "last", F.coalesce("corrupt", F.lit(0)).alias("corrupt"))


def refreshed(spark: SparkSession, source: str, landing: str, zones: str | None = None) -> DataFrame:
    """The landing's zone map, complete for the files that are there now."""
    where = zones or f"{landing.rstrip('/')}/{ZONES}"
    fs, jpath = filesystem(spark, where)
    files = _files(spark, landing)

    def known() -> DataFrame:
        if not fs.exists(jpath(where)):
            return spark.createDataFrame([], _SCHEMA)
        # two runs may have met the same file
        return spark.read.schema(_SCHEMA).parquet(where).dropDuplicates(_SAME)

    new = files.join(known(), _SAME, "left_anti")
    paths = [r["file"] for r in new.select("file").collect()]     # as many as Spark's own listing holds
    if paths:
        _scan(spark, source, new, paths).coalesce(1).write.mode("append").parquet(where)
    return files.join(known(), _SAME)


def overlapping(spark: SparkSession, source: str, landing: str, as_of: str, days: int = jsonsrc.WINDOW_DAYS,
                zones: str | None = None) -> list[str]:
    """The files that a window of the landing has to open."""
    last = F.current_date() if as_of == "today" else F.to_date(F.lit(as_of))
    inside = (F.col("first") <= last) & (F.col("last") >= F.date_sub(last, days))
    rows = refreshed(spark, source, landing, zones).where(inside | (F.col("corrupt") > 0))
    return sorted(r["file"] for r in rows.select("file").collect())


def read_window(spark: SparkSession, source: str, landing: str, as_of: str, days: int = jsonsrc.WINDOW_DAYS,
                zones: str | None = None) -> DataFrame:
    """The documents of the landing with a date in the window, and the records
    that did not parse; other files are not opened."""
    paths = overlapping(spark, source, landing, as_of, days, zones)
    if not paths:
        schema = StructType([*line_schema(source).fields]).add(jsonsrc.CORRUPT, StringType()).add("_ord_f", StringType()).add("_ord_g", LongType())
        return spark.createDataFrame([], schema)
    return jsonsrc.window(jsonsrc.read_lines(spark, source, paths), source, as_of, days)
