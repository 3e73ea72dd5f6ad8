"""Refresh on landing: Structured Streaming over the export landing directory.

The reference refreshes every table from the newest export on a daily
schedule.  Spark-native form: a file-stream source watches
``{landing}/{source}``, and ``foreachBatch`` runs the full table refresh through
the same :func:`~tradelake.plans.pipelines.refresh` as a batch run.

*One directory per export* (``export=<sortable id>``, with the marker
``_SUCCESS`` written last).  New files only say that something has landed.  The
refresh takes the newest directory that is complete, reads all of it, not just
the unseen files, and remembers its id, so an export that arrives late or in
pieces never replaces newer tables nor part of its own.  A marker that comes
after the last data file is found by the next run.

*A flat landing* is one export per run: the documents of all files that landed
since the previous run.

``trigger(availableNow=True)`` processes what has landed and stops, so a
scheduler can start it daily; the stream checkpoint (under
``spark.checkpoint.dir``) records which files were already processed.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..plans import pipelines
from ..session import ensure_checkpoint_dir, tune_session
from ..sources import jsonsrc
from ..sources.registry import line_schema
from ..sources.sinks import filesystem

# Partition column of a landing with one directory per export (export=<id>).
EXPORT_COLUMN = "export"
COMPLETE = "_SUCCESS"


def complete_exports(spark: SparkSession, landing: str) -> list[str]:
    """Ids of the export directories that have their marker, in order."""
    fs, jpath = filesystem(spark, landing)
    if not fs.exists(jpath(landing)):
        return []
    found = []
    for entry in fs.listStatus(jpath(landing)):
        name = entry.getPath().getName()
        if entry.isDirectory() and name.startswith(f"{EXPORT_COLUMN}=") and \
                fs.exists(jpath(entry.getPath(), COMPLETE)):
            found.append(name.partition("=")[2])
    return sorted(found)


def _last(spark: SparkSession, state: str) -> str | None:
    """The newest id that a refresh has finished with (an empty directory per id)."""
    fs, jpath = filesystem(spark, state)
    if not fs.exists(jpath(state)):
        return None
    return max((e.getPath().getName() for e in fs.listStatus(jpath(state))), default=None)


def refresh_newest(spark: SparkSession, source: str, landing: str, out_root: str, state: str, **kw) -> str | None:
    """Refresh from the newest complete export if it is newer than the last
    one; returns its id, or None if there is nothing to do."""
    ready, last = complete_exports(spark, landing), _last(spark, state)
    if not ready or (last is not None and ready[-1] <= last):
        return None
    pipelines.run(spark, source, f"{landing.rstrip('/')}/{EXPORT_COLUMN}={ready[-1]}", out_root, **kw)
    fs, jpath = filesystem(spark, state)
    fs.mkdirs(jpath(f"{state}/{ready[-1]}"))
    return ready[-1]


def refresh_on_landing(spark: SparkSession, source: str, landing: str, out_root: str,
                       *, available_now: bool = True, on_empty: str = "keep",
                       checkpoint: str | None = None, as_of: str | None = None):
    """Start the refresh stream for ``source``; returns the StreamingQuery."""
    tune_session(spark)
    # one stream = (export, landing directory): its file log lives with it
    key = hashlib.sha1(landing.rstrip("/").encode()).hexdigest()[:16]
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{source}-{key}"
    state = f"{ckpt.rstrip('/')}-exports"
    schema = line_schema(source).add(EXPORT_COLUMN, StringType()).add(jsonsrc.CORRUPT, StringType())
    stream = spark.readStream.schema(schema).option("columnNameOfCorruptRecord", jsonsrc.CORRUPT).json(landing)
    stream = stream.select("*", F.col("_metadata.file_path").alias("_ord_f"),
                           F.col("_metadata.file_block_start").alias("_ord_g"))
    options = {"on_empty": on_empty, "as_of": as_of}
    refresh_newest(spark, source, landing, out_root, state, **options)   # completed since the last run

    def refresh_batch(batch: DataFrame, batch_id: int) -> None:
        by_export, flat = batch.agg(F.count(EXPORT_COLUMN), F.count_if(F.col(EXPORT_COLUMN).isNull())).first()
        if by_export:
            refresh_newest(batch.sparkSession, source, landing, out_root, state, **options)
        if flat:
            docs = batch.where(F.col(EXPORT_COLUMN).isNull()).drop(EXPORT_COLUMN)
            docs = jsonsrc.window(docs, source, as_of) if as_of else docs
            pipelines.refresh(batch.sparkSession, source, docs, out_root,
                              bronze_key=f"{landing.rstrip('/')}#stream", on_empty=on_empty)

    w = stream.writeStream.foreachBatch(refresh_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 day")
    return w.start()
