"""Pipelines (one per export, SURVEY §2.4) and the three job groups.

``run(spark, source, landing, out_root)``:

1. read the landed export with its declared schema (JSON Lines or envelopes),
   the visit export optionally restricted to its date window (S5);
2. write the nested documents once to a bronze Parquet copy under the
   cluster's checkpoint directory, so the export is parsed once and every
   table reads only the nested columns it needs; the same pass counts what did
   not parse, and an export with any such record is refused;
3. stop when the export is empty (S6) — nothing is replaced (steps 2-6 are
   :func:`refresh`, shared with the landing stream);
4. parents that are de-duplicated are written once with the lists of their
   surviving documents; every child explodes from there, so what remains of a
   child is its own keep-first.  Parents that lose no row (visits) are not
   written: their children are narrow reads of the bronze copy;
5. write every table of the export to a version folder, several at a time,
   counting what its integer casts reject (D2) in the same pass; a ``strict`` run
   stops here if there is any, with all previous tables in place.  Where no table
   loses a row (visits), all come out of one scan (:mod:`.split`);
6. publish all tables and the rejects at once (S7, keep-on-empty; see
   :mod:`..sources.versions`), write the CSV copies (S8).

:func:`read_table` reads a table that a run has published.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.measures import (BRANCH_MEASURES, MEASURES, MONTHLY_MEASURES,
                                  branch_totals, monthly_branch_sales)
from ..session import checkpoint_root, ensure_checkpoint_dir, tune_session
from ..sources import jsonsrc, zonemap
from ..sources.sinks import filesystem, write_csv_copy
from ..sources.versions import Store, Version
from .build import build_with_refs, cast_columns, lists_of, loses_rows, output_columns
from .split import TAG, in_one_pass, reject_counts, row_counts, schema_of, split, typed
from .specs import JOB_GROUPS, PIPELINES, SPEC_BY_NAME, SPECS

#: Jobs that are submitted at a time (tables of an export, exports of a group).
PARALLEL = 4

REJECTS = "table string, column string, n_rejects long"

#: Export name under which the measures are published.
MEASURES_EXPORT = "measures"


def _export_of(name: str) -> str:
    if name in SPEC_BY_NAME:
        return SPEC_BY_NAME[name].source
    return name.removeprefix("rejects/") if name.startswith("rejects/") else MEASURES_EXPORT


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A published table under ``root``: one of the 64, a measure, or
    ``rejects/<export>``.  A folder ``root/name`` that other jobs have written
    is read where nothing was published."""
    store, export = Store(spark, root), _export_of(name)
    table = "rejects" if name.startswith("rejects/") else name
    if store.location(export, table):
        return store.read(export, table)
    fs, jpath = filesystem(spark, root)
    plain = f"{root.rstrip('/')}/{name}"
    if not fs.exists(jpath(plain)):
        raise FileNotFoundError(f"no table {name!r} under {root}")
    return spark.read.parquet(plain)


def _each(work: Callable, items: Iterable) -> list:
    """``work`` for each item, ``PARALLEL`` at a time; the first error raises
    when all have ended."""
    with ThreadPoolExecutor(PARALLEL) as pool:
        return [f.result() for f in [pool.submit(work, x) for x in items]]


def _has_zones(spark: SparkSession, source: str, landing: str) -> bool:
    """Is the landing one that the zone map prunes: asked for by date, and its
    folders do not tell the date already?"""
    return (source in jsonsrc.WINDOW_DATES
            and jsonsrc.WINDOW_DATES[source][1] not in jsonsrc.read_lines(spark, source, landing).columns)


def run(spark: SparkSession, source: str, landing: str, out_root: str, *,
        envelope: bool = False, as_of: str | None = None, date_column: str | None = None,
        csv_root: str | None = None, on_empty: str = "keep",
        strict: bool = False, on_corrupt: str = "raise") -> dict[str, bool]:
    """``as_of`` (a date or ``today``) limits the visit export to its window (on
    a flat landing by its zone map, so that only files of the window are read);
    with ``date_column`` it limits any export by that document column."""
    tune_session(spark)
    if as_of and not date_column and not envelope and _has_zones(spark, source, landing):
        docs = zonemap.read_window(spark, source, landing, as_of)
        return refresh(spark, source, docs, out_root, bronze_key=landing, csv_root=csv_root,
                       on_empty=on_empty, strict=strict, on_corrupt=on_corrupt)
    docs = (jsonsrc.read_envelopes(spark, source, landing) if envelope
            else jsonsrc.read_lines(spark, source, landing))
    if as_of:
        docs = (jsonsrc.date_window(docs, date_column, as_of) if date_column
                else jsonsrc.window(docs, source, as_of))
    return refresh(spark, source, docs, out_root, bronze_key=landing, csv_root=csv_root,
                   on_empty=on_empty, strict=strict, on_corrupt=on_corrupt)


Rejects = list[tuple[str, str, int]]


def _build_tables(spark: SparkSession, source: str, docs: DataFrame, version: Version, parents_root: str) -> Rejects:
    """Write each table of the export to ``version``; what its casts reject."""
    export = jsonsrc.flatten(source, docs)
    watched: dict[str, Observation] = {}

    def observed(name: str) -> Observation | None:
        if not cast_columns(name):
            return None
        watched[name] = Observation(f"{name}-{uuid.uuid4().hex}")
        return watched[name]

    # Parents are de-duplicated once and written with their child lists: lineage
    # is cut there, and a child reads back only the list and columns it needs.
    memo: dict = {}
    parents = {s.parent for s in SPECS if s.source == source and s.parent}
    for s in SPECS:                                      # specs are parent-first
        if s.source == source and s.name in parents and loses_rows(s):
            df, refs = build_with_refs(export, s.name, memo, lists_of(export, s.name), observed(s.name))
            path = f"{parents_root}/{s.name}"
            df.write.mode("overwrite").parquet(path)
            memo[s.name] = (spark.read.schema(df.schema).parquet(path), refs)

    plans = {name: build_with_refs(export, name, memo, seen=None if name in memo else observed(name))[0]
             for name in PIPELINES[source]}

    _each(lambda name: version.add(name, plans[name].select(*output_columns(name))), PIPELINES[source])
    return [(name, c, n) for name, o in watched.items() for c, n in o.get.items()]


def _split_tables(spark: SparkSession, source: str, docs: DataFrame, version: Version, _: str) -> Rejects:
    """The same in one pass over the documents, for exports that allow it."""
    if jsonsrc.CORRUPT in docs.columns:
        docs = docs.where(F.col(jsonsrc.CORRUPT).isNull())
    counts, refused = (Observation(f"{source}-{uuid.uuid4().hex}") for _ in range(2))
    rows = split(docs, source)
    wrong = reject_counts(source)
    if wrong:
        rows = rows.observe(refused, *wrong)
    rows = typed(rows, source).observe(counts, *row_counts(source))
    version.add_split(rows, TAG, lambda: counts.get, {n: schema_of(n, rows.schema) for n in PIPELINES[source]})
    return [(*name.split("."), n) for name, n in refused.get.items()] if wrong else []


def refresh(spark: SparkSession, source: str, docs: DataFrame, out_root: str, *,
            bronze_key: str, csv_root: str | None = None, on_empty: str = "keep",
            strict: bool = False, on_corrupt: str = "raise") -> dict[str, bool]:
    """Steps 2-6 for one export's documents ``docs``.  ``bronze_key`` names the
    bronze copy and the written parents (the landing directory), so a retried
    run overwrites its own copy only.  ``on_corrupt="drop"`` goes on without
    the records that did not parse."""
    if on_corrupt not in ("raise", "drop"):
        raise ValueError(on_corrupt)
    key = hashlib.sha1(bronze_key.rstrip("/").encode()).hexdigest()[:16]
    work = checkpoint_root(spark).rstrip("/")
    bronze = f"{work}/bronze/{source}-{key}"
    # one pass over the export: the bronze copy (scratch, not an output) is
    # written while its documents are counted
    docs = jsonsrc.in_order(docs)
    corrupt = F.col(jsonsrc.CORRUPT).isNotNull() if jsonsrc.CORRUPT in docs.columns else F.lit(False)
    count = Observation(f"docs-{uuid.uuid4().hex}")
    docs.observe(count, F.count(F.lit(1)).alias("n"), F.count_if(corrupt).alias("corrupt")).write.mode(
        "overwrite").parquet(bronze)
    counted = count.get
    if counted["corrupt"] and on_corrupt == "raise":
        raise ValueError(f"{source}: {counted['corrupt']} of {counted['n']} records of {bronze_key} do not parse")
    if counted["n"] == counted["corrupt"]:               # S6: no records, no table writes
        return {}
    version = Store(spark, out_root).begin(source)
    write = _split_tables if in_one_pass(source) else _build_tables
    rejected = write(spark, source, spark.read.schema(docs.schema).parquet(bronze), version, f"{work}/parents/{source}-{key}")
    if strict and any(n for _, _, n in rejected):        # D2 as the reference: refuse what it cannot type
        version.discard()
        raise ValueError("values that are not integers: " + ", ".join(
            f"{name}.{c} ({n})" for name, c, n in rejected if n))
    version.add("rejects", spark.createDataFrame(rejected, REJECTS).coalesce(1))
    written = version.publish(on_empty, always=("rejects",))
    written.pop("rejects")

    def copy(name: str) -> None:
        # the copy reads the table just written (or is empty): no recompute
        schema = StructType.fromJson(json.loads(version.columns[name]))
        write_csv_copy(spark.read.schema(schema).parquet(version.path(name)) if version.rows[name] else
                       spark.createDataFrame([], schema), f"{csv_root.rstrip('/')}/{name}")

    if csv_root:
        _each(copy, [n for n in PIPELINES[source] if written[n] or SPEC_BY_NAME[n].source != "visit"])
    return written


def refresh_measures(spark: SparkSession, tables_root: str, out_root: str, *,
                     on_empty: str = "keep") -> dict[str, bool]:
    """The dashboard measures (D1m-D12m) from the written ``orders`` and
    ``returns`` tables under ``tables_root``; one table per measure, published
    together under ``out_root``.  Each measure is an aggregate over the pruned
    columns it needs (partial aggregation before the shuffle).  The four monthly
    ones share one written branch x month aggregate and five more one written
    per-branch aggregate, instead of a scan of the orders each."""
    tune_session(spark)
    root = tables_root.rstrip("/")
    orders, returns = read_table(spark, root, "orders"), read_table(spark, root, "returns")
    # the branch x month base of four measures: aggregated from orders once,
    # written (it is small) and read by each of them
    key = hashlib.sha1(root.encode()).hexdigest()[:16]
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/measures/monthly-{key}"
    monthly_branch_sales(orders).write.mode("overwrite").parquet(base)
    monthly = spark.read.parquet(base)
    # likewise the per-branch totals behind five more measures
    branch_base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/measures/branch-{key}"
    branch_totals(orders).write.mode("overwrite").parquet(branch_base)
    branch = spark.read.parquet(branch_base)
    version = Store(spark, out_root).begin(MEASURES_EXPORT)
    for name, fn in MEASURES.items():
        if name == "d4_returned_orders":
            df = fn(orders, returns)
        elif name in MONTHLY_MEASURES:
            df = fn(orders, monthly=monthly)
        elif name in BRANCH_MEASURES:
            df = fn(orders, branch=branch)
        else:
            df = fn(orders)
        version.add(name, df)
    return version.publish(on_empty)


def run_group(spark: SparkSession, group: str, landing_root: str, out_root: str,
              as_of: str | None = None, **kw) -> dict[str, dict[str, bool]]:
    """Job group (references / sales / warehouse): its pipelines, independent
    of each other and run several at a time; each reads
    ``{landing_root}/{source}``.  ``as_of`` applies to exports with a window."""
    def one(src: str) -> dict[str, bool]:
        day = as_of if src in jsonsrc.WINDOW_DATES else None
        return run(spark, src, f"{landing_root.rstrip('/')}/{src}", out_root, as_of=day, **kw)

    return dict(zip(JOB_GROUPS[group], _each(one, JOB_GROUPS[group])))


def refresh_references(spark, landing_root, out_root, **kw):
    return run_group(spark, "references", landing_root, out_root, **kw)


def refresh_sales(spark, landing_root, out_root, **kw):
    return run_group(spark, "sales", landing_root, out_root, **kw)


def refresh_warehouse(spark, landing_root, out_root, **kw):
    return run_group(spark, "warehouse", landing_root, out_root, **kw)
