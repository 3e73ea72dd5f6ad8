"""Command line for spark-submit.

    spark-submit --py-files tradelake.zip scripts/tradelake_job.py run    --source order --landing s3://.../order --out s3://.../tables
    spark-submit --py-files tradelake.zip scripts/tradelake_job.py group  --group sales --landing-root s3://.../landing --out ...
    spark-submit --py-files tradelake.zip scripts/tradelake_job.py stream --source visit --landing ... --out ...
    spark-submit --py-files tradelake.zip scripts/tradelake_job.py measures --tables s3://.../tables --out s3://.../measures
    spark-submit --py-files tradelake.zip scripts/tradelake_job.py census --source order --landing s3://.../order --out s3://.../census
    spark-submit --py-files tradelake.zip scripts/tradelake_job.py tables --out s3://.../tables

The session comes from the submitting environment (``getOrCreate``); the
cluster's ``spark.checkpoint.dir`` is used for bronze copies and checkpoints.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .plans import pipelines
from .plans.specs import JOB_GROUPS, PIPELINES
from .sources.census import census
from .sources.sinks import write_table
from .sources.versions import Store
from .streaming.refresh import refresh_on_landing


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tradelake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("run", "stream"):
        p = sub.add_parser(name)
        p.add_argument("--source", required=True, choices=sorted(PIPELINES))
        p.add_argument("--landing", required=True)
        p.add_argument("--out", required=True)
        p.add_argument("--on-empty", default="keep", choices=["keep", "replace"])
        p.add_argument("--as-of", help="a date or 'today': limits the visit export to its window")
    r = sub.choices["run"]
    r.add_argument("--envelope", action="store_true")
    r.add_argument("--csv")
    r.add_argument("--date-column")
    r.add_argument("--strict", action="store_true")
    r.add_argument("--on-corrupt", default="raise", choices=["raise", "drop"])
    g = sub.add_parser("group")
    g.add_argument("--group", required=True, choices=sorted(JOB_GROUPS))
    g.add_argument("--landing-root", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--envelope", action="store_true")
    g.add_argument("--csv")
    g.add_argument("--on-empty", default="keep", choices=["keep", "replace"])
    g.add_argument("--as-of", help="a date or 'today': limits the visit export to its window")
    g.add_argument("--strict", action="store_true")
    g.add_argument("--on-corrupt", default="raise", choices=["raise", "drop"])
    m = sub.add_parser("measures")
    m.add_argument("--tables", required=True)
    m.add_argument("--out", required=True)
    c = sub.add_parser("census", help="fields of a landing that the declared schema drops or misses")
    c.add_argument("--source", required=True, choices=sorted(PIPELINES))
    c.add_argument("--landing", required=True)
    c.add_argument("--out", required=True)
    t = sub.add_parser("tables", help="where the published tables are")
    t.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"tradelake-{args.cmd}").getOrCreate()
    if args.cmd == "run":
        res = pipelines.run(spark, args.source, args.landing, args.out, envelope=args.envelope,
                            as_of=args.as_of, date_column=args.date_column, csv_root=args.csv,
                            on_empty=args.on_empty, strict=args.strict, on_corrupt=args.on_corrupt)
    elif args.cmd == "group":
        res = pipelines.run_group(spark, args.group, args.landing_root, args.out,
                                  envelope=args.envelope, csv_root=args.csv,
                                  on_empty=args.on_empty, as_of=args.as_of, strict=args.strict,
                                  on_corrupt=args.on_corrupt)
    elif args.cmd == "census":
        res = {"written": write_table(census(spark, args.source, args.landing), args.out, on_empty="replace")}
    elif args.cmd == "tables":
        res = Store(spark, args.out).locations()
    elif args.cmd == "measures":
        res = pipelines.refresh_measures(spark, args.tables, args.out)
    else:
        q = refresh_on_landing(spark, args.source, args.landing, args.out,
                               on_empty=args.on_empty, as_of=args.as_of)
        q.awaitTermination()
        res = {"stream": q.id}
    print(json.dumps(res, default=str))


if __name__ == "__main__":
    main()
