"""All visit tables from one pass equal those built one by one."""

import os
import random

from helpers import write_lines
from pyspark.sql.types import ArrayType
from tradelake.plans import pipelines, split
from tradelake.plans.build import rejects, table
from tradelake.plans.specs import PIPELINES
from tradelake.sources import jsonsrc
from tradelake.sources.registry import document_schema

VALUES = ["1", "2.5", " 7 ", "1e3", "junk", "", None, "inf", "text", "2024-01-03"]


def document(schema, rng):
    out = {}
    for f in schema.fields:
        if isinstance(f.dataType, ArrayType):
            out[f.name] = rng.choice([None, [], [None, document(f.dataType.elementType, rng)],
                                      [document(f.dataType.elementType, rng) for _ in range(rng.randint(1, 3))]])
        elif rng.random() < 0.9:
            out[f.name] = rng.choice(VALUES)
    return out


def landed(spark, path, seed, n):
    rng = random.Random(seed)
    schema = document_schema("visit")
    return write_lines(path, [{"_ord": i, **document(schema, rng)} for i in range(n)])


def test_split_equals_the_builders(spark, tmpdir_path):
    path = landed(spark, os.path.join(tmpdir_path, "l"), 1, 90)
    docs = jsonsrc.in_order(jsonsrc.read_lines(spark, "visit", path))
    docs.write.parquet(os.path.join(tmpdir_path, "bronze"))
    docs = spark.read.schema(docs.schema).parquet(os.path.join(tmpdir_path, "bronze"))
    export = jsonsrc.flatten("visit", docs)
    rows = split.typed(split.split(docs, "visit"), "visit")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan
    rows.write.parquet(os.path.join(tmpdir_path, "rows"))
    rows = spark.read.parquet(os.path.join(tmpdir_path, "rows"))
    seen = 0
    for name in PIPELINES["visit"]:
        want, got = table(export, name), split.table_from_split(rows, name)
        assert got.schema.simpleString() == want.schema.simpleString(), name
        want, got = (sorted(map(str, x.collect())) for x in (want, got))
        assert got == want, name
        seen += len(got)
    assert seen == rows.count() > 500


def test_run_splits_and_counts_rejects(spark, tmpdir_path):
    path, out = landed(spark, os.path.join(tmpdir_path, "l"), 2, 40), os.path.join(tmpdir_path, "out")
    assert all(pipelines.run(spark, "visit", path, out, csv_root=os.path.join(tmpdir_path, "csv")).values())
    export = jsonsrc.land_json(spark, "visit", path)
    want = {(t, c): n for name in PIPELINES["visit"] for t, c, n in map(tuple, rejects(export, name).collect())}
    assert {(r.table, r.column): r.n_rejects for r in pipelines.read_table(spark, out, "rejects/visit").collect()} == want
    assert sum(want.values()) > 0
    for name in ("visits", "visit_shelf_own"):
        got = pipelines.read_table(spark, out, name)
        assert sorted(map(str, got.collect())) == sorted(map(str, table(export, name).collect()))
        assert spark.read.option("header", True).csv(os.path.join(tmpdir_path, "csv", name)).columns == got.columns


def test_empty_tables_of_a_split(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "out")
    land = write_lines(os.path.join(tmpdir_path, "l"), [{"_ord": 1, "visit_headers": [{"visit_id": "3"}]}])
    written = pipelines.run(spark, "visit", land, out)
    assert [t for t, yes in written.items() if yes] == ["visits"]
    assert all(pipelines.run(spark, "visit", land, out, on_empty="replace").values())
    assert pipelines.read_table(spark, out, "visit_stocks").count() == 0
    assert pipelines.read_table(spark, out, "visit_stocks").columns == ["visit_id", "stock_product_code", "stock_quant", "stock_expiry_date", "stock_card_code"]


def test_only_narrow_exports_are_split():
    assert [s for s in PIPELINES if split.in_one_pass(s)] == ["visit"]
