"""Pipelines, sinks and the streaming refresh (S1–S8, job groups)."""

import json
import os

from helpers import write_lines
from tradelake.plans import pipelines
from tradelake.plans.pipelines import read_table
from tradelake.plans.build import table
from tradelake.plans.specs import JOB_GROUPS, OUTPUT_TABLES, PIPELINES
from tradelake.sources.jsonsrc import date_window, land_json, read_lines
from tradelake.sources.registry import SOURCES
from tradelake.streaming.refresh import refresh_on_landing

LOGISTICS = [
    {"_ord": 1, "logistics_id": "1", "deals": [{"deal_id": "5", "status": "A"},
                                               {"deal_id": "5.0", "status": "dup"}]},
    {"_ord": 2, "logistics_id": "1", "deals": [{"deal_id": "6"}]},
]


def test_registry_covers_all_tables():
    assert len(SOURCES) == 22 and len(OUTPUT_TABLES) == 64
    assert sorted(sum(JOB_GROUPS.values(), [])) == sorted(PIPELINES)


def test_run_writes_tables_and_csv(spark, tmpdir_path):
    land = write_lines(os.path.join(tmpdir_path, "landing", "logistics"), LOGISTICS)
    out, csv = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "csv")
    written = pipelines.run(spark, "logistics", land, out, csv_root=csv)
    assert written == {"logistics": True, "logistics_deals": True}
    deals = read_table(spark, out, "logistics_deals")
    assert sorted((r.logistics_id, r.deal_id, r.status) for r in deals.collect()) == [(1, 5, "A")]
    c = spark.read.option("header", True).csv(os.path.join(csv, "logistics_deals"))
    assert c.columns == ["logistics_id", "deal_id", "status", "external_id"]
    # idempotent re-run: same result
    pipelines.run(spark, "logistics", land, out)
    assert read_table(spark, out, "logistics_deals").count() == 1


def test_empty_export_keeps_previous_tables(spark, tmpdir_path):
    land = write_lines(os.path.join(tmpdir_path, "l1"), LOGISTICS)
    out = os.path.join(tmpdir_path, "out")
    pipelines.run(spark, "logistics", land, out)
    empty = write_lines(os.path.join(tmpdir_path, "l2"), [])
    assert pipelines.run(spark, "logistics", empty, out) == {}           # S6
    only_parent = write_lines(os.path.join(tmpdir_path, "l3"), [{"_ord": 1, "logistics_id": "2"}])
    w = pipelines.run(spark, "logistics", only_parent, out)
    assert w == {"logistics": True, "logistics_deals": False}            # D6 keep
    assert read_table(spark, out, "logistics_deals").count() == 1


def test_envelope_source(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "env")
    os.makedirs(d)
    with open(os.path.join(d, "a.json"), "w") as f:
        json.dump({"data": [{"code": "c1", "state": "A", "with_card": "1"},
                            {"code": "c1", "state": "A", "with_card": "0"},
                            None, {"code": "c2", "state": "P"}]}, f, indent=2)
    with open(os.path.join(d, "b.json"), "w") as f:
        json.dump({"data": None}, f)
    exp = land_json(spark, "price_type", d, envelope=True)
    assert [(r.code, r.with_card) for r in table(exp, "price_types").collect()] == [("c1", True)]


def test_date_window_prunes_partitions(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "visits")
    for day in ("2024-01-01", "2024-01-05", "2024-01-09"):
        write_lines(os.path.join(root, f"visit_date={day}"),
                    [{"_ord": int(day[-2:]), "visit_headers": [{"visit_id": day[-2:]}]}])
    docs = date_window(read_lines(spark, "visit", root), "visit_date", "2024-01-09", 7)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "visit_date" in plan
    assert sorted(r._ord for r in docs.collect()) == [5, 9]


def test_job_group_runs_its_pipelines(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landing")
    write_lines(os.path.join(root, "logistics"), LOGISTICS)
    for src in JOB_GROUPS["warehouse"]:
        if src != "logistics":
            write_lines(os.path.join(root, src), [])
    res = pipelines.refresh_warehouse(spark, root, os.path.join(tmpdir_path, "out"))
    assert res["logistics"]["logistics_deals"] is True and res["purchase"] == {}


def test_streaming_refresh_available_now(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "stream-landing")
    write_lines(land, LOGISTICS, "export-1.json")
    out = os.path.join(tmpdir_path, "out")
    q = refresh_on_landing(spark, "logistics", land, out)
    q.awaitTermination(120)
    assert read_table(spark, out, "logistics").count() == 1
    # a second export lands: the next run refreshes from the new files only
    write_lines(land, [{"_ord": 1, "logistics_id": "9"}, {"_ord": 2, "logistics_id": "8"}],
                "export-2.json")
    refresh_on_landing(spark, "logistics", land, out).awaitTermination(120)
    ids = sorted(r.logistics_id for r in read_table(spark, out, "logistics").collect())
    assert ids == [8, 9]


def test_streaming_refresh_takes_newest_export_directory(spark, tmpdir_path):
    """Two exports landed (one directory each) before a run: the tables are
    refreshed from the newer one only, never from a union of both."""
    land = os.path.join(tmpdir_path, "stream-dirs")
    write_lines(os.path.join(land, "export=20260101"),
                [{"_ord": 1, "logistics_id": "1"}, {"_ord": 2, "logistics_id": "2"}])
    write_lines(os.path.join(land, "export=20260102"),
                [{"_ord": 1, "logistics_id": "3"}], "part-0.json")
    write_lines(os.path.join(land, "export=20260102"),
                [{"_ord": 2, "logistics_id": "4"}], "part-1.json")
    for export in ("20260101", "20260102"):
        open(os.path.join(land, f"export={export}", "_SUCCESS"), "w").close()
    out = os.path.join(tmpdir_path, "out")
    refresh_on_landing(spark, "logistics", land, out).awaitTermination(120)
    ids = sorted(r.logistics_id for r in read_table(spark, out, "logistics").collect())
    assert ids == [3, 4]


def test_strict_run_refuses_fractional_ids(spark, tmpdir_path):
    import pytest
    land = write_lines(os.path.join(tmpdir_path, "s"), [{"_ord": 1, "logistics_id": "1.5"}])
    with pytest.raises(ValueError, match="logistics_id"):
        pipelines.run(spark, "logistics", land, os.path.join(tmpdir_path, "o"), strict=True)


def test_cli_run(spark, tmpdir_path):
    from tradelake.__main__ import main
    land = write_lines(os.path.join(tmpdir_path, "cli"), LOGISTICS)
    out = os.path.join(tmpdir_path, "cli-out")
    main(["run", "--source", "logistics", "--landing", land, "--out", out])
    assert read_table(spark, out, "logistics").count() == 1


def test_measures_from_written_tables(spark, tmpdir_path):
    """The measures job reads the tables a pipeline run wrote and gives the
    same rows as the measures over the tables in memory."""
    from helpers import SF_SMALL
    from tradelake.__main__ import main
    from tradelake.functions.measures import MEASURES
    from tradelake.sources.driver import land
    tables = os.path.join(tmpdir_path, "tables")
    orders = table(land(spark, SF_SMALL, "order"), "orders")
    returns = table(land(spark, SF_SMALL, "returns"), "returns")
    orders.write.parquet(os.path.join(tables, "orders"))
    returns.write.parquet(os.path.join(tables, "returns"))
    out = os.path.join(tmpdir_path, "measures")
    main(["measures", "--tables", tables, "--out", out])
    for name, fn in MEASURES.items():
        want = fn(orders, returns) if name == "d4_returned_orders" else fn(orders)
        got = read_table(spark, out, name)
        assert sorted(map(tuple, got.collect()), key=repr) == \
            sorted(map(tuple, want.collect()), key=repr), name


def test_write_table_keeps_previous_on_empty_and_leaves_no_staging(spark, tmpdir_path):
    from tradelake.sources.sinks import write_table
    path = os.path.join(tmpdir_path, "t")
    grouped = spark.range(10).selectExpr("id % 3 AS k").groupBy("k").count()
    assert write_table(grouped, path) is True
    empty = grouped.where("k > 99")
    assert write_table(empty, path) is False                     # previous table kept
    assert spark.read.parquet(path).count() == 3
    assert sorted(os.listdir(tmpdir_path)) == ["t"]              # staging removed
    assert write_table(grouped.where("k = 0"), path) is True     # replaced, not appended
    assert spark.read.parquet(path).count() == 1
    assert write_table(empty, path, on_empty="replace") is True
    assert spark.read.parquet(path).count() == 0


def test_cli_group_with_csv(spark, tmpdir_path):
    from tradelake.__main__ import main
    root = os.path.join(tmpdir_path, "landing")
    for src in JOB_GROUPS["warehouse"]:
        write_lines(os.path.join(root, src), LOGISTICS if src == "logistics" else [])
    out, csv = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "csv")
    main(["group", "--group", "warehouse", "--landing-root", root, "--out", out, "--csv", csv])
    assert read_table(spark, out, "logistics").count() == 1
    assert spark.read.option("header", True).csv(os.path.join(csv, "logistics")).count() == 1
