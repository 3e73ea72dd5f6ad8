"""The landing loses nothing: broken input is refused, order needs no help from
the export, refreshes never go back, swaps can be interrupted."""

import json
import os

import pytest

from helpers import write_lines
from tradelake.plans import pipelines
from tradelake.plans.pipelines import read_table
from tradelake.plans.build import table
from tradelake.plans.specs import JOB_GROUPS, PIPELINES
from tradelake.sources import jsonsrc, sinks
from tradelake.sources.jsonsrc import land_json
from tradelake.sources.registry import ENVELOPE_KEYS, SOURCES, document_schema
from tradelake.streaming.refresh import refresh_on_landing


def _read(spark, out, name, *cols):
    return sorted(map(tuple, read_table(spark, out, name).select(*cols).collect()), key=repr)


def test_children_without_ord(spark, tmpdir_path):
    land = write_lines(os.path.join(tmpdir_path, "l"), [
        {"logistics_id": "1", "deals": [{"deal_id": "5"}]}, {"logistics_id": "2", "deals": [{"deal_id": "6"}]}])
    out = os.path.join(tmpdir_path, "out")
    assert pipelines.run(spark, "logistics", land, out) == {"logistics": True, "logistics_deals": True}
    assert _read(spark, out, "logistics_deals", "logistics_id", "deal_id") == [(1, 5), (2, 6)]


def test_children_with_repeated_ord(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "l")
    write_lines(land, [{"_ord": 1, "logistics_id": "1", "deals": [{"deal_id": "5"}]}], "a.json")
    write_lines(land, [{"_ord": 1, "logistics_id": "2", "deals": [{"deal_id": "6"}]}], "b.json")
    assert sorted(map(tuple, table(land_json(spark, "logistics", land), "logistics_deals").select(
        "logistics_id", "deal_id").collect())) == [(1, 5), (2, 6)]


def test_keep_first_follows_file_order_without_ord(spark, tmpdir_path):
    land = write_lines(os.path.join(tmpdir_path, "l"), [
        {"logistics_id": "1", "deals": [{"deal_id": str(i)}]} for i in range(50)])
    got = table(land_json(spark, "logistics", land), "logistics_deals").collect()
    assert [(r.logistics_id, r.deal_id) for r in got] == [(1, 0)]


def _raw(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "a.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


@pytest.mark.parametrize("broken", ['{"_ord": 2, "logistics_id": "2", "deals": [{"deal',
                                    '{"_ord": 2, "logistics_id": "2", "deals": [{"deal_id": "6"}, 7]}'])
def test_broken_lines_are_refused(spark, tmpdir_path, broken):
    out = os.path.join(tmpdir_path, "out")
    good = '{"_ord": 1, "logistics_id": "1", "deals": [{"deal_id": "5"}]}'
    pipelines.run(spark, "logistics", _raw(os.path.join(tmpdir_path, "old"), [good]), out)
    land = _raw(os.path.join(tmpdir_path, "new"), [good.replace('"1"', '"9"'), broken])
    with pytest.raises(ValueError, match="1 of 2 records"):
        pipelines.run(spark, "logistics", land, out)
    assert _read(spark, out, "logistics", "logistics_id") == [(1,)]
    pipelines.run(spark, "logistics", land, out, on_corrupt="drop")
    assert _read(spark, out, "logistics", "logistics_id") == [(9,)]


def test_broken_envelope_is_refused(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "env")
    os.makedirs(land)
    whole = json.dumps({"data": [{"code": "c1", "state": "A"}]})
    for name, text in (("a", whole), ("b", whole[:20]), ("c", "{}")):
        with open(os.path.join(land, f"{name}.json"), "w") as f:
            f.write(text)
    with pytest.raises(ValueError, match="1 of 2 records"):
        pipelines.run(spark, "price_type", land, os.path.join(tmpdir_path, "out"), envelope=True)


def test_stream_waits_for_complete_exports_and_never_goes_back(spark, tmpdir_path):
    land, out = os.path.join(tmpdir_path, "land"), os.path.join(tmpdir_path, "out")

    def arrive(export, part, ids, complete=False):
        write_lines(os.path.join(land, f"export={export}"), [{"logistics_id": str(i)} for i in ids], f"{part}.json")
        if complete:
            open(os.path.join(land, f"export={export}", "_SUCCESS"), "w").close()
        refresh_on_landing(spark, "logistics", land, out).awaitTermination(120)
        return _read(spark, out, "logistics", "logistics_id") if os.path.exists(os.path.join(out, "_commits")) else None

    assert arrive("20260102", "a", [1, 2]) is None                      # not complete yet
    assert arrive("20260102", "b", [3], complete=True) == [(1,), (2,), (3,)]    # all of it, not the new file
    assert arrive("20260101", "a", [99], complete=True) == [(1,), (2,), (3,)]   # an older one is late
    assert arrive("20260103", "a", [4]) == [(1,), (2,), (3,)]
    open(os.path.join(land, "export=20260103", "_SUCCESS"), "w").close()        # only the marker is new
    refresh_on_landing(spark, "logistics", land, out).awaitTermination(120)
    assert _read(spark, out, "logistics", "logistics_id") == [(4,)]


VISITS = [{"_ord": n, "note": d, "visit_headers": [{"visit_id": str(n), "visit_date": d}], "stocks": [{"stock_quant": "1"}]}
          for n, d in enumerate(["2024-01-01", "2024-01-05", "2024-01-09", "2024-01-10"])]


def test_window_inside_documents_and_on_partitions(spark, tmpdir_path):
    flat = write_lines(os.path.join(tmpdir_path, "flat"), VISITS)
    parted = os.path.join(tmpdir_path, "parted")
    for v in VISITS:
        write_lines(os.path.join(parted, f"visit_date={v['note']}"), [v])
    for n, land in enumerate((flat, parted)):
        out = os.path.join(tmpdir_path, f"out{n}")
        pipelines.run(spark, "visit", land, out, as_of="2024-01-09")
        assert _read(spark, out, "visits", "visit_id") == [(1,), (2,)]
        assert _read(spark, out, "visit_stocks", "visit_id") == [(1,), (2,)]
    plan = jsonsrc.window(jsonsrc.read_lines(spark, "visit", parted), "visit", "2024-01-09")
    assert "PartitionFilters: [isnotnull(visit_date" in plan._jdf.queryExecution().executedPlan().toString() or \
        "visit_date" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1][:120]


def test_visits_need_no_shuffle(spark, tmpdir_path):
    exp = land_json(spark, "visit", write_lines(os.path.join(tmpdir_path, "v"), VISITS))
    for name in PIPELINES["visit"]:
        plan = table(exp, name)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan, name


def test_children_need_no_join(spark, tmpdir_path):
    land = write_lines(os.path.join(tmpdir_path, "o"), [
        {"_ord": 1, "deal_id": "1", "order_products": [{"product_unit_id": "1", "details": [{"card_code": "c"}]}]}])
    exp = land_json(spark, "order", land)
    for name, shuffles in (("order_products", 1), ("order_product_details", 1), ("order_gifts", 1)):
        plan = table(exp, name)._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and plan.count("Exchange hashpartitioning") == shuffles, name   # both keep-first run on deal_id


def test_rejects_are_written_and_strict_keeps_the_old_tables(spark, tmpdir_path):
    docs = [{"_ord": 1, "product_id": "1.5", "state": "P"}, {"_ord": 2, "product_id": "7", "state": "A"}]
    out = os.path.join(tmpdir_path, "out")
    pipelines.run(spark, "products", write_lines(os.path.join(tmpdir_path, "a"), docs), out, strict=True)  # inactive row
    assert _read(spark, out, "products", "product_id") == [(7,)]
    docs[0]["state"] = "A"
    bad = write_lines(os.path.join(tmpdir_path, "b"), [docs[0], {**docs[1], "product_id": "8"}])
    with pytest.raises(ValueError, match=r"products.product_id \(1\)"):
        pipelines.run(spark, "products", bad, out, strict=True)
    assert _read(spark, out, "products", "product_id") == [(7,)]
    assert len(os.listdir(os.path.join(out, "_versions", "products"))) == 1         # the refused run left nothing
    pipelines.run(spark, "products", bad, out)
    got = {(t, c): n for t, c, n in _read(spark, out, "rejects/products", "table", "column", "n_rejects")}
    assert got["products", "product_id"] == 1 and sum(got.values()) == 1


def test_interrupted_swap_keeps_a_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    sinks.write_table(spark.range(3), path)
    staged = sinks.stage_table(spark.range(5), path)          # killed before the swap
    assert sinks.read_table(spark, path).count() == 3
    os.rename(path, path + sinks.PREVIOUS)                    # killed in the middle of it
    assert sinks.read_table(spark, path).count() == 3
    sinks.recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    assert staged.commit() and spark.read.parquet(path).count() == 5
    assert os.listdir(tmpdir_path) == ["t"]


def test_catalog_table_keeps_on_empty(spark, tmpdir_path):
    spark.sql("DROP TABLE IF EXISTS tl_sink_test")
    assert sinks.write_table(spark.range(3), table="tl_sink_test")
    assert not sinks.write_table(spark.range(0), table="tl_sink_test")
    assert spark.table("tl_sink_test").count() == 3
    spark.sql("DROP TABLE tl_sink_test")


def _document(schema, n):
    """A document with two elements in every list."""
    from pyspark.sql.types import ArrayType
    out = {}
    for f in schema.fields:
        if isinstance(f.dataType, ArrayType):
            out[f.name] = [_document(f.dataType.elementType, 10 * n + i) for i in (1, 2)]
        else:
            out[f.name] = {"state": "A", "inventory_kind": "G"}.get(f.name, str(n))
    return out


@pytest.mark.parametrize("group", list(JOB_GROUPS))
def test_every_pipeline_of_a_group_with_data(spark, tmpdir_path, group):
    root, out = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "out")
    for source in JOB_GROUPS[group]:
        write_lines(os.path.join(root, source), [{"_ord": n, **_document(document_schema(source), n)} for n in (1, 2, 2)])
    written = pipelines.run_group(spark, group, root, out)
    for source in JOB_GROUPS[group]:
        assert written[source] == {name: True for name in PIPELINES[source]}
        exp = land_json(spark, source, os.path.join(root, source))
        for name in PIPELINES[source]:
            want = sorted(map(tuple, table(exp, name).collect()), key=repr)
            assert want and sorted(map(tuple, read_table(spark, out, name).collect()), key=repr) == want, name
    assert set(SOURCES) == set(ENVELOPE_KEYS)


def test_measures_with_huge_and_unusable_amounts(spark):
    from tradelake.functions import measures as M
    inf = float("inf")
    rows = [("b", 2e16, "2024-01-01"), ("b", 5.0, "2024-01-02"), ("b", inf, "2024-02-01"), ("b", 7.0, "soon"),
            ("b", None, "2024-02-01"), ("z", None, "2024-01-01")]
    orders = spark.createDataFrame([(f, a, t, "UZS", "m", i) for i, (f, a, t) in enumerate(rows)],
                                   "filial_code string, total_amount double, deal_time string, currency_code string, "
                                   "sales_manager_id string, deal_id long")
    got = {r.filial_code: r for r in M.sales_by_branch(orders).collect()}
    assert (got["b"].n_orders, got["b"].total_sales) == (5, 2e16 + 12)
    lost = {r.filial_code: r for r in M.unmeasured_orders(orders).collect()}
    assert (lost["b"].n_amount_unsummable, lost["b"].n_time_unparsed, lost["b"].sales_time_unparsed) == (1, 1, 7.0)
    assert lost["z"].n_amount_unsummable == 0
    monthly = sum(r.sales or 0 for r in M.trade_dynamics(orders).collect())
    assert monthly + lost["b"].sales_time_unparsed == got["b"].total_sales
    assert [r.share for r in M.contribution(orders.where("filial_code = 'z'")).collect()] == [None]


def test_anomalies_beyond_exact_range(spark):
    from tradelake.functions import measures as M
    for scale in (1.0, 1e16):
        rows = [("b", scale * (100, 102, 101)[i % 3], f"2024-{i + 1:02d}-01") for i in range(8)] + [("b", scale * 900, "2024-09-01")]
        orders = spark.createDataFrame(rows, "filial_code string, total_amount double, deal_time string")
        assert [r.month for r in M.sales_anomalies(orders).collect()] == ["2024-09"]


def test_checkpoint_root_prefers_the_contexts_folder(spark, tmpdir_path):
    from tradelake.session import checkpoint_root

    class Conf:
        def __init__(self, named):
            self.get = lambda key, default=None: named or default

    class Session:
        def __init__(self, named, given, master):
            self.conf = Conf(named)
            self.sparkContext = type("C", (), {"getConf": lambda s: Conf(named), "getCheckpointDir": lambda s: given,
                                               "master": master})()
    assert checkpoint_root(Session("/a", None, "yarn")) == "/a"
    assert checkpoint_root(Session("file:///a", "file:/a/uuid", "yarn")) == "file:///a"
    assert checkpoint_root(Session("/a", "/b/uuid", "yarn")) == "/b/uuid"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session(None, None, "spark://x"))
