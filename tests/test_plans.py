"""Plan shape and properties (§5.4) on the driver tables."""

import pytest

from helpers import SF_SMALL
from tradelake.operators.dedup import keep_first
from tradelake.plans.build import build_with_refs, table
from tradelake.sources.driver import land
from tradelake.sources.export import Frame

import __spark_entry__ as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["orders", "order_products", "visit_planogram_products",
                                  "purchase_marking_codes", "d7_trade_dynamics"])
def test_no_python_and_partial_dedup(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name in ("orders", "order_products"):
        assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scan_is_pruned(spark):
    df = E.queries()["order_product_details"](spark, SF_SMALL)
    # the orders side only needs the document key (and the customer key for the
    # join that supplies the branch): no other order column reaches the scan
    phys = df._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in phys.splitlines() if "orders.parquet" in ln]
    assert scans and all("o_totalprice" not in ln and "o_orderdate" not in ln for ln in scans)


def test_dedup_idempotent_and_order_independent(spark):
    exp = land(spark, SF_SMALL, "order")
    a = table(exp, "order_products")
    ref = sorted(map(tuple, a.collect()), key=repr)
    # keep-first again on its own output changes nothing
    df, refs = build_with_refs(exp, "order_products")
    again = keep_first(df, ["deal_id", "product_unit_id", "external_id"], refs)
    assert sorted(map(tuple, again.drop(*refs).collect()), key=repr) == ref
    # shuffling the input rows does not change the output (order comes from refs)
    from tradelake.sources.export import Frame
    for path, fr in list(exp.frames.items()):
        exp.frames[path] = Frame(fr.df.repartition(7), fr.refs)
    b = table(exp, "order_products")
    assert sorted(map(tuple, b.collect()), key=repr) == ref


def test_children_reference_surviving_parents(spark):
    exp = land(spark, SF_SMALL, "order")
    orders = table(exp, "orders").select("deal_id")
    lines = table(exp, "order_products").select("deal_id").distinct()
    # NULL deal ids are one parent too (NULL keys group together), so null-safe
    assert lines.join(orders, lines.deal_id.eqNullSafe(orders.deal_id), "left_anti").count() == 0


@pytest.mark.parametrize("name,column", [("order_products", "product_unit_id"), ("purchase_items", "purchase_item_id"),
                                         ("purchase_marking_codes", "marking_code"), ("sub_contracts", "sub_contract_id")])
def test_children_are_shuffled_once(spark, name, column):
    """A key that holds the parent's key stays within a document: its groups
    need no shuffle behind the join that brought the document together."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(E.queries()[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffles = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]
    assert "SortMergeJoin" in plan and shuffles
    assert not any(column in ln for ln in shuffles)


@pytest.mark.parametrize("name", ["cross_movement_items", "warehouse_input_items", "stocktaking_items", "writeoff_items",
                                  "purchase_items", "internal_movement_items", "order_products"])
def test_join_moves_source_rows(spark, name):
    """The join with the parents moves a line's own columns, each once; text made
    from them is made behind the join, from the lines that it keeps."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        node = _plan(df).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = next(i for i, ln in enumerate(node) if "SortMergeJoin" in ln)
    moved = next(ln for ln in node[join:] if "Project [" in ln).split("Project [")[1]
    assert "l_orderkey" in moved and "CASE" not in moved and "concat" not in moved and "cast(" not in moved


@pytest.mark.parametrize("source,name", [("order", "order_products"), ("order", "order_product_details"),
                                         ("cross_movement", "cross_movement_items"), ("purchase", "purchase_marking_codes")])
def test_source_rows_give_the_frames_rows(spark, tmp_path, source, name):
    """Joining the source rows gives what joining the frame gives, also with
    keys that are missing or repeat, in orders as in lines."""
    day = "timestamp'2024-01-05'"
    spark.sql("SELECT 1 AS n_nationkey, 'N' AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    spark.sql("SELECT id AS c_custkey, 'c' AS c_name, 1 AS c_nationkey FROM range(5)").write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql(f"""SELECT CASE WHEN id % 9 <> 8 THEN id % 50 END AS o_orderkey, CASE WHEN id % 11 <> 10 THEN id % 5 END AS o_custkey,
        'O' AS o_orderstatus, double(id % 50) AS o_totalprice, {day} AS o_orderdate, '1-URGENT' AS o_orderpriority
        FROM range(70)""").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(f"""SELECT CASE WHEN id % 7 <> 6 THEN id % 60 END AS l_orderkey, CASE WHEN id % 13 <> 12 THEN id END AS l_partkey,
        id % 3 AS l_suppkey, CASE WHEN id % 5 <> 4 THEN int(id % 2) END AS l_linenumber, double(id) AS l_quantity,
        double(id) AS l_extendedprice, CASE WHEN id % 17 <> 1 THEN 0.1D END AS l_discount, 0.08D AS l_tax,
        CASE WHEN id % 2 = 0 THEN 'R' END AS l_returnflag, 'F' AS l_linestatus, {day} AS l_shipdate
        FROM range(400) JOIN (SELECT explode(array(1, 2))) ON true""").write.parquet(f"{tmp_path}/lineitem.parquet")
    exp, plain = land(spark, str(tmp_path), source), land(spark, str(tmp_path), source)
    assert any(fr.source is not None for fr in exp.frames.values())
    for path, fr in list(plain.frames.items()):
        plain.frames[path] = Frame(fr.df, fr.refs, fr.lists)
    got = sorted(map(tuple, table(exp, name).collect()), key=repr)
    assert got and got == sorted(map(tuple, table(plain, name).collect()), key=repr)
