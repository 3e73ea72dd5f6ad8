"""Builder golden tests on tiny landed JSON exports.

Each fixture covers: duplicate key (first wins), NULL keys (collapse to one),
inactive / NULL state, child list NULL / empty / scalar / containing NULL,
absent fields, dirty numbers and booleans, codes with blanks."""

import os

import pytest

from helpers import write_lines
from tradelake.plans.build import table
from tradelake.sources.jsonsrc import land_json


def _rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


ORDERS = [
    {"_ord": 1, "deal_id": "10", "filial_code": "A", "total_amount": "100.50",
     "with_marking": "yes",
     "order_products": [
         {"product_unit_id": "1", "external_id": "e1", "sold_quant": "2",
          "details": [{"sold_quant": "1", "batch_number": "b1"}], "action_margins": None},
         {"product_unit_id": " 1 ", "external_id": "e1", "sold_quant": "3"},
         None,
         {"product_unit_id": "1e3", "price_type_id": "1.5", "action_margins": [
             {"bonus_id": "+4", "margin_value": "0.5"}]}],
     "order_gifts": "not a list",
     "order_consignments": [{"consignment_unit_id": "3", "consignment_amount": "inf"}]},
    {"_ord": 2, "deal_id": "10", "filial_code": "B",
     "order_products": [{"product_unit_id": "9", "external_id": "late"}]},
    {"_ord": 3, "deal_id": "abc", "total_amount": "nan", "order_products": []},
    {"_ord": 4, "deal_id": None, "filial_code": "dropped"},
    {"_ord": 5, "deal_id": "12.5", "filial_code": "dropped too"},
    {"_ord": 6, "deal_id": "9007199254740993", "status": "F"},
    {"_ord": 7, "deal_id": "+7", "total_amount": " 12 ", "with_marking": "Y",
     "self_shipment": "0", "order_actions": [{"product_unit_id": "2", "bonus_id": "x"}]},
]


def test_orders_pipeline(spark, tmpdir_path):
    exp = land_json(spark, "order", write_lines(os.path.join(tmpdir_path, "order"), ORDERS))
    orders = table(exp, "orders")
    assert len(orders.columns) == 51
    assert _rows(orders, "deal_id", "filial_code", "total_amount", "with_marking",
                 "self_shipment") == sorted([
        (10, "A", 100.5, True, None),
        (None, None, None, None, None),          # first of the NULL keys (_ord 3)
        (9007199254740993, None, None, None, None),
        (7, None, 12.0, None, False),
    ], key=repr)
    assert _rows(table(exp, "order_products"), "deal_id", "product_unit_id", "external_id",
                 "sold_quant", "price_type_id") == sorted([
        (10, 1, "e1", 2.0, None), (10, 1000, None, None, None)], key=repr)
    assert _rows(table(exp, "order_product_details")) == [(10, 1, None, None, "b1", 1.0)]
    assert _rows(table(exp, "order_product_action_margins"), "deal_id", "product_unit_id",
                 "bonus_id", "margin_value") == [(10, 1000, 4, 0.5)]
    assert table(exp, "order_gifts").count() == 0             # scalar list -> no rows
    assert _rows(table(exp, "order_actions"), "deal_id", "product_unit_id", "bonus_id") == [
        (7, 2, "x")]                                           # bonus_id stays text
    (c,) = table(exp, "order_consignments").collect()
    assert c.deal_id == 10 and c.consignment_unit_id == 3 and c.consignment_amount == float("inf")


PRODUCTS = [
    {"_ord": 1, "product_id": "1", "state": "A", "name": "first",
     "groups": [{"group_id": "5", "type_id": "1"}, {"group_id": "5", "type_id": "1.0"},
                {"group_id": "x", "type_id": "1"}],
     "inventory_kinds": [{"inventory_kind": " g "}, {"inventory_kind": "M"},
                         {"inventory_kind": ""}, {"inventory_kind": None},
                         {"inventory_kind": "x"}, {"inventory_kind": "m"}],
     "sector_codes": [{"sector_code": " s1\t"}, {"sector_code": "   "}, {"sector_code": ""}]},
    {"_ord": 2, "product_id": "1", "state": "A", "name": "second"},
    {"_ord": 3, "product_id": "2", "state": "P"},
    {"_ord": 4, "product_id": "3", "state": None},
    {"_ord": 5, "product_id": "4", "state": "A", "weight_netto": "5d"},
]


def test_products_pipeline(spark, tmpdir_path):
    exp = land_json(spark, "products", write_lines(os.path.join(tmpdir_path, "p"), PRODUCTS))
    assert _rows(table(exp, "products"), "product_id", "name", "weight_netto") == [
        (1, "first", None), (4, None, None)]
    assert _rows(table(exp, "product_group"), "product_id", "group_id", "type_id") == [(1, 5, 1)]
    assert _rows(table(exp, "product_inventory_kind")) == [
        (1, "G", "Goods (tovar)"), (1, "M", "Material (material)"), (1, "X", None)]
    assert _rows(table(exp, "product_sector")) == [(1, ""), (1, "s1")]


LEGAL = [
    {"_ord": 1, "person_id": "1", "state": "A", "is_client": "T",
     "groups": [{"group_code": " g1 ", "type_code": None}, {"group_code": "g2", "type_code": " "},
                {"group_code": "g1", "type_code": "t"}],
     "bank_accounts": [{"bank_account_id": "0", "state": "A", "is_main": "1"},
                       {"bank_account_id": "7", "state": ""},
                       {"bank_account_id": "8", "state": None},
                       {"bank_account_id": "", "state": "A"},
                       {"bank_account_id": "x", "state": "A"}],
     "rooms": [{"room_id": "3"}, {"room_id": ""}, {"room_id": "3", "room_code": "dup"}]},
]


def test_legal_entity_rules(spark, tmpdir_path):
    exp = land_json(spark, "legal_entity", write_lines(os.path.join(tmpdir_path, "l"), LEGAL))
    assert _rows(table(exp, "legal_entity_group")) == [(1, "g1", None), (1, "g2", None)]
    # O3 keeps "A" and "", O4 keeps text "0" (D7), junk id dropped by O11
    assert _rows(table(exp, "legal_entity_bank_account"), "bank_account_id", "is_main",
                 "state") == [(0, True, "A"), (7, None, "")]
    assert _rows(table(exp, "legal_entity_room"), "room_id", "room_code") == [(3, None)]


VISITS = [
    {"_ord": 1, "visit_headers": [{"visit_id": "5", "person_types": [{"person_type_id": "2"}]},
                                  {"visit_id": "6"}],
     "stocks": [{"stock_quant": "1"}],
     "merchandisings": [{"merchandising_id": "9",
                         "planograms": [{"planogram_id": "4",
                                         "planogram_products": [{"planogram_match": "y"}]}],
                         "shelf_shares": [{"own_shelf_shares": [
                             {"own_shelf_share_product_quant": "2"}]}]}],
     "quizzes": [{"quiz_sets": [{"quiz_name": "q"}]}]},
    {"_ord": 2, "note": "n", "stocks": [{"stock_quant": "x"}],
     "comments": [{"comment_name": "c"}]},
    {"_ord": 3, "note": None, "visit_headers": [{"visit_id": None}, {"visit_id": "8"}],
     "equipments": [{"equipment_id": "3"}]},
]


def test_visit_pipeline(spark, tmpdir_path):
    exp = land_json(spark, "visit", write_lines(os.path.join(tmpdir_path, "v"), VISITS))
    assert _rows(table(exp, "visits"), "visit_id", "note") == sorted(
        [(5, ""), (6, ""), (None, ""), (8, "")], key=repr)
    assert _rows(table(exp, "visit_person_types")) == [(5, 2, None)]
    assert _rows(table(exp, "visit_stocks"), "visit_id", "stock_quant") == sorted(
        [(5, 1.0), (None, None)], key=repr)                   # block without header
    assert _rows(table(exp, "visit_planogram_products"), "visit_id", "planogram_id",
                 "planogram_match") == [(5, 4, "y")]
    assert _rows(table(exp, "visit_shelf_own"), "visit_id", "merchandising_id",
                 "own_shelf_share_product_quant") == [(5, 9, 2.0)]
    assert _rows(table(exp, "visit_quizzes"), "visit_id", "quiz_name") == [(5, "q")]
    assert _rows(table(exp, "visit_comments"), "visit_id", "comment_name") == [(None, "c")]
    assert _rows(table(exp, "visit_equipments"), "visit_id", "equipment_id") == [(None, 3)]


def test_purchase_marking_codes_whole_row_dedup(spark, tmpdir_path):
    docs = [{"_ord": 1, "purchase_id": "1", "purchase_items": [
        {"purchase_item_id": "1", "marking_codes": [
            {"marking_code": "m1"}, {"marking_code": " m1\t"}, {"marking_code": ""},
            {"marking_code": None}, {"marking_code": "m2"}]},
        {"purchase_item_id": "1", "marking_codes": [{"marking_code": "m9"}]}]}]
    exp = land_json(spark, "purchase", write_lines(os.path.join(tmpdir_path, "pu"), docs))
    assert _rows(table(exp, "purchase_marking_codes")) == [(1, 1, "m1"), (1, 1, "m2")]


def test_empty_child_table_has_schema(spark, tmpdir_path):
    docs = [{"_ord": 1, "deal_id": "1"}]                       # D4: no lines at all
    exp = land_json(spark, "order", write_lines(os.path.join(tmpdir_path, "o"), docs))
    df = table(exp, "order_product_details")
    assert df.count() == 0 and df.columns[:2] == ["deal_id", "product_unit_id"]


def test_rejects_counted_not_fatal(spark, tmpdir_path):
    from tradelake.plans.build import rejects
    exp = land_json(spark, "order", write_lines(os.path.join(tmpdir_path, "r"), ORDERS))
    got = {r["column"]: r["n_rejects"] for r in rejects(exp, "orders").collect()}
    assert got["deal_id"] == 1 and got["room_id"] == 0          # "12.5"
    got = {r["column"]: r["n_rejects"] for r in rejects(exp, "order_products").collect()}
    assert got == {"product_unit_id": 0, "price_type_id": 1}   # "1.5"


@pytest.mark.parametrize("source, docs", [("order", ORDERS), ("visit", VISITS)])
def test_pipeline_run_equals_in_memory_build(spark, tmpdir_path, source, docs):
    """A pipeline run (bronze copy, parents written and read back) writes
    exactly the tables the in-memory builder gives, grandchildren included."""
    from tradelake.plans import pipelines
    from tradelake.plans.pipelines import read_table
    from tradelake.plans.specs import PIPELINES
    land = write_lines(os.path.join(tmpdir_path, "land"), docs)
    out = os.path.join(tmpdir_path, "out")
    pipelines.run(spark, source, land, out, on_empty="replace", on_corrupt="drop")
    from tradelake.sources.jsonsrc import flatten, in_order, read_lines
    docs = in_order(read_lines(spark, source, land))
    docs.write.parquet(os.path.join(tmpdir_path, "whole"))      # parsed in full, as the bronze copy is
    exp = flatten(source, spark.read.parquet(os.path.join(tmpdir_path, "whole")))
    for name in PIPELINES[source]:
        want = table(exp, name)
        got = read_table(spark, out, name)
        assert got.columns == want.columns, name
        assert _rows(got) == _rows(want), name


def test_lines_land_compressed(spark):
    """Landed documents take a fraction of their text on disk, and read as whole."""
    from tradelake.sources import driver, jsonsrc
    path = driver.write_as_json(spark, "/root/testdata/sf0.001", "order")
    files = jsonsrc.read_lines(spark, "order", path).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)
    docs = jsonsrc.read_lines(spark, "order", path)
    assert docs.count() == driver.documents(spark, "/root/testdata/sf0.001", "order").count()
    assert docs.where("_corrupt_record IS NOT NULL").isEmpty()


def test_lines_of_an_order_move_once_as_table_rows(spark, tmpdir_path):
    """Lists of the same lines are gathered at once, and their text is made behind the shuffle."""
    from datetime import datetime
    from tradelake.sources import driver
    day = datetime(2024, 5, 6)

    def line(order, number, flag="N"):
        return (order, 7, 3, number, 2.0, 10.0, 0.1, 0.02, flag, "O", day)
    tables = {
        "nation": ([(1, "UZ")], "n_nationkey int, n_name string"),
        "customer": ([(5, "c5", 1)], "c_custkey long, c_name string, c_nationkey int"),
        "orders": ([(1, 5, "O", 9.0, day, "1-URGENT"), (2, 5, "F", 8.0, day, "2-HIGH"), (None, 5, "F", 8.0, day, "2-HIGH")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([line(1, 2, "R"), line(None, 1), line(1, 1), line(3, 1), line(1, 1)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(tmpdir_path, f"{name}.parquet"))
    docs = driver.documents(spark, tmpdir_path, "order")
    got = {r["_ord"]: r for r in docs.collect()}
    assert set(got) == {1, 2, None}
    for path in ("order_products", "order_gifts", "order_actions"):
        assert [x["external_id"] for x in got[1][path]] == ["E1", "E1", "E2"]
        assert got[2][path] is None and got[None][path] is None
    assert [[d and d["batch_number"] for d in x["details"]] for x in got[1]["order_products"]] == [
        ["B1", None], ["B1", None], ["B1", "RB1"]]
    assert got[1]["filial_code"] == "UZ" and got[1]["order_gifts"][0]["card_code"] == "GIFT"
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [l_orderkey") == 1
    moved = plan[plan.index("RepartitionByExpression [l_orderkey"):].split(" parquet\n")[0]
    assert "l_shipdate" in moved and "CASE" not in moved and "concat" not in moved


@pytest.mark.parametrize("source, docs", [("order", ORDERS), ("legal_entity", LEGAL)])
def test_lists_are_shuffled_with_what_the_table_reads(spark, tmpdir_path, source, docs):
    from tradelake.plans.build import build_with_refs
    from tradelake.plans.specs import PIPELINES
    exp = land_json(spark, source, write_lines(os.path.join(tmpdir_path, "slim"), docs))
    for name in PIPELINES[source]:
        assert _rows(table(exp, name)) == _rows(table(exp, name, {})), name    # a memo: whole lists
    if source == "order":
        df, _ = build_with_refs(exp, "orders", carry=("order_products",), only="order_product_details")
        element = df.schema["_list_order_products"].dataType.elementType
        assert set(element.names) == {"product_unit_id", "external_id", "details"}
        assert set(element["details"].dataType.elementType.names) == {"expiry_date", "card_code", "batch_number", "sold_quant"}
