"""Landing adapter: the driver's relational tables -> normalised export frames.

The reference ingests nested exports of a trade system.  For tests and the
benchmark we derive those exports from the TPC-H-like driver tables (mapping in
SURVEY §7): an order document is an ``orders`` row, its ``order_products`` are
its ``lineitem`` rows, and so on.  A list whose elements all come from its
parent's own table row (a line's batches, a product's groups) is an array of
structs in that row, as in a nested document; a list that is a table of its own
stays a frame of its own.  Every frame is a projection (plus at most a join
with a dimension) of one table, so the landing work is narrow and grows
linearly with the tables.

Leaves are text, as in the real exports; some values are deliberately dirty
(whitespace, ``1e3``, ``12.5``, junk, blanks, NULLs, boolean spellings) so the
coercion and de-duplication rules do real work.  Frames are written in the
common subset of Spark SQL and DuckDB SQL, so the oracle reads exactly the same
landed rows and only the table builders are compared.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, settings
from . import jsonsrc
from .export import Export, Frame, path_depth
from .registry import ENVELOPE_KEYS

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


# -- dirty text helpers (SQL snippets valid in Spark and DuckDB) -----------------

def txt(x: str) -> str:
    return f"CAST({x} AS STRING)"


def dec(x: str) -> str:
    """Money/quantity as text with two decimals (same rendering in both engines)."""
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS STRING)"


def day(ts: str) -> str:
    return f"CAST(CAST({ts} AS DATE) AS STRING)"


def dirty_int(v: str, sel: str | None = None) -> str:
    """Integer id as text; ``sel`` (default ``v``) picks the spelling."""
    s = sel or v
    return (f"(CASE WHEN ({s}) % 53 = 7 THEN 'x' || {txt(v)} "
            f"WHEN ({s}) % 13 = 5 THEN ' ' || {txt(v)} || ' ' "
            f"WHEN ({s}) % 11 = 3 THEN {txt(v)} || '.0' "
            f"WHEN ({s}) % 59 = 9 THEN {txt(v)} || '.5' "
            f"WHEN ({s}) % 61 = 1 THEN NULL "
            f"WHEN ({s}) % 67 = 2 THEN '1e3' "
            f"WHEN ({s}) % 17 = 4 THEN '+' || {txt(v)} "
            f"WHEN ({s}) % 71 = 8 THEN '' "
            f"ELSE {txt(v)} END)")


def dirty_num(v: str, sel: str, inf: bool = False) -> str:
    """Decimal amount as text with junk, NaN, padding, blanks and NULLs."""
    extra = f"WHEN ({sel}) % 79 = 7 THEN 'inf' " if inf else ""
    return (f"(CASE WHEN ({sel}) % 43 = 2 THEN 'n/a' "
            f"WHEN ({sel}) % 47 = 3 THEN 'NaN' "
            f"WHEN ({sel}) % 41 = 4 THEN ' ' || {dec(v)} || ' ' "
            f"WHEN ({sel}) % 37 = 5 THEN '' "
            f"WHEN ({sel}) % 73 = 6 THEN NULL "
            f"WHEN ({sel}) % 83 = 8 THEN {dec(v)} || 'd' "
            f"{extra}ELSE {dec(v)} END)")


def dirty_bool(sel: str) -> str:
    return (f"(CASE ({sel}) % 12 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN 'T' "
            f"WHEN 3 THEN 'f' WHEN 4 THEN 'yes' WHEN 5 THEN 'NO' WHEN 6 THEN 'Y' "
            f"WHEN 7 THEN 'N' WHEN 8 THEN '1.0' WHEN 9 THEN ' true ' WHEN 10 THEN 'False' "
            f"ELSE NULL END)")


def dirty_code(v: str, sel: str) -> str:
    """A code with padding (space/tab), blank, whitespace-only and NULL cases."""
    return (f"(CASE ({sel}) % 9 WHEN 1 THEN ' ' || {v} || chr(9) WHEN 2 THEN '' "
            f"WHEN 3 THEN NULL WHEN 4 THEN '   ' ELSE {v} END)")


def state(sel: str) -> str:
    return (f"(CASE WHEN ({sel}) % 7 = 0 THEN 'P' WHEN ({sel}) % 23 = 0 THEN NULL "
            f"WHEN ({sel}) % 29 = 0 THEN '' ELSE 'A' END)")


# -- frame definitions -------------------------------------------------------------

@dataclass
class Part:
    source: str                                  # FROM clause, {table} placeholders
    refs: list[tuple[str, str]]                  # (name, expr) record/position columns
    fields: dict[str, str] = field(default_factory=dict)
    where: str | None = None
    distinct: bool = False

    def value(self, column: str) -> str:
        return self.fields.get(column, "CAST(NULL AS STRING)")

    def sql(self, columns: list[str], lists: dict[str, str] | None = None) -> str:
        sel = [f"{e} AS {n}" for n, e in self.refs]
        sel += [f"{self.value(c)} AS {c}" for c in columns]
        sel += [f"{e} AS {n}" for n, e in (lists or {}).items()]
        w = f" WHERE {self.where}" if self.where else ""
        d = "DISTINCT " if self.distinct else ""
        return f"SELECT {d}{', '.join(sel)} FROM {self.source}{w}"


@dataclass
class FrameDef:
    parts: list[Part]

    @property
    def refs(self) -> tuple[str, ...]:
        return tuple(n for n, _ in self.parts[0].refs)

    @property
    def columns(self) -> list[str]:
        cols: list[str] = []
        for p in self.parts:
            cols += [c for c in p.fields if c not in cols]
        return cols

    def sql(self, lists: dict[str, str] | None = None) -> str:
        cols = self.columns
        return " UNION ALL ".join(p.sql(cols, lists) for p in self.parts)


# Reference columns for a lineitem row: order key + the total tie-break order.
LINE_POS = [("_p1", "l_linenumber"), ("_p1_b", "l_partkey"), ("_p1_c", "l_suppkey"),
            ("_p1_d", "l_quantity"), ("_p1_e", "l_extendedprice"), ("_p1_f", "l_discount"),
            ("_p1_g", "l_tax"), ("_p1_h", "l_returnflag"), ("_p1_i", "l_linestatus"),
            ("_p1_j", "l_shipdate")]
LINE_REFS = [("_ord", "l_orderkey")] + LINE_POS
BLOCK = "(user_id * 10000 + month(ts) * 100 + day(ts))"   # visit block = user x day


def _copies(n: int, make) -> list[Part]:
    return [make(i) for i in range(n)]


def _line_fields(sel: str = "l_partkey") -> dict[str, str]:
    return {
        "external_id": "(CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE 'E' || "
                       + txt("l_linenumber") + " END)",
        "product_unit_id": dirty_int("l_linenumber", sel),
        "product_code": txt("l_partkey"),
        "product_local_code": "'LC' || " + txt("l_partkey % 97"),
        "product_name": "'part ' || " + txt("l_partkey"),
        "expiry_date": day("l_shipdate"),
        "order_quant": dec("l_quantity"),
        "sold_quant": dirty_num("l_quantity", "l_partkey + l_linenumber"),
        "return_quant": f"(CASE WHEN l_returnflag = 'R' THEN {dec('l_quantity')} ELSE '0' END)",
        "inventory_kind": "'G'",
        "on_balance": "l_linestatus",
        "warehouse_code": "'W' || " + txt("l_suppkey"),
    }


def _frames() -> dict[str, dict[str, FrameDef]]:
    F_: dict[str, dict[str, FrameDef]] = {}
    L = "{lineitem}"
    O = "{orders}"

    # ------------------------------------------------------------------ order
    ocn = ("{orders} JOIN {customer} ON o_custkey = c_custkey "
           "JOIN {nation} ON c_nationkey = n_nationkey")
    F_["order"] = {
        "": FrameDef([Part(ocn, [("_ord", "o_orderkey")], {
            "filial_code": "n_name",
            "external_id": "'EX' || " + txt("o_orderkey"),
            "deal_id": dirty_int("o_orderkey"),
            "deal_time": day("o_orderdate"),
            "total_amount": dirty_num("o_totalprice", "o_orderkey"),
            "room_id": dirty_int("o_custkey", "o_orderkey + 3"),
            "room_code": "'R' || " + txt("o_custkey % 300"),
            # manager proxy: o_custkey % 50 (the driver tables have no sales reps)
            "sales_manager_id": txt("o_custkey % 50"),
            "sales_manager_code": "'M' || " + txt("o_custkey % 50"),
            "person_id": txt("o_custkey"),
            "person_name": "c_name",
            "currency_code": "(CASE WHEN o_orderkey % 4 = 0 THEN 'USD' ELSE 'UZS' END)",
            "payment_type_code": "o_orderpriority",
            "deal_margin_value": dirty_num("o_totalprice", "o_custkey"),
            "status": "o_orderstatus",
            "with_marking": dirty_bool("o_orderkey"),
            "self_shipment": dirty_bool("o_custkey"),
            "visit_id": dirty_int("o_custkey", "o_custkey + o_orderkey"),
            "total_weight_netto": dirty_num("o_totalprice", "o_orderkey + 1", inf=True),
        })]),
        "order_products": FrameDef([Part(L, LINE_REFS, {
            **_line_fields(),
            "card_code": "(CASE WHEN l_tax > 0.05 THEN 'CARD' END)",
            "product_price": dirty_num("l_extendedprice", "l_suppkey + l_linenumber"),
            "margin_value": dec("l_discount"),
            "margin_kind": "'P'",
            "vat_percent": dec("l_tax"),
            "sold_amount": dec("l_extendedprice"),
            "price_type_code": "'PT' || " + txt("l_suppkey % 40"),
            "price_type_id": dirty_int("l_suppkey % 10", "l_partkey"),
        })]),
        "order_products.details": FrameDef([
            Part(L, LINE_REFS + [("_p2", "0")], {
                "expiry_date": day("l_shipdate"),
                "card_code": "l_linestatus",
                "batch_number": "'B' || " + txt("l_orderkey"),
                "sold_quant": dec("l_quantity"),
            }),
            Part(L, LINE_REFS + [("_p2", "1")], {
                "expiry_date": day("l_shipdate"),
                "batch_number": "'RB' || " + txt("l_orderkey"),
                "sold_quant": "'-' || " + dec("l_quantity"),
            }, where="l_returnflag = 'R'"),      # a returned line has a return batch too
        ]),
        "order_products.action_margins": FrameDef([
            Part(L, LINE_REFS + [("_p2", "0")], {
                "bonus_calc_level": "'line'",
                "bonus_id": dirty_int("l_suppkey", "l_partkey + 1"),
                "margin_value": dirty_num("l_discount * 100", "l_partkey"),
                "margin_kind": "'P'",
                "action_name": "'promo ' || " + txt("l_suppkey % 20"),
            }),
            Part(L, LINE_REFS + [("_p2", "1")], {
                "bonus_calc_level": "'order'",
                "bonus_id": txt("l_orderkey % 1000"),
                "margin_value": dec("l_tax"),
                "margin_kind": "'A'",
            }),
        ]),
        "order_gifts": FrameDef([Part(L, LINE_REFS, {
            **_line_fields("l_suppkey"), "card_code": "'GIFT'"})]),
        "order_actions": FrameDef([Part(L, LINE_REFS, {
            **_line_fields("l_orderkey"),
            "bonus_id": txt("l_suppkey"),
            "action_name": "'action ' || " + txt("l_suppkey % 15"),
        })]),
        "order_consignments": FrameDef([Part(O, [("_ord", "o_orderkey"), ("_p1", "0")], {
            "external_id": "'C' || " + txt("o_orderkey"),
            "consignment_unit_id": dirty_int("o_custkey", "o_orderkey"),
            "consignment_date": day("o_orderdate"),
            "consignment_amount": dirty_num("o_totalprice", "o_custkey + o_orderkey"),
        })]),
    }

    # ---------------------------------------------------------------- returns
    F_["returns"] = {
        "": FrameDef([Part(O, [("_ord", "o_orderkey")], {
            "filial_code": "'F' || " + txt("o_custkey % 25"),
            "external_id": "'RX' || " + txt("o_orderkey"),
            "deal_id": dirty_int("o_orderkey + 1000000", "o_orderkey"),
            "deal_time": day("o_orderdate"),
            "order_deal_id": dirty_int("o_orderkey", "o_custkey"),
            "room_id": txt("o_custkey % 300"),
            "person_id": txt("o_custkey"),
            "total_amount": dirty_num("o_totalprice", "o_orderkey + 2"),
            "status": "o_orderpriority",
            "return_reason_id": dirty_int("o_custkey % 12", "o_orderkey"),
            "return_reason_code": "'RR' || " + txt("o_custkey % 12"),
            "currency_code": "'UZS'",
        }, where="o_orderkey IN (SELECT l_orderkey FROM {lineitem} WHERE l_returnflag = 'R')")]),
        "return_products": FrameDef([Part(L, LINE_REFS, {
            **_line_fields("l_suppkey"),
            "return_quant": dirty_num("l_quantity", "l_suppkey"),
            "product_price": dec("l_extendedprice"),
            "margin_value": dec("l_discount"),
            "vat_percent": dec("l_tax"),
            "sold_amount": dec("l_extendedprice"),
        }, where="l_returnflag = 'R'")]),
    }

    # ------------------------------------------------------------------ visit
    E = "{events}"
    blk = [("_ord", BLOCK)]
    ev1 = blk + [("_p1", "event_id")]
    click = "event_type = 'click'"
    F_["visit"] = {
        "": FrameDef([Part(E, blk, {
            "note": f"(CASE WHEN (user_id + day(ts)) % 5 = 0 THEN NULL ELSE 'u' || "
                    f"{txt('user_id')} || '-' || {txt('day(ts)')} END)",
        }, distinct=True)]),
        "visit_headers": FrameDef([Part(E, ev1, {
            "visit_id": dirty_int("event_id", "event_id + user_id"),
            "filial_code": "'F' || " + txt("user_id % 25"),
            "visit_date": day("ts"),
            "visit_start_time": txt("hour(ts)") + " || ':' || " + txt("minute(ts)"),
            "time_at_retail_outlet_sec": dirty_num("value", "event_id", inf=True),
            "person_id": txt("user_id"),
            "person_code": "'U' || " + txt("user_id"),
            "room_id": dirty_int("user_id % 300", "event_id"),
            "supervisor_id": txt("user_id % 7"),
            "sales_manager_id": txt("user_id % 50"),
            "is_planned": "(CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END)",
            "visit_status": "event_type",
        }, where="event_type IN ('view', 'signup')")]),
        "visit_headers.person_types": FrameDef([Part(E, ev1 + [("_p2", "0")], {
            "person_type_id": dirty_int("user_id % 4", "event_id"),
            "person_type_name": "'type ' || " + txt("user_id % 4"),
        }, where="event_type IN ('view', 'signup')")]),
        "stocks": FrameDef([Part(E, ev1, {
            "stock_product_code": "'P' || " + txt("event_id % 500"),
            "stock_quant": dirty_num("value", "event_id"),
            "stock_expiry_date": day("ts"),
        }, where="event_type = 'purchase'")]),
        "merchandisings": FrameDef([Part(E, ev1, {
            "merchandising_id": dirty_int("event_id", "user_id"),
        }, where=click)]),
        "merchandisings.assortment": FrameDef(_copies(2, lambda i: Part(
            E, ev1 + [("_p2", str(i))], {
                "assortment_product_code": "'A' || " + txt(f"(event_id + {i}) % 300"),
                "has_assortment": "'true'" if i == 0 else "'false'",
                "assortment_product_quant": dirty_num("value", f"event_id + {i}"),
                "assortment_product_ir_quant": dec(f"value * {i + 2}"),
            }, where=click))),
        "merchandisings.planograms": FrameDef([Part(E, ev1 + [("_p2", "0")], {
            "planogram_id": dirty_int("event_id * 10", "event_id + 1"),
            "planogram_name": "'plan ' || " + txt("user_id % 9"),
            "planogram_plan_quant": dec("value"),
            "planogram_plan_sku": txt("user_id % 13"),
            "planogram_fact_quant": dirty_num("value", "event_id + 2"),
            "planogram_fact_sku": txt("event_id % 13"),
        }, where=click)]),
        "merchandisings.planograms.planogram_equipments": FrameDef([Part(
            E, ev1 + [("_p2", "0"), ("_p3", "0")], {
                "planogram_equipment_id": dirty_int("event_id % 1000", "user_id"),
                "planogram_equipment_name": "'equipment'",
            }, where=click)]),
        "merchandisings.planograms.planogram_products": FrameDef(_copies(2, lambda i: Part(
            E, ev1 + [("_p2", "0"), ("_p3", str(i))], {
                "planogram_product_name": "'prod ' || " + txt(f"event_id % 50 + {i}"),
                "planogram_sample_unit_id": dirty_int(f"event_id % 50 + {i}", f"event_id + {i}"),
                "planogram_product_plan_quant": dec("value"),
                "planogram_product_fact_quant": dirty_num("value", f"event_id + {i}"),
                "planogram_match": "'true'",
                "planogram_match_face_quant": txt(f"{i} + user_id % 3"),
            }, where=click))),
        "merchandisings.shelf_shares.own_shelf_shares": FrameDef([Part(
            E, ev1 + [("_p2", "0"), ("_p3", "0")], {
                "own_shelf_share_product_code": "'P' || " + txt("user_id % 70"),
                "own_shelf_share_product_quant": dirty_num("value", "user_id + event_id"),
            }, where=click)]),
        "merchandisings.shelf_shares.competitor_inventories": FrameDef([Part(
            E, ev1 + [("_p2", "0"), ("_p3", "0")], {
                "competitor_code": "'K' || " + txt("user_id % 5"),
                "competitor_inventory_product_code": "'Q' || " + txt("event_id % 40"),
                "competitor_inventory_product_quant": dec("value"),
            }, where=click)]),
        "merchandisings.price_tags": FrameDef([Part(E, ev1 + [("_p2", "0")], {
            "price_tag_product_code": "'P' || " + txt("event_id % 90"),
            "has_price_tag": "(CASE WHEN event_id % 3 = 0 THEN 'false' ELSE 'true' END)",
            "price": dirty_num("value * 3", "event_id"),
        }, where=click)]),
        "merchandisings.displays": FrameDef([Part(E, ev1 + [("_p2", "0")], {
            "display_id": dirty_int("event_id % 777", "event_id"),
            "display_name": "'display'",
            "has_display": "'true'",
        }, where=click)]),
        "quizzes.quiz_sets": FrameDef([Part(E, ev1 + [("_p2", "0")], {
            "quiz_name": "'quiz ' || " + txt("event_id % 6"),
            "answer": txt("value"),
            "has_quiz_photo": "'false'",
        }, where="event_type = 'error'")]),
        "equipments": FrameDef([Part(E, ev1, {
            "equipment_id": dirty_int("user_id % 400", "event_id"),
            "equipment_serial_number": "'SN' || " + txt("event_id"),
            "equipment_status": "'ok'",
        }, where="event_type = 'signup'")]),
        "comments": FrameDef([Part(E, ev1, {
            "comment_name": "'comment ' || " + txt("event_id"),
            "comment_created_by_name": "'U' || " + txt("user_id"),
        }, where="event_type = 'view'")]),
    }

    # -------------------------------------------------------------- warehouse
    def movement_items(id_sel: str) -> dict[str, str]:
        return {
            "external_id": "'MI' || " + txt("l_linenumber"),
            "product_code": txt("l_partkey"),
            "inventory_kind": "'G'",
            "card_code": "l_linestatus",
            "expiry_date": day("l_shipdate"),
            "serial_number": "'S' || " + txt("l_partkey"),
            "quantity": dirty_num("l_quantity", f"l_partkey + {id_sel}"),
            "batch_number": "'B' || " + txt("l_suppkey"),
        }

    F_["cross_movement"] = {
        "": FrameDef([Part(O, [("_ord", "o_orderkey")], {
            "from_filial_code": "'F' || " + txt("o_custkey % 25"),
            "external_id": "(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'CM' || "
                           + txt("o_custkey") + " END)",
            "movement_id": dirty_int("o_orderkey"),
            "from_time": day("o_orderdate"),
            "request_id": txt("o_custkey"),
            "reason_id": dirty_int("o_custkey % 9", "o_orderkey"),
            "amount": dirty_num("o_totalprice", "o_orderkey"),
            "amount_base": dec("o_totalprice"),
            "status": "o_orderstatus",
        }, where="o_orderpriority IN ('1-URGENT', '2-HIGH')")]),
        "movement_items": FrameDef([Part(L, LINE_REFS, {
            "movement_unit_id": dirty_int("l_linenumber", "l_partkey"),
            "request_item_id": dirty_int("l_partkey", "l_suppkey"),
            "from_inventory_kind": "'G'",
            "product_code": txt("l_partkey"),
            "quantity": dirty_num("l_quantity", "l_partkey"),
            "price": dec("l_extendedprice"),
            "amount": dirty_num("l_extendedprice", "l_suppkey"),
            "margin_value": dec("l_discount"),
            "vat_percent": dec("l_tax"),
            "load_id": "'LD' || " + txt("l_suppkey"),
        })]),
    }
    F_["internal_movement"] = {
        "": FrameDef([Part(O, [("_ord", "o_orderkey")], {
            "filial_code": "'F' || " + txt("o_custkey % 25"),
            "external_id": "'IM' || " + txt("o_orderkey"),
            "movement_id": dirty_int("o_orderkey", "o_orderkey + 5"),
            "movement_number": txt("o_orderkey"),
            "from_movement_date": day("o_orderdate"),
            "request_id": dirty_int("o_custkey", "o_orderkey"),
            "status": "o_orderstatus",
        }, where="o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")]),
        "movement_items": FrameDef([Part(L, LINE_REFS, {
            **movement_items("l_suppkey"),
            "movement_item_id": dirty_int("l_linenumber", "l_suppkey"),
            "request_item_id": txt("l_partkey"),
        })]),
    }
    F_["stocktaking"] = {
        "": FrameDef([Part(O, [("_ord", "o_orderkey")], {
            "filial_code": "'F' || " + txt("o_custkey % 25"),
            "stocktaking_id": dirty_int("o_orderkey", "o_orderkey + 1"),
            "stocktaking_date": day("o_orderdate"),
            "status": "o_orderpriority",
            "c_income_amount": dirty_num("o_totalprice", "o_orderkey"),
            "c_income_amount_base": dec("o_totalprice"),
            "c_expense_amount": dirty_num("o_totalprice", "o_custkey + 1"),
        }, where="o_orderstatus = 'O'")]),
        "stocktaking_items": FrameDef([Part(L, LINE_REFS, {
            **movement_items("l_orderkey"),
            "stocktaking_item_id": dirty_int("l_linenumber", "l_partkey + 1"),
            "balance_quantity": dec("l_quantity + 1"),
            "income_price": dirty_num("l_extendedprice", "l_suppkey"),
            "income_amount": dec("l_extendedprice"),
        })]),
    }
    F_["writeoff"] = {
        "": FrameDef([Part(O, [("_ord", "o_orderkey")], {
            "filial_code": "'F' || " + txt("o_custkey % 25"),
            "writeoff_id": dirty_int("o_orderkey", "o_orderkey + 2"),
            "writeoff_date": day("o_orderdate"),
            "c_amount": dirty_num("o_totalprice", "o_orderkey"),
            "c_amount_base": dec("o_totalprice"),
        }, where="o_orderstatus = 'P'")]),
        "writeoff_items": FrameDef([Part(L, LINE_REFS, {
            **movement_items("l_linenumber"),
            "writeoff_item_id": dirty_int("l_linenumber", "l_suppkey + 2"),
        })]),
    }
    F_["warehouse_input"] = {
        "": FrameDef([Part(O, [("_ord", "o_orderkey")], {
            "filial_code": "'F' || " + txt("o_custkey % 25"),
            "input_id": dirty_int("o_orderkey", "o_orderkey + 3"),
            "input_time": day("o_orderdate"),
            "status": "o_orderstatus",
        }, where="o_orderstatus = 'F'")]),
        "input_items": FrameDef([Part(L, LINE_REFS, {
            **movement_items("l_linenumber * 3"),
            "input_item_id": dirty_int("l_linenumber", "l_suppkey"),
            "purchase_id": txt("l_suppkey"),
            "purchase_item_id": dirty_int("l_partkey", "l_partkey + 1"),
            "price": dec("l_extendedprice"),
            "margin_value": dec("l_discount"),
            "vat_percent": dirty_num("l_tax", "l_partkey"),
        })]),
    }
    F_["purchase"] = {
        "": FrameDef([Part(O, [("_ord", "o_orderkey")], {
            "filial_code": "'F' || " + txt("o_custkey % 25"),
            "purchase_id": dirty_int("o_orderkey", "o_orderkey + 4"),
            "purchase_time": day("o_orderdate"),
            "supplier_code": "'S' || " + txt("o_custkey % 100"),
            "order_id": txt("o_orderkey"),
            "total_margin_value": dirty_num("o_totalprice", "o_orderkey + 3"),
            "status_code": "o_orderstatus",
            "posted": dirty_bool("o_orderkey"),
        })]),
        "purchase_items": FrameDef([Part(L, LINE_REFS, {
            **movement_items("l_suppkey"),
            "purchase_item_id": dirty_int("l_linenumber", "l_partkey + 3"),
            "order_item_id": txt("l_linenumber"),
            "base_price": dec("l_extendedprice"),
            "price": dirty_num("l_extendedprice", "l_partkey"),
            "vat_amount": dec("l_tax * 10"),
        })]),
        "purchase_items.marking_codes": FrameDef(_copies(3, lambda i: Part(
            L, LINE_REFS + [("_p2", str(i))], {
                "marking_code": ["'MC' || " + txt("l_partkey"),
                                 "' MC' || " + txt("l_partkey") + " || chr(9)",
                                 "(CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE 'MX' || "
                                 + txt("l_suppkey") + " END)"][i],
            }))),
    }
    F_["logistics"] = {
        "": FrameDef([Part("{customer}", [("_ord", "c_custkey")], {
            "logistics_id": dirty_int("c_custkey"),
            "external_id": "'LG' || " + txt("c_custkey"),
            "expeditor_code": "'X' || " + txt("c_nationkey"),
            "expeditor_name": "c_name",
            "van_code": "c_mktsegment",
            "cash_register_id": dirty_int("c_nationkey", "c_custkey"),
        })]),
        "deals": FrameDef([Part(O, [("_ord", "o_custkey"), ("_p1", "o_orderkey")], {
            "deal_id": dirty_int("o_orderkey", "o_custkey + o_orderkey"),
            "status": "o_orderstatus",
            "external_id": "'EX' || " + txt("o_orderkey"),
        })]),
    }

    # ------------------------------------------------------------- references
    P = "{part}"
    pk = [("_ord", "p_partkey")]
    F_["products"] = {
        "": FrameDef([Part(P, pk, {
            "product_id": dirty_int("p_partkey"),
            "code": "p_brand",
            "name": "p_name",
            "short_name": "substr(p_name, 1, 10)",
            "weight_netto": dirty_num("p_retailprice", "p_partkey", inf=True),
            "weight_brutto": dec("p_retailprice"),
            "litr": txt("p_size"),
            "box_quant": dirty_num("p_size", "p_partkey + 1"),
            "producer_code": "p_brand",
            "order_no": txt("p_partkey % 100"),
            "barcodes": "'BC' || " + txt("p_partkey"),
            "state": state("p_partkey"),
        })]),
        "groups": FrameDef(_copies(2, lambda i: Part(P, pk + [("_p1", str(i))], {
            "group_id": txt("p_size") if i == 0 else dirty_int("p_size", "p_partkey"),
            "group_code": "p_type" if i == 0 else "p_brand",
            "type_id": txt("p_size % 5") if i == 0 else dirty_int("p_size % 5", "p_partkey + 1"),
            "type_code": "'T' || " + txt("p_size % 5"),
        }))),
        "inventory_kinds": FrameDef(_copies(2, lambda i: Part(P, pk + [("_p1", str(i))], {
            "inventory_kind": [
                "(CASE p_partkey % 7 WHEN 0 THEN ' g ' WHEN 1 THEN 'M' WHEN 2 THEN 'p' "
                "WHEN 3 THEN 'E' WHEN 4 THEN 'S' WHEN 5 THEN 'X' ELSE '' END)",
                "(CASE p_size % 4 WHEN 0 THEN 'G' WHEN 1 THEN NULL WHEN 2 THEN '  ' "
                "ELSE 'S' || chr(9) END)"][i],
        }))),
        "sector_codes": FrameDef(_copies(2, lambda i: Part(P, pk + [("_p1", str(i))], {
            "sector_code": dirty_code("'SEC' || " + txt(f"p_size % {8 + i}"), f"p_partkey + {i}"),
        }))),
    }
    C = "{customer}"
    ck = [("_ord", "c_custkey")]
    F_["natural_person"] = {
        "": FrameDef([Part(C, ck, {
            "person_id": dirty_int("c_custkey"),
            "first_name": "c_name",
            "code": "c_mktsegment",
            "region_code": txt("c_nationkey"),
            "is_budgetarian": dirty_bool("c_custkey"),
            "state": state("c_custkey"),
            "is_client": dirty_bool("c_custkey + 3"),
            "is_supplier": dirty_bool("c_custkey + 7"),
            "main_phone": "'+998' || " + txt("c_custkey"),
        })]),
        "groups": FrameDef(_copies(2, lambda i: Part(C, ck + [("_p1", str(i))], {
            "group_code": dirty_code("c_mktsegment" if i == 0 else "'G' || " + txt("c_nationkey"),
                                     f"c_custkey + {i}"),
            "type_code": dirty_code("'T' || " + txt("c_nationkey % 3"), f"c_custkey + {2 * i + 1}"),
        }))),
        "rooms": FrameDef(_copies(2, lambda i: Part(C, ck + [("_p1", str(i))], {
            "room_id": dirty_int("c_nationkey", "c_custkey") if i == 0 else
            "(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE " + txt("c_custkey % 40") + " END)",
            "room_code": "'R' || " + txt(f"c_nationkey + {i}"),
            "room_type_code": "'shop'",
        }))),
    }
    Sp = "{supplier}"
    sk = [("_ord", "s_suppkey")]
    F_["services"] = {
        "": FrameDef([Part(Sp, sk, {
            "service_id": dirty_int("s_suppkey"),
            "code": "'SV' || " + txt("s_suppkey"),
            "name": "s_name",
            "measure_code": "'pc'",
            "state": state("s_suppkey"),
            "order_no": dirty_num("s_acctbal", "s_suppkey"),
        })]),
        "groups": FrameDef(_copies(2, lambda i: Part(Sp, sk + [("_p1", str(i))], {
            "group_code": dirty_code("'G' || " + txt(f"s_nationkey + {i}"), f"s_suppkey + {i}"),
            "type_code": dirty_code("'TY' || " + txt("s_suppkey % 3"), f"s_suppkey + {i + 2}"),
        }))),
    }
    F_["product_group"] = {
        "": FrameDef([Part(P, pk, {
            "product_group_id": dirty_int("p_size", "p_partkey"),
            "code": "p_type",
            "name": "p_brand",
            "product_kind": "'G'",
            "state": state("p_partkey + 1"),
        })]),
        "product_group_types": FrameDef(_copies(2, lambda i: Part(P, pk + [("_p1", str(i))], {
            "code": dirty_code("'PGT' || " + txt(f"p_partkey % {5 + i}"), f"p_partkey + {3 * i}"),
            "name": "p_brand",
            "order_no": dirty_num("p_retailprice", f"p_partkey + {i}"),
            "state": state(f"p_partkey + {i + 2}"),
        }))),
    }
    F_["price_type"] = {
        "": FrameDef([Part(Sp, sk, {
            "code": "'PT' || " + txt("s_suppkey % 40"),
            "name": "s_name",
            "with_card": dirty_bool("s_suppkey"),
            "state": state("s_suppkey + 1"),
            "price_type_kind": "'S'",
            "currency_code": "(CASE WHEN s_nationkey % 2 = 0 THEN 'USD' ELSE 'UZS' END)",
        })]),
    }
    F_["inventory_price"] = {
        "": FrameDef([Part(P, pk, {
            "inventory_code": "(CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE p_brand || '-' || "
                              + txt("p_partkey % 300") + " END)",
            "inventory_barcode": "'IB' || " + txt("p_partkey"),
        })]),
        "price_type": FrameDef(_copies(3, lambda i: Part(P, pk + [("_p1", str(i))], {
            "price_type_code": dirty_code(f"'R{i % 2}'", f"p_partkey + {i}"),
            "card_code": "(CASE WHEN p_size % 2 = 0 THEN NULL ELSE 'C' END)",
            "price": dirty_num(f"p_retailprice * {i + 1}", f"p_partkey + {i}"),
        }))),
    }
    F_["producers"] = {
        "": FrameDef([Part(Sp, sk, {
            "code": "'PR' || " + txt("s_nationkey") + " || '-' || " + txt("s_suppkey % 7"),
            "person_code": "s_name",
            "state": state("s_suppkey + 2"),
            "order_no": dirty_num("s_acctbal", "s_suppkey + 1"),
        })]),
    }
    F_["legal_entity"] = {
        "": FrameDef([Part(C, ck, {
            "person_id": dirty_int("c_custkey", "c_custkey + 5"),
            "name": "c_name",
            "code": "'LE' || " + txt("c_custkey"),
            "region_code": txt("c_nationkey"),
            "is_budgetarian": dirty_bool("c_custkey + 1"),
            "tin": txt("c_custkey * 7"),
            "state": state("c_custkey + 1"),
            "is_client": dirty_bool("c_custkey + 4"),
            "is_supplier": dirty_bool("c_custkey + 8"),
        })]),
        "groups": FrameDef(_copies(2, lambda i: Part(C, ck + [("_p1", str(i))], {
            "group_code": dirty_code("c_mktsegment" if i == 0 else "'G' || " + txt("c_nationkey"),
                                     f"c_custkey + {i + 4}"),
            "type_code": dirty_code("'T' || " + txt("c_nationkey % 3"), f"c_custkey + {2 * i}"),
        }))),
        "bank_accounts": FrameDef(_copies(3, lambda i: Part(C, ck + [("_p1", str(i))], {
            "bank_account_id": f"(CASE (c_custkey + {i}) % 6 WHEN 0 THEN '' WHEN 1 THEN '0' "
                               f"WHEN 2 THEN NULL ELSE " + dirty_int(f"c_custkey * 10 + {i}")
                               + " END)",
            "bank_account_code": "'BA' || " + txt(f"c_custkey * 10 + {i}"),
            "is_main": dirty_bool(f"c_custkey + {i}"),
            "currency_code": "'UZS'",
            "state": f"(CASE (c_custkey + {i}) % 4 WHEN 0 THEN 'A' WHEN 1 THEN '' "
                     f"WHEN 2 THEN NULL ELSE 'P' END)",
            "mfo": txt("c_nationkey"),
        }))),
        "rooms": FrameDef(_copies(2, lambda i: Part(C, ck + [("_p1", str(i))], {
            "room_id": dirty_int(f"c_nationkey + {i}", f"c_custkey + {i}"),
            "room_code": "'R' || " + txt(f"c_nationkey + {i}"),
            "room_type_code": "'office'",
        }))),
    }
    F_["person_group"] = {
        "": FrameDef([Part(C, ck, {
            "person_group_id": dirty_int("c_custkey % 200", "c_custkey"),
            "code": "c_mktsegment",
            "name": "'group ' || " + txt("c_custkey % 200"),
            "person_kind": "'L'",
            "state": state("c_custkey + 3"),
        })]),
        "person_group_types": FrameDef(_copies(2, lambda i: Part(C, ck + [("_p1", str(i))], {
            "code": dirty_code("'PGT' || " + txt(f"c_nationkey % {3 + i}"), f"c_custkey + {i}"),
            "name": "c_mktsegment",
            "order_no": dirty_num("c_acctbal", f"c_custkey + {i}"),
            "state": state(f"c_custkey + {i + 5}"),
        }))),
    }
    F_["workspaces"] = {
        "": FrameDef([Part("{customer} JOIN {nation} ON c_nationkey = n_nationkey", ck, {
            "room_id": dirty_int("c_custkey", "c_custkey + 6"),
            "room_code": "'R' || " + txt("c_custkey"),
            "filial_code": "n_name",
            "room_name": "c_name",
            "room_type_code": "c_mktsegment",
            "state": state("c_custkey + 4"),
            "order_no": dirty_num("c_acctbal", "c_custkey"),
        })]),
    }
    F_["contracts"] = {
        "": FrameDef([Part(O, [("_ord", "o_orderkey")], {
            "contract_id": dirty_int("o_custkey", "o_orderkey"),
            "filial_code": "'F' || " + txt("o_custkey % 25"),
            "code": "'CT' || " + txt("o_orderkey"),
            "contract_date": day("o_orderdate"),
            "contract_number": txt("o_orderkey"),
            "person_code": txt("o_custkey"),
            "currency_code": "'UZS'",
            "initial_amount": dirty_num("o_totalprice", "o_orderkey"),
            "state": state("o_orderkey"),
            "is_main": dirty_bool("o_orderkey"),
        })]),
        "sub_contracts": FrameDef([Part(L, LINE_REFS, {
            "sub_contract_id": dirty_int("l_linenumber", "l_partkey"),
            "sub_contract_date": day("l_shipdate"),
            "sub_contract_number": txt("l_partkey"),
            "amount": dec("l_extendedprice"),
            "expiry_date": day("l_shipdate"),
        })]),
    }
    F_["return_reason"] = {
        "": FrameDef([Part(Sp, sk, {
            "return_reason_id": dirty_int("s_suppkey % 30", "s_suppkey"),
            "code": "'RR' || " + txt("s_suppkey % 30"),
            "name": "s_name",
            "state": state("s_suppkey + 3"),
            "order_no": dirty_num("s_acctbal", "s_suppkey + 2"),
        })]),
    }
    return F_


FRAMES: dict[str, dict[str, FrameDef]] = _frames()
_TABLE_REF = re.compile(r"\{(\w+)\}")


def tables_of(sql: str) -> list[str]:
    return sorted(set(_TABLE_REF.findall(sql)))


def frame_sql(source: str, path: str, naming=lambda t: t) -> str:
    """The landing SQL of one frame with driver-table names substituted."""
    sql = FRAMES[source][path].sql()
    return sql.format(**{t: naming(t) for t in tables_of(sql)})


def _list_sql(source: str, path: str, part: Part) -> dict[str, str]:
    """Child lists of a frame row that come from the same table row, as Spark
    array expressions: list field -> ``array(named_struct(..), ..)``, with the
    lists of the elements inside.  A list has as many elements as the frame
    definition has parts, so its size is bounded."""
    frames = FRAMES[source]
    prefix = path + "." if path else ""
    out: dict[str, str] = {}
    for seg in dict.fromkeys(p[len(prefix):].split(".")[0] for p in frames if p.startswith(prefix) and p != path):
        child = prefix + seg
        if child in frames:
            parts = frames[child].parts
            if any(q.source != part.source or q.distinct or q.refs[:-1] != part.refs or not q.refs[-1][1].isdigit()
                   for q in parts):
                continue
            inner = _list_sql(source, child, parts[0]) if len(parts) == 1 else {}
            cols = frames[child].columns
        else:                                 # a level without fields of its own
            depth = path_depth(child)
            parts = [Part(part.source, [*part.refs, (f"_p{depth}", "0")], where=part.where)]
            inner, cols = _list_sql(source, child, parts[0]), []
            if not inner:
                continue
        elements = []
        for q in parts:
            pairs = [f"'{c}', {q.value(c)}" for c in cols] + [f"'{n}', {e}" for n, e in inner.items()]
            e = f"named_struct({', '.join(pairs)})"
            elements.append(e if q.where in (None, part.where) else f"CASE WHEN {q.where} THEN {e} END")
        out[seg] = f"array({', '.join(elements)})"
    return out


def land(spark: SparkSession, sf_dir: str, source: str) -> Export:
    """Export ``source`` derived from the driver tables under ``sf_dir``.
    Frames are defined on first use; each driver table is read once."""
    exp = Export(source)
    cache: dict[str, DataFrame] = {}

    def run(sql: str) -> DataFrame:
        dfs = {}
        for t in tables_of(sql):
            if t not in cache:
                cache[t] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")
            dfs[t] = cache[t]
        return spark.sql(sql, **dfs)

    def make(path: str, fd: FrameDef) -> Frame:
        part = fd.parts[0]
        plain = len(fd.parts) == 1 and not part.distinct
        lists = _list_sql(source, path, part) if plain else {}
        df = run(fd.sql(lists))
        if not plain:
            return Frame(df, fd.refs, tuple(lists))
        rows = run(f"SELECT * FROM {part.source}" + (f" WHERE {part.where}" if part.where else ""))
        exprs = {**dict(part.refs), **{c: part.value(c) for c in fd.columns}, **lists}
        return Frame(df, fd.refs, tuple(lists), rows, exprs)

    for path, fd in FRAMES[source].items():
        exp.frames.defer(path, lambda path=path, fd=fd: make(path, fd))
    return exp


# -- the same exports as landed JSON ---------------------------------------------

ENVELOPE_DOCUMENTS = 500        # documents in one response object


def _by_document(fr: Frame, root_refs: tuple[str, ...]) -> DataFrame:
    """The frame with the rows of a document together, documents in order.  Shuffled
    and sorted are the rows that it is a projection of: the text is made behind it."""
    rows, on = (fr.df, list(root_refs)) if fr.source is None else (fr.source, [F.expr(fr.exprs[r]) for r in root_refs])
    return rows.repartition(*on).sortWithinPartitions(*on)


def _alike(source: str, paths: list[str]) -> list[list[str]]:
    """The paths, those together whose frames are projections of the same rows."""
    alike: dict[str, list[str]] = {}
    for path in paths:
        parts = FRAMES[source][path].parts
        same = f"{parts[0].source} {parts[0].where} {parts[0].refs}"
        alike.setdefault(same if len(parts) == 1 and not parts[0].distinct else path, []).append(path)
    return list(alike.values())


def documents(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The export as nested documents.  A list that is a table of its own (an
    order's lines) is gathered per document, as a real document holds it; it is
    as long as one document's list.  Lists of the same rows are gathered at once."""
    exp = land(spark, sf_dir, source)
    root = exp.frame("")
    docs = root.df
    if root.source is not None:
        docs = _by_document(root, root.refs).select(*[F.expr(e).alias(c) for c, e in root.exprs.items()])
    for paths in _alike(source, [p for p in FRAMES[source] if p and "." not in p and p not in root.lists]):
        frames = {p: exp.frame(p) for p in paths}
        fr = frames[paths[0]]
        own = {p: [c for c in x.df.columns if c not in x.refs] for p, x in frames.items()}

        def made(x: Frame, c: str):
            return (F.col(c) if x.source is None else F.expr(x.exprs[c])).alias(c)
        rows = _by_document(fr, root.refs).select(*[made(fr, r) for r in fr.refs], *[
            F.struct(*[made(x, c) for c in own[p]]).alias(p) for p, x in frames.items()])
        lists = rows.groupBy(*root.refs).agg(F.sort_array(F.collect_list(F.struct(*fr.refs, *paths))).alias("_l")).select(
            *root.refs, *[F.expr(f"transform(_l, e -> e.{p})").alias(p) for p in paths])
        docs = docs.join(lists, list(root.refs), "left")
    for path in [p for p in FRAMES[source] if p.count(".") == 1 and p.partition(".")[0] not in FRAMES[source]
                 and p.partition(".")[0] not in root.lists]:
        # the list in between has no fields of its own, just the inner list
        outer, _, inner = path.partition(".")
        fr = exp.frame(path)
        above, own = fr.parent_refs(1), [c for c in fr.df.columns if c not in fr.refs]
        rest = [r for r in above if r not in root.refs]
        lists = fr.df.groupBy(*above).agg(F.sort_array(F.collect_list(F.struct(*fr.refs, *own))).alias("_l"))
        element = F.struct(*rest, F.transform("_l", lambda e: F.struct(*[e[c].alias(c) for c in own])).alias(inner))
        lists = lists.groupBy(*root.refs).agg(F.sort_array(F.collect_list(element)).alias("_l")).select(
            *root.refs, F.transform("_l", lambda e: F.struct(e[inner].alias(inner))).alias(outer))
        docs = docs.join(lists, list(root.refs), "left")
    return docs


def land_as_json(spark: SparkSession, sf_dir: str, source: str, envelope: bool = False) -> DataFrame:
    """The export as it reads from JSON that was landed."""
    path = write_as_json(spark, sf_dir, source, envelope)
    return jsonsrc.read_envelopes(spark, source, path) if envelope else jsonsrc.read_lines(spark, source, path)


def write_as_json(spark: SparkSession, sf_dir: str, source: str, envelope: bool = False) -> str:
    """Write the export as JSON to the shared scratch folder as it would be
    landed, one document a line (gzip) or one response object a file; the path."""
    docs = documents(spark, sf_dir, source)
    path = f"{checkpoint_root(spark).rstrip('/')}/json/{source}-{uuid.uuid4().hex}"
    own = [c for c in docs.columns if not c.startswith("_ord")]
    if not envelope:
        # lists are gathered from sorted rows: a hash of documents would sort them again, as text
        with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true",
                      spark__sql__execution__useObjectHashAggregateExec="false"):
            docs.select(F.to_json(F.struct("_ord", *own)).alias("value")).write.option("compression", "gzip").text(path)
        return path
    part = F.lpad(F.floor(F.col("_ord") / ENVELOPE_DOCUMENTS).cast("string"), 12, "0")
    records = F.transform(F.sort_array(F.collect_list(F.struct("_ord", *own))),
                          lambda e: F.struct(*[e[c].alias(c) for c in own]))
    (docs.groupBy(part.alias("part")).agg(records.alias(ENVELOPE_KEYS[source]))
         .select("part", F.to_json(F.struct(ENVELOPE_KEYS[source])).alias("value"))
         .write.partitionBy("part").text(path))
    return path


def write_with_new_fields(spark: SparkSession, sf_dir: str) -> str:
    """An order export whose source has added fields that no schema declares:
    one on each document, one on some, one inside the lists; the path."""
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.struct(F.col("o_orderdate").cast("string").alias("since")))
    line = F.struct(F.col("o_custkey").cast("string").alias("product_unit_id"),
                    F.when(F.col("o_orderstatus") == "F", F.lit("7")).alias("bonus_points"))
    path = f"{checkpoint_root(spark).rstrip('/')}/json/new-fields-{uuid.uuid4().hex}"
    orders.select(F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("deal_id"), F.col("o_orderpriority").alias("priority text"),
        urgent.alias("urgent"), F.array(line, line).alias("order_products"))).alias("value")).write.text(path)
    return path
