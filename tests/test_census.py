"""Fields that the declared schema drops show up in a report."""

import json
import os

from tradelake.plans.build import table
from tradelake.sources import census
from tradelake.sources.jsonsrc import land_json


def test_shapes_are_read():
    text = "OBJECT<VOID: ARRAY<VOID>, b: ARRAY<OBJECT<c: STRING, `d e`: DECIMAL(2,1)>>, m: ARRAY<VARIANT>, `n:<>`: STRING, `q``q`: OBJECT<k: OBJECT<>>, z: VOID>"
    assert census.Shape(text).read() == {"VOID": ["VOID"], "b": [{"c": "STRING", "d e": "DECIMAL"}], "m": ["VARIANT"], "n:<>": "STRING",
                                         "q`q": {"k": {}}, "z": "VOID"}


DOCS = [{"_ord": 1, "logistics_id": "1", "deals": [{"deal_id": "5", "status": "A", "colour": "red"}], "odd name": {"x": {"y": 1}}},
        {"_ord": 2, "logistics_id": 2, "deals": [None, {"deal_id": "6"}, {"dealStatus": "B"}], "external_id": None},
        {"logistics_id": "3", "deals": [{"deal_id": "7", "colour": 3}], "odd name": 1},
        {"logistics_id": "4", "deals": []}, {"logistics_id": "5", "deals": None}, {"logistics_id": "6", "deals": "none"},
        {"logistics_id": "7", "deals": [{"deal_id": "7"}, 3]}]


def test_unknown_and_renamed_fields(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "l")
    os.makedirs(path)
    with open(os.path.join(path, "a.json"), "w") as f:
        f.write("\n".join([*map(json.dumps, DOCS), "broken", "[1]", "", '"text"']) + "\n")
    got = {(r.path, r.finding): (r.documents, r.types) for r in census.census(spark, "logistics", path).collect()}
    absent = {p for p, f in got if f == "absent"}
    assert "deals.external_id" in absent and "van_code" in absent and "deals" not in absent and "external_id" not in absent
    assert "deals.status" not in absent and all(got[p, "absent"] == (0, "") for p in absent)
    assert {k: v for k, v in got.items() if k[1] != "absent"} == {
        ("deals.colour", "undeclared"): (2, "BIGINT, STRING"), ("deals.dealStatus", "undeclared"): (1, "STRING"),
        ("odd name", "undeclared"): (2, "BIGINT, OBJECT"), ("deals", "mixed"): (2, "ARRAY<VARIANT>, STRING"), ("", "broken"): (3, ", ARRAY<BIGINT>, STRING")}


def test_tables_are_unchanged(spark, tmpdir_path):
    for name, docs in (("more", DOCS[:3]), ("plain", [{k: v for k, v in d.items() if k != "odd name"} for d in DOCS[:3]])):
        os.makedirs(os.path.join(tmpdir_path, name))
        with open(os.path.join(tmpdir_path, name, "a.json"), "w") as f:
            f.write("\n".join(map(json.dumps, docs)) + "\n")
    rows = [sorted(map(str, table(land_json(spark, "logistics", os.path.join(tmpdir_path, n)), "logistics_deals").collect())) for n in ("more", "plain")]
    assert rows[0] == rows[1] and len(rows[0]) == 4
    assert census.census(spark, "logistics", os.path.join(tmpdir_path, "plain")).where("finding = 'undeclared'").count() == 2


def test_nothing_landed(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "l")
    os.makedirs(path)
    open(os.path.join(path, "a.json"), "w").close()
    assert census.census(spark, "logistics", path).count() == 0
