"""A window opens only the files that overlap it."""

import os

from helpers import write_lines
from tradelake.plans import pipelines
from tradelake.plans.pipelines import read_table
from tradelake.sources import jsonsrc, zonemap


def visit(n, *days):
    return {"_ord": n, "visit_headers": [{"visit_id": str(n), "visit_date": d} for d in days] + [None]}


FILES = {"a": [visit(1, "2024-01-01"), visit(2, "2024-01-03")], "b": [visit(3, "2024-01-05"), visit(4, "2024-01-09")],
         "c": [visit(5, "2024-01-20")], "d": [visit(6, "2024-01-01", "2024-03-01")], "e": [visit(7), visit(8, "soon", None)], "f": []}


def landing(path):
    for name, docs in FILES.items():
        write_lines(path, docs, f"{name}.json")
    return path


def names(paths):
    return "".join(sorted(p.rpartition("/")[2][0] for p in paths))


def test_only_files_of_the_window_are_opened(spark, tmpdir_path):
    land = landing(os.path.join(tmpdir_path, "l"))
    for as_of, want in (("2024-01-09", "abd"), ("2024-01-12", "bd"), ("2024-01-20", "cd"), ("2024-03-01", "d"), ("2025-01-01", "")):
        docs = zonemap.read_window(spark, "visit", land, as_of)
        assert names(docs.inputFiles()) == want, as_of
        plain = jsonsrc.window(jsonsrc.read_lines(spark, "visit", land), "visit", as_of)
        assert sorted(r["_ord"] for r in docs.collect()) == sorted(r["_ord"] for r in plain.collect()), as_of


def test_new_and_changed_files_are_read_once(spark, tmpdir_path, monkeypatch):
    land, read = landing(os.path.join(tmpdir_path, "l")), []
    real = zonemap._scan
    monkeypatch.setattr(zonemap, "_scan", lambda s, src, files, paths: read.append(names(paths)) or real(s, src, files, paths))
    assert names(zonemap.overlapping(spark, "visit", land, "2024-01-20")) == "cd"
    assert names(zonemap.overlapping(spark, "visit", land, "2024-01-09")) == "abd"
    assert read == ["abcde"]                # an empty file holds nothing and is not listed
    write_lines(land, [visit(9, "2024-01-19"), visit(10, "2024-01-20")], "a.json")      # changed
    write_lines(land, [visit(11, "2024-01-18")], "g.json")
    assert names(zonemap.overlapping(spark, "visit", land, "2024-01-20")) == "acdg"
    assert read == ["abcde", "ag"]
    os.remove(os.path.join(land, "g.json"))
    assert names(zonemap.overlapping(spark, "visit", land, "2024-01-20")) == "acd" and len(read) == 2


def test_files_with_broken_records_are_always_opened(spark, tmpdir_path):
    import pytest
    land, out = landing(os.path.join(tmpdir_path, "l")), os.path.join(tmpdir_path, "out")
    assert pipelines.run(spark, "visit", land, out, as_of="2024-01-20")["visits"]
    assert sorted(r.visit_id for r in read_table(spark, out, "visits").collect()) == [5]
    with open(os.path.join(land, "z.json"), "w") as f:
        f.write('{"visit_headers": [{"visit_id"\n')
    with pytest.raises(ValueError, match="1 of 2 records"):
        pipelines.run(spark, "visit", land, out, as_of="2024-01-20")
