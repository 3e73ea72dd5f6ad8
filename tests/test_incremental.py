"""Any split of an export into batches gives the tables of a single run."""

import os
import random

import pytest

from helpers import write_lines
from tradelake.plans.build import table
from tradelake.plans.incremental import STATE, Incremental
from tradelake.plans.specs import PIPELINES
from tradelake.sources.jsonsrc import land_json, read_lines


def purchase(rng, n):
    return {"_ord": rng.choice([n, None]), "purchase_id": str(rng.choice([n % 9, "junk"])), "note": f"n{n}",
            "purchase_items": [{"purchase_item_id": str(rng.randrange(4)), "quantity": str(n), "marking_codes": [
                {"marking_code": rng.choice(["a", "b", " c "])} for _ in range(rng.randrange(3))]} for _ in range(rng.randrange(4))]}


def rows(df):
    return sorted(map(str, df.collect())) if df is not None else []


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order(spark, tmpdir_path, seed):
    rng = random.Random(seed)
    land = os.path.join(tmpdir_path, "l")
    files = [f"{c}.json" for c in "abcdef"]
    for n, f in enumerate(files):
        write_lines(land, [purchase(rng, 10 * n + k) for k in range(6)], f)
    whole = land_json(spark, "purchase", land)
    state = Incremental(spark, "purchase", os.path.join(tmpdir_path, "out"), buckets=4)
    rng.shuffle(files)
    cuts = sorted(rng.sample(range(1, 6), 2))
    for batch in (files[:cuts[0]], files[cuts[0]:cuts[1]], files[cuts[1]:], files[:1]):      # one file a second time
        state.apply(read_lines(spark, "purchase", [os.path.join(land, f) for f in batch]))
    for name in PIPELINES["purchase"]:
        assert rows(state.read(name)) == rows(table(whole, name)) != [], name


def test_only_touched_buckets_are_written(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "l")
    write_lines(land, [{"logistics_id": str(i), "deals": [{"deal_id": str(i)}]} for i in range(40)], "a.json")
    write_lines(land, [{"logistics_id": "3", "deals": [{"deal_id": "99"}]}, {"logistics_id": "77", "deals": []}], "b.json")
    write_lines(land, [], "c.json")
    state = Incremental(spark, "logistics", os.path.join(tmpdir_path, "out"), buckets=8)
    assert state.read("logistics") is None
    assert len(state.apply(read_lines(spark, "logistics", os.path.join(land, "a.json")))) == 8
    before = dict(state.store.current("logistics").tables)
    touched = state.apply(read_lines(spark, "logistics", os.path.join(land, "b.json")))
    after = state.store.current("logistics").tables
    assert 1 <= len(touched) <= 2
    assert {n for n, f in before.items() if after.get(n) != f} <= {f"{t}/bucket={b}" for t in (*PIPELINES["logistics"], STATE) for b in touched}
    assert state.read("logistics").count() == 41
    assert {r.deal_id for r in state.read("logistics_deals").collect()} == set(range(40))     # file a is first in order
    assert state.apply(read_lines(spark, "logistics", os.path.join(land, "c.json"))) == []


def test_exports_without_keys_grow(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "l")
    state = Incremental(spark, "visit", os.path.join(tmpdir_path, "out"))
    for n, f in enumerate("ab"):
        write_lines(land, [{"visit_headers": [{"visit_id": str(n)}], "stocks": [{"stock_quant": "1"}] * n}], f"{f}.json")
        state.apply(read_lines(spark, "visit", os.path.join(land, f"{f}.json")))
    whole = land_json(spark, "visit", land)
    for name in ("visits", "visit_stocks"):
        assert rows(state.read(name)) == rows(table(whole, name)) != []
