"""Hard negatives against brute force, Strassen against numpy."""

import math
import random

import numpy as np
import pytest

from tradelake.llm import hard_negatives as hn


@pytest.mark.parametrize("m,k,n,leaf", [(1, 1, 1, 1), (7, 5, 9, 1), (33, 64, 65, 8), (40, 0, 3, 2), (0, 4, 4, 1), (64, 64, 64, 4)])
def test_strassen_is_exact(m, k, n, leaf):
    rng = np.random.default_rng(m * 100 + n)
    a, b = (rng.integers(-2**29, 2**29, s) for s in ((m, k), (k, n)))
    assert (hn.strassen(a, b, leaf) == a @ b).all()
    top = np.full((m, k), -2**31, dtype=np.int64)   # sums of quarters leave 64 bits, the product does not
    assert (hn.strassen(top, b // 2**20, leaf) == top @ (b // 2**20)).all()


def test_heaps_merge_in_any_order():
    rng = random.Random(1)
    rows = [(rng.randrange(5), place, rng.randrange(4)) for place in range(200)]
    want = {}
    for o, p, s in sorted(rows, key=lambda r: (r[0], -r[2], r[1])):
        want.setdefault(o, []).append((p, s))
    for size in (200, 7, 31):
        h = hn._Heaps(3)
        rng.shuffle(rows)
        for at in range(0, 200, size):
            h.push(*(np.array(c) for c in zip(*rows[at:at + size])))
        got = {}
        for o, p, s in zip(*h.held):
            got.setdefault(int(o), []).append((int(p), int(s)))
        assert got == {o: v[:3] for o, v in want.items()}


def brute(rows, every):
    part = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(256 * x) if math.isfinite(256 * x) else 2**40 for x in v]
        if sum(x * x for x in v) <= hn.LONGEST:
            part.append((i, v, (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    key = lambda r: (-r[1], r[0] is None, r[0] or 0)
    for n, (i, v, label) in enumerate(part):
        if i is None or i % every:
            continue
        scored = [(j, sum(x * y for x, y in zip(v, w)), lab) for m, (j, w, lab) in enumerate(part) if m != n]
        for p, ps, _ in sorted((r for r in scored if r[2] == label), key=key)[:5]:
            near = [r for r in scored if r[2] != label and 80 * ps <= 100 * r[1] <= 100 * ps]
            out += [(i, p, k + 1, j, ps, s) for k, (j, s, _) in enumerate(sorted(near, key=key)[:5])]
    return sorted(out, key=str)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def rows_of(seed=3):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, 1) for _ in range(9)] for _ in range(3)]
    rows = []
    for i in range(300):
        c = rng.choice(centre)
        rows.append((i, [x + rng.gauss(0, 0.2) for x in c], rng.randrange(4)))
    rows += [(300 + i, rows[5][1], i % 4) for i in range(40)]                  # ties: one vector many times
    rows += [rows[0], rows[20], (0, rows[7][1], 2), (None, rows[0][1], 1), (None, rows[9][1], 2)]
    rows += [(400, None, 1), (401, rows[1][1], None), (402, [1.0, None], 1), (403, [math.nan] * 9, 1),
             (404, [math.inf], 0), (405, [], 1), (406, [2.5], 2), (407, rows[3][1] + [1.0, 4.0], 3),
             (408, [1e300], 0), (409, [3e6] * 9, 0), (410, [-1e6, 1e6], 2), (420, [4e6], 1), (421, [4e6], 2), (440, [3.9e6], 1)]
    return rows


@pytest.mark.parametrize("sizes", [None, (37, 3, 8, 2)])
def test_against_brute_force(spark, monkeypatch, sizes):
    if sizes:
        for name, n in zip(("SLAB", "BLOCK", "TILE", "LEAF"), sizes):
            monkeypatch.setattr(hn, name, n)
    rows = rows_of()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, embedding array<double>, label int, `row` string, _b int").repartition(4)
    got = hn.mine(df, every=20)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 20)


def test_empty_and_unmatched(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert hn.mine(spark.createDataFrame([], schema)).count() == 0
    lone = spark.createDataFrame([(100, [1.0], 1), (101, [2.0], 2)], schema)
    assert hn.mine(lone).count() == 0
