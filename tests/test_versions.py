"""All tables of an export change at once, whatever stops a run and when."""

import json
import os

import pytest

from helpers import write_lines
from tradelake.plans import pipelines
from tradelake.plans.pipelines import read_table
from tradelake.sources import sinks, versions
from tradelake.sources.versions import Store

OLD = [{"_ord": 1, "purchase_id": "1", "purchase_items": [{"purchase_item_id": "5", "marking_codes": [{"marking_code": "a"}]}]}]
TABLES = pipelines.PIPELINES["purchase"]


class Killed(Exception):
    pass


def docs_of(n):
    text = json.dumps(OLD).replace('"1"', f'"{n}"').replace('"5"', f'"{n}5"').replace('"a"', f'"code{n}"')
    return json.loads(text)


def state(spark, out):
    rows = {t: sorted(map(str, read_table(spark, out, t).collect())) for t in ("purchases", "purchase_items")}
    return {n for n in range(1, 9) for t in rows if any(f"={n}," in r or f"={n})" in r or f"={n}5" in r for r in rows[t])}


STEPS = [(versions.Version, "add"), (Store, "_publish"), (Store, "expire"), (versions.Version, "publish")]


@pytest.mark.parametrize("after", [False, True])
def test_a_run_killed_between_any_two_steps(spark, tmpdir_path, monkeypatch, after):
    out = os.path.join(tmpdir_path, "out")
    monkeypatch.setattr(sinks, "_move", lambda *a: pytest.fail("a table is moved"))      # no rename is needed
    pipelines.run(spark, "purchase", write_lines(os.path.join(tmpdir_path, "l1"), docs_of(1)), out)
    assert state(spark, out) == {1}
    kill_at, current, ended = 0, 1, False
    while not ended:
        kill_at += 1
        calls = [0]
        with monkeypatch.context() as m:
            for cls, name in STEPS:
                def step(self, *a, _real=getattr(cls, name), **kw):
                    calls[0] += 1
                    mine = calls[0]
                    if mine == kill_at and not after:
                        raise Killed
                    got = _real(self, *a, **kw)
                    if mine == kill_at:
                        raise Killed
                    return got
                m.setattr(cls, name, step)
            n = 2 + kill_at % 7
            try:
                pipelines.run(spark, "purchase", write_lines(os.path.join(tmpdir_path, f"n{kill_at}"), docs_of(n)), out)
                ended = True
            except Killed:
                pass
        got = state(spark, out)
        assert got in ({current}, {n}), kill_at            # never a mixture
        current = got.pop()
    assert ended and current == n and kill_at > len(TABLES) + 2


def test_a_manifest_that_was_cut_off_is_none(spark, tmpdir_path):
    store = Store(spark, os.path.join(tmpdir_path, "out"))

    def publish(n):
        v = store.begin("x")
        v.add("t", spark.range(n))
        return v.publish()
    publish(3)
    folder = os.path.join(tmpdir_path, "out", "_commits", "x")
    whole = open(os.path.join(folder, "000000000001.json")).read()
    for text in ("", whole[:10], whole[:-1]):
        with open(os.path.join(folder, "000000000002.json"), "w") as f:
            f.write(text)
        assert store.read("x", "t").count() == 3
        os.remove(os.path.join(folder, "000000000002.json"))
        if os.path.exists(os.path.join(folder, ".000000000002.json.crc")):
            os.remove(os.path.join(folder, ".000000000002.json.crc"))
    with open(os.path.join(folder, "000000000002.json"), "w") as f:
        f.write(whole[:10])
    assert publish(5) == {"t": True} and store.current("x").number == 3 and store.read("x", "t").count() == 5


def test_empty_tables_keep_their_version_and_old_ones_go(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "out")
    store = Store(spark, root)
    held = None
    for n in range(1, 6):
        v = store.begin("x")
        v.add("a", spark.range(n))
        v.add("b", spark.range(1 if n == 1 else 0))
        assert v.publish() == {"a": True, "b": n == 1}
        if n == 4:
            held = store.read("x", "a")
    assert store.read("x", "a").count() == 5 and store.read("x", "b").count() == 1
    assert held.count() == 4                                # a reader of the commit before goes on
    assert len(os.listdir(os.path.join(root, "_versions", "x"))) == 3        # two commits' and the one of b
    v = store.begin("x")
    v.add("b", spark.range(0))
    assert v.publish() == {"b": False} and store.current("x").number == 5
    v = store.begin("x")
    v.add("b", spark.range(0))
    assert v.publish("replace") == {"b": True} and store.read("x", "b").count() == 0
    assert store.read("x", "b").columns == ["id"]
    with pytest.raises(FileNotFoundError):
        store.read("x", "c")
    assert set(store.locations()) == {"a", "b"}


def test_a_number_is_taken_once(spark, tmpdir_path):
    store = Store(spark, os.path.join(tmpdir_path, "out"))
    store._publish("x", {}, {})
    store._numbers = lambda export: []       # another publisher that has not seen it
    with pytest.raises(Exception, match="already exists|AlreadyExists"):
        store._publish("x", {}, {})
