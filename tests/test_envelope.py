"""Envelopes read by byte range give what one reader of the whole file gives."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from tradelake.sources import envelope

SCHEMA = StructType().add("id", StringType()).add("note", StringType()).add(
    "lines", ArrayType(StructType().add("n", StringType()).add("text", StringType())))
BAD = "_corrupt_record"


@pytest.fixture(params=[4_000_000, 150])
def ranges(spark, request):
    """Bytes of a range; the chunks of a file are read by many tasks or one."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], "1")
    yield request.param
    for n in names:
        spark.conf.unset(n)


def land(path, **texts):
    os.makedirs(path)
    for name, text in texts.items():
        with open(os.path.join(path, f"{name}.json"), "w", encoding="utf-8") as f:
            f.write(text if isinstance(text, str) else json.dumps(text, ensure_ascii=False, indent=random.Random(name).choice([None, 1])))
    return path


def got(spark, path):
    df = envelope.read_records(spark, path, "data", SCHEMA, BAD)
    return [r for r in df.orderBy("_ord_f", "_ord_g", "_ord_h").collect()]


def records(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(['}', '{', '"', "\\", "[", "]", ",", ":", "a", "é", '"data":[', "\n", "\\\"", "null"]) for _ in range(rng.randint(0, 9)))
    return [{"id": str(i), "note": rng.choice([word(), None, "x" * 200]), "extra": {"data": [{"id": "no"}], "k": [[], {}]},
             "lines": [{"n": str(k), "text": word()} for k in range(rng.randint(0, 3))]} for i in range(n)]


def plain(r):
    return (r["id"], r["note"], [(x["n"], x["text"]) for x in r["lines"] or []])


def test_equals_the_whole_file(spark, tmpdir_path, ranges):
    a, b = records(1, 25), records(2, 12)
    path = land(os.path.join(tmpdir_path, "l"),
                a={"meta": {"n": 1, "data": "no", "x": {"data": [{"id": "no"}]}}, "data": a, "after": [{"id": "no"}, [1]]},
                b={"other": [{"id": "no", "data": [{"id": "no"}]}], "data": [None, *b[:3], None, None, *b[3:], None]},
                c={"data": None}, d={}, e={"data": []}, f={"data": [None]}, g='\n {"data" \n : \n [ ] } \n\n')
    rows = got(spark, path)
    assert [r for r in rows if r[BAD] is not None] == []
    assert [plain(r) for r in rows] == [plain(r) for r in a + b]
    whole = spark.read.schema(StructType().add("data", ArrayType(SCHEMA))).option("multiLine", True).json(path)
    want = whole.select(F.explode("data").alias("d")).where("d is not null").select("d.*")
    assert sorted(map(str, want.collect())) == sorted(str(r) for r in envelope.read_records(spark, path, "data", SCHEMA, BAD).drop(
        "_ord_f", "_ord_g", "_ord_h", BAD).collect())


BROKEN = {
    "cut": '{"data":[{"id":"1"},{"id":"2","note":"a',
    "cut_behind_a_record": '{"data":[{"id":"1"},{"id":"2"}',
    "no_last_brace": '{"data":[{"id":"1"}]',
    "no_comma": '{"data":[{"id":"1"} {"id":"2"}]}',
    "number_between": '{"data":[{"id":"1"}, 7, {"id":"2"}]}',
    "number_first": '{"data":[7, {"id":"1"}]}',
    "number_last": '{"data":[{"id":"1"}, 7]}',
    "number_alone": '{"data":[7]}',
    "wrong_type": '{"data":[{"id":"1","lines":[{"n":"1"},5]},{"id":"2"}]}',
    "junk_behind": '{"data":[{"id":"1"}]} x',
    "one_brace_more": '{"data":[{"id":"1"}]}}',
    "open_string": '{"data":[{"id":"1"},{"id":"2]}',
}


@pytest.mark.parametrize("most", [4_000_000, 13])
def test_broken_files_are_told(spark, tmpdir_path, most):
    path = land(os.path.join(tmpdir_path, "l"), **BROKEN, whole={"data": [{"id": "9"}]})
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    for n, v in zip(names, (most, 1)):
        spark.conf.set(n, v)
    try:
        rows = got(spark, path)
    finally:
        for n in names:
            spark.conf.unset(n)
    told = {r["_ord_f"].rpartition("/")[2].removesuffix(".json") for r in rows if r[BAD]}
    assert told == set(BROKEN)
    assert [r["id"] for r in rows if r["_ord_f"].endswith("whole.json")] == ["9"]


def test_many_splits_go_by_shuffle(spark, tmpdir_path, monkeypatch):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "120")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        a = records(5, 20)
        path = land(os.path.join(tmpdir_path, "l"), a={"data": a})
        tasks = envelope._chunks(spark, path).rdd.getNumPartitions()
        assert tasks > 8
        monkeypatch.setattr(envelope, "BROADCAST_SPLITS", 0)
        assert [plain(r) for r in got(spark, path)] == [plain(r) for r in a]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_nothing_there(spark, tmpdir_path):
    assert got(spark, land(os.path.join(tmpdir_path, "l"), a="")) == []
