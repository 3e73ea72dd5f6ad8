"""The pipeline, stage by stage, against brute force on a small table."""

import tempfile
from collections import Counter

import brute
import corpus_pipeline
from corpus import corpus
from pyspark.sql import functions as F

from tradelake.llm import near_dedup, sharding


def rows_of(spark, path):
    return Counter((r["doc_id"], r["text"]) for r in spark.read.parquet(path).select("doc_id", "text").collect())


def test_pipeline(spark):
    """With null and repeated ids, and rows that repeat."""
    d = tempfile.mkdtemp(prefix="tl-pipe-")
    rows = corpus(11)
    rows += [(rows[3][0], rows[8][1]), (None, rows[8][1])]
    df = spark.createDataFrame([(i, t, "en", f"src{n % 3}", len(t or "")) for n, (i, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{d}/documents.parquet")
    items = [(0, " ".join(brute.words(rows[8][1])[2:20])), (1, "nowhere to be found at all in any of these texts x")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")

    lazy = near_dedup.near_duplicates(spark.read.parquet(f"{d}/documents.parquet"))
    docs, left = spark.read.parquet(f"{d}/documents.parquet"), {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, d)
        if name != "sharding":
            assert out.columns == df.columns
        out.write.parquet(f"{d}/{n}")
        docs = spark.read.parquet(f"{d}/{n}")
        left[name] = rows_of(spark, f"{d}/{n}")
    assert lazy.count() == len(rows)            # the stages remove only what they made

    judged = list(left["quality_rules"].elements())
    assert left["quality_rules"] <= Counter(r for r in rows if not brute.quality_counts(r[1])[5]) and len(judged) > 50
    judged.sort(key=lambda r: (r[0] is None, r[0] or 0))
    unique = [judged[i] for i, _, c in brute.near_components([(n, t) for n, (_, t) in enumerate(judged)], 80) if i == c]
    assert Counter(r[0] for r in left["minhash_near_dedup"].elements()) == Counter(r[0] for r in unique)
    given = list(left["minhash_near_dedup"].elements())
    clean = Counter(r for r, c in zip(given, brute.contamination(given, items)) if c[2] == 0)
    assert left["benchmark_decontamination"] == clean and sum(clean.values()) < len(given)
    assert set(left["source_mixing"]) <= set(clean)             # whole texts
    longest = max(len(brute.words(t)) for _, t in clean)
    total = sum(len(brute.words(t)) * n for (_, t), n in clean.items())
    mixed = sum(len(brute.words(t)) * n for (_, t), n in left["source_mixing"].items())
    assert abs(mixed - 1.5 * total) <= 3 * longest
    assert left["sharding"] == left["source_mixing"]
    for r in docs.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m"),
                                       F.countDistinct("slot").alias("k")).collect():
        assert r["n"] == r["k"] == r["m"] + 1
    whole = corpus_pipeline.run(spark, d)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_empty_table(spark):
    d = tempfile.mkdtemp(prefix="tl-pipe-")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    out = corpus_pipeline.run(spark, d)
    assert out.count() == 0 and out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]


def test_names_that_clash_in_every_stage(spark):
    """Sharding writes a table whose columns are all different."""
    df = spark.createDataFrame([(1, "a", 1, 2, "x")], "doc_id long, text string, shard int, _shard int, SLOT string")
    out = sharding.sharded_documents(df)
    assert out.columns == ["doc_id", "text", "shard", "_shard", "SLOT", "__shard", "_slot"]
    out.write.parquet(tempfile.mkdtemp(prefix="tl-shard-") + "/t")
