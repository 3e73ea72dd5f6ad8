"""Operators on documents against their brute-force versions."""

import zlib

import brute
import pytest
from corpus import edited, in_order, sentence, table
from pyspark.sql import functions as F

from tradelake.llm import (decontamination, language_id, mixing, near_dedup, quality, sharding, substring_dedup,
                           suffix_dedup)


def test_quality_counts_and_verdict(spark, docs, rows, nothing):
    out = quality.quality_rules(docs, carry=["doc_id", "text"])
    got = out.select("_in1", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                     "kept", "posterior").collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:7] == brute.quality_counts(r[0])
        assert r["kept"] == (not r["base_failed"] and r["posterior"] >= 0.5)
        assert 0 <= r["posterior"] <= 1
    assert quality.quality_rules(nothing).count() == 0
    kept = quality.keep_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)


def test_quality_rejects_junk_and_keeps_clean(spark):
    import random
    rng = random.Random(3)
    clean = [(i, sentence(rng, 100) + ".") for i in range(150)]
    junk = [(1000 + i, " ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in sentence(rng, 80).split())) for i in range(20)]
    loud = [(2000 + i, "!! ".join(sentence(rng, 80).upper().split())) for i in range(20)]
    df = spark.createDataFrame(clean + junk + loud, "doc_id long, text string")
    kept = {r[0] for r in quality.keep_documents(df).select("doc_id").collect()}
    assert kept == {i for i, _ in clean}


def test_quality_rules_do_not_depend_on_length_or_script(spark):
    import random
    rng = random.Random(6)
    vocabulary = sorted({w for w in sentence(rng, 12_000).split()})[:4000]
    # word frequencies fall with rank: 0.6 distinct in 1,000 words, 0.1 in 40,000
    book = " ".join(rng.choices(vocabulary, [1 / (5 + n) for n in range(len(vocabulary))], k=40_000))
    assert len(set(book.split())) < 0.15 * 40_000
    few = " ".join(rng.choices(vocabulary[:60], k=5000))
    marks = {3: "हिन्दी भारत की राजभाषा है और इसे करोड़ों लोग बोलते हैं। यह देवनागरी लिपि में लिखी जाती है।",
             4: "বাংলা ভাষা দক্ষিণ এশিয়ার একটি প্রধান ভাষা এবং কোটি কোটি মানুষ এই ভাষায় কথা বলে।"}
    df = spark.createDataFrame([(1, book), (2, few), *marks.items()], "doc_id long, text string")
    names = list(quality.RULES)
    got = {r["_in0"]: r for r in quality.quality_rules(df, carry=["doc_id"]).collect()}
    vote = {(i, n): v for i, r in got.items() for n, v in zip(names, r["votes"])}
    assert vote[1, "variety"] == 1 and vote[2, "variety"] == -1
    w = book.split() + ["end"]
    assert quality.text_counts(spark.createDataFrame([(" ".join(w),)], "text string"), "text").first()["n_stretch_words"] == sum(
        len(set(w[k:k + quality.STRETCH])) for k in range(0, len(w), quality.STRETCH))
    assert vote[3, "letters"] == vote[4, "letters"] == 1
    clean = [(10 + i, sentence(rng, 100)) for i in range(100)]
    junk = [(1000 + i, " ".join(w + "***" for w in sentence(rng, 80).split())) for i in range(3)]
    df = spark.createDataFrame([(1, book), (5, marks[3] + " " + sentence(rng, 30)), *clean, *junk], "doc_id long, text string")
    assert {r[0] for r in quality.keep_documents(df).select("doc_id").collect()} == {1, 5} | {i for i, _ in clean}


def _posteriors(spark, counts):
    m = len(quality.RULES)
    rows = [([bad.get(j, 1) for j in range(m)], n) for bad, n in counts]
    out = quality._em(spark.createDataFrame(rows, "votes array<int>, n long"))
    got = {tuple(r["votes"]): r["posterior"] for r in out.collect()}
    return [got[tuple(v)] for v, _ in rows]


@pytest.mark.parametrize("size", [1, 20, 1000])
def test_one_bad_vote_of_a_noisy_rule_does_not_reject(spark, size):
    """Rule 1 votes bad on 2 % of the documents that all others call good;
    rules 0, 3 and 4 agree on the 5 % that are bad."""
    good, noisy, bad, worse = _posteriors(spark, [({}, 930 * size), ({1: -1}, 20 * size), ({0: -1, 3: -1}, 25 * size),
                                                  ({0: -1, 3: -1, 4: -1}, 25 * size)])
    assert good > 0.95 and noisy >= 0.5 and bad < 0.5 and worse < 0.5
    # each rule alone on 2 %: nothing bears any of them out
    single = _posteriors(spark, [({}, 840 * size), *[({j: -1}, 20 * size) for j in range(8)]])
    assert min(single) >= 0.5
    # no bad vote, no rejection, though the bad ones abstain there too
    none, *rest = _posteriors(spark, [({1: 0}, 5 * size), ({}, 900 * size), ({0: -1, 1: 0}, 60 * size), ({0: -1, 1: -1}, 35 * size)])
    assert none >= 0.5 and rest[0] >= 0.5 and max(rest[1:]) < 0.5


def test_em_is_native(docs):
    plan = quality.quality_rules(docs, carry=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_substring_dedup(docs, rows, nothing):
    out = substring_dedup.remove_repeats(docs)
    got = table(out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("k")),
                "doc_id", "n_words", "n_removed", "k")
    assert got == in_order(brute.word_repeats(rows, 13))
    for r in out.select("n_removed", "spans").collect():
        ends = [0] + [s["end"] for s in r["spans"]]
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]
        assert all(s["start"] > e or e == 0 for s, e in zip(r["spans"], ends))   # maximal: never touching
    assert substring_dedup.remove_repeats(nothing).count() == 0


def test_suffix_dedup(docs, rows, nothing):
    out = suffix_dedup.remove_repeats(docs)
    got = table(out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n"),
                           F.sha2("kept", 256).alias("k")), "doc_id", "n_bytes", "n_removed", "n", "k")
    assert got == in_order(brute.byte_repeats(rows, 50))
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_suffix_dedup_crowds_and_many_blocks(spark, rows, monkeypatch):
    from tradelake.llm import blocks
    monkeypatch.setattr(blocks, "CROWD", 2)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 2000)
    some = [r for r in rows if len(r[1] or "") < 5000]
    df = spark.createDataFrame(some, "doc_id long, text string").repartition(4)
    out = suffix_dedup.remove_repeats(df)
    got = table(out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n"),
                           F.sha2("kept", 256).alias("k")), "doc_id", "n_bytes", "n_removed", "n", "k")
    assert got == in_order(brute.byte_repeats(some, 50))


def test_suffix_dedup_rows_follow_the_routes(spark, rows, monkeypatch):
    """A block sends a row for each route, not for each of the many buckets."""
    from tradelake.llm import blocks
    monkeypatch.setattr(suffix_dedup, "BLOCK", 20_000)
    monkeypatch.setattr(suffix_dedup, "PER_BUCKET", 50)         # 1024 buckets
    sent = {}
    per_block = blocks.per_block

    def counted(answers, name):
        sent[name] = answers.groupBy("block").count().agg(F.max("count")).first()[0]
        return per_block(answers, name)
    monkeypatch.setattr(blocks, "per_block", counted)
    some = [r for r in rows if len(r[1] or "") < 5000]
    out = suffix_dedup.remove_repeats(spark.createDataFrame(some, "doc_id long, text string").repartition(2))
    got = table(out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n"),
                           F.sha2("kept", 256).alias("k")), "doc_id", "n_bytes", "n_removed", "n", "k")
    assert got == in_order(brute.byte_repeats(some, 50))
    assert 64 < sent["repeats"] <= 128


def test_crowds_count_places(spark, monkeypatch):
    """Not the blocks that have a hash but the places, as these fill its bucket."""
    import numpy as np
    from tradelake.llm import blocks
    monkeypatch.setattr(blocks, "CROWD", 6)
    df = spark.createDataFrame([(1, "aaaaab"), (2, "ac"), (3, "b"), (4, "b"), (5, "d")], "doc_id long, text string")
    written = blocks.blocks_of(df.repartition(1), "crowds", 6)

    def letters(block):
        return block.buf.astype(np.uint64) << np.uint64(56), np.searchsorted(block.ends, np.arange(len(block.buf)), side="right")
    got = blocks.repeated(written, letters, 4, "crowds", any_other=True).collect()
    assert len(got) == 2
    crowds = [np.unpackbits(np.frombuffer(x["crowds"], dtype=np.uint8), count=x["n"]).tolist() for r in got for x in r["answers"]]
    assert sum(map(sum, crowds)) == 2                            # "a", in both blocks


def test_long_block_in_pieces(rows, monkeypatch):
    import numpy as np
    from tradelake.llm import blocks
    data = max((t for _, t in rows if t), key=len).encode()
    block = blocks.Block(np.array([1]), np.array([len(data)]), np.frombuffer(data, dtype=np.uint8), np.array([True]))
    whole = suffix_dedup.runs_of(block)
    monkeypatch.setattr(suffix_dedup, "_PLACE", 8)

    def windows(runs):
        return sorted((f, g) for a, b, g in zip(runs.first, runs.last, runs.gram) for f in range(a, b + 1))
    assert [f for f, _ in windows(whole)] == [f for f, _ in windows(suffix_dedup.runs_of(block))] == list(
        range(len(data) - 49))


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(docs, rows, nothing, percent):
    out = near_dedup.near_duplicates(docs, percent=percent)
    assert out.count() == len(rows)
    known = [r for r in rows if r[0] is not None]
    expect = {i: (n, c) for i, n, c in brute.near_components(known, percent)}
    for r in out.collect():
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == expect[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert any(c != i for i, (_, c) in expect.items())
    assert near_dedup.near_duplicates(nothing).count() == 0
    kept = near_dedup.unique_documents(docs)
    assert kept.columns == docs.columns


def test_near_duplicates_of_edit_chains(spark):
    """Chains of edits: links are few among many almost similar texts, so the
    comparison in blocks has to find them."""
    import random
    rng = random.Random(8)
    texts = [sentence(rng, 120)]
    for _ in range(260):
        words = rng.choice(texts).split(" ")
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        texts.append(" ".join(words))
    rng.shuffle(texts)
    given = list(enumerate(texts))
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(4)
    got = table(near_dedup.near_duplicates(df), "doc_id", "n_shingles", "component_id")
    assert got == in_order(brute.near_components(given, near_dedup.PERCENT))


def test_block_comparison_of_a_crowded_band(spark, monkeypatch):
    import random
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(9)
    texts = [sentence(rng, 60)]
    for _ in range(80):
        words = rng.choice(texts).split(" ")
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        texts.append(" ".join(words))
    given = list(enumerate(texts))
    df = spark.createDataFrame(given, "doc_id long, text string")
    got = table(near_dedup.near_duplicates(df), "doc_id", "n_shingles", "component_id")
    assert got == in_order(brute.near_components(given, near_dedup.PERCENT))


def test_documents_meet_their_sets_once_a_key(spark):
    """Rows for many block pairs are made behind the join with the sets."""
    pairs = [(7, lo, hi, lo, rep, rep) for rep in range(3) for lo in range(4) for hi in range(4)]
    likely = spark.createDataFrame(pairs, "key long, lo int, hi int, side int, rep long, comp long")
    sets = spark.createDataFrame([(r, bytes([r])) for r in range(3)], "row long, shingles binary")
    got = near_dedup._with_sets(likely, sets)
    assert sorted((*r[:6], bytes(r[6])) for r in got.collect()) == sorted((k, lo, hi, s, r, c, bytes([r])) for k, lo, hi, s, r, c in pairs)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join") < plan.index("Aggregate")


def test_similarity_corrects_collisions_of_both_sizes():
    import numpy as np
    rng = np.random.default_rng(3)
    for n, m, both in ((3000, 3000, 0), (20_000, 400, 0), (150, 9000, 0), (5000, 5000, 4500), (2000, 6000, 1500)):
        equal = []
        for _ in range(60):
            h = rng.integers(0, 2**63, n + m, dtype=np.uint64)
            sets = [h[:n], h[n - both:n + m - both]]
            r = [near_dedup.registers(x, np.zeros(len(x), dtype=np.int64), 1)[0] for x in sets]
            equal.append((r[0] == r[1]).mean())
        got = near_dedup.similarity(np.array(equal), np.full(60, n), np.full(60, m)).mean()
        assert abs(got - both / (n + m - both)) < 0.01, (n, m, got)
        if not both:
            log = sorted(round(4 * np.log2(x)) for x in (n, m))
            assert abs(near_dedup._collisions(*log) - np.mean(equal)) < 4 * (np.mean(equal) / 12_000) ** 0.5 + 1e-4


def test_links_of_a_family_grow_with_its_size(spark, monkeypatch):
    """Near copies of one text: four times the documents, some of them too far
    edited to link, draw 5.8 times the pairs into a comparison, not sixteen times."""
    import random
    rows = {}
    real = near_dedup._confirmed

    def counted(docs, asked, *a):
        rows[size] = rows.get(size, 0) + asked.count()
        return real(docs, asked, *a)
    monkeypatch.setattr(near_dedup, "_confirmed", counted)
    for size in (60, 240):
        rng = random.Random(3)
        text = sentence(rng, 150)
        given = [(i, edited(rng, text, 0.008)) for i in range(size)]
        out = near_dedup.near_duplicates(spark.createDataFrame(given, "doc_id long, text string"))
        assert table(out, "doc_id", "n_shingles", "component_id") == in_order(brute.near_components(given, near_dedup.PERCENT))
    assert rows[240] < 7 * rows[60]


def test_near_duplicates_of_repeated_ids(spark):
    import random
    rng = random.Random(2)
    a, b = sentence(rng, 60), sentence(rng, 60)
    given = [(5, a), (5, b), (3, b), (None, a), (None, a), (9, a), (9, a), (4, None)]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 5, True), (5, 3, False), (3, 3, True), (None, None, True), (None, None, True), (9, 5, False), (9, 5, False), (4, 4, True)], key=str)
    kept = [(r[0], r[1]) for r in near_dedup.unique_documents(df).collect()]
    assert sorted(kept, key=str) == sorted([(5, a), (3, b), (4, None)], key=str)
    none = spark.createDataFrame([(None, a), (None, a), (None, b)], "doc_id long, text string")
    assert near_dedup.unique_documents(none).count() == 2


def test_decontamination(spark, docs, rows, nothing):
    import random
    rng = random.Random(4)
    texts = [t for _, t in rows if t and len(t.split()) > 40]
    items = [(n, " ".join(t.split()[k:k + m])) for n, (t, k, m) in enumerate(
        zip(texts, (0, 5, 9, 3, 20, 1), (10, 25, 9, 3, 2, 14)))]
    items += [(50, items[0][1].upper()), (51, None), (52, ""), (53, "..."), (54, sentence(rng, 30)), (55, "a b c d"), (56, "the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.decontaminate(docs, bench)
    got = table(out.select("doc_id", "n_words", "n_hit", "n_items",
                           F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("k")),
                "doc_id", "n_words", "n_hit", "n_items", "k")
    single = [r for r in rows if r[0] is not None]
    expect = in_order(brute.contamination(single, items))
    assert [g for g in got if g[0] is not None] == expect
    assert sum(x[2] > 0 for x in expect) > 6
    assert decontamination.decontaminate(nothing, bench).count() == 0
    assert decontamination.decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0
    clean = decontamination.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert clean.filter("doc_id is not null").count() == sum(x[2] == 0 for x in expect)


def test_decontamination_judges_each_row_by_its_text(spark):
    import random
    rng = random.Random(15)
    a, b = sentence(rng, 15), sentence(rng, 12)
    given = [(None, f"{sentence(rng, 9)} {a}"), (None, sentence(rng, 5)), (None, None), (7, f"x {b}"), (7, "two words"), (7, f"x {b}"),
             (None, f"{a} {b}"), (8, "clean " * 20)]
    docs = spark.createDataFrame([(*r, "m") for r in given], "doc_id long, text string, mark string").repartition(3)
    bench = spark.createDataFrame([(1, a), (2, b)], "item_id long, text string")
    out = decontamination.decontaminate(docs, bench)
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], brute.sha(",".join(r["items"]).encode())) for r in out.collect()]
    assert in_order(got) == in_order(brute.contamination(given, [(1, a), (2, b)]))
    kept = decontamination.clean_documents(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(
        map(str, spark.createDataFrame([given[k] for k in (1, 2, 4, 7)], "doc_id long, text string").collect()))


def test_decontamination_by_items_without_id(spark):
    import random
    rng = random.Random(14)
    a, b, c = (sentence(rng, 15) for _ in range(3))
    given = [(1, f"{sentence(rng, 9)} {a} {sentence(rng, 9)}"), (2, f"{a} {b}"), (3, sentence(rng, 30)), (None, f"x {c}"), (4, c)]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    bench = spark.createDataFrame([(None, a), (None, c), (7, b), (8, c)], "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items"], r["n_items"], r["contaminated"])
           for r in decontamination.decontaminate(docs, bench).collect()}
    assert got == {1: (15, [None], 1, True), 2: (30, [None, "7"], 2, True), 3: (0, [], 0, False),
                   None: (15, [None, "8"], 2, True), 4: (15, [None, "8"], 2, True)}
    assert [r["doc_id"] for r in decontamination.clean_documents(docs, bench).collect()] == [3]


def test_mixing(docs, rows, nothing):
    out = mixing.mix(docs)
    got = out.select("_id", "source", "size", "source_size", "target", "takes").collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
        assert sum(t["taken"] for t in r["takes"]) <= 2 * r["size"]
        assert all(0 <= t["position"] <= 1 for t in r["takes"])
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None]
    own = {s: sum(r["size"] for r in by[s]) for s in by}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(own.values())
    while True:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 2 * own[s]}
        if not full:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in full:
            target[s] = 2.0 * own[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    for s in names:
        assert {r["source_size"] for r in by[s]} == {own[s]}
        assert all(abs(r["target"] - target[s]) < 1e-6 * max(1, target[s]) for r in by[s])
        taken = sum(t["taken"] for r in by[s] for t in r["takes"])
        assert abs(taken - target[s]) <= 1
    again = mixing.mix(docs.repartition(7)).select("_id", "size", "takes").collect()
    assert sorted(map(str, again)) == sorted(map(str, out.select("_id", "size", "takes").collect()))
    assert mixing.mix(nothing).count() == 0
    placed = [r["position"] for r in mixing.in_training_order(out).collect()]
    assert placed == sorted(placed)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len(brute.words(r["text"])) for r in mixed.select("text").collect()) == sum(
        r["size"] for r in got for t in r["takes"] if 2 * t["taken"] >= r["size"])
    assert {r["text"] for r in mixed.collect()} <= {t for _, t in rows}        # no text is cut


def test_schedule_position_inverts_the_integral(spark):
    df = spark.range(0, 101).select((F.col("id") / 100).alias("u"))
    for slope in (-0.5, 0.0, 0.5, 1.0, -1.0):
        for r in df.select("u", mixing.position(F.col("u"), F.lit(slope)).alias("t")).collect():
            assert abs(r["t"] + slope * (r["t"] ** 2 - r["t"]) - r["u"]) < 1e-9


def test_sharding(docs, rows, nothing):
    out = sharding.shard(docs, carry=["doc_id", "text"]).collect()
    assert len(out) == len(rows)
    slots = {}
    for r in out:
        data = (r["_in1"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert r["grown_shard"] in (r["shard"], 8)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_id = {}
    for r in out:
        assert by_id.setdefault(r["_in0"], r["shard"]) == r["shard"]
    assert sharding.shard(nothing).count() == 0
    assert sharding.sharded_documents(docs).columns == docs.columns + ["_shard", "slot"]


def test_jump_hash_moves_only_into_the_new_shard():
    import numpy as np
    keys = np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64)
    for n in (1, 2, 7, 8, 50):
        a, b = sharding.jump_hash(keys, n), sharding.jump_hash(keys, n + 1)
        assert a.max() < n and ((a == b) | (b == n)).all()
        assert abs((b == n).mean() - 1 / (n + 1)) < 0.01
        assert abs(np.bincount(a, minlength=n) / len(keys) - 1 / n).max() < 0.02


def test_language_id(spark, nothing):
    import random
    rng = random.Random(2)
    tongues = {"aa": "the and ing of thr wh".split(), "bb": "der sch ung ein ich über".split(), "cc": "que ción los ñas".split()}
    rows = []
    for i in range(300):
        lang = rng.choice(list(tongues))
        rows.append((i, " ".join("".join(rng.choices(tongues[lang], k=2)) for _ in range(30)), lang))
    odd = [(500, None, "aa"), (501, "", None), (502, "12 34 !!", "aa"), (503, "зима", None), (None, rows[0][1], None),
           (504, rows[0][1] * 400, None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in language_id.identify(df).collect()}
    truth = {i: lang for i, _, lang in rows}
    held = [i for i in truth if out[i]["held_out"]]
    assert held == [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(out[i]["lang_pred"] == truth[i] for i in held) / len(held) > 0.95
    assert [out[i]["lang_pred"] for i in (500, 501, 502)] == ["und"] * 3
    assert out[503]["lang_pred"] in tongues and out[504]["lang_pred"] == truth[0] == out[None]["lang_pred"]
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert language_id.identify(nothing).count() == 0
    none = language_id.identify(df.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()
    assert [r[0] for r in none] == ["und"]


def test_language_sample_holds_rare_languages_and_counts_copies_once(spark, monkeypatch):
    import random
    monkeypatch.setattr(language_id, "MOST_TEXTS", 40)
    rng = random.Random(12)

    def texts(parts, n):
        return [" ".join("".join(rng.choices(parts, k=2)) for _ in range(30)) for _ in range(n)]

    often, rare = "the and ing of thr wh".split(), "que ción los ñas".split()
    given = [(t, "aa") for t in texts(often, 3000)] + [(t, "bb") for t in texts(rare, 3)]
    # a language of which nearly all rows are copies of one text without the trigrams of the others
    given += [("zzz kkk", "cc")] * 1000 + [(t, "cc") for t in texts("der sch ung ein ich über".split(), 5)]
    rows = [(3 * n, t, lang) for n, (t, lang) in enumerate(given)]
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    assert {lang for _, _, lang in train} == {"aa", "bb", "cc"}
    asked = [(100_000 + n, t, None) for n, t in enumerate(texts(rare, 5) + texts("der sch ung ein ich über".split(), 5))]
    df = spark.createDataFrame(rows + asked, "doc_id long, text string, lang string")
    model = language_id.fit(df)
    assert model.languages == ["aa", "bb", "cc"]
    out = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(df, model).collect()}
    assert [out[i] for i, _, _ in asked] == ["bb"] * 5 + ["cc"] * 5
