"""The estimation and placing steps against plain-Python versions of them."""

import math
import random

import numpy as np

from tradelake.llm import mixing, quality, sharding


def plain_em(patterns):
    """[(votes, n)] -> {votes: posterior}: counts of each pattern, rates by
    maximum a posteriori, a last step without the abstentions."""
    rows = sorted(patterns)
    prior, k = quality.PRIOR, float(quality.PRIOR_DOCUMENTS)
    state = [(1 + sum(v == 1 for v in votes)) / (2 + sum({1: 1, -1: 4, 0: 0}[v] for v in votes)) for votes, _ in rows]
    for step in range(quality.ITERATIONS + 1):
        last = step == quality.ITERATIONS
        if last:
            break
        good, bad = sum(n * q for (_, n), q in zip(rows, state)), sum(n * (1 - q) for (_, n), q in zip(rows, state))
        odds, ratios = math.log((good + k) / (bad + k)), []
        for j in range(len(quality.RULES)):
            r = []
            for nth, vote in enumerate((1, 0, -1)):
                g = sum(n * q for (votes, n), q in zip(rows, state) if votes[j] == vote)
                b = sum(n * (1 - q) for (votes, n), q in zip(rows, state) if votes[j] == vote)
                r.append(math.log((g + k * prior["good"][nth]) / (good + k)) - math.log((b + k * prior["bad"][nth]) / (bad + k)))
            top, low = max(r[0], 0.0), min(r[2], 0.0)
            ratios.append({1: top, 0: min(max(r[1], low), top), -1: low})
        state = [1 / (1 + math.exp(-(odds + sum(ratios[j][v] for j, v in enumerate(votes))))) for votes, _ in rows]
    # the verdict's own estimate of the rates comes from the last state
    good, bad = sum(n * q for (_, n), q in zip(rows, state)), sum(n * (1 - q) for (_, n), q in zip(rows, state))
    odds, out = math.log((good + k) / (bad + k)), {}
    ratios = []
    for j in range(len(quality.RULES)):
        r = []
        for nth, vote in enumerate((1, 0, -1)):
            g = sum(n * q for (votes, n), q in zip(rows, state) if votes[j] == vote)
            b = sum(n * (1 - q) for (votes, n), q in zip(rows, state) if votes[j] == vote)
            r.append(math.log((g + k * prior["good"][nth]) / (good + k)) - math.log((b + k * prior["bad"][nth]) / (bad + k)))
        ratios.append({1: max(r[0], 0.0), 0: 0.0, -1: min(r[2], 0.0)})
    for votes, _ in rows:
        out[votes] = 1 / (1 + math.exp(-(odds + sum(ratios[j][v] for j, v in enumerate(votes)))))
    return out


def test_em_equals_its_plain_version(spark):
    rng = random.Random(12)
    for size in (1, 7, 60):
        patterns = {}
        for _ in range(size):
            votes = tuple(rng.choices((1, 0, -1), (8, 1, 1))[0] for _ in quality.RULES)
            patterns[votes] = patterns.get(votes, 0) + rng.choice((1, 3, 500, 100_000))
        df = spark.createDataFrame([(list(v), n) for v, n in patterns.items()], "votes array<int>, n long")
        got = {tuple(r["votes"]): r["posterior"] for r in quality._em(df).collect()}
        want = plain_em(list(patterns.items()))
        assert got.keys() == want.keys()
        assert all(math.isclose(got[v], want[v], rel_tol=1e-9, abs_tol=1e-12) for v in want)


def plain_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash_equals_its_plain_version():
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.integers(0, 2**64, 3000, dtype=np.uint64), np.array([0, 1, 2**63, 2**64 - 1], dtype=np.uint64)])
    for shards in (1, 2, 8, 9, 1000):
        assert sharding.jump_hash(keys, shards).tolist() == [plain_jump(int(k), shards) for k in keys]


def test_taken_per_document_is_a_cut_stream(spark):
    """Each source's documents in hash order, passed through again and again, cut at
    the target; positions by inverting the integrated schedule."""
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", "c", None]), "w " * rng.randint(0, 40)) for i in range(150)] + [(7, "a", "x y"), (None, "a", "x")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    got = mixing.mix(df).collect()
    hashes = {(r["_id"], r["source"]): (r["b"], r["h"]) for r in df.selectExpr(
        "doc_id AS _id", "source", "xxhash64(cast(doc_id AS string), source) AS h",
        f"pmod(xxhash64(cast(doc_id AS string), source), {mixing.BUCKETS}L) AS b").collect()}
    for source in ("a", "b", "c", None):
        mine = [r for r in got if r["source"] == source]
        mine.sort(key=lambda r: (*hashes[r["_id"], source], r["_id"] is not None, r["_id"] or 0, r["size"]))
        total, target = mine[0]["source_size"], mine[0]["target"]
        slope = mixing.SLOPES[["a", "b", "c", None].index(source) % 3]
        at = 0
        for r in mine:
            takes = []
            for n in range(2):
                start = at + n * total
                taken = max(0, min(r["size"], math.floor(target) - start))
                if taken:
                    takes.append((n, taken, min(1.0, start / max(target, 1))))
            assert [(t["pass"], t["taken"]) for t in r["takes"]] == [t[:2] for t in takes]
            for t, (_, _, done) in zip(r["takes"], takes):
                assert math.isclose(t["position"] + slope * (t["position"] ** 2 - t["position"]), done, abs_tol=1e-9)
            at += r["size"]
        assert at == total
