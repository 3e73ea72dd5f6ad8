"""Collocations against brute force, the index against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tradelake.llm import collocations as co

LOWER = {i: i + 32 for i in range(65, 91)}


def pieces(text):
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER))]


def brute(rows, longest=3, least=10, top=2000, inside=50):
    out = []
    for lang in {x or "und" if x is None else x for x, _ in rows}:
        f, before, behind, n = Counter(), Counter(), Counter(), 0
        for x, text in rows:
            if ("und" if x is None else x) == lang:
                for p in pieces(text):
                    n += len(p)
                    for k in range(1, longest + 1):
                        for i in range(len(p) - k + 1):
                            g = tuple(p[i:i + k])
                            f[g] += 1
                            before[g] += i > 0
                            behind[g] += i + k < len(p)
        cand = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        rows_of = []
        for g, a in cand.items():
            if any(100 * b >= inside * a for h, b in cand.items() if len(h) > len(g)
                   and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))):
                continue
            s, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            rows_of.append((s, a, " ".join(g), f[g[:k]], f[g[k:]], n, before[g], behind[g]))
        rows_of.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, l, r, n, s, b, e) for i, (s, a, p, l, r, n, b, e) in enumerate(rows_of[:top])]
    return sorted(out)


def rows_of(seed=2):
    rng = random.Random(seed)
    vocabulary = "the of New York city ça ñu Ünder a b c d e f g".split() + [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randint(0, 60)):
            words.append(rng.choice([rng.choice(vocabulary), rng.choice(vocabulary[:9]), "New York city", "of the", "a a a a"]))
            if rng.random() < 0.15:
                words.append(rng.choice([".", ",", "; ", "!\n", "\x0b", "?", ":", " \t ", "\xa0"]))
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), " ".join(words)))
    rows += [("en", None), ("en", ""), (None, " .,\t"), ("de", "x"), ("en", "the of " * 3000), ("en", "z" * 5000), rows[3], rows[3]]
    return rows


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "before", "behind"]


@pytest.mark.parametrize("shard,bits,longest", [(co.SHARD, co.BITS, 3), (700, 3, 3), (5000, 20, 4)])
def test_against_brute_force(spark, monkeypatch, shard, bits, longest):
    monkeypatch.setattr(co, "SHARD", shard)
    monkeypatch.setattr(co, "BITS", bits)
    rows = rows_of()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, word string, a int").repartition(3)
    got = co.collocations(df, longest=longest, top=40)
    assert got.columns == COLUMNS
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, longest, top=40)


def test_empty(spark):
    assert co.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert co.collocations(spark.createDataFrame([("en", None), (None, "a. b")], "lang string, text string")).count() == 0


def test_shards_without_a_phrase(spark):
    """A frequent word that always stands alone in its piece: no phrase in its
    shard, beside shards with phrases and without them."""
    alone, rows = [("fr", "solo. " * 20)], [("fr", "solo. " * 20), ("en", "new york city " * 12)]
    assert co.collocations(spark.createDataFrame(alone, "lang string, text string")).count() == 0
    got = co.collocations(spark.createDataFrame(rows, "lang string, text string"))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("depth", [2, 3, 5])
def test_index_counts_phrases(depth):
    rng = np.random.default_rng(depth)
    seq = np.concatenate([[0], rng.integers(0, 6, 400), [0]]).astype(np.int32)
    one = co.Index(co.transform(seq, 6, depth), co.transform(np.ascontiguousarray(seq[::-1]), 6, depth), 6)
    found, text = one.singles(), seq.tolist()
    for d in range(1, depth + 1):
        if d > 1:
            found = one.longer(*found)
        want = Counter(tuple(text[i:i + d]) for i in range(len(text) - d + 1) if min(text[i:i + d]) >= co.FIRST)
        assert {tuple(p): n for p, n in zip(found[0].tolist(), found[3].tolist())} == want
        if d < depth:   # the interval forward is that of the phrase: its letters before are right
            for p, a, n in zip(found[0].tolist(), found[1].tolist(), found[3].tolist()):
                at = [i for i in range(len(text) - d + 1) if text[i:i + d] == p]
                assert sorted(one.before[a:a + n].tolist()) == sorted(text[i - 1] for i in at)


def test_words_of_one_hash_stay_apart(monkeypatch):
    parts = [np.frombuffer(b"ab cd ab. cd ab", dtype=np.uint8), np.frombuffer(b"ef", dtype=np.uint8)]
    want = co._sequence(parts)
    monkeypatch.setattr(co.Words, "_hashes", lambda self, buf: np.zeros(len(self.start), dtype=np.uint64))
    got = co._sequence(parts)
    name = lambda r: [r[0][i - 1] if i else None for i in r[2]]
    assert name(got) == name(want) == [None, "ab", "cd", "ab", None, "cd", "ab", None, "ef", None]


def test_scores_are_exact(spark):
    rows = [(7, 10, 10), (10**15 + 1, 10**15 + 3, 10**15 + 7), (3, 7, 11)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in df.select(co.score_of(df.a, df.l, df.r)).collect()]
    assert got == [10**6 * a * a // (l * r) for a, l, r in rows]
