"""Words, hashes, blocks and the transform's index against plain Python."""

import numpy as np
import pyarrow as pa
from brute import ALNUM, LOWER, words
from hypothesis import given, settings
from hypothesis import strategies as st

from tradelake.llm import text as X
from tradelake.llm.suffix_dedup import repeat_groups, repeats_in


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\té9.", max_size=12) | st.none(), max_size=8))
def test_words_of_chunks(texts):
    buf, ends = X.text_bytes(pa.array(texts, pa.string()))
    w = X.Words(buf, ends, X.BLANK_SEPARATED)
    got = [[] for _ in texts]
    for d, s, e in zip(w.doc, w.start, w.end):
        got[d].append(bytes(buf[s:e]).decode())
    assert got == [words(t) for t in texts]
    low = X.lower_ascii(buf)
    w = X.Words(low, ends, X.ALPHANUMERIC)
    got = [[] for _ in texts]
    for d, s, e in zip(w.doc, w.start, w.end):
        got[d].append(bytes(low[s:e]).decode())
    assert got == [ALNUM.findall((t or "").translate(LOWER)) for t in texts]
    assert len({bytes(low[s:e]) for s, e in zip(w.start, w.end)}) == len(set(w.hash.tolist()))


def test_chunks_cover_all_rows():
    texts = ["x" * n for n in (0, 5, 100, 0, 3, 7)]
    buf, ends = X.text_bytes(pa.array(texts))
    got = []
    for lo, hi, part, e in X.chunks(buf, ends, 10):
        got += [bytes(part[s:t]).decode() for s, t in zip(np.concatenate([[0], e[:-1]]), e)]
    assert got == texts


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.integers(1, 12))
def test_repeat_groups(codes, length):
    c = np.array(codes, dtype=np.uint16)
    order, bound = repeat_groups(c, length)
    group = np.cumsum(bound) - 1
    twice = codes + codes
    while len(twice) < len(codes) + length:
        twice += codes
    of = {}
    for o, g in zip(order, group):
        of.setdefault(tuple(twice[o:o + length]), set()).add(int(g))
    assert all(len(v) == 1 for v in of.values())
    assert len({next(iter(v)) for v in of.values()}) == len(of)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.text(alphabet="ab", min_size=4, max_size=12)), min_size=1, max_size=9))
def test_repeats_in(strings):
    ids = np.array([i for i, _ in strings])
    data = [t.encode() for _, t in strings]
    key = np.zeros(len(data), dtype=np.uint32)
    got = repeats_in(ids, np.array([len(d) for d in data]), key, np.frombuffer(b"".join(data), dtype=np.uint8), 4)
    first = {}
    for i, d in zip(ids, data):
        for p in range(len(d) - 3):
            first[d[p:p + 4]] = min(first.get(d[p:p + 4], 99), i)
    assert got.tolist() == [first[d[p:p + 4]] < i for i, d in zip(ids, data) for p in range(len(d) - 3)]
