"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import re

WORD = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def quality_counts(text):
    w = words(text)
    seen = {}
    for k in range(len(w) - 7):
        seen.setdefault(tuple(w[k:k + 8]), []).append(k)
    rep = {i for v in seen.values() if len(v) > 1 for k in v for i in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(rep), n < 20 or 100 * len(rep) > 30 * n)


def word_repeats(rows, k):
    """{row number: (n_words, n_removed, sha of kept)} for (doc_id, text) rows."""
    first = {}
    split = [(i, words(t)) for i, t in rows]
    order = float("inf")
    for i, w in split:
        for p in range(len(w) - k + 1):
            key = tuple(w[p:p + k])
            first[key] = min(first.get(key, order), order if i is None else i)
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - k + 1):
            if first[tuple(w[p:p + k])] < (order if i is None else i):
                gone.update(range(p, p + k))
        out.append((i, len(w), len(gone), sha(" ".join(x for p, x in enumerate(w) if p not in gone).encode())))
    return out


def byte_repeats(rows, k):
    first, order = {}, float("inf")
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for p in range(len(b) - k + 1):
            key = b[p:p + k]
            first[key] = min(first.get(key, order), order if i is None else i)
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - k + 1):
            if first[b[p:p + k]] < (order if i is None else i):
                gone[p:p + k] = b"\1" * k
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def shingles(text, k=5):
    w = words((text or "").translate(LOWER))
    return {tuple(w[p:p + k]) for p in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near_components(rows, percent=85):
    """[(doc_id, n_shingles, component)]"""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    of = {}
    for n, (i, s) in enumerate(sets):
        near = {}
        for x in s:
            for j in of.get(x, ()):
                near[j] = near.get(j, 0) + 1
            of.setdefault(x, []).append(n)
        for j, both in near.items():
            if 100 * both >= percent * (len(s) + len(sets[j][1]) - both):
                a, b = root(i), root(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return [(i, len(s), root(i)) for i, s in sets]


def contamination(rows, items, k=10):
    """[(doc_id, n_words, n_hit, n_items, items_sha256)]"""
    windows = {}
    for item, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        size = min(k, len(w))
        for p in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[p:p + size]), set()).add(item)
    sizes = {len(x) for x in windows}
    out = []
    for i, t in rows:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for p in range(len(w) - size + 1):
                of = windows.get(tuple(w[p:p + size]))
                if of:
                    found |= of
                    hit.update(range(p, p + size))
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found))).encode())))
    return out
