"""Remove byte passages that an earlier document has, by threshold-bounded
interval expansion on a Burrows-Wheeler transform.

The index that decides is :func:`repeat_groups`: it builds the transform of a
text, starts from the intervals of single letters and extends them backwards,
breadth first.  A boundary between neighbouring suffixes is found in the round
that equals their common prefix, so prefixes come out by increasing value, and
the rounds stop at the minimum length: the suffixes that no boundary separates
then share at least that much.

One transform over 100 TB is neither possible nor needed.  Two equal strings
of ``LENGTH`` bytes have the same *minimizer* (the place in them with the
smallest hash of ``GRAM`` bytes, the leftmost of equals), so:

1. Each document is cut into runs of windows with the same minimizer.  Hashes
   of minimizers are counted over all documents (:mod:`tradelake.llm.blocks`);
   runs whose minimizer no other document has hold no repeat and go no further.
2. The bytes of the remaining runs go to the bucket of their minimizer, equal
   runs of a block once.  All occurrences of a string meet in one bucket.  Runs
   that share their minimizer with a different run are indexed as above, equal
   ones once; a run that all documents have alike needs no index.
3. A minimizer of very many runs (a passage in a large part of all documents,
   each time with other bytes around it) has its runs cut into single windows,
   which are spread by the hash of the whole window.  This takes some eight times
   the bytes, so what counts is the size of the bucket, however many blocks there
   are.

A block sends one row for each route, which is up to ``2 ** ROUTE`` neighbouring
buckets: with more text there are more blocks and more buckets, and a row for each
pair of them would take its time for a few strings.  A route works on its buckets
one after the other and answers a block with one bit per window.

Defined results: a null text is empty; texts shorter than ``LENGTH`` are kept
whole; rows with the same doc_id are never repeats of each other; a null doc_id
counts as larger than all others; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import blocks as B
from tradelake.llm.scratch import pick
from tradelake.llm.substring_dedup import span_lists
from tradelake.llm.text import U, covered, letters_of, mix64, run_starts, spans_hash, window_hashes

LENGTH = 50
GRAM = 24
BLOCK = 4 << 20
PER_BUCKET = 2_000_000   # bytes of documents for each bucket, of which an index holds some
ROUTE = 3                # log2 of the buckets that share a row
ROUTES = 6               # log2 of the routes that there are before buckets share a row
_PLACE = 17              # bits for a place in the piece of a block that is worked on at once
SEED = 7                 # letters from which extension starts
PLACE = np.int32         # places in a block or an index, both far below 2 GB
_SEGMENT = 2 << 20       # bytes whose hash sums are held at once

RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start long, end long>>, kept binary"


# ---------------------------------------------------------------- the index

def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """All rotations of ``codes`` (below 512), sorted by their first ``depth``
    codes or more.  The text's end is followed by its start, so the letter
    before a rotation is always defined."""
    span, key = 7, np.zeros(len(codes), dtype=U)
    for i in range(span):
        key = (key << U(9)) | np.roll(codes, -i).astype(U)
    while True:
        order = np.argsort(key).astype(PLACE)
        if span >= depth:
            return order
        key = key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank = np.empty(len(codes), dtype=np.uint32)
        rank[order] = np.cumsum(new, dtype=np.uint32)
        key = rank.astype(U)
        key <<= U(32)
        key |= np.roll(rank, -span)
        span *= 2


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for each of the ranges."""
    at = np.cumsum(sizes) - sizes
    out = np.repeat((starts - at).astype(PLACE), sizes)
    out += np.arange(len(out), dtype=PLACE)
    return out


def repeat_groups(codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, which of them start a group): the suffixes of a
    group share at least ``length`` codes, those of different groups less.

    A boundary at p with common prefix l splits an interval.  Backward
    extension by a letter maps the letter's first occurrence behind p, if the
    interval also has it before p, to a boundary with common prefix l + 1.
    Per split, all parts but the largest are looked through, so a place is
    visited O(log n) times.  Extension starts from the intervals of all strings
    of ``SEED`` letters, as it would reach them from single letters.
    """
    n = len(codes)
    order = suffix_order(codes, length)
    bwt = codes[order - 1]                       # the letter before each suffix
    by_letter = np.argsort(bwt, kind="stable").astype(PLACE)
    to = np.empty(n, dtype=PLACE)                # LF: where the suffix one longer stands
    to[by_letter] = np.arange(n, dtype=PLACE)
    same = bwt[by_letter][1:] == bwt[by_letter][:-1]
    prev, following = np.full(n, -1, dtype=PLACE), np.full(n, n, dtype=PLACE)
    prev[by_letter[1:][same]] = by_letter[:-1][same]
    following[by_letter[:-1][same]] = by_letter[1:][same]
    del by_letter, same, bwt

    # the intervals of strings of SEED letters are read off the sorted suffixes
    seed = min(SEED, length)
    key = np.zeros(n, dtype=U)
    for i in range(seed):
        key = (key << U(9)) | np.roll(codes, -i)[order]
    differs = key[1:] != key[:-1]
    key >>= U(9)
    bound = np.concatenate([[True], key[1:] != key[:-1]])   # common prefix below seed - 1
    new = np.flatnonzero(differs & ~bound[1:]) + 1          # common prefix seed - 1
    del key, differs
    interval = np.cumsum(bound, dtype=PLACE) - PLACE(1)     # the interval of each place
    start = np.append(np.flatnonzero(bound), n).astype(PLACE)
    end = np.append(start[1:], n).astype(PLACE)
    intervals = len(start) - 1
    bound[new] = True
    for _ in range(length - seed):
        if not len(new):
            break
        parent = interval[new]
        firsts = run_starts(parent)              # new boundaries of one interval lie together
        group = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(new))))
        # parts: from the interval's start, and from each new boundary
        parts = len(new) + len(firsts)
        at = np.arange(len(new)) + group + 1
        head = firsts + np.arange(len(firsts))
        s, owner = np.empty(parts, dtype=PLACE), np.empty(parts, dtype=PLACE)
        s[at], s[head] = new, start[parent[firsts]]
        owner[at], owner[head] = parent, parent[firsts]
        e = np.append(s[1:], PLACE(0))
        last = np.append(head[1:] - 1, parts - 1)
        e[last] = end[parent[firsts]]
        size = e - s
        most = np.repeat(np.maximum.reduceat(size, head), np.diff(np.append(head, parts)))
        part_of = np.repeat(np.arange(len(head)), np.diff(np.append(head, parts)))
        big = np.flatnonzero(size == most)
        big = big[run_starts(part_of[big])]      # the first largest part of each interval
        small = np.ones(parts, dtype=bool)
        small[big] = False
        big_s, big_e = s[big][part_of], e[big][part_of]
        origin = s[head][part_of]

        places = _ranges(s[small], size[small])
        part = np.repeat(np.flatnonzero(small).astype(PLACE), size[small])
        back = prev[places]
        here = places[(back < s[part]) & (back >= origin[part])]
        ahead = following[places]
        there = ahead[(s[part] < big_s[part]) & (ahead >= big_s[part]) & (ahead < big_e[part])]

        numbers = intervals + np.arange(int(small.sum()))
        intervals += len(numbers)
        interval[places] = np.repeat(numbers, size[small])
        if intervals > len(start):
            start = np.concatenate([start, np.zeros(intervals, dtype=PLACE)])
            end = np.concatenate([end, np.zeros(intervals, dtype=PLACE)])
        start[numbers], end[numbers] = s[small], e[small]
        start[owner[big]], end[owner[big]] = s[big], e[big]

        new = to[np.concatenate([here, there])]
        new = np.sort(new[~bound[new]])
        bound[new] = True
    return order, bound


# ------------------------------------------------------------ runs of windows

class Runs:
    """Runs of windows of a block: minimizer hash, text number, first window,
    byte behind the last window, and the hash of the run's bytes."""

    def __init__(self, gram: np.ndarray, doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        self.gram, self.doc, self.first, self.last = gram, doc, first, last

    def take(self, which: np.ndarray) -> Runs:
        return Runs(self.gram[which], self.doc[which], self.first[which], self.last[which])


def runs_of(block: B.Block, length: int = LENGTH, gram: int = GRAM) -> Runs:
    """The runs of all windows of ``length`` bytes that lie within a text, worked
    out in overlapping pieces that fit a processor's cache."""
    empty = np.zeros(0, dtype=np.int64)
    found = [(np.zeros(0, dtype=U), empty, empty, empty)]
    most = 1 << _PLACE
    for lo in range(0, max(1, len(block.buf)), most - length):
        found.append(_runs(block, lo, min(lo + most, len(block.buf)), length, gram))
    return Runs(*(np.concatenate(x) for x in zip(*found)))


def _runs(block: B.Block, lo: int, hi: int, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Those of the windows that start in lo..hi - length."""
    n = hi - lo
    empty = np.zeros(0, dtype=np.int64)
    if n < length or (lo and n == length):
        return np.zeros(0, dtype=U), empty, empty, empty
    h = window_hashes(letters_of(block.buf[lo:hi]), gram)
    place = U((1 << _PLACE) - 1)
    low = (h & ~place) | np.arange(len(h), dtype=U)       # ties: the leftmost
    wide, width = 1, length - gram + 1
    while wide * 2 <= width:
        low = np.minimum(low[:-wide], low[wide:])
        wide *= 2
    if width > wide:
        low = np.minimum(low[:len(low) - (width - wide)], low[width - wide:])
    # windows that reach beyond their text; pieces overlap by ``length``, and a
    # window on the seam belongs to the next one
    ends = block.ends[np.searchsorted(block.ends, lo):np.searchsorted(block.ends, hi + length) + 1] - lo
    beyond = np.zeros(len(low) + 1, dtype=np.int32)
    np.add.at(beyond, np.clip(ends - length + 1, 0, len(low)), 1)
    np.add.at(beyond, np.clip(ends, 0, len(low)), -1)
    inside = np.cumsum(beyond[:-1]) == 0
    if hi < len(block.buf):
        inside[hi - lo - length:] = False
    start = np.flatnonzero(inside)
    if not len(start):
        return np.zeros(0, dtype=U), empty, empty, empty
    at = (low[inside] & place).astype(np.int64)            # the minimizer of each window
    cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)]))
    first, last = start[cut] + lo, np.append(start[cut[1:] - 1], start[-1]) + lo
    # minimizers are small by choice: mixed once more, they spread evenly again
    return mix64(h[at[cut]]), np.searchsorted(block.ends, first, side="right"), first, last


def byte_hashes(buf: np.ndarray, first: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings first..behind, in the order of ``first``."""
    out = np.zeros(len(first), dtype=U)
    lo = 0
    while lo < len(first):
        at = int(first[lo])
        hi = max(lo + 1, int(np.searchsorted(first, at + _SEGMENT)))
        s, e = first[lo:hi] - at, behind[lo:hi] - at
        out[lo:hi] = mix64(spans_hash(buf[at:at + int(e.max())], s, e) + (e - s).astype(U))
        lo = hi
    return out


class Candidates:
    """The runs of a block that may hold repeats, each distinct string once, in
    the order of their buckets."""

    def __init__(self, block: B.Block, flags: np.ndarray, crowds: np.ndarray, length: int, gram: int) -> None:
        runs = runs_of(block, length, gram)
        _, first, of = B.distinct(block, runs.gram, runs.doc)
        many = np.zeros(len(first), dtype=bool)            # two texts of this block have it
        ids = block.ids[runs.doc]
        if len(of):
            many[of[ids != block.ids[first][of]]] = True
        open_ = (flags | many)[of] if len(of) else np.zeros(0, dtype=bool)
        crowded = (crowds[of] if len(of) else open_) & open_
        plain, hot = runs.take(open_ & ~crowded), runs.take(crowded)
        sizes = hot.last - hot.first + 1
        single = _ranges(hot.first, sizes)
        self.doc = np.concatenate([plain.doc, np.repeat(hot.doc, sizes)])
        self.first = np.concatenate([plain.first, single])
        self.behind = np.concatenate([plain.last, single]) + length
        self.hash = np.concatenate([byte_hashes(block.buf, r, r_behind) for r, r_behind in (
            (plain.first, plain.last + length), (single, single + length))])
        self.key = np.concatenate([plain.gram, self.hash[len(plain.doc):]])
        order = np.lexsort((self.doc, self.hash, self.key))    # texts are in doc_id order
        self.doc, self.first, self.behind, self.hash, self.key = (
            x[order] for x in (self.doc, self.first, self.behind, self.hash, self.key))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (self.hash[1:] != self.hash[:-1]) | (self.key[1:] != self.key[:-1])
        self.starts = np.flatnonzero(new)                      # the first occurrence of each string
        self.of = np.cumsum(new) - 1


# ------------------------------------------------------------------ the job

def _encode(block: B.Block, c: Candidates, cuts: np.ndarray, squeeze: zstandard.ZstdCompressor) -> bytes:
    """Strings of a route with minimizer and smallest id; cuts: between its buckets."""
    which = c.starts[cuts[0]:cuts[-1]]
    s = c.first[which]
    size = c.behind[which] - s
    table, of = np.unique(block.ids[c.doc[which]], return_inverse=True)
    head = np.array([len(which), len(table), len(cuts) - 1], dtype=np.int64)
    return head.tobytes() + squeeze.compress(b"".join([
        table.tobytes(), np.diff(cuts).tobytes(), B.planes(of.astype(np.uint32)), B.planes(size.astype(np.uint32)),
        c.key[which].astype(np.uint32).tobytes(), block.buf[_ranges(s, size)].tobytes()]))


def _decode(data: bytes, loose: zstandard.ZstdDecompressor) -> tuple[np.ndarray, ...]:
    """(bucket in the route of each string, its id, its size, part of its
    minimizer's hash, bytes)"""
    n, ids, buckets = np.frombuffer(data, dtype=np.int64, count=3).tolist()
    raw = loose.decompress(data[24:])
    at = 8 * (ids + buckets)
    table = np.frombuffer(raw, dtype=np.int64, count=ids)
    held = np.frombuffer(raw, dtype=np.int64, count=buckets, offset=8 * ids)
    of, size = (B.unplanes(raw[at + 4 * n * i:at + 4 * n * (i + 1)], np.uint32, n) for i in range(2))
    key = np.frombuffer(raw, dtype=np.uint32, count=n, offset=at + 8 * n)
    return (np.repeat(np.arange(buckets, dtype=np.uint8), held), table[of], size.astype(np.int64), key,
            np.frombuffer(raw, dtype=np.uint8, offset=at + 12 * n))


def repeats_in(ids: np.ndarray, size: np.ndarray, key: np.ndarray, buf: np.ndarray, length: int) -> np.ndarray:
    """For every window of each string: does a string with a smaller id have it
    too?  Windows come string by string.  Strings with different ``key`` share
    no window."""
    first = np.cumsum(size) - size
    windows = size - length + 1
    h = byte_hashes(buf, first, first + size)
    order = np.lexsort((ids, h))
    starts = run_starts(h[order])                        # equal strings count once,
    of = np.empty(len(order), dtype=PLACE)               # by the smallest id
    of[order] = np.repeat(np.arange(len(starts), dtype=PLACE), np.diff(np.append(starts, len(order))))
    one = order[starts]
    del h, order, starts
    base = np.cumsum(windows[one]) - windows[one]
    smallest = np.repeat(ids[one], windows[one])         # per window of the distinct strings

    # a string that is the only one with its key can't share a window
    _, kind, times = np.unique(key[one], return_inverse=True, return_counts=True)
    some = np.flatnonzero(times[kind] > 1)
    if len(some):
        which = one[some]
        codes = np.zeros(int((size[which] + 1).sum()), dtype=np.uint16)   # 0 ends each string
        at = np.cumsum(size[which] + 1) - size[which] - 1
        codes[_ranges(at, size[which])] = buf[_ranges(first[which], size[which])].astype(np.uint16) + 1
        suffixes, bound = repeat_groups(codes, length)
        group = np.empty(len(codes), dtype=PLACE)
        group[suffixes] = np.cumsum(bound, dtype=PLACE) - PLACE(1)
        group = group[_ranges(at, windows[which])]       # of the suffixes that are windows
        least = np.full(int(bound.sum()), np.iinfo(np.int64).max)
        np.minimum.at(least, group, np.repeat(ids[which], windows[which]))
        smallest[_ranges(base[some], windows[which])] = least[group]
    return smallest[_ranges(base[of], windows)] < np.repeat(ids, windows)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, the removed intervals and the bytes kept."""
    def minimizers(block: B.Block) -> tuple[np.ndarray, np.ndarray]:
        runs = runs_of(block, length, gram)
        return runs.gram, runs.doc

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for number, block, batch, row in B.unpack(batches):
            c = Candidates(block, B.flags_of(batch, row), B.flags_of(batch, row, field="crowds"), length, gram)
            at = np.searchsorted(c.key[c.starts] >> shift, np.arange((1 << bits) + 1, dtype=U))
            full = np.flatnonzero(np.diff(at[::held]))
            yield pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()), pa.array(np.full(len(full), number), pa.int64()),
                pa.array([_encode(block, c, at[r * held:(r + 1) * held + 1], squeeze) for r in full], pa.binary())],
                names=["bucket", "block", "sent"])

    def answer(group: pa.Table) -> pa.Table:
        loose = zstandard.ZstdDecompressor()
        parts = [_decode(x, loose) for x in group["sent"].to_pylist()]
        bucket, ids, size, key, buf = (np.concatenate([p[i] for p in parts]) for i in range(5))
        sizes = [int((p[2] - length + 1).sum()) for p in parts]
        del parts
        windows, first = size - length + 1, np.cumsum(size) - size
        base = np.cumsum(windows) - windows
        hit = np.empty(int(windows.sum()), dtype=bool)
        order = np.argsort(bucket, kind="stable")
        for which in np.split(order, run_starts(bucket[order])[1:]):
            hit[_ranges(base[which], windows[which])] = repeats_in(
                ids[which], size[which], key[which], buf[_ranges(first[which], size[which])], length)
        return pa.table({"block": group["block"], "bucket": group["bucket"], "n": pa.array(sizes, pa.int32()),
                         "flags": pa.array([np.packbits(x).tobytes() for x in np.split(hit, np.cumsum(sizes)[:-1])],
                                           pa.binary())})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, batch, row in B.unpack(batches):
            n, total = len(block.ids), len(block.buf)
            c = Candidates(block, B.flags_of(batch, row), B.flags_of(batch, row, field="crowds"), length, gram)
            told = B.flags_of(batch, row, column="windows")
            gone = np.zeros(total, dtype=bool)
            if len(c.of):
                windows = c.behind - c.first - length + 1
                base = np.cumsum(windows[c.starts]) - windows[c.starts]
                repeat = told[_ranges(base[c.of], windows)]       # by a smaller id of any block
                repeat |= np.repeat(block.ids[c.doc] > block.ids[c.doc[c.starts]][c.of], windows)
                gone = covered(np.sort(_ranges(c.first, windows)[repeat]), length, total)
            size = np.diff(block.ends, prepend=0)
            doc = np.repeat(np.arange(n), size)
            left = np.bincount(doc[~gone], minlength=n)
            offsets = np.concatenate([[0], np.cumsum(left)]).astype(np.int32)
            kept = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()),
                                                                pa.py_buffer(block.buf[~gone].tobytes())])
            yield pa.RecordBatch.from_arrays([
                block.id_column(), pa.array(size, pa.int64()), pa.array(size - left, pa.int64()),
                span_lists(gone, doc, block.ends - size, n), kept],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    blocks = B.blocks_of(pick(docs, doc_id=doc_id, text=text), "bytes", BLOCK)
    total = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    bits = max(2, math.ceil(math.log2(max(1.0, total / PER_BUCKET))))
    shift = U(64 - bits)
    held = 1 << max(0, min(ROUTE, bits - ROUTES))            # buckets of a route
    shared = B.repeated(blocks, minimizers, B.bucket_bits(blocks, (length - gram + 2) / 2), "minimizers", any_other=True)
    columns = ["block", "ids", "ends", "n_bytes", "data", "answers"]
    flagged = blocks.join(shared, "block", "left").select(*columns)
    answers = flagged.mapInArrow(send, "bucket int, block long, sent binary").groupBy("bucket").applyInArrow(
        answer, "block long, bucket int, n int, flags binary")
    windows = B.per_block(answers, "repeats").withColumnRenamed("answers", "windows")
    joined = blocks.join(shared, "block", "left").join(windows, "block", "left")
    return joined.select(*columns, "windows").mapInArrow(cut, RESULT)
