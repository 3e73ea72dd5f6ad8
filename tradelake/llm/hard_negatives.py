"""Hard negatives of anchors by integer inner products, tile by tile.

1. *Rows.*  A component x becomes ``floor(SCALE * x)``.  A row number, fixed
   once written, tells rows apart from here on and deals them into slabs of
   about ``SLAB`` candidates and blocks of about ``BLOCK`` anchors, whatever
   their ids, labels and vectors; a hot label or vector is spread like any other.
2. *Products.*  A task gets one block of anchors and one slab of candidates and
   multiplies tiles of them by Strassen's recursion on int64 matrices: odd sizes
   are padded with zeros, seven products and exact integer sums make one level,
   and parts of at most ``LEAF`` in one direction are multiplied plainly.
3. *Heaps.*  A tile gives every anchor its best ``positives`` rows of the same
   label; a second pass over the tiles gives every (anchor, positive) its best
   ``negatives`` rows of other labels in the score window of that positive.
   Such short lists merge: tile into slab within the task, slabs by a top-k per
   key, which Spark cuts down before it shuffles.

Defined results: a row with a null label, a null vector or a null or non-finite
component takes no part, nor does one whose squared length (after scaling)
exceeds ``LONGEST``: scores could leave 64 bits.  Vectors of unequal length are
compared as if zeros followed the shorter; an empty vector scores 0.  A null id is
no anchor, comes last among ties and may be a candidate.  Rows that repeat an id
are rows of their own (an anchor's copy is an "other" row).  An anchor without
a row of its label, or a positive without one in its window, returns nothing; an
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelake.llm.scratch import pick, written

SCALE = 256
SLAB, BLOCK, TILE, LEAF = 4096, 1024, 1024, 32
#: No |score| exceeds the largest squared length.
LONGEST = 2.0 ** 60
POSITIVES = NEGATIVES = 5
#: The window: LOW * positive <= FULL * negative <= FULL * positive.
LOW, FULL = 80, 100
_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices, exact (modulo 2**64)."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    pad = (m % 2, k % 2, n % 2)
    if any(pad):
        a = np.pad(a, ((0, pad[0]), (0, pad[1])))
        b = np.pad(b, ((0, pad[1]), (0, pad[2])))
    y, x, z = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:y, :x], a[:y, x:], a[y:, :x], a[y:, x:]
    b11, b12, b21, b22 = b[:x, :z], b[:x, z:], b[x:, :z], b[x:, z:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * y, 2 * z), dtype=np.int64)
    out[:y, :z] = p1 + p4 - p5 + p7
    out[:y, z:] = p3 + p5
    out[y:, :z] = p2 + p4
    out[y:, z:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """The vectors as rows of ``width`` numbers, zeros behind shorter ones."""
    v = vectors.combine_chunks()
    sizes = np.diff(np.asarray(v.offsets)).astype(np.int64)
    out = np.zeros((len(v), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = np.asarray(v.flatten())
    return out


def _best(scores: np.ndarray, allowed: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score) of each row's ``top`` highest allowed scores, by
    row, then rank; of equal scores the first column."""
    left = np.where(allowed, scores, _NONE)
    out = []
    for _ in range(min(top, left.shape[1])):
        at = left.argmax(axis=1)
        value = np.take_along_axis(left, at[:, None], 1)[:, 0]
        row = np.flatnonzero(value != _NONE)
        if not len(row):
            break
        out.append((row, at[row], value[row]))
        left[row, at[row]] = _NONE
    if not out:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


class _Heaps:
    """The best ``top`` (score, place) of each owner, merged tile by tile.
    Places are in order of id, so smaller places win ties."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.held = (np.zeros(0, dtype=np.int64),) * 3

    def push(self, owner: np.ndarray, place: np.ndarray, score: np.ndarray) -> None:
        owner, place, score = (np.concatenate(x) for x in zip(self.held, (owner, place, score)))
        order = np.lexsort((place, -score, owner))
        owner, place, score = owner[order], place[order], score[order]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else owner
        nth = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
        self.held = tuple(x[nth < self.top] for x in (owner, place, score))


def _in_id_order(rows: pa.Table) -> pa.Table:
    return rows.sort_by([("vec_id", "ascending"), ("row", "ascending")])  # nulls come last


def _tiles(anchors: pa.Table, rows: pa.Table, tile: int, leaf: int):
    """(first place, label, row, scores) of each tile of the candidates."""
    width = max(np.diff(np.asarray(t["vector"].combine_chunks().offsets)).max(initial=0) for t in (anchors, rows))
    a, b = _matrix(anchors["vector"], width), _matrix(rows["vector"], width)
    label, row = np.asarray(rows["label"]), np.asarray(rows["row"])
    for at in range(0, len(b), tile):
        s = slice(at, at + tile)
        yield at, label[s], row[s], strassen(a, np.ascontiguousarray(b[s].T), leaf)


def _positives_of(top: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    tile, leaf = TILE, LEAF

    def of(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows, heaps = _in_id_order(rows), _Heaps(top)
        label, own = np.asarray(anchors["label"]), np.asarray(anchors["row"])
        if anchors.num_rows:
            for at, theirs, row, scores in _tiles(anchors, rows, tile, leaf):
                ok = (label[:, None] == theirs[None, :]) & (own[:, None] != row[None, :])
                i, j, s = _best(scores, ok, top)
                heaps.push(i, at + j, s)
        i, j, s = heaps.held
        found = rows.take(pa.array(j))
        return pa.table({"anchor": pa.array(own[i]), "anchor_id": anchors["vec_id"].take(pa.array(i)),
                         "positive": found["row"], "positive_id": found["vec_id"], "positive_score": pa.array(s)})
    return of


def _negatives_of(top: int, low: int, full: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of anchors with their positives (a row each: nth, positive_score)."""
    tile, leaf = TILE, LEAF

    def of(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        rows, heaps = _in_id_order(rows), _Heaps(top)
        positives = anchors["positives"].combine_chunks()
        ends = np.asarray(positives.offsets) - np.asarray(positives.offsets)[0] if len(positives) else np.zeros(1, dtype=np.int64)
        scores_of = np.asarray(positives.flatten())
        least = np.array([-(-low * p // full) for p in scores_of.tolist()], dtype=np.int64)  # products beyond 64 bits
        label, count = np.asarray(anchors["label"]), np.diff(ends)
        if anchors.num_rows:
            for at, theirs, _, scores in _tiles(anchors, rows, tile, leaf):
                other = label[:, None] != theirs[None, :]
                for nth in range(count.max(initial=0)):
                    mine = np.flatnonzero(count > nth)
                    slot = ends[mine] + nth
                    p, s = scores_of[slot][:, None], scores[mine]
                    i, j, s = _best(s, other[mine] & (least[slot][:, None] <= s) & (s <= p), top)
                    heaps.push(slot[i], at + j, s)
        slot, j, s = heaps.held
        owner = np.searchsorted(ends, slot, side="right") - 1
        found = rows.take(pa.array(j))
        return pa.table({"anchor": anchors["row"].take(pa.array(owner)), "nth": pa.array((slot - ends[owner]).astype(np.int32)),
                         "negative_id": found["vec_id"], "negative_score": pa.array(s)})
    return of


def integer_rows(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(row, vec_id, label, vector): the rows that take part, components as
    integers."""
    rows = pick(vectors, vec_id=vec_id, vector=vector, label=label).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"),
        F.transform("vector", lambda x: F.lit(float(SCALE)) * x.cast("double")).alias("v"))
    rows = rows.filter("label IS NOT NULL AND v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND abs(x) < double('Infinity'))")
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    return rows.filter(length <= LONGEST).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label",
        F.transform("v", lambda x: F.floor(x).try_cast("int")).alias("vector"))


def _dealt(rows: DataFrame, block: int) -> tuple[Column, int]:
    """The block of a row, by its number, and how many there are."""
    n = max(1, -(-rows.count() // block))
    return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int"), n


def _met(anchors: DataFrame, rows: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work`` on every block of anchors with every slab of candidates."""
    block, blocks = _dealt(anchors, BLOCK)
    slab, slabs = _dealt(rows, SLAB)
    left = anchors.withColumns({"_b": block, "_s": F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))})
    right = rows.withColumns({"_s": slab, "_b": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    return left.groupBy("_b", "_s").cogroup(right.groupBy("_b", "_s")).applyInArrow(work, schema)


def _top(rows: DataFrame, by: list[str], score: str, tie: str, top: int) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.col(score).desc(), F.col(tie).asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, full: int = FULL) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score of rows (row, vec_id, label, vector) whose ``row`` is fixed."""
    anchors = written(rows.filter(is_anchor), "anchors")
    found = _met(anchors, rows, _positives_of(positives),
                 "anchor long, anchor_id long, positive long, positive_id long, positive_score long")
    best = _top(found, ["anchor"], "positive_score", "positive_id", positives)
    best = written(best.select("anchor", "anchor_id", (F.col("rank") - 1).alias("nth"), "positive_id", "positive_score"), "positives")
    lists = best.groupBy("anchor").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("nth", "positive_score"))), lambda x: x["positive_score"]).alias("positives"))
    asking = anchors.join(lists, F.col("row") == F.col("anchor")).select("row", "label", "vector", "positives")
    asking = written(asking, "asking")
    near = _met(asking, rows, _negatives_of(negatives, low, full),
                "anchor long, nth int, negative_id long, negative_score long")
    near = _top(near, ["anchor", "nth"], "negative_score", "negative_id", negatives)
    return near.join(best, ["anchor", "nth"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine(vectors: DataFrame, every: int = 100, relabel_every: int = 7, labels: int = 10) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every``.  The label
    of every ``relabel_every``-th id is moved on by one first, among ``labels``."""
    rows = integer_rows(vectors)
    moved = F.coalesce(F.col("vec_id") % relabel_every == 0, F.lit(False))
    rows = written(rows.withColumn("label", F.when(moved, (F.col("label") + 1) % labels).otherwise(F.col("label"))), "vectors")
    return hard_negatives(rows, F.col("vec_id") % every == 0)
