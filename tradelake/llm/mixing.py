"""Mix sources to target weights with a time-varying curriculum, in DataFrame
and SQL functions only.

1. *Targets.*  Sources in code point order (null last) get the weights in
   turn.  Together they are to give ``share`` times all words; no source more
   than ``cap`` times its own.  With the sources sorted by cap / weight the
   level that fills them is a running sum, not a loop.
2. *Words taken.*  Each source is a stream of its documents in a stable hash
   order, repeated pass by pass, cut at its target.  Where a document starts
   in that stream is a prefix sum.  It is taken in two steps, over hash
   buckets of a source and within a bucket, so a source that holds a third of
   all rows is spread over all tasks.
3. *Positions.*  A source's weight over training time t in [0, 1] is linear,
   ``1 + slope * (2t - 1)``.  Its integral is the share of its words due by t;
   inverting that at a document's place in the stream gives its position.
   Sorting by range of position writes the training order.

Defined results: a null text has size 0 and takes nothing; a null source is a
source of its own; rows that repeat are each placed; ties in the hash order
break by id and size; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelake.llm.scratch import column_of, positional, words_of, written

WEIGHTS = (3, 1, 2)
SLOPES = (0.5, 0.0, -0.5)
SHARE = 1.5
CAP = 2
BUCKETS = 1024


def source_targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, share=SHARE, cap=CAP) -> DataFrame:
    """(source, source_size, target, slope) from (source, size); one row per
    source, so the windows below see sources, not documents."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1

    def in_turn(values) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (nth % len(values) + 1).cast("int"))

    s = per.select("source", "source_size", in_turn(weights).alias("w"), in_turn(slopes).alias("slope"))
    s = s.withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    by_room = W.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    everything = W.partitionBy(F.lit(0))
    full = F.coalesce(F.sum("most").over(by_room.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    open_w = F.sum("w").over(by_room.rowsBetween(0, W.unboundedFollowing))
    wanted = F.lit(float(share)) * F.sum("source_size").over(everything)
    s = s.withColumn("level", (wanted - full) / open_w)
    return s.select("source", "source_size", "slope",
                    F.least("most", F.col("w") * F.max("level").over(everything)).alias("target"))


def position(share_done: Column, slope: Column) -> Column:
    """t with ``t + slope * (t*t - t) = share_done``, the inverse of the
    integrated schedule."""
    u, a = share_done, slope
    root = F.sqrt(F.pow(1 - a, F.lit(2.0)) + 4 * a * u)
    return F.when(a == 0, u).otherwise((root - (1 - a)) / (2 * a))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        carry: list[str] | None = None, weights=WEIGHTS, slopes=SLOPES, share=SHARE, cap=CAP) -> DataFrame:
    """One row per document: ``carry`` (by position), size, source_size, target
    and ``takes``, an array of (pass, taken, position) that holds its part in
    each pass that takes any word of it."""
    pos, names = positional(docs)
    keep = [column_of(names, c) for c in carry] if carry is not None else []
    key, src = F.col(column_of(names, doc_id)), F.col(column_of(names, source))
    h = F.xxhash64(key.cast("string"), src.cast("string"))
    # a row number, fixed once written, brings the carried columns back at the
    # end: what moves in between are a few numbers per document, not its text
    whole = written(pos.select(
        *keep, F.monotonically_increasing_id().alias("_row"), key.alias("_id"), src.cast("string").alias("source"), h.alias("_h"),
        F.pmod(h, F.lit(BUCKETS)).alias("_b"),
        F.size(words_of(F.col(column_of(names, text)))).cast("long").alias("size")), "mix")
    rows = whole.drop(*keep)

    targets = source_targets(rows, weights, slopes, share, cap)
    per_bucket = rows.groupBy("source", "_b").agg(F.sum("size").alias("_n"))
    before = W.partitionBy("source").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_bucket.select(F.col("source").alias("_os"), F.col("_b").alias("_ob"),
                                F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = W.partitionBy("source", "_b").orderBy("_h", "_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("_in_bucket", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(offsets, F.col("source").eqNullSafe(F.col("_os")) & (F.col("_b") == F.col("_ob")))
    t = targets.select(F.col("source").alias("_ts"), "source_size", "target", "slope")
    placed = placed.join(t, F.col("source").eqNullSafe(F.col("_ts")))

    start = F.col("_off") + F.col("_in_bucket")
    words = F.floor("target")
    takes = []
    for n in range(math.ceil(cap)):
        at = start + n * F.col("source_size")
        taken = F.least(F.col("size"), F.greatest(F.lit(0), words - at)).cast("long")
        share_done = F.least(F.lit(1.0), at / F.greatest(F.col("target"), F.lit(1.0)))
        takes.append(F.struct(F.lit(n).alias("pass"), taken.alias("taken"),
                              position(share_done, F.col("slope")).alias("position")))
    placed = placed.select("_row", "_id", "source", "size", "source_size", "target",
                           F.filter(F.array(*takes), lambda x: x["taken"] > 0).alias("takes"))
    return placed.join(whole.select("_row", *keep), "_row") if keep else placed


def in_training_order(placed: DataFrame) -> DataFrame:
    """One row per part taken, range-sorted by position."""
    parts = placed.withColumn("take", F.explode("takes")).drop("takes")
    parts = parts.withColumns({"taken": F.col("take.taken"), "position": F.col("take.position"),
                               "pass": F.col("take.pass")}).drop("take")
    return parts.repartitionByRange("position", "_id").sortWithinPartitions("position", "_id")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Pipeline form: the documents of the mix in training order, a row for
    every time one is taken.  No text is cut: the one document per source and
    pass that the target cuts short comes whole or not at all, whichever leaves
    the source nearer to its target (in a tie, whole)."""
    pos, names = positional(docs)
    placed = in_training_order(mix(docs, carry=names).withColumn(
        "takes", F.expr("filter(takes, t -> 2 * t.taken >= size)")))
    return placed.select(*pos.columns).toDF(*names)
