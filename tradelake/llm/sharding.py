"""Shard documents by jump consistent hashing.

A key's shard depends on the key and the number of shards alone; there is no
ring table.  With one more shard a key either stays or moves into the new one.

Numbering rows within a shard needs no window over a whole shard: each task
counts its own rows per shard as they pass, the result is written once, and a
prefix sum over (task, shard) counts gives each task's first slot.  A hot key,
source or group of copies makes no task larger than its input.

Defined results: a null key is a key like any other; repeated keys share a
shard and get slots of their own; a null text has no bytes (size 1, CRC 0); an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelake.llm.scratch import column_of, positional, written

SHARDS = 8


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Lamping and Veach's jump consistent hash of 64-bit keys."""
    key = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(key), dtype=np.int64)
    jump = np.zeros(len(key), dtype=np.int64)
    live = np.arange(len(key))
    while len(live):
        shard[live] = jump[live]
        k = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        key[live] = k
        to = (shard[live] + 1) * (2.0**31 / ((k >> np.uint64(33)).astype(np.float64) + 1.0))
        jump[live] = to.astype(np.int64)
        live = live[to < shards]
    return shard


def _placer(shards: int):
    @F.pandas_udf("struct<shard int, grown_shard int, nth long>")
    def place(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(shards, dtype=np.int64)  # rows of each shard in this task so far
        for keys in parts:
            k = keys.to_numpy(dtype=np.int64).view(np.uint64)
            now = jump_hash(k, shards)
            nth = pd.Series(now).groupby(now).cumcount().to_numpy() + seen[now]
            seen += np.bincount(now, minlength=shards)
            yield pd.DataFrame({"shard": now.astype(np.int32), "nth": nth,
                                "grown_shard": jump_hash(k, shards + 1).astype(np.int32)},
                               columns=["shard", "grown_shard", "nth"])
    return place.asNondeterministic()


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS,
          carry: list[str] | None = None) -> DataFrame:
    """``carry`` (by position, all columns by default) plus size, text_crc32,
    shard, grown_shard and slot, gapless from 0 in each shard."""
    pos, names = positional(docs)
    keep = [column_of(names, c) for c in carry] if carry is not None else pos.columns
    t = F.coalesce(F.col(column_of(names, text)), F.lit("")).cast("binary")
    h = F.xxhash64(F.col(column_of(names, key)))
    placed = pos.select(*keep, (F.octet_length(t) + 1).cast("long").alias("size"),
                        F.crc32(t).alias("text_crc32"), _placer(shards)(h).alias("_p"),
                        F.spark_partition_id().alias("_task"))
    rows = written(placed, "shard")  # a task's numbers must not change afterwards
    counts = rows.groupBy("_task", F.col("_p.shard").alias("_shard")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("_shard").orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    first = counts.select(F.col("_task").alias("_t"), "_shard",
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    joined = rows.join(first, (F.col("_task") == F.col("_t")) & (F.col("_p.shard") == F.col("_shard")))
    return joined.select(*keep, "size", "text_crc32", F.col("_p.shard").alias("shard"),
                         F.col("_p.grown_shard").alias("grown_shard"),
                         (F.col("_first") + F.col("_p.nth")).alias("slot"))


def sharded_documents(docs: DataFrame) -> DataFrame:
    """Pipeline form: the documents with shard and slot behind their columns;
    where a name is taken (in any case), underscores go before it."""
    out = shard(docs)
    taken, extra = {n.lower() for n in docs.columns}, []
    for n in ("shard", "slot"):
        while n in taken:
            n = f"_{n}"
        taken.add(n)
        extra.append(n)
    return out.select(*[f"_in{i}" for i in range(len(docs.columns))], "shard", "slot").toDF(
        *docs.columns, *extra)
