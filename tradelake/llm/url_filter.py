"""Judge urls by rules and by a Bloom filter cascade of listed keys.

The cascade holds a set of listed keys exactly, relative to all keys of the
corpus.  Level 0 is a Bloom filter of the listed keys; level 1 one of the
unlisted keys of the corpus that pass level 0; level 2 one of the listed keys
that pass level 1, and so on until none passes wrongly.  The level at which a
key fails tells whether it is listed, without a join.

Keys are split into shards by hash, so each shard's cascade is built in one
task of bounded size.  Filters go out by broadcast in groups of at most
``BROADCAST`` bytes; where they are larger in total, further groups add further
passes over the rows within the same stage.

Defined results: a null url or one without ``://`` has an empty host and path
(a key like any other); a null html is no junk; repeated urls are judged alike;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.scratch import pick, written
from tradelake.llm.text import U, mix64

KEYS_PER_SHARD = 200_000
BROADCAST = 16 << 20
MOST_LEVELS = 64
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path start); the longest that fits decides.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

#: A page is junk if it has this many runs of three symbols.
JUNK = r"[#*$%&]{3}"
JUNK_RUNS = 20


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))  # null: no "at"


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule that fits (like ``net/``) and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):   # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _passes(level: int, m: int, k: int, bits: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    out = np.ones(len(h1), dtype=bool)
    for pos in _positions(level, m, k, h1, h2):
        out &= (bits[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1 == 1
    return out


def _positions(level: int, m: int, k: int, h1: np.ndarray, h2: np.ndarray):
    a = mix64(h1 + U(level * 0x9E3779B97F4A7C15 % 2**64))
    b = mix64(h2 + U(level * 0xD1342543DE82EF95 % 2**64)) | U(1)
    for j in range(k):
        yield ((a + U(j) * b) % U(m)).astype(np.int64)


def _build(keys: pd.DataFrame) -> pd.DataFrame:
    """One shard's cascade, a row per level, from (shard, h1, h2, listed)."""
    h1, h2 = (keys[c].to_numpy(dtype=np.int64).view(U) for c in ("h1", "h2"))
    listed = keys["listed"].to_numpy(dtype=bool)
    inside, outside = (h1[listed], h2[listed]), (h1[~listed], h2[~listed])
    rows, level = [], 0
    while len(inside[0]):
        if level == MOST_LEVELS:
            raise ValueError("two keys, one listed and one not, have the same 128 hash bits")
        wrong = 0.5 if level else min(0.5, math.sqrt(0.5) * len(inside[0]) / max(1, len(outside[0])))
        k = max(1, round(-math.log2(wrong)))
        m = max(8, math.ceil(len(inside[0]) * k / math.log(2)))
        bits = np.zeros((m + 7) // 8, dtype=np.uint8)
        for pos in _positions(level, m, k, *inside):
            np.bitwise_or.at(bits, pos >> 3, np.uint8(1) << (pos & 7).astype(np.uint8))
        rows.append((int(keys["shard"].iloc[0]), level, m, k, bits.tobytes()))
        pas = _passes(level, m, k, bits, *outside)
        inside, outside = (outside[0][pas], outside[1][pas]), inside
        level += 1
    return pd.DataFrame(rows, columns=["shard", "level", "m", "k", "bits"])


def hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit("second"))


def build_cascade(keys: DataFrame, name: str = "cascade") -> tuple[DataFrame, int]:
    """The cascade of (key, listed), one row per key of the corpus; and its
    number of shards."""
    h1, h2 = hashes(F.col("key"))
    keys = written(keys.select(h1.alias("h1"), h2.alias("h2"), "listed"), f"{name}-keys")
    shards = max(1, math.ceil(keys.count() / KEYS_PER_SHARD))
    rows = keys.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int")).groupBy("shard").applyInPandas(
        _build, "shard int, level int, m long, k int, bits binary")
    return written(rows, name), shards


def _probe(filters: Broadcast, lo: int, hi: int):
    @F.pandas_udf(T.BooleanType())
    def listed(shard: pd.Series, first: pd.Series, second: pd.Series) -> pd.Series:
        s = shard.to_numpy()
        h1, h2 = (x.to_numpy(dtype=np.int64).view(U) for x in (first, second))
        out = np.full(len(s), None, dtype=object)
        for n in np.unique(s[(s >= lo) & (s < hi)]):
            at = np.flatnonzero(s == n)
            verdict, open_ = np.zeros(len(at), dtype=bool), np.ones(len(at), dtype=bool)
            levels = filters.value.get(int(n), [])
            for level, m, k, bits in levels:
                ok = _passes(level, m, k, np.frombuffer(bits, dtype=np.uint8), h1[at], h2[at])
                verdict[open_ & ~ok] = level % 2 == 1
                open_ &= ok
            verdict[open_] = len(levels) % 2 == 1
            out[at] = verdict
        return pd.Series(out)
    return listed


def is_listed(df: DataFrame, key: str, cascade: DataFrame, shards: int, out: str) -> DataFrame:
    """``df`` with a boolean ``out``: is ``key`` listed?"""
    spark = df.sparkSession
    weights = {r["shard"]: r["bytes"] for r in
               cascade.groupBy("shard").agg(F.sum(F.octet_length("bits") + 64).alias("bytes")).collect()}
    groups, lo, weight = [], 0, 0
    for n in range(shards):
        if weight and weight + weights.get(n, 0) > BROADCAST:
            groups.append((lo, n))
            lo, weight = n, 0
        weight += weights.get(n, 0)
    groups.append((lo, shards))
    h1, h2 = hashes(F.col(key))
    df = df.withColumns({"_h1": h1, "_h2": h2}).withColumn("_shard", F.pmod("_h1", F.lit(shards)).cast("int"))
    answers = []
    for lo, hi in groups:   # each at most BROADCAST bytes, or one shard of KEYS_PER_SHARD keys
        held: dict[int, list] = {}
        for r in cascade.filter((F.col("shard") >= lo) & (F.col("shard") < hi)).orderBy("shard", "level").collect():
            held.setdefault(r["shard"], []).append((r["level"], r["m"], r["k"], bytes(r["bits"])))
        answers.append(_probe(spark.sparkContext.broadcast(held), lo, hi)("_shard", "_h1", "_h2"))
    return df.withColumn(out, F.coalesce(*answers)).drop("_h1", "_h2", "_shard")


def key_of(host: Column, path: Column) -> Column:
    """A page's key: its url without scheme, query and fragment."""
    return F.concat(F.coalesce(host, F.lit("")), F.coalesce(path, F.lit("")))


def junk_keys(pages: DataFrame) -> DataFrame:
    """(key, listed): every key of (url, html), listed if a page of it is junk."""
    junk = F.coalesce(F.regexp_count("html", F.lit(JUNK)) >= JUNK_RUNS, F.lit(False))
    key = key_of(host_of(F.col("url")), path_of(F.col("url")))
    return pages.select(key.alias("key"), junk.alias("junk")).groupBy("key").agg(F.max("junk").alias("listed"))


def judge_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
               listed: DataFrame | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, listed and verdict of every row.  ``listed``:
    (key, listed) of all keys; by default from the pages themselves."""
    rows = pick(pages, page_id=page_id, url=url, html=html)
    cascade, shards = build_cascade(listed if listed is not None else junk_keys(rows))
    urls = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    urls = is_listed(urls.withColumn("_key", key_of(F.col("host"), F.col("path"))), "_key", cascade, shards, "listed")
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return urls.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(says, method).alias("verdict"), "listed")
