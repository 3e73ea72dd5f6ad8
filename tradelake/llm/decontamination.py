"""Find benchmark passages in documents by a prefix-filtered join.

Every run of ``k`` words of a benchmark item is a window (an item of fewer
words is one window).  A window's tokens are its 3-word shingles (shorter
windows: the whole window); a document that holds the window holds all of
them, so one token per window, the rarest among the documents, is enough to
join on: the necessary prefix.

1. Tasks look up the shingles of whole documents in a fixed-size bitmap of all
   benchmark tokens and count the ones that hit: the rarity order.
2. A bitmap of the chosen prefix tokens gives the places in documents that are
   joined with the windows on the token.  Such a place carries up to 2k words
   around it, never the text.
   The same pass counts each row's words and numbers the rows, once for all.
3. Length and position decide first whether the window fits there, then the
   words are compared one by one.

Bitmaps have 2**BITS bits whatever the size of the benchmark; a fuller bitmap
lets more places through to the join, which is a shuffle join and exact.

Defined results: a null text has no words; an item without words has no
window; equal windows of different items count for each item; every row is
judged by its own text, also rows that share a doc_id or have none; all items
without an item_id count as one item, which comes first (a null) in ``items``;
an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelake.llm.scratch import column_of, pick, positional, written
from tradelake.llm.text import ALPHANUMERIC, U, Words, chunks, lower_ascii, mix64, text_bytes, window_hashes

WINDOW = 10
TOKEN = 3
BITS = 20


def _tokens(words: Words, docs: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each run of ``size`` words within a text."""
    h = window_hashes(words.hash, size)
    if not len(h):
        return h, np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(words.doc[:len(h)] == words.doc[size - 1:])
    return mix64(h[at] ^ U(size)), at


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bytes, Words, np.ndarray, int]]:
    """(rows, bytes, words, words of each text, texts) of chunks; the texts are
    the second column."""
    for batch in batches:
        buf, ends = text_bytes(batch.column(1))
        for lo, hi, part, e in chunks(buf, ends):
            low = lower_ascii(part)
            words = Words(low, e, ALPHANUMERIC)
            counts = words.counts(hi - lo)
            yield batch.slice(lo, hi - lo), low.tobytes(), words, counts, hi - lo


def _runs(low: bytes, words: Words, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """Words first..last (both included) of each place, joined by one space."""
    s, e = words.start.tolist(), words.end.tolist()
    return pa.array([b" ".join([low[s[w]:e[w]] for w in range(a, b + 1)]) for a, b in zip(first.tolist(), last.tolist())],
                    pa.binary())


def windows_of(benchmark: DataFrame, k: int = WINDOW) -> DataFrame:
    """(item_id, size, words, tokens): windows of (item_id, text) with the hash
    and place of each token."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, low, words, counts, n in _texts(batches):
            start = np.concatenate([[0], np.cumsum(counts)[:-1]]) if n else counts
            first = np.concatenate([np.arange(s, s + max(1, c - k + 1)) for s, c in zip(start, counts) if c]
                                   or [np.zeros(0, dtype=np.int64)])
            owner = words.doc[first]
            size = np.minimum(k, counts[owner])
            tokens: list[list[int]] = [[] for _ in first]
            for t in range(1, TOKEN + 1):
                h, at = _tokens(words, n, t)
                of = np.full(len(words), -1)
                of[at] = np.arange(len(at))
                for i in np.flatnonzero(np.minimum(size, TOKEN) == t):
                    tokens[i] = h[of[first[i]:first[i] + size[i] - t + 1]].view(np.int64).tolist()
            yield pa.RecordBatch.from_arrays([
                rows.column(0).take(pa.array(owner)), pa.array(size, pa.int32()), _runs(low, words, first, first + size - 1),
                pa.array(tokens, pa.list_(pa.int64()))], names=["item_id", "size", "words", "tokens"])

    return benchmark.mapInArrow(cut, "item_id string, size int, words binary, tokens array<long>")


def _lookup(spark: SparkSession, tokens: DataFrame) -> Broadcast:
    """The bitmap of a column ``token``: at most 2**BITS different bits come to
    the driver, and 2**BITS / 8 bytes go out, whatever the benchmark."""
    bits = np.zeros(1 << BITS, dtype=bool)
    found = tokens.select(F.shiftrightunsigned("token", 64 - BITS).alias("bit")).distinct().toArrow()
    bits[np.asarray(found["bit"]).astype(np.int64)] = True
    return spark.sparkContext.broadcast(np.packbits(bits).tobytes())


def _hits(words: Words, n: int, packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of 1 to TOKEN words whose bit is set: hash, first word, words."""
    bits = np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).view(bool)
    out = [(h[ok], at[ok], np.full(int(ok.sum()), t)) for t in range(1, TOKEN + 1)
           for h, at in [_tokens(words, n, t)] for ok in [bits[(h >> U(64 - BITS)).astype(np.int64)]]]
    return tuple(np.concatenate(x) for x in zip(*out))


def _frequencies(docs: DataFrame, tokens: DataFrame) -> DataFrame:
    """(token, df): how often benchmark tokens occur in documents (tokens that
    share a bit with one may come along, and are dropped by the later join)."""
    packed = _lookup(docs.sparkSession, tokens)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, words, _, n in _texts(batches):
            token, times = np.unique(_hits(words, n, packed.value)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(times, pa.int64())],
                                             names=["token", "df"])

    return docs.mapInArrow(count, "token long, df long").groupBy("token").agg(F.sum("df").alias("df"))


def _places(docs: DataFrame, tokens: DataFrame, k: int) -> DataFrame:
    """Rows (row, text, doc_id, mark) with their n_words, and where prefix
    tokens occur in them: (row, token, at, left, n_around, around)."""
    packed = _lookup(docs.sparkSession, tokens)
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("mark", pa.string()), ("n_words", pa.int64()),
                        ("token", pa.int64()), ("at", pa.int64()), ("left", pa.int32()), ("n_around", pa.int32()), ("around", pa.binary())])

    def of(columns: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, low, words, counts, n in _texts(batches):
            yield of({"row": rows.column(0), "doc_id": rows.column(2), "mark": rows.column(3), "n_words": pa.array(counts, pa.int64())}, n)
            token, at, _ = _hits(words, n, packed.value)
            owner = words.doc[at]
            start = (np.concatenate([[0], np.cumsum(counts)[:-1]]) if n else counts)[owner]
            first, last = np.maximum(start, at - k + 1), np.minimum(start + counts[owner] - 1, at + k - 1)
            for lo in range(0, len(at), 20_000):
                s = slice(lo, lo + 20_000)
                yield of({"row": rows.column(0).take(pa.array(owner[s])), "token": pa.array(token[s].view(np.int64)),
                          "at": pa.array((at - start)[s], pa.int64()), "left": pa.array((at - first)[s], pa.int32()),
                          "n_around": pa.array((last - first + 1)[s], pa.int32()),
                          "around": _runs(low, words, first[s], last[s])}, len(at[s]))

    return docs.mapInArrow(find, "row long, doc_id long, mark string, n_words long, token long, at long, left int, n_around int, around binary")


def occurrences(docs: DataFrame, benchmark: DataFrame, k: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Of (row, text, doc_id, mark): the rows (row, doc_id, mark, n_words), and
    (row, start, size, items, unnamed), each place where a window occurs, with
    the item_ids (as strings) that have it and whether an item without id has it."""
    cut = written(windows_of(benchmark, k), "windows")
    windows = written(cut.groupBy("words").agg(
        F.first("size").alias("size"), F.first("tokens").alias("tokens"),
        F.collect_set("item_id").alias("items"), F.bool_or(F.col("item_id").isNull()).alias("unnamed")), "items")
    tokens = windows.select("words", F.posexplode("tokens").alias("place", "token"))
    rarity = _frequencies(docs, tokens.select("token").distinct())
    ranked = tokens.join(rarity, "token").groupBy("words").agg(
        F.min(F.struct("df", "token", "place")).alias("rarest"), F.count(F.lit(1)).alias("known"))
    # a window with a token that no document has occurs nowhere
    prefix = written(ranked.join(windows, "words").filter(F.col("known") == F.size("tokens")).select(
        F.col("rarest.token").alias("token"), F.col("rarest.place").alias("place"), "size", "words", "items", "unnamed"), "prefix")
    found = written(_places(docs, prefix.select("token"), k), "places")
    places = found.filter("token IS NOT NULL").select("row", "token", "at", "left", "n_around", "around")
    met = places.join(prefix, "token").filter((F.col("left") >= F.col("place")) & (
        F.col("left") - F.col("place") + F.col("size") <= F.col("n_around")))
    there = F.slice(F.split(F.col("around").cast("string"), " "), F.col("left") - F.col("place") + 1, F.col("size"))
    same = met.filter(F.array_join(there, " ") == F.col("words").cast("string"))
    return (found.filter("token IS NULL").select("row", "doc_id", "mark", "n_words"),
            same.select("row", (F.col("at") - F.col("place")).alias("start"), "size", "items", "unnamed"))


def _judged(docs: DataFrame, benchmark: DataFrame, k: int) -> DataFrame:
    """Rows (doc_id, text, mark) with what occurs in each."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "text", "doc_id", "mark")
    rows, same = occurrences(numbered, benchmark, k)
    found = written(same, "occurrences")
    items = found.select("row", F.explode("items").alias("item")).distinct().groupBy("row").agg(
        F.sort_array(F.collect_list("item")).alias("items"))
    spans = found.groupBy("row", "start").agg(F.max("size").alias("size"), F.max("unnamed").alias("unnamed"))
    before = W.partitionBy("row").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    seen = F.coalesce(F.max(end).over(before), F.lit(0))
    spans = spans.withColumn("new", F.greatest(F.lit(0), end - F.greatest(F.col("start"), seen)))
    hit = spans.groupBy("row").agg(F.sum("new").alias("n_hit"), F.max("unnamed").alias("unnamed"))
    # the places alone say what is hit; a document may hold none but unnamed items
    nothing = F.array().cast("array<string>")
    null = F.when(F.col("unnamed"), F.array(F.lit(None).cast("string"))).otherwise(nothing)
    told = hit.join(items, "row", "left").select("row", "n_hit", F.concat(null, F.coalesce("items", nothing)).alias("items"))
    out = rows.join(told, "row", "left")
    return out.select("doc_id", "mark", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", nothing).alias("items"),
                      F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def _items(benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    return pick(benchmark, item_id=item_id, text=item_text).select(F.col("item_id").cast("string"), F.col("text").cast("string"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", k: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted item_ids as strings, null first),
    n_items and contaminated, for each row of ``docs``."""
    rows = pick(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.lit(None).cast("string").alias("mark"))
    return _judged(rows, _items(benchmark, item_id, item_text), k).drop("mark")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline form: rows whose text has no hit, columns as they came.  A text
    is told by its SHA-256, so no row is judged by another one's id."""
    pos, names = positional(docs)
    text = F.col(column_of(names, "text")).cast("string")
    mark = F.sha2(text.cast("binary"), 256)
    rows = pos.select(F.lit(None).cast("long").alias("doc_id"), text.alias("text"), mark.alias("mark"))
    dirty = _judged(rows, _items(benchmark), WINDOW).filter("contaminated").select(F.col("mark").alias("_dirty")).distinct()
    return pos.join(written(dirty, "dirty"), mark == F.col("_dirty"), "left_anti").toDF(*names)
