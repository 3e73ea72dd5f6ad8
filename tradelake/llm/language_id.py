"""Predict languages with bit-sliced Bloom filters of letter trigrams.

One table of ``ROWS`` bit masks holds the filters of all languages side by
side: bit i of a mask belongs to language i.  A trigram picks ``HASHES`` rows;
their conjunction is the set of all languages that (may) contain it.  A text
counts, per language, the trigrams whose mask has its bit, takes off what the
filter's fill lets through by chance, and the largest count decides.

The filters are learned from the labelled training texts: of each language at
most about ``MOST_TEXTS`` different ones, chosen by the hash of the text (a
documented bound on a language's sample, kept by a rate, not by a cut; a language
with fewer has all of them in it).  A text that is there more than once counts
once.  A trigram belongs to a language if at least ``LEAST_SHARE`` of its sampled
texts contain it.  The table has a fixed size, so it is broadcast whatever the
corpus.  Every whole text is scored.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
ties go to the smaller language name; without any training text all are
``und``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.scratch import drop, pick, written
from tradelake.llm.text import CHUNK, U, mix64

ROWS = 1 << 17
HASHES = 3
SLICE = 63             # languages in one mask
MOST_TEXTS = 20_000
LEAST_SHARE = 0.01
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of all trigrams around a letter; whatever isn't a
    letter counts as a gap."""
    low = [t.lower() for t in texts]
    sizes = np.array([len(t) + 2 for t in low], dtype=np.int64)
    codes = np.frombuffer("".join(f" {t} " for t in low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[codes]
    c = np.where(letter, codes, 0).astype(U)
    at = np.flatnonzero(letter[1:-1]) + 1 if len(c) > 2 else np.zeros(0, dtype=np.int64)
    doc = np.searchsorted(np.cumsum(sizes), at, side="right")
    return mix64(c[at - 1] | (c[at] << U(21)) | (c[at + 1] << U(42))), doc


def _positions(h: np.ndarray) -> Iterator[np.ndarray]:
    for j in range(HASHES):
        yield ((h >> U(20 * j)) % U(ROWS)).astype(np.int64)


def _pieces(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of pieces of about CHUNK characters."""
    held, weight, first = [], 0, 0
    for i, t in enumerate(column.to_pylist()):
        held.append(t or "")
        weight += len(held[-1])
        if weight >= CHUNK // 2:
            yield first, held
            held, weight, first = [], 0, i + 1
    if held:
        yield first, held


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Model:
    """Language names, the table (ROWS x slices) and each language's fill."""

    def __init__(self, languages: list[str], table: np.ndarray) -> None:
        self.languages, self.table = languages, table
        bits = [(table[:, i // SLICE] >> U(i % SLICE)) & U(1) for i in range(len(languages))]
        self.by_chance = np.array([b.mean() ** HASHES for b in bits])

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected trigram counts (texts x languages) and trigrams."""
        h, doc = trigrams(texts)
        total = np.bincount(doc, minlength=len(texts))
        out = np.zeros((len(texts), len(self.languages)))
        rows = list(_positions(h))
        for s in range(self.table.shape[1]):
            mask = self.table[rows[0], s]
            for r in rows[1:]:
                mask = mask & self.table[r, s]
            for i in range(s * SLICE, min((s + 1) * SLICE, len(self.languages))):
                has = ((mask >> U(i % SLICE)) & U(1)).astype(bool)
                out[:, i] = np.bincount(doc[has], minlength=len(texts))
        chance = self.by_chance[None, :]
        return (out - total[:, None] * chance) / np.maximum(1 - chance, 1e-9), total


def fit(rows: DataFrame) -> Model:
    """From (doc_id, text, lang): the training texts' trigrams per language."""
    train = rows.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    train = train.select("text", "lang", F.xxhash64("text").alias("hash"))
    different = {r["lang"]: r["n"] for r in train.select("lang", "hash").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    # below a share of all 2**64 hashes, alike for copies; a rare language has all of its texts
    highest = [F.lit(x) for name, n in different.items()
               for x in (name, -2**63 + min(2**64, MOST_TEXTS * 2**64 // n) - 1)]
    if different:
        train = train.filter(F.col("hash") <= F.create_map(*highest)[F.col("lang")])
    train = written(train.dropDuplicates(["lang", "hash"]), "language-sample")   # at most about MOST_TEXTS a language

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _pieces(batch.column(0)):
                h, doc = trigrams(texts)
                lang = batch.column(1).slice(first, len(texts)).dictionary_encode()
                of = np.asarray(lang.indices)
                order = np.lexsort((h, doc))        # each trigram once a text
                pair = np.stack([doc[order].astype(U), h[order]])
                new = np.concatenate([[True], (pair[:, 1:] != pair[:, :-1]).any(axis=0)]) if len(h) else np.zeros(0, dtype=bool)
                g, l = h[order][new], of[doc[order][new]]
                for k, name in enumerate(lang.dictionary.to_pylist()):
                    gram, times = np.unique(g[l == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * len(gram), pa.string()), pa.array(gram.view(np.int64)),
                        pa.array(times, pa.int64())], names=["lang", "gram", "n"])

    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes, key=lambda x: x.encode())
    table = np.zeros((ROWS, max(1, -(-len(languages) // SLICE))), dtype=U)
    if languages:
        number = F.create_map(*[F.lit(x) for i, name in enumerate(languages) for x in (name, i)])
        least = F.create_map(*[F.lit(x) for name in languages for x in (name, LEAST_SHARE * sizes[name])])
        counts = train.select("text", "lang").mapInArrow(grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(
            F.sum("n").alias("n"))
        inside = counts.filter(F.col("n") >= least[F.col("lang")]).select("gram", number[F.col("lang")].alias("i"))
        places = F.array(*[F.shiftrightunsigned("gram", 20 * j) % ROWS if j else
                           (F.col("gram").bitwiseAND(F.lit(ROWS - 1))) for j in range(HASHES)])
        masks = inside.select(F.explode(places).alias("row"), (F.col("i") / SLICE).cast("int").alias("slice"),
                              F.expr(f"shiftleft(1L, i % {SLICE})").alias("bit")).groupBy("row", "slice").agg(
            F.bit_or("bit").alias("mask")).toArrow()   # at most ROWS rows a slice
        table[np.asarray(masks["row"]).astype(np.int64), np.asarray(masks["slice"])] = np.asarray(masks["mask"]).view(U)
    drop(train)
    return Model(languages, table)


def predict(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row of (doc_id, text)."""
    sent = rows.sparkSession.sparkContext.broadcast((model.languages, model.table))   # fixed size

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = Model(*sent.value)
        for batch in batches:
            for first, texts in _pieces(batch.column(1)):
                points, total = local.scores(texts)
                if local.languages:
                    best = points.argmax(axis=1)
                    share = np.clip(points[np.arange(len(texts)), best] / np.maximum(total, 1), 0, 1)
                    names = [local.languages[b] if n else UNKNOWN for b, n in zip(best, total)]
                else:
                    share, names = np.zeros(len(texts)), [UNKNOWN] * len(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(names, pa.string()),
                                                  pa.array(np.where(total > 0, share, 0.0))],
                                                 names=["doc_id", "lang_pred", "score"])

    return rows.select("doc_id", "text").mapInArrow(judge, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs``."""
    rows = pick(docs, doc_id=doc_id, text=text, lang=lang).select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    return predict(rows, fit(rows)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
