"""Collocations per language from FM-indexes over word ids.

1. *Shards.*  A task cuts its texts into shards of about ``SHARD`` bytes of one
   language.  A shard is its words as numbers, with separators between pieces;
   longer texts are cut between pieces, which no phrase crosses.
2. *Word ids.*  The shards' vocabularies are counted together.  Words with
   ``least`` occurrences or more get an id of their own (per language), all
   others one code that no phrase may hold: a phrase occurs no more often than
   its words.
3. *Index.*  A shard's Burrows-Wheeler transforms, of the sequence and of its
   reverse, over rotations sorted by as many words as the longest phrase has.
4. *Enumeration.*  Breadth first, all intervals of one length at once: the
   rows of an interval, grouped by their character in the transform of the
   reverse, are its extensions to the right, with their counts; the interval in
   the other transform is narrowed along.  The two transforms also tell how
   often a word comes before and behind.  Counts are summed across shards.
   A phrase one word longer is only sent if its first and last words without one
   may be frequent, which a bitmap of ``2**BITS`` bits tells, whatever the
   corpus; a full bitmap lets more through to the sum, which is exact.
5. *Scores* in exact decimals, the lowest cut of each phrase, phrases inside
   longer ones dropped, and the best of each language.

Defined results: a null text is empty; a null language is ``und`` (and joins
such a label); ties go to the smaller phrase; repeated rows count each time; an empty table
gives an empty result.  Counts below 10**16 are exact.  Clashing column names
do no harm, only ``lang`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradelake.llm.bits import bitmap, may_hold
from tradelake.llm.scratch import drop, pick, written
from tradelake.llm.text import Words, byte_class, lower_ascii, run_starts, text_bytes

SHARD = 4 << 20
LONGEST, LEAST, TOP, INSIDE = 3, 10, 2000, 50
BITS = 23
PARTS = 32
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_BREAK = ~byte_class(_BREAKS)
_WORD = byte_class(_BREAKS + b" \t")
#: Codes of a shard's sequence: a separator, a word too rare for any phrase; frequent words follow.
SEPARATOR, RARE, FIRST = 0, 1, 2


def _pieces(data: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """A text in parts of about ``most`` bytes, cut behind breaks only."""
    while len(data) > most:
        ends = np.flatnonzero(_BREAK[data[:most]])
        if not len(ends):      # one piece longer than that: whole
            behind = np.flatnonzero(_BREAK[data[most:]])
            ends = behind[:1] + most
            if not len(ends):
                break
        yield data[:int(ends[-1]) + 1]
        data = data[int(ends[-1]) + 1:]
    yield data


def _same_bytes(buf: np.ndarray, words: Words, of: np.ndarray) -> bool:
    """Whether every word has the bytes of word ``of`` that stands for it."""
    size = words.end - words.start
    if (size != size[of]).any():
        return False
    for lo in range(0, len(size), 1 << 18):
        s = slice(lo, lo + (1 << 18))
        n = size[s]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if (buf[np.repeat(words.start[s], n) + step] != buf[np.repeat(words.start[of[s]], n) + step]).any():
            return False
    return True


def _numbered(buf: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(a word that stands for each different word, number of each word)."""
    _, first, number = np.unique(words.hash, return_index=True, return_inverse=True)
    if len(words) and not _same_bytes(buf, words, first[number]):   # two words of one hash
        data, seen = buf.tobytes(), {}
        number = np.array([seen.setdefault(data[s:e], len(seen)) for s, e in zip(words.start.tolist(), words.end.tolist())])
        first = np.unique(number, return_index=True)[1]
    return first, number


def _sequence(parts: list[np.ndarray]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(different words, their counts, numbers of the words from 1 with a
    SEPARATOR between pieces and at both ends)."""
    buf = lower_ascii(np.concatenate(parts))
    words = Words(buf, np.cumsum([len(p) for p in parts]), _WORD)
    first, number = _numbered(buf, words)
    breaks = np.concatenate([[0], np.cumsum(_BREAK[buf])])
    new = (words.doc[1:] != words.doc[:-1]) | (breaks[words.start[1:]] > breaks[words.end[:-1]])
    at = np.arange(len(words)) + np.concatenate([[1], 1 + np.cumsum(new)])[:len(words)]
    seq = np.zeros(len(words) + int(new.sum()) + 2, dtype=np.int32)
    seq[at] = number + 1
    data = buf.tobytes()
    said = [data[s:e].decode() for s, e in zip(words.start[first].tolist(), words.end[first].tolist())]
    return said, np.bincount(number, minlength=len(first)), seq


def shards(texts: DataFrame) -> DataFrame:
    """(shard, lang, words, counts, seq) of (lang, text) rows."""
    most = SHARD

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size, nth = 0, TaskContext.get().partitionId() << 32

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size, nth
            for lang, parts in held.items():
                words, counts, seq = _sequence(parts)
                if words:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([nth], pa.int64()), pa.array([lang], pa.string()), pa.array([words], pa.list_(pa.string())),
                        pa.array([counts], pa.list_(pa.int64())), pa.array([seq.tobytes()], pa.binary())],
                        names=["shard", "lang", "words", "counts", "seq"])
                    nth += 1
            held.clear()
            size = 0

        for batch in batches:
            buf, ends = text_bytes(batch.column(1))
            for lang, start, end in zip(batch.column(0).to_pylist(), [0, *ends.tolist()], ends.tolist()):
                for part in _pieces(buf[start:end], most):
                    if len(part):
                        held.setdefault(lang, []).append(part.copy())
                        size += len(part)
                        if size >= most:
                            yield from flush()
        yield from flush()

    return texts.mapInArrow(cut, "shard long, lang string, words array<string>, counts array<long>, seq binary")


def _order(seq: np.ndarray, letters: int, depth: int) -> np.ndarray:
    """Rotations of ``seq`` in order of their first ``depth`` letters."""
    key, top = seq.astype(np.int64), letters
    for d in range(1, depth):
        if top * letters > 2**62:
            key = np.unique(key, return_inverse=True)[1]
            top = int(key.max()) + 1
        key = key * letters + np.roll(seq, -d)
        top *= letters
    return np.argsort(key, kind="stable")


def transform(seq: np.ndarray, letters: int, depth: int) -> np.ndarray:
    """The Burrows-Wheeler transform of order ``depth``."""
    return seq[_order(seq, letters, depth) - 1]


class Index:
    """A sequence by its transform and that of its reverse."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray, letters: int) -> None:
        self.letters = letters
        self.before, self.behind = forward, backward      # the letter before, behind each row
        self.begins = np.concatenate([[0], np.cumsum(np.bincount(forward, minlength=letters))])
        self.step = np.empty(len(backward), dtype=np.int64)   # row of the rotation one letter longer
        self.step[np.argsort(backward, kind="stable")] = np.arange(len(backward))
        self.is_word = [np.concatenate([[0], np.cumsum(x != SEPARATOR)]) for x in (forward, backward)]

    def singles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(letters of the phrase, first row forward, first row backward,
        rows) of all frequent words."""
        code = np.arange(FIRST, self.letters)
        return code[:, None], self.begins[code], self.begins[code], self.begins[code + 1] - self.begins[code]

    def longer(self, phrase, fore, back, rows):
        """All phrases one word longer to the right, in the same form."""
        owner = np.repeat(np.arange(len(rows)), rows)
        start = np.cumsum(rows) - rows
        at = np.arange(len(owner)) - start[owner] + back[owner]
        key = owner * self.letters + self.behind[at]
        order = np.argsort(key, kind="stable")
        first = run_starts(key[order])
        size = np.diff(np.append(first, len(order)))
        owner, letter, row = owner[order[first]], self.behind[at[order[first]]], at[order[first]]
        fore = fore[owner] + first - start[owner]
        keep = letter >= FIRST
        return (np.concatenate([phrase[owner], letter[:, None]], axis=1)[keep], fore[keep], self.step[row][keep], size[keep])

    def around(self, fore, back, rows) -> list[np.ndarray]:
        """How many of each phrase's occurrences a word precedes, follows."""
        return [c[a + rows] - c[a] for c, a in zip(self.is_word, (fore, back))]


def indexes(cut: DataFrame, dictionary: DataFrame, longest: int) -> DataFrame:
    """(ids, forward, backward) of each shard: the ids of its letters from
    FIRST on and its two transforms."""
    said = cut.select("shard", "lang", F.posexplode("words").alias("number", "word"))
    known = said.join(dictionary.select("lang", "word", "id"), ["lang", "word"]).groupBy("shard").agg(
        F.collect_list("number").alias("numbers"), F.collect_list("id").alias("ids"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                seq = np.frombuffer(batch.column(0)[n].as_py(), dtype=np.int32)
                numbers, ids = (np.asarray(batch.column(c)[n].values) for c in (1, 2))
                code = np.full(int(seq.max()) + 1, RARE, dtype=np.int32)
                code[0] = SEPARATOR
                code[numbers + 1] = np.arange(FIRST, FIRST + len(numbers))
                seq, letters = code[seq], FIRST + len(numbers)
                both = [transform(np.ascontiguousarray(s), letters, longest).tobytes() for s in (seq, seq[::-1])]
                yield pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), *[pa.array([b], pa.binary()) for b in both]],
                                                 names=["ids", "forward", "backward"])

    whole = cut.select("shard", "seq").join(known, "shard").select("seq", "numbers", "ids")
    return whole.mapInArrow(build, "ids array<long>, forward binary, backward binary")


def _names(n: int) -> list[str]:
    return [f"w{i}" for i in range(1, n + 1)]


def phrases(index: DataFrame, size: int, shorter: dict[int, Broadcast]) -> DataFrame:
    """(w1.. , a, before, behind): phrases of ``size`` words and how often they
    occur, with a word before, with a word behind; ``shorter`` holds the
    bitmaps of the frequent phrases of 2 to ``size`` - 1 words."""
    def enumerate_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                ids = np.concatenate([np.zeros(FIRST, dtype=np.int64), np.asarray(batch.column(0)[n].values)])
                one = Index(*(np.frombuffer(batch.column(c)[n].as_py(), dtype=np.int32) for c in (1, 2)), len(ids))
                found = one.singles()
                for d in range(2, size + 1):
                    found = one.longer(*found)
                    if d > 2:
                        keep = may_hold(shorter[d - 1].value, ids[found[0][:, 1:]])
                        found = tuple(x[keep] for x in found)
                    if d < size:
                        keep = may_hold(shorter[d].value, ids[found[0]])
                        found = tuple(x[keep] for x in found)
                phrase, *rows = found
                counts = [rows[2], *one.around(*rows)]
                for lo in range(0, len(phrase), 1 << 16):
                    s = slice(lo, lo + (1 << 16))
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(ids[phrase[s, c]]) for c in range(size)), *(pa.array(c[s], pa.int64()) for c in counts)],
                        names=[*_names(size), "a", "before", "behind"])

    schema = ", ".join(f"{c} long" for c in [*_names(size), "a", "before", "behind"])
    return index.mapInArrow(enumerate_all, schema).groupBy(*_names(size)).agg(
        *[F.sum(c).alias(c) for c in ("a", "before", "behind")])


def score_of(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 * a * a / (l * r)), exact."""
    a, l, r = (c.cast("decimal(16,0)") for c in (a, l, r))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * a * a, l * r)


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = LONGEST, least: int = LEAST,
                 top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, and before and behind: how many
    occurrences have a word before or behind them in their piece."""
    rows = pick(docs, lang=lang, text=text).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string"))
    cut = written(shards(rows), "shards")
    totals = written(cut.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n")), "totals")
    said = cut.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", F.col("w.words").alias("word"))
    dictionary = written(said.agg(F.sum("w.counts").alias("f")).filter(F.col("f") >= least).withColumn(
        "id", F.monotonically_increasing_id()), "dictionary")
    index = written(indexes(cut, dictionary, longest), "index")
    drop(cut)

    tables = {1: dictionary.select(F.col("id").alias("w1"), F.col("f").alias("a"))}
    maps: dict[int, Broadcast] = {}
    for n in range(2, longest + 1):
        tables[n] = written(phrases(index, n, maps).filter(F.col("a") >= least), f"phrases{n}")
        if n < longest:
            maps[n] = docs.sparkSession.sparkContext.broadcast(bitmap(tables[n], _names(n), BITS))
    drop(index)

    parts = []
    for n in range(2, longest + 1):
        cuts = tables[n]
        for k in range(1, n):
            first = tables[k].select(*_names(k), F.col("a").alias(f"l{k}"))
            rest = tables[n - k].select(*[F.col(f"w{i}").alias(f"w{i + k}") for i in range(1, n - k + 1)], F.col("a").alias(f"r{k}"))
            cuts = cuts.join(first, _names(k)).join(rest, [f"w{i}" for i in range(k + 1, n + 1)])
        lowest = F.array_min(F.array(*[F.struct(score_of(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"),
                                                F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
                                       for k in range(1, n)]))
        cuts = cuts.withColumn("low", lowest).select(*_names(n), "a", "before", "behind", "low.l", "low.r", "low.score")
        for m in range(n + 1, longest + 1):       # dropped where one longer phrase has most of it
            held = reduce(DataFrame.union, [tables[m].select(*[F.col(f"w{i + at}").alias(f"w{i}") for i in range(1, n + 1)],
                                                             F.col("a").alias("longer")) for at in range(m - n + 1)])
            held = held.groupBy(*_names(n)).agg(F.max("longer").alias("longer"))
            cuts = cuts.join(held, _names(n), "left").filter(
                F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside)).drop("longer")
        words = dictionary.select("id", "lang", "word")
        for i in range(1, n + 1):
            of = words if i == 1 else words.drop("lang")
            cuts = cuts.join(of.withColumnRenamed("word", f"t{i}"), F.col(f"w{i}") == F.col("id")).drop("id", f"w{i}")
        parts.append(cuts.select("lang", F.concat_ws(" ", *[f"t{i}" for i in range(1, n + 1)]).alias("phrase"),
                                 "a", "l", "r", "score", "before", "behind"))
    # the best of a language are among the best of its parts, so no task ranks more than PARTS * top
    ranked = reduce(DataFrame.union, parts).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    for by in (["lang", "part"], ["lang"]):
        best = W.partitionBy(*by).orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
        ranked = ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                              "score", "before", "behind")
