"""Near-duplicate documents by HyperMinHash and exact confirmation.

1. *Signatures.*  A document's set is its distinct 5-word shingles.  Each
   shingle falls into one of ``REGISTERS`` buckets by hash; of the smallest
   value in a bucket the register keeps the leading zero count (6 bits) and 10
   bits behind the leading one.  Empty registers borrow from others in an
   order fixed by hash, so short texts are compared alike.
2. *Equal sets* are one node from here on, whatever the number of copies.
3. *Bands* of ``ROWS`` registers are joined.  A pair with a similarity of 0.8
   misses all bands with a probability of about 1e-7, one of 0.85 below 1e-10.
   The smallest document of a band key is its centre; each document is held
   against centres, not against all documents of the key.
4. *Estimate.*  The share of equal registers, corrected for the collisions
   that compressed registers of sets of these two sizes have by chance, drops
   pairs far below the threshold (8 standard deviations).
5. *Confirmation* on the full sets.  In a first round every document meets one
   centre, the one that it shares most bands with; the confirmed links are
   contracted to components.  In a second round it meets its other centres that
   are in another component by then: within a family of near copies there are none.
6. *The rest.*  Where a band key still has documents of different components,
   those are compared with each other in blocks of ``BLOCK`` documents: by
   registers, then exactly, on the full sets.  Only confirmed links between
   different components leave a block, so no link that matters is lost and no
   pair list is written.
7. *Copies* take the component of their set when all components are known.

Full sets are made only of texts whose set was drawn into a comparison; a
bitmap of ``2**BITS`` bits tells which may be, so no text is shuffled.

Defined results: a null text or one without words has an empty set and links
with nothing; a row without doc_id is judged alone (component null, kept);
rows that repeat a doc_id are documents of their own; an empty table gives an
empty result.  The pipeline form numbers the rows and keeps one row of each
component: the one with the smallest doc_id (null last), the first of equals.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.bits import bitmap, filter_rows
from tradelake.llm.components import components, extended
from tradelake.llm.scratch import column_of, drop, pick, positional, written
from tradelake.llm.text import BLANK_SEPARATED, U, Words, chunks, lower_ascii, mix64, run_starts, text_bytes, window_hashes

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
MANTISSA = 10
VALUE_BITS = 38
MARGIN = 0.25          # below the threshold, in estimated similarity
BLOCK = 256
_EMPTY = np.uint16(0xFFFF)
_SHORT = [U(0x1234567 * c + 1) for c in range(SHINGLE)]
_PROBES = np.random.Generator(np.random.PCG64(7)).integers(0, REGISTERS, (REGISTERS, 64))
BITS = 22


@lru_cache(maxsize=4096)
def _collisions(log_a: int, log_b: int) -> float:
    """How likely two registers of independent sets agree, their sizes
    2**(log / 4): the chance that the smallest values of a bucket, one of each
    set, fall into the same cell (a zero count and mantissa bits)."""
    per = [2.0 ** (x / 4) / REGISTERS for x in (log_a, log_b)]
    edge = np.concatenate([[0.0], (2.0 ** np.arange(-VALUE_BITS + MANTISSA, 0))[:, None].repeat(64, 1).ravel()
                           * np.tile(1 + np.arange(64) / 64, VALUE_BITS - MANTISSA), [1.0]])
    # a set of n values in a bucket has its smallest above x with (1 - x)**n; without any value the bucket is empty
    left = [np.exp(max(n, 1.0) * np.log1p(-np.minimum(edge, 1 - 1e-16))) for n in per]
    mass = [x[:-1] - x[1:] for x in left]
    # 64 steps an octave hold 2**MANTISSA / 64 cells each, and values below the last octave one each
    return float((mass[0] * mass[1])[1:].sum() / (2 ** MANTISSA / 64) + mass[0][0] * mass[1][0])


def _steps(sizes: np.ndarray) -> np.ndarray:
    """Sizes as quarters of octaves."""
    return np.rint(4 * np.log2(np.maximum(np.asarray(sizes), 1).astype(np.float64))).astype(int)


def _chances(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(table of collision chances, its row or column for each of ``logs``)."""
    known, of = np.unique(logs, return_inverse=True)
    return np.array([[_collisions(*sorted((x, y))) for y in known.tolist()] for x in known.tolist()]), of


def similarity(equal: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers of sets of sizes
    ``a`` and ``b``, corrected for chance collisions."""
    if not len(equal):
        return equal
    table, of = _chances(np.concatenate([_steps(a), _steps(b)]))
    chance = table[of[:len(equal)], of[len(equal):]]
    return (equal - chance) / (1 - chance)


def shingle_sets(buf: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after the other,
    and how many each has."""
    n = len(ends)
    words = Words(lower_ascii(buf), ends, BLANK_SEPARATED)
    hashes = window_hashes(words.hash, SHINGLE)
    whole = words.doc[:len(hashes)] == words.doc[SHINGLE - 1:] if len(hashes) else np.zeros(0, dtype=bool)
    docs, values = [words.doc[:len(hashes)][whole]], [hashes[whole]]
    counts = words.counts(n)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if n else counts
    for c in range(1, SHINGLE):   # fewer words: the whole sequence
        short = np.flatnonzero(counts == c)
        if len(short):
            docs.append(short)
            values.append(mix64(window_hashes(words.hash, c)[first[short]] ^ _SHORT[c]))
    doc, value = np.concatenate(docs), np.concatenate(values)
    order = np.argsort(doc, kind="stable")
    doc, value = doc[order], value[order]
    sets = [np.unique(x) for x in np.split(value, np.cumsum(np.bincount(doc, minlength=n))[:-1])] if n else []
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    return (np.concatenate(sets) if n else value), sizes


def registers(values: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """HyperMinHash registers (docs x REGISTERS) of sets with hashes ``values``."""
    g = mix64(values ^ U(0x5851F42D4C957F2D))
    bucket = ((g >> U(32)) * U(REGISTERS)) >> U(32)
    rest = mix64(g) >> U(64 - VALUE_BITS)
    packed = np.sort(((doc.astype(U) * U(REGISTERS) + bucket) << U(VALUE_BITS)) | rest)
    packed = packed[run_starts(packed >> U(VALUE_BITS))]
    low = packed & U((1 << VALUE_BITS) - 1)
    length = np.frexp(low.astype(np.float64))[1]                      # bits up to the leading one
    zeros = (VALUE_BITS - length).astype(U)
    shift = np.maximum(length - 1 - MANTISSA, 0).astype(U)
    up = np.maximum(MANTISSA + 1 - length, 0).astype(U)
    mantissa = ((low >> shift) << up) & U((1 << MANTISSA) - 1)
    out = np.full(docs * REGISTERS, _EMPTY, dtype=np.uint16)
    out[(packed >> U(VALUE_BITS)).astype(np.int64)] = ((zeros << U(MANTISSA)) | mantissa).astype(np.uint16)
    out = out.reshape(docs, REGISTERS)
    empty = out == _EMPTY
    rows, cols = np.nonzero(empty & ~empty.all(axis=1)[:, None])
    for t in range(_PROBES.shape[1] + REGISTERS):
        if not len(rows):
            break
        src = _PROBES[cols, t] if t < _PROBES.shape[1] else (cols + t) % REGISTERS
        ok = ~empty[rows, src]
        out[rows[ok], cols[ok]] = out[rows[ok], src[ok]]
        rows, cols = rows[~ok], cols[~ok]
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """(row, key, n_shingles, hi, lo, regs) of each row of (row, text, key)."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, ends = text_bytes(batch.column(1))
            for lo, hi, part, e in chunks(buf, ends):
                for at in range(0, hi - lo, 1 << 16):  # texts whose registers are held at once
                    stop = min(at + (1 << 16), hi - lo)
                    start = int(e[at - 1]) if at else 0
                    values, sizes = shingle_sets(part[start:int(e[stop - 1])], e[at:stop] - start)
                    doc = np.repeat(np.arange(stop - at), sizes)
                    regs = registers(values, doc, stop - at)
                    sums = []
                    for seed in (U(0x9216D5D98979FB1B), U(0xD1310BA698DFB5AC)):
                        c = np.concatenate([np.zeros(1, dtype=U), np.cumsum(mix64(values ^ seed), dtype=U)])
                        edge = np.concatenate([[0], np.cumsum(sizes)])
                        sums.append((c[edge[1:]] - c[edge[:-1]]).view(np.int64))
                    packed = [r.tobytes() if s else None for r, s in zip(regs, sizes)]
                    yield pa.RecordBatch.from_arrays([
                        *(batch.column(c).slice(lo + at, stop - at) for c in (0, 2)), pa.array(sizes, pa.int64()), pa.array(sums[0]),
                        pa.array(sums[1]), pa.array(packed, pa.binary())],
                        names=["row", "key", "n_shingles", "hi", "lo", "regs"])

    return docs.mapInArrow(sign, "row long, key long, n_shingles long, hi long, lo long, regs binary")


def packed_sets(docs: DataFrame, keep: Callable | None = None) -> DataFrame:
    """(row, shingles): the full sets, 6 bytes a hash in order, of the rows
    that ``keep`` leaves of a batch."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = keep(batch) if keep else batch
            buf, ends = text_bytes(batch.column(1))
            for lo, hi, part, e in chunks(buf, ends):
                values, sizes = shingle_sets(part, e)
                six = np.ascontiguousarray(values.byteswap().view(np.uint8).reshape(-1, 8)[:, :6])
                at = np.concatenate([[0], np.cumsum(sizes) * 6])
                whole = six.tobytes()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo),
                    pa.array([whole[at[i]:at[i + 1]] for i in range(hi - lo)], pa.binary())],
                    names=["row", "shingles"])

    return docs.mapInArrow(pack, "row long, shingles binary")


def _unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    wide[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return wide.view(">u8").reshape(-1).astype(U)


def _bands(reps: DataFrame) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16).reshape(n, BANDS, ROWS)
            key = np.full((n, BANDS), U(0), dtype=U) + np.arange(1, BANDS + 1, dtype=U)
            for r in range(ROWS):
                key = mix64(key * U(0x9E3779B97F4A7C15) + regs[:, :, r].astype(U))
            yield pa.RecordBatch.from_arrays([
                pa.array(key.reshape(-1).view(np.int64)),
                pa.array(np.repeat(np.asarray(batch.column(0)), BANDS))], names=["key", "rep"])

    return reps.select("rep", "regs").mapInArrow(keys, "key long, rep long")


def _likely(a: Column, b: Column, percent: int) -> Column:
    """Length bound: similar sets are of similar size."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


@F.pandas_udf(T.DoubleType())
def _estimate(a: pd.Series, b: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="float64")
    x = np.frombuffer(b"".join(a), dtype=np.uint16).reshape(len(a), REGISTERS)
    y = np.frombuffer(b"".join(b), dtype=np.uint16).reshape(len(b), REGISTERS)
    return pd.Series(similarity((x == y).mean(axis=1), n.to_numpy(), m.to_numpy()))


def _linked(percent: int) -> Callable[[str, str], Column]:
    def one(x: bytes, y: bytes) -> bool:
        both = np.sort(np.concatenate([_unpack(x), _unpack(y)]))
        same = int((both[1:] == both[:-1]).sum())
        return 100 * same >= percent * (len(both) - same)

    @F.pandas_udf(T.BooleanType())
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype=bool)
    return linked


def _sets_for(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """The full sets of the documents ``ids``.  Texts that cannot be among them
    are passed over where they are read; what remains is joined without text."""
    wanted = written(ids.select(F.col("rep").alias("row")).distinct(), f"{name}-ids")
    keep = filter_rows(docs, "row", bitmap(wanted, ["row"], BITS))
    out = written(packed_sets(docs, keep).join(wanted, "row", "left_semi"), name)
    drop(wanted)
    return out


def _threshold(percent: int) -> float:
    return percent / 100 - MARGIN


def _plausible(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Of each (key, lo, hi) group of rows (key, lo, hi, side, rep, comp,
    n_shingles, regs): those that may link with a row of another component."""
    for table in _groups(batches):
        n = table.num_rows
        regs = np.frombuffer(b"".join(table["regs"].to_pylist()), dtype=np.uint16).reshape(n, REGISTERS)
        ok = np.zeros(n, dtype=bool)
        comp, size, side = (np.asarray(table[c]) for c in ("comp", "n_shingles", "side"))
        within = bool(table["lo"][0].as_py() == table["hi"][0].as_py())
        chances, of = _chances(_steps(size))
        # so many registers have to agree for an estimate at the threshold
        least = REGISTERS * (_threshold(percent) * (1 - chances) + chances)
        for i in range(n):
            other = (comp != comp[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i]))
            if not within:
                other &= side != side[i]
            j = np.flatnonzero(other)
            if len(j) and ((regs[j] == regs[i]).sum(axis=1) >= least[of[i], of[j]]).any():
                ok[i] = True
        yield from table.select(["key", "lo", "hi", "side", "rep", "comp", "n_shingles"]).filter(pa.array(ok)).to_batches()


def _block_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Confirmed links between components, by exact intersection sizes."""
    for table in _groups(batches):
        rep, comp, side = (np.asarray(table[c]) for c in ("rep", "comp", "side"))
        sets = [_unpack(x) for x in table["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        vocabulary, of, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = np.cumsum(times > 1) - 1
        row = np.repeat(np.arange(len(sets)), sizes)
        keep = times[of] > 1
        row, col = row[keep], shared[of[keep]]
        both = np.zeros((len(sets), len(sets)), dtype=np.float64)
        for at in range(0, int(shared[-1]) + 1, 4096):
            part = np.zeros((len(sets), 4096), dtype=np.float32)
            here = (col >= at) & (col < at + 4096)
            part[row[here], col[here] - at] = 1
            both += part @ part.T
        union = sizes[:, None] + sizes[None, :] - both
        link = (100 * both >= percent * union) & (comp[:, None] != comp[None, :]) & (rep[:, None] < rep[None, :])
        i, j = np.nonzero(link)
        # links between the same two components say the same
        pair = np.unique(np.stack([np.minimum(comp[i], comp[j]), np.maximum(comp[i], comp[j])]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pair[0], pa.int64()), pa.array(pair[1], pa.int64())], names=["a", "b"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal (key, lo, hi) of sorted rows; a group has at most about
    two blocks of rows."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        k = [np.asarray(held[c]) for c in ("key", "lo", "hi")]
        cut = np.flatnonzero((k[0][1:] != k[0][:-1]) | (k[1][1:] != k[1][:-1]) | (k[2][1:] != k[2][:-1])) + 1
        edges = [0, *cut.tolist()]
        for s, e in zip(edges[:-1], edges[1:]):
            yield held.slice(s, e - s)
        held = held.slice(edges[-1])
    if held is not None and held.num_rows:
        yield held


def _gathered(rows: DataFrame) -> DataFrame:
    by = ["key", "lo", "hi"]
    return rows.repartition(*by).sortWithinPartitions(*by)


def _with_sets(likely: DataFrame, sets: DataFrame) -> DataFrame:
    """``likely`` rows with the full sets.  A document of a key is joined with
    its set once; only then it goes to all block pairs it takes part in."""
    once = likely.groupBy("key", "rep").agg(F.first("comp").alias("comp"), F.collect_list(F.struct("lo", "hi", "side")).alias("in"))
    both = once.join(sets.withColumnRenamed("row", "rep"), "rep")
    return both.select("key", "rep", "comp", "shingles", F.explode("in").alias("in")).select(
        "key", "in.lo", "in.hi", "in.side", "rep", "comp", "shingles")


def _confirmed(docs: DataFrame, asked: DataFrame, side: DataFrame, percent: int, name: str) -> DataFrame:
    """The linked ones of pairs (center, rep), as (a, b)."""
    mine = asked.join(side, "rep")
    theirs = side.select(F.col("rep").alias("center"), F.col("n_shingles").alias("_n"), F.col("regs").alias("_r"))
    pairs = mine.join(theirs, "center").filter(_likely(F.col("n_shingles"), F.col("_n"), percent))
    pairs = pairs.select("center", "rep", _estimate("regs", "_r", "n_shingles", "_n").alias("_e")).filter(F.col("_e") >= _threshold(percent))
    pairs = written(pairs.select("center", "rep"), f"{name}-pairs")
    if pairs.isEmpty():
        return pairs.select(F.col("center").alias("a"), F.col("rep").alias("b"))
    sets = _sets_for(docs, pairs.select("rep").union(pairs.select(F.col("center").alias("rep"))), f"{name}-sets")
    # a set travels once to its document's pair and once more to its centre; a centre's meets them there
    both = pairs.join(sets.select(F.col("row").alias("rep"), F.col("shingles").alias("_b")), "rep").join(
        sets.select(F.col("row").alias("center"), F.col("shingles").alias("_a")), "center")
    out = written(both.filter(_linked(percent)("_a", "_b")).select(F.col("center").alias("a"), F.col("rep").alias("b")), f"{name}-links")
    drop(sets, pairs)
    return out


def _with_component(rows: DataFrame, comps: DataFrame, column: str, name: str) -> DataFrame:
    of = comps.select(F.col("node").alias(column), F.col("component").alias(name))
    return rows.join(of, column, "left").withColumn(name, F.coalesce(name, column))


def linked_components(docs: DataFrame, reps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, component): what the links connect of documents whose sets share
    ``percent`` of their union or more, among ``reps`` (rep, n_shingles, regs),
    one row of ``docs`` (row, text) for each different set."""
    side = reps.select("rep", "n_shingles", "regs")
    bands = written(_bands(reps), "bands")
    shared = bands.groupBy("key").agg(F.min("rep").alias("center"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = written(bands.join(shared, "key"), "shared")
    drop(bands)
    stars = written(shared.filter("rep <> center").groupBy("center", "rep").agg(F.count(F.lit(1)).alias("votes")), "stars")
    first = stars.groupBy("rep").agg(F.max(F.struct("votes", (-F.col("center")).alias("c"))).alias("best")).select(
        "rep", (-F.col("best.c")).alias("center"))
    links = _confirmed(docs, first, side, percent, "first")
    comps = components(links, "a", "b", "first")
    open_stars = _with_component(_with_component(stars, comps, "rep", "_x"), comps, "center", "_y").filter("_x <> _y")
    second = open_stars.select("rep", "center").join(first.select("rep", F.col("center").alias("_first")), "rep").filter(
        "center <> _first").select("rep", "center")
    more_links = _confirmed(docs, written(second, "second"), side, percent, "second")

    # the rest: band keys whose documents are not in one component yet
    comps = extended(comps, more_links, "a", "b", "stars")
    of = _with_component(shared.filter("members > 2").select("key", "rep", "members"), comps, "rep", "comp")
    mixed = of.groupBy("key").agg(F.min("comp").alias("_x"), F.max("comp").alias("_y")).filter("_x <> _y").select("key")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rest = of.join(mixed, "key").join(side, "rep").withColumns({
        "_mine": F.pmod(F.xxhash64("rep", "key"), blocks).cast("int"),
        "_other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    rest = rest.select("key", F.least("_mine", "_other").alias("lo"), F.greatest("_mine", "_other").alias("hi"),
                       F.col("_mine").alias("side"), "rep", "comp", "n_shingles", "regs")
    likely = written(_gathered(rest).mapInArrow(
        partial(_plausible, percent=percent), "key long, lo int, hi int, side int, rep long, comp long, n_shingles long"), "likely")
    if likely.isEmpty():
        drop(shared, stars, likely)
        return comps
    more = _sets_for(docs, likely, "rest")
    found = _gathered(_with_sets(likely, more)).mapInArrow(
        partial(_block_links, percent=percent), "a long, b long")
    out = extended(comps, written(found, "found"), "a", "b", "all")
    drop(shared, stars, links, more_links, likely, more)
    return out


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a column ``_row``, the same number in every later pass."""
    return written(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def components_of(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """row, key, n_shingles, component (the smallest row reachable) and
    component_key (the smallest key of the component) of each of ``rows`` (row,
    text, key); rows with a negative number or an empty set have no component."""
    sig = written(signatures(rows), "signatures")
    full = sig.filter("n_shingles > 0 AND row >= 0")
    reps = written(full.groupBy("hi", "lo", "n_shingles").agg(
        F.min("row").alias("rep"), F.min("key").alias("least"), F.first("regs").alias("regs")), "reps")
    named = _with_component(reps.drop("regs"), linked_components(rows, reps, percent), "rep", "component")
    named = written(named, "sets")
    keys = named.groupBy("component").agg(F.min("least").alias("component_key"))
    named = written(named.join(keys, "component").select("hi", "lo", "n_shingles", "component", "component_key"), "components")
    drop(reps)
    # copies of a set take its component; rows that are out of it come back with none
    out = sig.drop("regs").join(named, ["hi", "lo", "n_shingles"], "left")
    return out.select("row", "key", "n_shingles", *[F.when(F.col("row") >= 0, F.col(c)).alias(c) for c in ("component", "component_key")])


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable) and
    kept, a row for each row of ``docs``."""
    rows = numbered(pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string")))
    alone = F.when(F.col("key").isNull(), -1 - F.col("_row")).otherwise(F.col("_row"))
    out = components_of(rows.select(alone.alias("row"), "text", "key"), percent)
    component = F.coalesce("component_key", "key")
    return out.select(F.col("key").alias("doc_id"), "n_shingles", component.alias("component_id"),
                      (F.col("key").isNull() | (component == F.col("key"))).alias("kept"))


def unique_documents(docs: DataFrame) -> DataFrame:
    """Pipeline form: one row of each component, columns as they came."""
    pos, names = positional(docs)
    key, text = F.col(column_of(names, "doc_id")).cast("long"), F.col(column_of(names, "text")).cast("string")
    whole = numbered(pos)
    judged = components_of(whole.select(F.col("_row").alias("row"), text.alias("text"), key.alias("key"))).filter("component IS NOT NULL")
    judged = written(judged, "judged")
    order = F.struct(F.col("key").isNull().alias("without"), "key", "row")
    stays = judged.groupBy("component").agg(F.min(order).alias("stays"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    gone = judged.join(stays, "component").filter(F.col("stays.row") != F.col("row")).select(F.col("row").alias("_row"))
    return whole.join(gone, "_row", "left_anti").select(*pos.columns).toDF(*names)
