"""Find hashes that repeat across documents without a row per hash.

Documents are packed into *blocks* of a few MB, written once to the shared
checkpoint folder, so that every later pass sees the same blocks whatever
executors are lost.  A block sends each of its distinct hashes once, with the
smallest doc_id and the number of places that have it, as one packed row per
hash bucket: the counting shuffle has a few rows per block and some 7 bytes per
distinct hash, and a hash that a third of all documents share costs its bucket
one entry per block.
The answer to a block is one bit per hash it sent.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.scratch import written
from tradelake.llm.text import CHUNK, U, chunks, run_starts, text_bytes

NO_ID = np.iinfo(np.int64).max   # a null doc_id: behind all others
PER_BUCKET = 1_500_000           # hashes that one task of the count sorts, about

CROWD = 8192                     # places that have a hash from which on it counts as crowded
_TIMES = np.iinfo(np.uint16).max  # as many places of a block are told apart

ANSWERS = "block long, bucket int, n int, flags binary, crowds binary"
BLOCK = "block long, ids array<long>, ends array<long>, n_bytes long, data binary"


class Block:
    """Texts ordered by doc_id, null last."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, buf: np.ndarray, valid: np.ndarray) -> None:
        self.ids, self.ends, self.buf, self.valid = ids, ends, buf, valid

    def id_column(self) -> pa.Array:
        return pa.array(self.ids, mask=~self.valid)


def blocks_of(docs: DataFrame, name: str, size: int = CHUNK) -> DataFrame:
    """Pack ``docs`` (doc_id long, text string) into written blocks."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        squeeze = zstandard.ZstdCompressor(level=1)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        weight = 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            ids = np.concatenate([h[0] for h in held])
            valid = np.concatenate([h[1] for h in held])
            lengths = np.concatenate([h[2] for h in held])
            buf = np.concatenate([h[3] for h in held])
            order = np.argsort(ids, kind="stable")
            texts = np.split(buf, np.cumsum(lengths)[:-1])
            data = b"".join(texts[i] for i in order)
            row = pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()),
                pa.array([[int(i) if v else None for i, v in zip(ids[order], valid[order])]], pa.list_(pa.int64())),
                pa.array([np.cumsum(lengths[order])], pa.list_(pa.int64())),
                pa.array([len(data)], pa.int64()), pa.array([squeeze.compress(data)], pa.binary()),
            ], names=["block", "ids", "ends", "n_bytes", "data"])
            number += 1
            return row

        for batch in batches:
            if not batch.num_rows:
                continue
            buf, ends = text_bytes(batch.column(1))
            key = batch.column(0)
            valid = ~np.asarray(key.is_null())
            ids = np.asarray(key.fill_null(NO_ID)).astype(np.int64)
            for lo, hi, part, e in chunks(buf, ends, size):
                if held and weight + len(part) > size:
                    yield flush()
                    held, weight = [], 0
                held.append((ids[lo:hi], valid[lo:hi], np.diff(e, prepend=0), part))
                weight += len(part)
        if held:
            yield flush()

    return written(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                   .mapInArrow(pack, BLOCK), name)


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block, pa.RecordBatch, int]]:
    """(block number, block, batch, row) for each row of block columns."""
    loose = zstandard.ZstdDecompressor()
    for batch in batches:
        c = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for r in range(batch.num_rows):
            ids = c["ids"][r].values
            data = c["data"][r].as_py()
            buf = np.frombuffer(loose.decompress(data), dtype=np.uint8) if c["n_bytes"][r].as_py() else \
                np.zeros(0, dtype=np.uint8)
            yield c["block"][r].as_py(), Block(
                np.asarray(ids.fill_null(NO_ID)), np.asarray(c["ends"][r].values), buf,
                ~np.asarray(ids.is_null())), batch, r


#: From a block, one hash per place and the text number of each place.
Hasher = Callable[[Block], tuple[np.ndarray, np.ndarray]]


def distinct(block: Block, hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, the first text that has each, and for every
    place the number of its hash."""
    order = np.argsort(hashes, kind="stable")  # texts are in doc_id order, and stay so
    starts = run_starts(hashes[order])
    of = np.empty(len(hashes), dtype=np.int64)
    of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(hashes))))
    return hashes[order][starts], doc[order][starts], of


def planes(values: np.ndarray) -> bytes:
    """Fixed-width numbers, transposed so that equal high bytes lie together."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unplanes(data: bytes, dtype: type, n: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, n).T).view(dtype).reshape(n)


def encode(hashes: np.ndarray, ids: np.ndarray, times: np.ndarray, squeeze: zstandard.ZstdCompressor) -> bytes:
    """Sorted distinct hashes with an id and a number of places each."""
    table, of = np.unique(ids, return_inverse=True)
    of = of.astype(np.uint16 if len(table) <= 1 << 16 else np.uint32)
    head = np.array([len(hashes), len(table), of.itemsize], dtype=np.int64).tobytes()
    gaps = np.diff(hashes, prepend=U(0))
    steps = np.diff(table, prepend=np.int64(0))
    return head + squeeze.compress(planes(gaps) + planes(steps) + planes(of) + planes(times))


def decode(data: bytes, loose: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, ids, width = np.frombuffer(data[:24], dtype=np.int64).tolist()
    raw = loose.decompress(data[24:])
    hashes = np.cumsum(unplanes(raw[:8 * n], U, n), dtype=U)
    table = np.cumsum(unplanes(raw[8 * n:8 * (n + ids)], np.int64, ids))
    behind = 8 * (n + ids) + width * n
    of = unplanes(raw[8 * (n + ids):behind], np.uint16 if width == 2 else np.uint32, n)
    return hashes, table[of], unplanes(raw[behind:], np.uint16, n)


def bucket_bits(blocks: DataFrame, bytes_per_hash: float, per_bucket: int = PER_BUCKET) -> int:
    """log2 of the number of hash buckets, from the size of all blocks."""
    total = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    return max(4, math.ceil(math.log2(max(1.0, total / bytes_per_hash / per_bucket))))


def repeated(blocks: DataFrame, hasher: Hasher, bits: int, name: str, any_other: bool = False) -> DataFrame:
    """(block, answers): for each block, two bitmaps per bucket over the
    distinct hashes it sent: does a smaller doc_id of another block have it
    (or, with ``any_other``, any other doc_id), and do ``CROWD`` places or more
    in all blocks have it?"""
    shift = U(64 - bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for number, block, _, _ in unpack(batches):
            hashes, first, of = distinct(block, *hasher(block))
            times = np.minimum(np.bincount(of, minlength=len(hashes)), _TIMES).astype(np.uint16)
            at = np.searchsorted(hashes >> shift, np.arange((1 << bits) + 1, dtype=U))
            full = np.flatnonzero(np.diff(at))
            rows = [encode(hashes[lo:hi], block.ids[first[lo:hi]], times[lo:hi], squeeze)
                    for lo, hi in zip(at[full], at[full + 1])]
            yield pa.RecordBatch.from_arrays([
                pa.array(full, pa.int32()), pa.array(np.full(len(full), number), pa.int64()),
                pa.array(rows, pa.binary())], names=["bucket", "block", "sent"])

    def answer(group: pa.Table) -> pa.Table:
        loose = zstandard.ZstdDecompressor()
        parts = [decode(x, loose) for x in group["sent"].to_pylist()]
        sizes = [len(p[0]) for p in parts]
        hashes, ids, times = (np.concatenate([p[i] for p in parts]) for i in range(3))
        del parts
        order = np.argsort(hashes, kind="stable")
        starts = run_starts(hashes[order])
        sorted_ids = ids[order]
        least = np.minimum.reduceat(sorted_ids, starts)
        counts = np.diff(np.append(starts, len(order)))
        hit = np.empty(len(order), dtype=bool)
        if any_other:
            hit[order] = np.repeat(least != np.maximum.reduceat(sorted_ids, starts), counts)
        else:
            hit[order] = sorted_ids > np.repeat(least, counts)
        crowd = np.empty(len(order), dtype=bool)
        crowd[order] = np.repeat(np.add.reduceat(times[order].astype(np.int64), starts) >= CROWD, counts)
        flags, crowds = ([np.packbits(x).tobytes() for x in np.split(y, np.cumsum(sizes)[:-1])] for y in (hit, crowd))
        return pa.table({"block": group["block"], "bucket": group["bucket"], "n": pa.array(sizes, pa.int32()),
                         "flags": pa.array(flags, pa.binary()), "crowds": pa.array(crowds, pa.binary())})

    sent = blocks.mapInArrow(send, "bucket int, block long, sent binary")
    answers = sent.groupBy("bucket").applyInArrow(answer, ANSWERS)
    return per_block(answers, name)


def per_block(answers: DataFrame, name: str) -> DataFrame:
    """A block's answers in one row: a few bits per hash of a block."""
    rest = [c for c in answers.columns if c not in ("block", "bucket")]
    return written(answers, name).groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("bucket", *rest))).alias("answers"))


def flags_of(batch: pa.RecordBatch, row: int, column: str = "answers", field: str = "flags") -> np.ndarray:
    """The answers to a block, in the order of its distinct hashes."""
    cell = batch.column(batch.schema.get_field_index(column))[row]
    if not cell.is_valid:
        return np.zeros(0, dtype=bool)
    return np.concatenate([np.unpackbits(np.frombuffer(x[field], dtype=np.uint8), count=x["n"])
                           for x in cell.as_py()] or [np.zeros(0, dtype=np.uint8)]).astype(bool)
