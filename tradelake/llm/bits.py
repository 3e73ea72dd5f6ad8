"""Bitmaps of fixed size that tell which keys may be in a set of any size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.text import U, mix64


def slots(keys: np.ndarray, size: int) -> np.ndarray:
    """The bit, of ``size`` (a power of two), of each row of 64-bit keys."""
    keys = keys[:, None] if keys.ndim == 1 else keys      # a reshape to -1 columns fails without rows
    h = np.full(len(keys), U(keys.shape[1]), dtype=U)
    for c in range(keys.shape[1]):
        h = mix64(h * U(0x9E3779B97F4A7C15) + keys[:, c].astype(U))
    return (h & U(size - 1)).astype(np.int64)


def bitmap(rows: DataFrame, columns: list[str], bits: int) -> bytes:
    """2**bits bits; those of the rows' keys are set.  They are or-ed together on
    Spark; at most 2**bits / 8 short rows come to the driver, whatever the rows."""
    size = 1 << bits

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(slots(np.stack([np.asarray(c) for c in batch.columns], axis=1), size))
            byte, first = np.unique(at >> 3, return_index=True)
            value = np.bitwise_or.reduceat(1 << (at & 7), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(byte, pa.int64()), pa.array(value, pa.int64())], names=["byte", "bits"])

    found = rows.select(*columns).mapInArrow(mark, "byte long, bits long").groupBy("byte").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(max(1, size >> 3), dtype=np.uint8)
    out[np.asarray(found["byte"])] = np.asarray(found["bits"])
    return out.tobytes()


def may_hold(packed: bytes, keys: np.ndarray) -> np.ndarray:
    at = slots(keys, len(packed) << 3)
    return (np.frombuffer(packed, dtype=np.uint8)[at >> 3] >> (at & 7) & 1).astype(bool)


def filter_rows(rows: DataFrame, column: str, packed: bytes) -> Callable:
    """A predicate on batches, for tasks: the rows whose ``column`` may be in."""
    shared = rows.sparkSession.sparkContext.broadcast(packed)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(may_hold(shared.value, np.asarray(batch.column(column)))))
    return keep
