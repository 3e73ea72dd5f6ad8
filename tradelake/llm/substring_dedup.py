"""Remove word passages that an earlier document has.

Every window of ``k`` words is hashed (Rabin-Karp over word hashes) and looked
up among the windows of all documents (:mod:`tradelake.llm.blocks`).  A window
is a repeat if a document with a smaller doc_id has it; overlapping repeats
merge into maximal intervals of words, which are removed.

Defined results: a null text has no words; texts shorter than a window are
kept whole; rows with the same doc_id are never repeats of each other; a null
doc_id counts as larger than all others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradelake.llm import blocks as B
from tradelake.llm.scratch import pick
from tradelake.llm.text import BLANK_SEPARATED, Words, covered, window_hashes

WINDOW = 13
BYTES_PER_WORD = 5  # only sizes the buckets

RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start long, end long>>, kept string"


def _windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each window that lies within one text."""
    hashes = window_hashes(words.hash, k)
    if not len(hashes):
        return hashes, np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(words.doc[:len(hashes)] == words.doc[k - 1:])
    return hashes[at], at


def span_lists(gone: np.ndarray, doc: np.ndarray, first: np.ndarray, docs: int) -> pa.Array:
    """Maximal runs of ``gone`` within each text, as places in the text."""
    if not len(gone):
        starts = ends = np.zeros(0, dtype=np.int64)
    else:
        same = np.concatenate([[False], doc[1:] == doc[:-1]])
        prev = np.concatenate([[False], gone[:-1]]) & same
        after = np.concatenate([gone[1:] & same[1:], [False]])
        starts, ends = np.flatnonzero(gone & ~prev), np.flatnonzero(gone & ~after)
    owner = doc[starts] if len(starts) else np.zeros(0, dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=docs))]).astype(np.int32)
    cells = pa.StructArray.from_arrays([pa.array(starts - first[owner], pa.int64()),
                                        pa.array(ends + 1 - first[owner], pa.int64())], names=["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets), cells)


def joined_words(buf: np.ndarray, words: Words, keep: np.ndarray, docs: int) -> pa.Array:
    """The kept words of each text, joined by one space."""
    s, e, doc = words.start[keep], words.end[keep], words.doc[keep]
    length = e - s
    total = int(length.sum())
    at = np.concatenate([[0], np.cumsum(length)[:-1]]) if len(length) else length
    source = np.arange(total) + np.repeat(s - at, length)
    last = np.concatenate([doc[1:] != doc[:-1], [True]]) if len(doc) else np.zeros(0, dtype=bool)
    gaps = np.concatenate([[0], np.cumsum(~last)[:-1]]) if len(doc) else length  # spaces before each word
    out = np.full(total + int((~last).sum()), 32, dtype=np.uint8)
    out[np.arange(total) + np.repeat(gaps, length)] = buf[source]
    size = np.bincount(doc, weights=length, minlength=docs) + np.maximum(0, np.bincount(doc, minlength=docs) - 1)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.StringArray.from_buffers(docs, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes()))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, the removed intervals and the text kept."""
    def places(block: B.Block) -> tuple[np.ndarray, np.ndarray]:
        words = Words(block.buf, block.ends, BLANK_SEPARATED)
        hashes, at = _windows(words, k)
        return hashes, words.doc[at]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, batch, row in B.unpack(batches):
            n = len(block.ids)
            words = Words(block.buf, block.ends, BLANK_SEPARATED)
            hashes, at = _windows(words, k)
            _, first, of = B.distinct(block, hashes, words.doc[at])
            gone = np.zeros(len(words), dtype=bool)
            if len(at):
                owner = block.ids[words.doc[at]]
                repeat = B.flags_of(batch, row)[of] | (owner > block.ids[first][of])
                gone = covered(at[repeat], k, len(words))
            counts = words.counts(n)
            start = np.concatenate([[0], np.cumsum(counts)[:-1]])
            yield pa.RecordBatch.from_arrays([
                block.id_column(), pa.array(counts, pa.int64()),
                pa.array(np.bincount(words.doc[gone], minlength=n), pa.int64()),
                span_lists(gone, words.doc, start, n), joined_words(block.buf, words, ~gone, n),
            ], names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    blocks = B.blocks_of(pick(docs, doc_id=doc_id, text=text), "windows")
    answers = B.repeated(blocks, places, B.bucket_bits(blocks, BYTES_PER_WORD), "repeats")
    joined = blocks.join(answers, "block", "left")
    return joined.select("block", "ids", "ends", "n_bytes", "data", "answers").mapInArrow(cut, RESULT)
