"""Words, hashes and blocks of many texts at once, for use inside tasks.

Texts are handled as one byte buffer with the end of each text, so that numpy
works on a few MB at a time and memory does not follow the number of rows.

Hashes are polynomials over 64-bit numbers (mod 2**64, odd base) whose letters
are random 64-bit values, finished by a mixing step; two different strings get
the same value with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK = 4 << 20      # bytes of text handled at once
_SEGMENT = 2 << 20   # bytes whose hash sums are held at once
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_LETTER = _RANDOM.integers(1, 2**64, 256, dtype=U, endpoint=False)
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(int(_BASE), -1, 2**64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        for name, b in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, b, dtype=U)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=U)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """The finishing step of MurmurHash3, a bijection that spreads all bits."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def byte_class(separators: bytes) -> np.ndarray:
    """True for bytes that belong to words."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: Words are runs of anything but space and tab to carriage return.
BLANK_SEPARATED = byte_class(b" \t\n\x0b\x0c\r")
#: Words are runs of digits, ASCII letters and all that is not ASCII.
ALPHANUMERIC = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string or binary array, and the end of each row
    (a null row is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + n + 1]
    at = at.astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, dtype=np.uint8)
    return buf, at[1:] - at[0]


def chunks(buf: np.ndarray, ends: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, ends) of pieces of at most ``most``
    bytes, or of one longer row."""
    lo, n = 0, len(ends)
    while lo < n:
        start = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, start + most, side="right")))
        yield lo, hi, buf[start:int(ends[hi - 1])], ends[lo:hi] - start
        lo = hi


def spans_hash(buf: np.ndarray, first: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Hashes (not yet mixed) of the byte strings first..behind of ``buf``."""
    up, down = _powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, dtype=U)
    np.cumsum(_LETTER[buf] * up[:-1], out=sums[1:])
    return (sums[behind] - sums[first]) * down[first]


class Words:
    """The words of a chunk: text number, first byte, byte behind, hash."""

    def __init__(self, buf: np.ndarray, ends: np.ndarray, table: np.ndarray) -> None:
        n = len(buf)
        inside = table[buf]
        edge = np.zeros(n + 1, dtype=bool)      # a text starts here
        edge[0] = True
        edge[ends] = True
        before = np.concatenate([[False], inside[:-1]]) if n else inside
        self.start = np.flatnonzero(inside & (~before | edge[:n]))
        after = np.concatenate([inside[1:], [False]]) if n else inside
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.doc = np.searchsorted(ends, self.start, side="right")
        self.hash = self._hashes(buf)

    def __len__(self) -> int:
        return len(self.start)

    def _hashes(self, buf: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.start), dtype=U)
        lo = 0
        while lo < len(out):
            at = int(self.start[lo])
            hi = max(lo + 1, int(np.searchsorted(self.start, at + _SEGMENT)))
            s, e = self.start[lo:hi] - at, self.end[lo:hi] - at
            out[lo:hi] = mix64(spans_hash(buf[at:at + int(e[-1])], s, e))
            lo = hi
        return out

    def counts(self, docs: int) -> np.ndarray:
        return np.bincount(self.doc, minlength=docs)


def window_hashes(letters: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp hashes of all runs of ``k`` letters (64-bit values)."""
    n = len(letters)
    if n < k:
        return np.zeros(0, dtype=U)
    up, down = _powers(n)
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum(letters * up, out=sums[1:])
    return mix64((sums[k:] - sums[:-k]) * down[:n - k + 1])


def letters_of(buf: np.ndarray) -> np.ndarray:
    return _LETTER[buf]


def run_starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    if not len(sorted_values):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """True for the positions of 0..n-1 that a window from ``starts`` covers."""
    steps = np.zeros(n + 1, dtype=np.int32)
    steps[starts] += 1
    np.add.at(steps, np.minimum(starts + length, n), -1)
    return np.cumsum(steps[:n]) > 0
