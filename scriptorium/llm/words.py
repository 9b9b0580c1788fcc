"""Whole texts of an Arrow column as flat word arrays, hashed without a loop over words.

Words are runs of bytes other than the six ASCII blanks. Hashes depend on the bytes alone, so they
agree between tasks, machines and runs.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLOCK = 1 << 21
_STEP = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER = np.random.Generator(np.random.PCG64(20240501)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits of the result (a bijection)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and the offset at which each row begins; a missing row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words(NamedTuple):
    """Words of several rows: byte positions [begin, end) in `data`; row i has words first[i] … first[i + 1]."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count())


def split_words(column: pa.Array, lower: bool = False) -> Words:
    """Words of each row; with `lower`, after A-Z became a-z."""
    data, offsets = flat_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = ~_BLANK[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, begin, end, np.searchsorted(begin, offsets))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    steps = np.full(n, _STEP, np.uint64)
    back = np.full(n, pow(_STEP, -1, 2**64), np.uint64)
    steps[0] = back[0] = 1
    return np.multiply.accumulate(steps), np.multiply.accumulate(back)


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over random letter values, taken from prefix sums and mixed.

    Works in blocks of about 2 MB that end between words, so memory does not depend on the batch.
    """
    out = np.empty(len(words.begin), np.uint64)
    if not _POWERS:
        _POWERS.append(_powers(_BLOCK))
    at = 0
    while at < len(out):
        base = words.begin[at]
        upto = max(at + 1, int(np.searchsorted(words.end, base + _BLOCK, side="right")))
        size = int(words.end[upto - 1] - base)
        power, back = _POWERS[0] if size <= _BLOCK else _powers(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_LETTER[words.data[base : base + size]] * power[:size], out=sums[1:])
        begin, end = words.begin[at:upto] - base, words.end[at:upto] - base
        out[at:upto] = mix(((sums[end] - sums[begin]) * back[begin]) ^ (end - begin).astype(np.uint64))
        at = upto
    return out


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every `n` consecutive word hashes, rows not regarded; shorter input has none."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    power, length = hashes, 1
    joined, done = None, 0
    while True:
        if n & length:
            joined = power if joined is None else _append(joined, done, power, length)
            done += length
        if done == n:
            return mix(joined[: len(hashes) - n + 1])
        power, length = _append(power, length, power, length), 2 * length


def _append(left: np.ndarray, n_left: int, right: np.ndarray, n_right: int) -> np.ndarray:
    tail = right[n_left:]
    size = min(len(left), len(tail))
    return left[:size] * np.uint64(pow(_STEP, n_right, 2**64)) + tail[:size]


def full_grams(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the `n`-grams that lie within one row, and each one's row."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[:-1][rows] + within, rows
