"""Exact word codes: equal words of a slice get equal small integers, without hashes that could collide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from scriptorium.llm.words import Words


def word_codes(words: Words) -> tuple[np.ndarray, pa.Array]:
    """The code of each word and the distinct words (as bytes), which codes point into."""
    edges = np.zeros(len(words.data) + 1, np.int8)
    edges[words.begin] += 1
    edges[words.end] -= 1
    offsets = np.zeros(len(words.begin) + 1, np.int64)
    np.cumsum(words.end - words.begin, out=offsets[1:])
    letters = words.data[np.cumsum(edges[:-1], dtype=np.int8) > 0]
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))]
    encoded = pa.Array.from_buffers(pa.large_binary(), len(words.begin), buffers).dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def row_positions(first: np.ndarray) -> np.ndarray:
    """The row of each position, from the offsets at which rows begin."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
