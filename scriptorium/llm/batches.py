"""Arrow batches cut into slices of bounded bytes, and small caches with a bound."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
SLICE_ROWS = 2000
_BETWEEN_WORDS = re.compile(r" (?=\S)(?<=\S )")


def text_slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut a batch between rows into slices of about `most` bytes of text and `rows` rows; a longer text is a slice of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + most, side="right"))))
        yield batch.slice(at, upto - at)
        at = upto


def whole_texts(batch: pa.RecordBatch, text: str) -> list[str]:
    """The texts of a batch; a missing one is empty."""
    return pc.fill_null(batch.column(text), "").to_pylist()


class BoundedDict(dict):
    """A cache that starts anew when it holds more than `most` entries; call `trim` between uses."""

    def __init__(self, most: int):
        super().__init__()
        self.most = most

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()


class AgingDict(dict):
    """A cache of at most two generations of about `most` entries each; call `trim` between uses.

    What is looked for in time moves on to the young generation, so frequent entries outlive all rare ones.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most = most
        self.old: dict = {}

    def unknown(self, keys: Iterable) -> list:
        """Those of the keys that neither generation holds; the others are young afterwards."""
        missing = [k for k in keys if k not in self]
        if not self.old:
            return missing
        old = self.old
        self.update({k: old[k] for k in missing if k in old})
        return [k for k in missing if k not in old]

    def trim(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


def split_segments(text: str) -> list[str]:
    """Cut a text at single spaces between two visible characters, and drop those spaces.

    The usual pre-token patterns begin a new pre-token at such a space, so the first segment, and every
    further one with its space put back, can be tokenized alone. Equal segments then cost once.
    """
    return _BETWEEN_WORDS.split(text)
