"""Token counts without building the tokens: rank-synchronous merging on ragged arrays."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.batches import BoundedDict, split_segments, text_slices, whole_texts
from scriptorium.llm.bpe import load_merges, surviving_counts

PIECES_AT_ONCE = 200_000
CACHE_ENTRIES = 400_000
_CACHES: dict[tuple[str, str], BoundedDict] = {}


def _piece_lists(text: str, pattern: regex.Pattern) -> Iterator[list[str]]:
    if len(text) <= PIECES_AT_ONCE:
        yield pattern.findall(text)
        return
    found = pattern.finditer(text)
    while block := [m.group() for m in islice(found, PIECES_AT_ONCE)]:
        yield block


def _counter(vocabulary: str, pattern: str):
    """A function that counts the tokens of each of a list of texts."""
    merges, compiled = load_merges(vocabulary), regex.compile(pattern)
    special = regex.compile("|".join(map(regex.escape, sorted(merges.special, key=len, reverse=True)))) if merges.special else None
    known = _CACHES.setdefault((vocabulary, pattern), BoundedDict(CACHE_ENTRIES))

    def of_segments(segments: list[str]) -> list[int]:
        """Tokens of each segment; pre-tokens are merged together once they are many."""
        out = np.zeros(len(segments), np.int64)
        rows: list[int] = []
        pieces: list[bytes] = []

        def merge() -> None:
            np.add.at(out, rows, surviving_counts(pieces, merges))
            rows.clear()
            pieces.clear()

        for i, segment in enumerate(segments):
            for block in _piece_lists(segment, compiled):
                pieces += map(str.encode, block)
                rows += [i] * len(block)
                if len(rows) >= PIECES_AT_ONCE:
                    merge()
        if rows:
            merge()
        return out.tolist()

    def count(texts: list[str]) -> np.ndarray:
        known.trim()
        out = np.zeros(len(texts), np.int64)
        parts, row_of = [], []
        for row, text in enumerate(texts):
            cut = special.split(text) if special else [text]
            out[row] = len(cut) - 1
            parts += cut
            row_of += [row] * len(cut)
        words = [split_segments(part) for part in parts]
        new = list({w for first_rest in words for w in first_rest[1:] if w not in known})
        known.update(zip(new, of_segments([" " + w for w in new]), strict=True))
        heads = of_segments([w[0] for w in words])
        for row, head, word in zip(row_of, heads, words, strict=True):
            out[row] += head + sum(map(known.__getitem__, word[1:]))
        return out

    return count


def token_counts(
    docs: DataFrame, vocabulary: str, pattern: str, limit: int = 1024, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of each row's whole text.

    `vocabulary` is the path of a byte-level tokenizer file, the same on every executor; `pattern` its
    pre-token pattern. Special strings in a text count as one token, as the library does by default.
    A missing or empty text has 0 bytes and 0 tokens; a missing key stays missing; repeated rows give
    repeated results; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(vocabulary, pattern)
        for batch in batches:
            for part in text_slices(batch, "text"):
                n = count(whole_texts(part, "text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("n_bytes"), pa.array(n), pa.array(n > limit)],
                    ["key", "n_bytes", "n_tokens", "over_limit"],
                )

    rows = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes")
    )
    schema = f"key {dict(docs.dtypes)[key]}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
