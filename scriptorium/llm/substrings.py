"""Substring deduplication on a compacted de Bruijn graph of token k-mers.

An edge is a k-mer of words (a window); it leads from its first k - 1 words to its last k - 1. Only
repeated edges matter. Edges that follow each other in a text and share their anchor, the shorter k-mer
of least hash within them, travel as one row, a path. An edge can only repeat where its anchor does, and
then as part of a path with the same anchor:

* paths whose anchor occurs once are dropped: none of their edges repeats;
* paths with the same anchor and the same words are one nonbranching path; its first place is the source
  and all others repeat it;
* where paths of one anchor differ, the graph branches. Their words are fetched by source coordinates,
  one place per distinct path, and their edges are compared one by one.

What repeats returns to its document by a join on the coordinates and is joined to spans there. Anchor
and words are hashed apart, so a path is known by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.batches import text_slices, whole_texts
from scriptorium.llm.words import Words, full_grams, gram_hashes, mix, split_words, word_hashes
from scriptorium.session import through_table

WINDOW = 20
ANCHOR = 8
_NO_KEY = 2**63 - 1


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least of every `width` consecutive values."""
    place, length = np.arange(len(values)), 1

    def nearer(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        left = left[: len(right)]
        return np.where(values[right] < values[left], right, left)

    while length * 2 <= width:
        place, length = nearer(place, place[length:]), length * 2
    return nearer(place, place[width - length :]) if width > length else place


def paths(words: Words, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(row, start, n, anchor hash, path hash) of each run of windows that share their anchor."""
    hashes = word_hashes(words)
    at, rows = full_grams(words.first, window)
    if not len(at):
        return rows, at, at, hashes[:0], hashes[:0]
    anchors = gram_hashes(hashes, anchor)
    place = _leftmost_least(anchors, window - anchor + 1)[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (rows[1:] != rows[:-1])
    begin = np.flatnonzero(fresh)
    n = np.diff(np.append(begin, len(at)))
    grams = gram_hashes(hashes, window)
    first, last = grams[at[begin]], grams[at[begin + n - 1]]
    inside = (place[begin] - at[begin]).astype(np.uint64)
    path = mix(first * np.uint64(3) + mix(last + n.astype(np.uint64)) + inside)
    row = rows[begin]
    return row, at[begin] - words.first[row], n, anchors[place[begin]], path


def _identities(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return part.column("key").to_numpy(zero_copy_only=False), part.column("digest").to_numpy(zero_copy_only=False)


def _settle(keys: np.ndarray, digests: np.ndarray, names: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the first document of each name, and of all later documents, which repeat it.

    What the first document says again is left to the document itself. So a name that many
    documents of a batch share leaves the batch once.
    """
    order = np.lexsort((digests, keys, names[1], names[0]))
    a, b, k, d = names[0][order], names[1][order], keys[order], digests[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    source = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    later = (k != k[source]) | (d != d[source])
    return order[fresh], order[later]


_EDGE = "a bigint, b bigint, key bigint, digest bigint, start int, n int, settled boolean"
_EDGE_NAMES = ["a", "b", "key", "digest", "start", "n", "settled"]


def _edge_rows(part, row, start, n, names) -> pa.RecordBatch:
    keys, digests = _identities(part)
    first, later = _settle(keys[row], digests[row], names)
    picked = np.concatenate([first, later])
    settled = np.arange(len(picked)) >= len(first)
    spread = mix(digests[row[picked]].view(np.uint64) + start[picked].astype(np.uint64))
    a = np.where(settled, spread, names[0][picked]).view(np.int64)
    columns = [
        pa.array(a),
        pa.array(names[1][picked].view(np.int64)),
        part.column("key").take(pa.array(row[picked])),
        pa.array(digests[row[picked]]),
        pa.array(start[picked].astype(np.int32)),
        pa.array(n[picked].astype(np.int32)),
        pa.array(settled),
    ]
    return pa.RecordBatch.from_arrays(columns, _EDGE_NAMES)


def _places(rows: DataFrame) -> DataFrame:
    """Number the documents of each (a, b) along their keys, and mark names `a` with more than one row or `b`.

    Equal rows are one document: those of the least (key, digest) all have place 1 and repeat nothing.
    """
    by_name = Window.partitionBy("a")
    in_order = Window.partitionBy("a", "b").orderBy("key", "digest")
    marked = rows.select(
        "*",
        F.rank().over(in_order).alias("place"),
        F.count("*").over(by_name).alias("many"),
        (F.min("b").over(by_name) != F.max("b").over(by_name)).alias("branches"),
    )
    return marked.filter(F.col("settled") | (F.col("many") > 1))


def repeated_runs(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(key, digest, start, n): windows start … start + n - 1 of a document occur in an earlier document.

    `docs` has (key bigint, digest bigint, text); documents are ordered by key, then by digest.
    """

    def to_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                row, start, n, a, b = paths(split_words(part.column("text")), window, anchor)
                yield _edge_rows(part, row, start, n, (a, b))

    def to_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = split_words(part.column("text"))
                grams = gram_hashes(word_hashes(words), window)
                asked = part.column("asked")
                row = np.repeat(np.arange(len(asked)), pc.list_value_length(asked).to_numpy(zero_copy_only=False))
                flat = asked.flatten()
                start, n = flat.field("start").to_numpy().astype(np.int64), flat.field("n").to_numpy().astype(np.int64)
                name = np.repeat(flat.field("a").to_numpy().view(np.uint64), n)
                start = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
                row = np.repeat(row, n)
                edge = grams[words.first[row] + start]
                yield _edge_rows(part, row, start, np.ones(len(row), np.int64), (mix(edge + name), edge))

    found = through_table(_places(docs.mapInArrow(to_paths, _EDGE)).drop("many"), "repeated-paths")
    settled = found.filter(F.col("settled") | (F.col("place") > 1))
    branching = found.filter(~F.col("settled") & F.col("branches") & (F.col("place") == 1))
    asked = branching.groupBy("key", "digest").agg(F.collect_set(F.struct("a", "start", "n")).alias("asked"))
    opened = docs.join(asked, ["key", "digest"]).dropDuplicates(["key", "digest"])
    edges = _places(opened.mapInArrow(to_edges, _EDGE))
    repeated = edges.filter(F.col("settled") | (F.col("place") > 1))
    return settled.select("key", "digest", "start", "n").unionAll(repeated.select("key", "digest", "start", "n"))


def covered_words(words: Words, runs: pa.Array, window: int) -> np.ndarray:
    """Which words lie in a window that an earlier document has, or that begins earlier in the same text."""
    cover = np.zeros(len(words.begin) + 1, np.int64)
    row = np.repeat(np.arange(len(runs)), pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False))
    flat = runs.flatten()
    begin = words.first[row] + flat.field("start").to_numpy()
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + flat.field("n").to_numpy() + window - 1, -1)
    at, rows = full_grams(words.first, window)
    grams = gram_hashes(word_hashes(words), window)[at]
    order = np.lexsort((grams, rows))
    same = (grams[order[1:]] == grams[order[:-1]]) & (rows[order[1:]] == rows[order[:-1]])
    again = at[order[1:][same]]
    np.add.at(cover, again, 1)
    np.add.at(cover, again + window, -1)
    return np.cumsum(cover)[:-1] > 0


def _with_runs(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """`docs` (key, digest, text, …) with the array `runs` of each document's repeated windows."""
    runs = repeated_runs(docs.select("key", "digest", "text"), window, anchor)
    by_document = runs.groupBy("key", "digest").agg(F.collect_set(F.struct("start", "n")).alias("runs"))
    joined = docs.join(by_document, ["key", "digest"], "left")
    empty = F.array().cast("array<struct<start: int, n: int>>")
    return joined.withColumn("runs", F.coalesce("runs", empty))


def _identity(key: str, text: str) -> list[Column]:
    """Key and text hash, by which documents are known and ordered; a missing key is the largest."""
    return [
        F.coalesce(F.col(key).cast("bigint"), F.lit(_NO_KEY)).alias("key"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("digest"),
        F.col(text).alias("text"),
    ]


def substring_report(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept_sha256): the words of each text without repeated windows.

    A word goes if a window of `window` consecutive words that covers it also starts earlier: in a
    document of smaller key, or earlier in the same text. Windows are judged on the input. The digest is
    that of the kept words joined by one space. Words are separated by ASCII blanks and compared as they
    are. Keys are integers; a missing key comes last. Rows of equal key and text are one document and
    give equal results; of equal keys with different texts, the one of smaller text hash is earlier.
    Missing, empty and short texts lose only words that repeat; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = split_words(part.column("text"))
                gone = covered_words(words, part.column("runs"), window)
                removed = np.concatenate([[0], np.cumsum(gone)])[words.first]
                digests = []
                for i, text in enumerate(whole_texts(part, "text")):
                    kept = compress(text.encode().split(), ~gone[words.first[i] : words.first[i + 1]])
                    digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                columns = [part.column("key"), pa.array(words.count()), pa.array(np.diff(removed)), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "n_removed", "kept_sha256"])

    known = F.when(F.col("key") != _NO_KEY, F.col("key")).alias("key")
    rows = _with_runs(docs.select(*_identity(key, text)), window, anchor).select(known, "text", "runs")
    result = rows.mapInArrow(run, "key bigint, n_words bigint, n_removed bigint, kept_sha256 string")
    return result.withColumnRenamed("key", key)


def cut_words(text: str, words: Words, i: int, gone: np.ndarray) -> str:
    """The text without the words marked in `gone`, each with the blanks that follow it."""
    if not gone.any():
        return text
    raw = text.encode()
    base = int(words.begin[words.first[i]]) - (len(raw) - len(raw.lstrip(b" \t\n\v\f\r")))
    begins = words.begin[words.first[i] : words.first[i + 1]] - base
    change = np.zeros(len(raw) + 1, np.int64)
    change[begins[gone]] += 1
    change[np.append(begins[1:], len(raw))[gone]] -= 1
    keep = np.cumsum(change)[:-1] == 0
    return np.frombuffer(raw, np.uint8)[keep].tobytes().decode()


def drop_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with repeated words cut out of `text` as `substring_report` says; other columns stay as they are.

    A text that repeats nothing stays as it is, also its blanks; a text of which nothing is left becomes
    empty.
    """
    columns = docs.columns
    others = F.struct(*(F.col(c) for c in columns if c != text)).alias("row")
    named = docs.select(*_identity(key, text), others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = split_words(part.column("text"))
                gone = covered_words(words, part.column("runs"), window)
                cut = [
                    None if x is None else cut_words(x, words, i, gone[words.first[i] : words.first[i + 1]])
                    for i, x in enumerate(part.column("text").to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(cut, pa.string())], ["row", "cut"])

    row_type = named.schema["row"].dataType.simpleString()
    result = _with_runs(named, window, anchor).select("row", "text", "runs").mapInArrow(run, f"row {row_type}, cut string")
    return result.select(*(F.col("cut").alias(c) if c == text else F.col(f"row.{c}").alias(c) for c in columns))
