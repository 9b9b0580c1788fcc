"""Runs of words that repeat with a period, found by a dictionary of basic factors.

The dictionary names the factors of 1, 2, 4, … words: equal factors of one text have equal names, and a
name of 2L words comes from the two names of L words in it. Only factors that occur again in their text
are named further, so ordinary prose ends after a few levels.

At length L the next occurrence of a factor within less than 2L words counts, and where three
occurrences follow each other at one distance d >= L (an arithmetic progression), d is proposed as a
period. A run of smallest period q is at least 4q words long, and some factor of L <= q < 2L words occurs
once in each of its periods, so every run is proposed at one level, with its own period and no multiple
of it. A proposal is extended to the whole stretch in which words d apart are equal; stretches that many
proposals share are kept once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.batches import text_slices, whole_texts
from scriptorium.llm.codes import row_positions, word_codes
from scriptorium.llm.words import split_words

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _named(values: np.ndarray) -> np.ndarray:
    """Dense names of values, equal for equal values."""
    return np.unique(values, return_inverse=True)[1]


def proposals(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, period, factor length): a factor starts there and twice more, one period apart each time."""
    n = len(codes)
    row = row_positions(first)
    end = first[1:][row]
    at = np.arange(n)
    name = _named(row * (codes.max(initial=0) + 1) + codes)
    found = []
    length = 1
    while len(at):
        order = np.argsort(name, kind="stable")
        place, same = at[order], np.zeros(len(at) + 1, bool)
        same[1:-1] = name[order][1:] == name[order][:-1]
        gap = np.diff(place)
        near = same[1:-1] & (gap >= length) & (gap < 2 * length)
        threefold = np.flatnonzero(near[:-1] & near[1:] & (gap[:-1] == gap[1:]))
        found.append((place[threefold], gap[threefold], np.full(len(threefold), length)))
        again = same[1:] | same[:-1]
        names = np.full(n, -1, np.int64)
        names[place[again]] = name[order][again]
        at = np.sort(place[again])
        at = at[at + 2 * length <= end[at]]
        at = at[names[at + length] >= 0]
        name = _named(names[at] * n + names[at + length])
        length *= 2
    return tuple(np.concatenate(part) for part in zip(*found, strict=True)) if found else (at, at, at)


def _stretches(codes: np.ndarray, place: np.ndarray, period: int, factor: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, length) of the stretches of one text with this period that hold a whole proposal of it."""
    equal = np.zeros(len(codes) - period + 2, np.int8)
    equal[1:-1] = codes[:-period] == codes[period:]
    change = np.diff(equal)
    start, stop = np.flatnonzero(change == 1), np.flatnonzero(change == -1) + period
    inside = np.searchsorted(start, place, side="right") - 1
    held = np.unique(inside[(inside >= 0) & (place + 2 * period + factor <= stop[inside])])
    return [(int(s), int(e - s)) for s, e in zip(start[held], stop[held], strict=True) if e - s >= least]


def find_runs(
    codes: np.ndarray, first: np.ndarray, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT
) -> dict[int, list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each row that has any, by start and period; starts count within the row."""
    place, period, factor = proposals(codes, first)
    row = row_positions(first)[place]
    order = np.lexsort((place, period, row))
    place, period, factor, row = place[order], period[order], factor[order], row[order]
    cuts = np.flatnonzero((row[1:] != row[:-1]) | (period[1:] != period[:-1])) + 1
    runs: dict[int, list[tuple[int, int, int]]] = {}
    for begin, end in zip([0, *cuts], [*cuts, len(row)], strict=True):
        if begin == end:
            continue
        r, d = int(row[begin]), int(period[begin])
        text = codes[first[r] : first[r + 1]]
        least = max(least_length, least_exponent * d)
        for start, length in _stretches(text, place[begin:end] - first[r], d, factor[begin:end], least):
            runs.setdefault(r, []).append((start, length, d))
    return {r: sorted(found, key=lambda run: (run[0], run[2])) for r, found in runs.items()}


def collapse_runs(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_exponent: int = LEAST_EXPONENT,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, runs, collapsed): the periodic runs of each text, and the text with one period left of each.

    A run is a stretch of at least `least_length` words and `least_exponent` of its smallest periods which
    no neighbouring word extends. `runs` has (start, length, period) in words, by start and period. A word is
    dropped if it lies in any run behind that run's first period; `collapsed` is the other words joined
    by one space. Words are separated by ASCII blanks and compared as they are. Every row counts on its own,
    so repeated rows and missing keys give rows of their own; a missing, empty or blank text has no runs and
    an empty result. The exponent is at least 4, below which the proposals would not be complete.
    """
    if least_exponent < 4 or least_length < 1:
        raise ValueError("runs have at least four periods and one word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                words = split_words(part.column("text"))
                found = find_runs(word_codes(words)[0], words.first, least_length, least_exponent)
                collapsed = []
                for i, whole in enumerate(whole_texts(part, "text")):
                    kept = whole.encode().split()
                    if i in found:
                        change = np.zeros(len(kept) + 1, np.int64)
                        for start, length, period in found[i]:
                            change[start + period] += 1
                            change[start + length] -= 1
                        kept = compress(kept, np.cumsum(change[:-1]) == 0)
                    collapsed.append(b" ".join(kept).decode())
                listed = [[{"start": s, "length": n, "period": p} for s, n, p in found.get(i, ())] for i in range(part.num_rows)]
                kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
                columns = [part.column("key"), pa.array(listed, kind), pa.array(collapsed, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "runs", "collapsed"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {key_type}, runs {RUNS}, collapsed string").withColumnRenamed("key", key)


def run_report(collapsed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Figures and digests of `collapse_runs`: the number of runs, the longest one, and SHA-256 of runs and text."""
    longest = F.reduce(
        "runs",
        F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"),
        lambda best, run: F.when(best.isNull() | (run["length"] > best["length"]), run).otherwise(best),
    )
    lines = F.array_join(F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))), "")
    return collapsed.withColumn("longest", longest).select(
        key,
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("longest.start").alias("start"),
        F.col("longest.length").alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("(longest.length * 1000) div longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
