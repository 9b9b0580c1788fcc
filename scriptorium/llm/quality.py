"""Quality rules on documents, and on their hosts by shrunk failure rates."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.batches import text_slices
from scriptorium.llm.words import full_grams, gram_hashes, split_words, word_hashes
from scriptorium.session import through_table

SYMBOLS = "#*$%&|<>"
COUNTS = "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, n_repeat_words: bigint>"


class Rules(NamedTuple):
    """A document fails with fewer than `min_words` words or more than `max_repeat_percent` repeated ones.

    A host fails when its shrunk rate of failing documents is above `max_host_rate`.
    """

    min_words: int = 10
    repeat_window: int = 5
    max_repeat_percent: int = 20
    max_host_rate: float = 0.5


def count_texts(column: pa.Array, window: int = 5) -> pa.StructArray:
    """The five counts of every text; a missing or empty text has zeros."""
    words = split_words(column)
    n_words = words.count()
    letters = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    per_word = np.concatenate([[0], np.cumsum(letters[words.end] - letters[words.begin])])
    symbol = np.isin(np.arange(256), list(SYMBOLS.encode()))
    at, rows = full_grams(words.first, window)
    grams = gram_hashes(word_hashes(words), window)[at]
    bounds = np.searchsorted(rows, np.arange(len(n_words) + 1))
    n_symbols, n_lines, n_repeat = (np.zeros(len(n_words), np.int64) for _ in range(3))
    for i, value in enumerate(column):
        if not n_words[i]:
            text = value.as_py() or ""
            n_symbols[i] = sum(map(text.count, SYMBOLS))
            continue
        raw = value.as_py().encode()
        n_symbols[i] = np.count_nonzero(symbol[np.frombuffer(raw, np.uint8)])
        if b"\n" in raw:
            lines = [x for x in raw.split(b"\n") if x.strip()]
            n_lines[i] = len(lines) - len(set(lines))
        own = grams[bounds[i] : bounds[i + 1]]
        if len(own) > 1:
            order = np.argsort(own)
            same = own[order[1:]] == own[order[:-1]]
            if same.any():
                twice = np.zeros(len(own), np.int64)
                twice[order[1:][same]] = twice[order[:-1][same]] = 1
                covered = np.convolve(twice, np.ones(window, np.int64))
                n_repeat[i] = np.count_nonzero(covered)
    fields = (n_words, per_word[words.first[1:]] - per_word[words.first[:-1]], n_symbols, n_lines, n_repeat)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in fields], names)


def text_counts(text: Column | str, window: int = 5) -> Column:
    """`count_texts` as a column."""

    @F.arrow_udf(COUNTS)
    def counts(column: pa.Array) -> pa.Array:
        parts = text_slices(pa.RecordBatch.from_arrays([column], ["text"]), "text")
        return pa.concat_arrays([count_texts(part.column("text"), window) for part in parts] or [count_texts(column, window)])

    return counts(text)


def base_failure(counts: Column, rules: Rules) -> Column:
    repeated = F.lit(100) * counts["n_repeat_words"] > F.lit(rules.max_repeat_percent) * counts["n_words"]
    return (counts["n_words"] < rules.min_words) | repeated


def host_verdicts(judged: DataFrame, rules: Rules, host: str, failed: str) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, host_failed) of every host that is known.

    The beta prior is fitted to the rates of all hosts by moments: their mean m, and their variance less
    what chance alone gives, v. Then alpha + beta is m (1 - m) / v - 1. Without spread between hosts
    beyond chance the prior takes all, and every host has the mean rate. Host rows are partial sums
    before they are shuffled, so a host with a large share of the documents costs no more than others.
    """
    hosts = (
        judged.filter(F.col(host).isNotNull())
        .groupBy(host)
        .agg(F.count("*").alias("n_docs"), F.sum(F.col(failed).cast("bigint")).alias("n_failed"))
        .withColumn("rate", F.col("n_failed") / F.col("n_docs"))
    )
    mean, square, chance = hosts.agg(F.avg("rate"), F.avg(F.col("rate") * F.col("rate")), F.avg(1 / F.col("n_docs"))).first()
    if mean is None:
        mean = square = chance = 0.0
    spread = square - mean * mean - mean * (1 - mean) * chance
    weight = max(0.0, mean * (1 - mean) / spread - 1) if spread > 1e-12 else None
    if weight is None:
        shrunk = F.lit(float(mean))
    else:
        shrunk = (F.col("n_failed") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.select(host, "n_docs", "n_failed", shrunk.alias("shrunk_rate"), (shrunk > rules.max_host_rate).alias("host_failed"))


def judge(judged: DataFrame, rules: Rules, host: str, failed: str = "base_failed", kept: str = "kept") -> DataFrame:
    """Add `kept`: false if the document failed, else whether its host passed.

    A document without a host is judged by itself. Only failing hosts are joined back; Spark broadcasts
    them while they are few, and splits a hot host otherwise.
    """
    bad = host_verdicts(judged, rules, host, failed).filter("host_failed").select(F.col(host).alias("__bad_host"))
    joined = judged.join(bad, F.col(host) == F.col("__bad_host"), "left")
    return joined.withColumn(kept, ~F.col(failed) & F.col("__bad_host").isNull()).drop("__bad_host")


def quality_report(docs: DataFrame, rules: Rules = Rules(), key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(key, five counts, base_failed, kept) of each row's whole text.

    A missing or empty text has no words and fails; a missing key or host stays missing; repeated rows
    give repeated results; an empty table gives none. Counts are stored once, as hosts need them too.
    """
    counted = docs.select(
        F.col(key).alias("key"), F.col(host).alias("host"), text_counts(F.col(text), rules.repeat_window).alias("counts")
    )
    judged = counted.select("key", "host", "counts.*", base_failure(F.col("counts"), rules).alias("base_failed"))
    stored = through_table(judged, "quality-counts")
    return judge(stored, rules, "host").drop("host").withColumnRenamed("key", key)


def keep_good(docs: DataFrame, rules: Rules = Rules(), text: str = "text", host: str = "source") -> DataFrame:
    """The rows of `docs` that pass, as they are."""
    failed = docs.withColumn("__failed", base_failure(text_counts(F.col(text), rules.repeat_window), rules))
    kept = judge(through_table(failed, "quality-rows"), rules, host, "__failed", "__kept")
    return kept.filter("__kept").select(docs.columns)
