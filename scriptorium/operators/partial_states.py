"""Corpus statistics that grow with the corpus: what a split contributes is stored once and merged.

A state has counts, sums and extremes, which add up, and the words of each source with their counts, in
ranges of the word's hash, since distinct words do not add up. Adding a split reads that split alone;
statistics read the states alone. Storing a split again replaces what it had contributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions.hashing import hash_bucket
from scriptorium.functions.text import clean_words, word_count

SPLIT = "split"
WORD_RANGES = 64
_COLUMN_STATE = (
    "split string, column_name string, n_rows bigint, n_null bigint, n_chars bigint, n_words bigint, min_words int, max_words int"
)
_TEXT_STATE = "split string, source string, label int, word string, n bigint, n_words bigint"
_SOURCE_STATE = "split string, source string, label int, n_texts bigint, n_words bigint"
_WORD_STATE = "split string, word_range bigint, source string, word string, n bigint"


def column_state(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_rows, n_null, n_chars, n_words, min_words, max_words) of text columns, in one pass.

    A missing text counts as -1 words, as in `word_count_stats`.
    """
    makers = {
        "n_rows": lambda c: F.count("*"),
        "n_null": lambda c: F.count("*") - F.count(c),
        "n_chars": lambda c: F.sum(F.length(c).cast("bigint")),
        "n_words": lambda c: F.sum(F.coalesce(word_count(c), F.lit(-1)).cast("bigint")),
        "min_words": lambda c: F.min(F.coalesce(word_count(c), F.lit(-1))),
        "max_words": lambda c: F.max(F.coalesce(word_count(c), F.lit(-1))),
    }
    row = wide.agg(*(make(F.col(c)).alias(f"{i}_{name}") for i, c in enumerate(columns) for name, make in makers.items()))
    entries = [F.struct(F.lit(c).alias("column_name"), *(F.col(f"{i}_{n}").alias(n) for n in makers)) for i, c in enumerate(columns)]
    return row.select(F.inline(F.array(*entries)))


def text_state(clean: DataFrame) -> DataFrame:
    """(source, label, word, n, n_words): the words of cleaned texts, and without a word the texts and their `word_count`.

    Texts are cleaned and split once for both; each task counts its own words before the shuffle.
    """
    none = F.array(F.lit(None).cast("string"))
    found = F.concat(none, F.coalesce(clean_words("text_clean"), F.array().cast("array<string>")))
    each = clean.select("source", F.col("label").cast("int").alias("label"), "word_count", F.explode(found).alias("word"))
    words = F.sum(F.when(F.col("word").isNull(), F.col("word_count")).cast("bigint"))
    return each.groupBy("source", "label", "word").agg(F.count("*").alias("n"), words.alias("n_words"))


def source_state(texts: DataFrame) -> DataFrame:
    """(source, label, n_texts, n_words) from `text_state`."""
    counted = texts.filter(F.col("word").isNull()).groupBy("source", "label")
    return counted.agg(F.sum("n").alias("n_texts"), F.sum("n_words").alias("n_words"))


def word_state(texts: DataFrame, ranges: int = WORD_RANGES) -> DataFrame:
    """(word_range, source, word, n): the words of each source from `text_state`."""
    counted = texts.filter(F.col("word").isNotNull()).groupBy("source", "word").agg(F.sum("n").alias("n"))
    return counted.select(hash_bucket("word", ranges).alias("word_range"), "source", "word", "n")


def store_split(path: str, split: str, wide: DataFrame, clean: DataFrame, columns: Sequence[str]) -> None:
    """Store what one split contributes: `wide` has its text columns, `clean` its cleaned texts."""

    def store(name: str, state: DataFrame) -> None:
        state.write.mode("overwrite").parquet(f"{path}/{name}/{SPLIT}={split}")

    store("columns", column_state(wide, columns))
    store("texts", text_state(clean))
    texts = _read(clean.sparkSession, path, "texts", _TEXT_STATE).filter(F.col(SPLIT) == split)
    store("sources", source_state(texts))
    store("words", word_state(texts))


def _read(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def split_row_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per split and in total, the total under the name TOTAL."""
    rows = _read(spark, path, "columns", _COLUMN_STATE).groupBy(SPLIT).agg(F.max("n_rows").alias("n"))
    totals = rows.rollup(SPLIT).agg(F.grouping(SPLIT).alias("__all"), F.sum("n").alias("n_rows"))
    return totals.select(F.when(F.col("__all") == 1, F.lit("TOTAL")).otherwise(F.col(SPLIT)).alias(SPLIT), "n_rows")


def column_statistics(spark: SparkSession, path: str) -> DataFrame:
    """(column_name, n_null, avg_chars, avg_words, min_words, max_words) over all splits."""
    n, filled = F.sum("n_rows"), F.sum("n_rows") - F.sum("n_null")
    return _read(spark, path, "columns", _COLUMN_STATE).groupBy("column_name").agg(
        F.sum("n_null").alias("n_null"),
        F.when(filled > 0, F.sum("n_chars") / filled).alias("avg_chars"),
        F.when(n > 0, F.sum("n_words") / n).alias("avg_words"),
        F.min("min_words").alias("min_words"),
        F.max("max_words").alias("max_words"),
    )


def text_counts(spark: SparkSession, path: str, *by: str) -> DataFrame:
    """Cleaned texts by any of split, source and label."""
    counts = _read(spark, path, "sources", _SOURCE_STATE).groupBy(*by).agg(F.sum("n_texts").alias("n_rows"))
    return counts.orderBy(*by) if by else counts


def word_frequency(spark: SparkSession, path: str) -> DataFrame:
    """Occurrences per word over all splits."""
    return _read(spark, path, "words", _WORD_STATE).groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary_stats(spark: SparkSession, path: str) -> DataFrame:
    """Per source: words, distinct words, their ratio and mean words per text, as from all texts at once.

    Words of one source and range are merged first, so a source that holds most words is spread by range.
    """
    words = _read(spark, path, "words", _WORD_STATE).groupBy("source", "word_range", "word").agg(F.sum("n").alias("n"))
    ranges = words.groupBy("source", "word_range").agg(F.sum("n").alias("n"), F.count("*").alias("distinct"))
    total, unique = F.sum("n"), F.sum("distinct")
    counted = ranges.groupBy("source").agg(total.alias("total_words"), unique.alias("unique_words"), (unique / total).alias("ttr"))
    texts = _read(spark, path, "sources", _SOURCE_STATE).groupBy("source")
    means = texts.agg((F.sum("n_words") / F.sum("n_texts")).alias("avg_words_per_abstract"))
    whole = means.join(counted, "source", "left")
    return whole.select(
        "source",
        F.coalesce("total_words", F.lit(0)).alias("total_words"),
        F.coalesce("unique_words", F.lit(0)).alias("unique_words"),
        F.coalesce("ttr", F.lit(0.0)).alias("ttr"),
        "avg_words_per_abstract",
    )
