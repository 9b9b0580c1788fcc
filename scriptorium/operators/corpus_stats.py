"""Corpus statistics, each in one pass over its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions.profiles import UNICODE_BLANKS
from scriptorium.functions.text import clean_words, ml_tokenize, word_count
from scriptorium.operators.heavy_hitters import HELD_ITEMS, leading_items
from scriptorium.operators.reshape import nonempty_clean_filter


def split_row_counts(df: DataFrame, method: str = "generation_method") -> DataFrame:
    """Rows per split and in total, the total under the name TOTAL."""
    return (
        df.rollup(method)
        .agg(F.grouping(method).alias("__all"), F.count("*").alias("n_rows"))
        .select(F.when(F.col("__all") == 1, F.lit("TOTAL")).otherwise(F.col(method)).alias("split"), "n_rows")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of NULLs in every column."""
    return df.select(*(F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns))


def _per_column(df: DataFrame, columns: Sequence[str], stats: dict[str, callable]) -> DataFrame:
    """Aggregate several columns in one pass and turn the single row into one row per column."""
    one_row = df.agg(
        *(make(F.col(c)).alias(f"{i}_{stat}") for i, c in enumerate(columns) for stat, make in stats.items())
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), *(F.col(f"{i}_{stat}").alias(stat) for stat in stats))
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*entries)))


def avg_length_per_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean raw length per column; columns without a positive mean are left out."""
    means = _per_column(df, columns, {"avg_chars": lambda c: F.avg(F.length(c))})
    return means.filter(F.col("avg_chars") > 0)


def word_count_stats(df: DataFrame, columns: Sequence[str], legacy_null_size: bool = True) -> DataFrame:
    """Mean, least and greatest word count per text column.

    A missing text counts as -1 words under `legacy_null_size`, as older Spark defaults had it.
    """

    def words(c: Column) -> Column:
        return F.coalesce(word_count(c), F.lit(-1)) if legacy_null_size else word_count(c)

    return _per_column(
        df,
        columns,
        {
            "avg_words": lambda c: F.avg(words(c)),
            "min_words": lambda c: F.min(words(c)),
            "max_words": lambda c: F.max(words(c)),
        },
    )


def class_balance(df: DataFrame) -> DataFrame:
    """Rows per class with their share of all rows in percent."""
    counts = df.groupBy("label").agg(F.count("*").alias("n_rows"))
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(0)))
    return counts.select(
        "label",
        F.when(F.col("label") == 0, "human").otherwise("ai").alias("class"),
        "n_rows",
        (F.col("n_rows") * 100 / total).alias("percent"),
    )


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    """Row counts by the given columns, ordered by them."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows")).orderBy(*columns)


def words_of(df: DataFrame, text: str = "text_clean", keep: Sequence[str] = ()) -> DataFrame:
    """One row per non-empty word."""
    return df.select(*keep, F.explode(clean_words(text)).alias("word"))


def vocabulary_stats(df: DataFrame) -> DataFrame:
    """Per source: words, distinct words, their ratio, and mean words per document, in one pass.

    Spark first aggregates by (source, word), so a source that holds most words is spread by word. The
    document's own word count rides along with its first word. A text without words counts as a document.
    """
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    total, unique = F.col("total_words"), F.col("unique_words")
    words = df.select("source", "word_count", F.posexplode_outer(clean_words("text_clean")).alias("pos", "word"))
    counted = words.groupBy("source").agg(
        F.count("word").alias("total_words"),
        F.countDistinct("word").alias("unique_words"),
        F.avg(F.when(first, F.col("word_count"))).alias("avg_words_per_abstract"),
    )
    return counted.select(
        "source",
        "total_words",
        "unique_words",
        F.when(total > 0, unique / total).otherwise(F.lit(0.0)).alias("ttr"),
        "avg_words_per_abstract",
    )


def vocabulary_richness(df: DataFrame) -> DataFrame:
    """Per source: words, distinct words and their ratio; zeros where no text has a word."""
    return vocabulary_stats(df).drop("avg_words_per_abstract")


def word_frequency(df: DataFrame, text: str = "text_clean") -> DataFrame:
    """Occurrences per word; each task counts its own words before the shuffle."""
    return words_of(df, text).groupBy("word").agg(F.count("*").alias("n"))


def top_words(df: DataFrame, n: int = 20, held: int = HELD_ITEMS) -> DataFrame:
    """The leading words with their exact counts; see `leading_items`."""
    words = df.select(clean_words("text_clean").alias("words"))
    return leading_items(words, "words", n, held=held).orderBy("rank").select(F.col("item").alias("word"), "n")


def top_bigrams(df: DataFrame, n: int = 10, held: int = HELD_ITEMS) -> DataFrame:
    """The leading bigrams with their exact counts; see `leading_items`."""
    tokens = nonempty_clean_filter(df).select(ml_tokenize("text_clean").alias("tokens"))
    return leading_items(tokens, "tokens", n, held=held, width=2).orderBy("rank").select(F.col("item").alias("bigram"), "n")


def delimited_word_count(table: DataFrame, column: str = "text_clean", position: int = 4) -> DataFrame:
    """Word totals of a delimited file, ordered by word.

    The text column is found by name, else by position; rows too short to have it are NULL there and
    contribute nothing.
    """
    if column in table.columns:
        text = F.col(column)
    elif len(table.columns) > position:
        text = F.col(table.columns[position])
    else:
        text = F.lit(None).cast("string")
    spaced = F.translate(text, UNICODE_BLANKS, " " * len(UNICODE_BLANKS))
    words = table.select(F.explode(F.split(spaced, " ")).alias("word"))
    return words.filter(F.col("word") != "").groupBy("word").agg(F.count("*").alias("n")).orderBy("word")


def sum_count_pairs(lines: DataFrame, line: str = "value") -> DataFrame:
    """Totals of ``word<TAB>count`` lines; lines that do not parse are skipped."""
    parts = F.split(F.btrim(F.col(line), F.lit(UNICODE_BLANKS)), "\t", 2)
    count = F.btrim(F.get(parts, F.lit(1)), F.lit(UNICODE_BLANKS))
    pairs = lines.select(
        F.get(parts, F.lit(0)).alias("word"), count.try_cast("bigint").alias("n")
    ).filter(F.col("n").isNotNull())
    return pairs.groupBy("word").agg(F.sum("n").alias("n"))


def word_count_crosscheck(left: DataFrame, right: DataFrame) -> DataFrame:
    """Compare two (word, n) tables: words in all, and words on which they differ."""
    both = left.withColumnRenamed("n", "n_left").join(right.withColumnRenamed("n", "n_right"), "word", "full")
    return both.agg(
        F.count("*").alias("n_words"),
        F.count(F.when(~F.col("n_left").eqNullSafe(F.col("n_right")), 1)).alias("n_mismatches"),
    )


def class_word_weights(df: DataFrame, n: int = 200, documents: int | None = None, order: str = "doc_id", held: int = HELD_ITEMS) -> DataFrame:
    """The `n` leading words of humans and of machines with their weight relative to the leader.

    With `documents`, each class is first reduced to that many documents in key order.
    """
    kind = F.when(F.col("source") == "human", "human").otherwise("ai")
    tagged = df.withColumn("class", kind)
    if documents is not None:
        tagged = (
            tagged.filter(F.col("class") == "human").orderBy(order).limit(documents)
            .unionByName(tagged.filter(F.col("class") == "ai").orderBy(order).limit(documents))
        )
    words = tagged.select("class", clean_words("text_clean").alias("words"))
    leading = leading_items(words, "words", n, by="class", held=held)
    named = leading.select(F.col("group").alias("class"), F.col("item").alias("word"), "n", "rank")
    return named.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy("class")))


def feature_summary(
    df: DataFrame, by: str, features: dict[str, str], stats: Sequence[str] = ("avg",), order: bool = True
) -> DataFrame:
    """Statistics of feature columns per group: columns ``{stat}_{name}``."""
    make = {"avg": F.avg, "min": F.min, "max": F.max, "stddev": F.stddev_samp}
    grouped = df.groupBy(by).agg(
        *(make[stat](column).alias(f"{stat}_{name}") for name, column in features.items() for stat in stats)
    )
    return grouped.orderBy(by) if order else grouped


def vocabulary_size(df: DataFrame, min_count: int = 3, text: str = "text_clean") -> DataFrame:
    """Number of tokens seen at least `min_count` times."""
    tokens = nonempty_clean_filter(df).select(F.explode(ml_tokenize(text)).alias("word"))
    counts = tokens.groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_count).agg(F.count("*").alias("vocabulary_size"))


def split_class_counts(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Per split: rows in all and per class."""
    return (
        df.groupBy(split)
        .agg(
            F.count("*").alias("n_rows"),
            F.count(F.when(F.col(label) == 0, 1)).alias("n_human"),
            F.count(F.when(F.col(label) == 1, 1)).alias("n_ai"),
        )
        .orderBy(split)
    )
