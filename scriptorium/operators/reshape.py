"""Projection, reshape, filters and unions over the corpus tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.profiles import UNICODE_BLANKS
from scriptorium.plans.prefix import with_row_numbers
from scriptorium.session import through_table

# Column names and tags of the corpus files.
SOURCE_COLUMNS = (
    ("original_abstract", "human"),
    ("allam_generated_abstract", "allam"),
    ("jais_generated_abstract", "jais"),
    ("llama_generated_abstract", "llama"),
    ("openai_generated_abstract", "openai"),
)
GENERATION_METHODS = ("by_polishing", "from_title", "from_title_and_content")
SOURCES = tuple(source for _, source in SOURCE_COLUMNS)
MIN_RAW_LENGTH = 10
MIN_CLEAN_LENGTH = 20


def tag_generation_method(df: DataFrame, method: str) -> DataFrame:
    return df.withColumn("generation_method", F.lit(method))


def union_splits(splits: Iterable[DataFrame]) -> DataFrame:
    """Stack tables by column name."""
    return reduce(lambda a, b: a.unionByName(b), splits)


def union_positional(parts: Iterable[DataFrame]) -> DataFrame:
    """Stack tables by column position."""
    return reduce(lambda a, b: a.union(b), parts)


def wide_to_long(
    wide: DataFrame,
    columns: Sequence[tuple[str, str]] = SOURCE_COLUMNS,
    keep: Sequence[str] = ("generation_method",),
) -> DataFrame:
    """One row per text column: (text, label, source, *keep). One scan; duplicates and NULLs stay."""
    entries = [
        F.struct(
            F.col(column).alias("text"),
            F.lit(0 if source == "human" else 1).alias("label"),
            F.lit(source).alias("source"),
        )
        for column, source in columns
    ]
    return wide.select(F.inline(F.array(*entries)), *keep)


def drop_null_short_text(df: DataFrame, text: str = "text", longer_than: int = MIN_RAW_LENGTH) -> DataFrame:
    return df.filter(F.col(text).isNotNull() & (F.length(text) > longer_than))


def min_clean_length_filter(df: DataFrame, longer_than: int = MIN_CLEAN_LENGTH) -> DataFrame:
    return df.filter(F.col("char_count") > longer_than)


def nonempty_clean_filter(df: DataFrame) -> DataFrame:
    return df.filter(F.col("text_clean") != "")


def source_filter(df: DataFrame, column: str, value: str | int, equal: bool = True) -> DataFrame:
    """Rows whose source or label is, or is not, the given one."""
    return df.filter(F.col(column) == value if equal else F.col(column) != value)


def row_limit(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first `n` rows in a stated order; Spark keeps only `n` rows per task."""
    return df.orderBy(*order).limit(n)


def payload_rows(
    df: DataFrame, column: str, order: str, epoch: Column, limit: int | None = None
) -> DataFrame:
    """Texts to send: (id, text, true_source, timestamp).

    Blank and missing texts are skipped and take no id. Ids count 0, 1, 2 … along the unique numeric
    column `order`. The true source follows from the name of the text column. The texts are stored first, as
    numbering reads its rows several times.
    """
    text = F.btrim(F.col(column), F.lit(UNICODE_BLANKS))
    rows = df.select(F.col(order).alias("__order"), text.alias("text"), epoch.cast("double").alias("timestamp"))
    rows = rows.filter(F.col("text").isNotNull() & (F.col("text") != ""))
    if limit is not None:
        rows = row_limit(rows, limit, "__order")
    numbered = with_row_numbers(through_table(rows, "payload-texts"), "__order", "id")
    tag = "human" if "original" in column else "ai"
    return numbered.select("id", "text", F.lit(tag).alias("true_source"), "timestamp")
