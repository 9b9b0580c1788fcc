"""Corpus tables derived from the given `documents`, `labels` and `embeddings` tables.

The given documents hold Latin prose, so their text is first mapped letter by letter to Arabic script;
every other table here follows from that one. The SQL twins are in `oracle_sql.py`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions.hashing import hash_bucket
from scriptorium.functions.messages import message_json
from scriptorium.functions.stylometry import with_clean_text, with_style_counts
from scriptorium.operators.reshape import (
    GENERATION_METHODS,
    SOURCE_COLUMNS,
    SOURCES,
    drop_null_short_text,
    min_clean_length_filter,
)
from scriptorium.plans.bounds import spread_small_input, with_once

# Our own mapping of the test texts to Arabic script: common words first, then single letters.
WORD_MAP = (
    (" the ", " في "),
    (" and ", " على "),
    (" of ", " من "),
    (" la ", " لم "),
    (" de ", " أن "),
    (" on ", " نحن "),
)
LETTERS = "abcdefghijklmnopqrstuvwxyz.,éè"
SCRIPT = (
    "\u0627\u0628\u0622\u062f\u064e\u0641\u063a\u0647\u0650\u062c\u0643\u0644\u0645\u0646\u0623"
    "\u0649\u0642\u0631\u0633\u062a\u0648\u0624\u0626\u062e\u064a\u0632\u003a\u060c\u0651\u0670"
)
VECTOR_DIMS = 64
EPOCH = 1_700_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def to_arabic(text: Column | str) -> Column:
    lowered = F.lower(text)
    worded = reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), WORD_MAP, lowered)
    return F.translate(worded, LETTERS, SCRIPT)


def arabic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) in Arabic script."""
    docs = spread_small_input(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("given")))
    return with_once(docs, "text", to_arabic("given")).drop("given")


def _pick(position: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (position + 1).cast("int"))


def _row_of(doc_id: str = "doc_id") -> Column:
    return F.expr(f"{doc_id} div 5")


def _with_tags(docs: DataFrame) -> DataFrame:
    place = F.col("doc_id") % 5
    return docs.select(
        "*",
        F.when(place == 0, 0).otherwise(1).alias("label"),
        _pick(place, SOURCES).alias("source"),
        _pick(_row_of() % 3, GENERATION_METHODS).alias("generation_method"),
    )


def long_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, label, source, generation_method): five texts per corpus row, the first human."""
    return _with_tags(arabic_documents(spark, sf_dir))


def corpus_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`long_corpus` without the text, which is then neither read nor mapped."""
    return _with_tags(table(spark, sf_dir, "documents").select("doc_id"))


def wide_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, five text columns, generation_method): the same texts, one corpus row each."""
    place = F.col("doc_id") % 5
    rows = arabic_documents(spark, sf_dir).groupBy(_row_of().alias("row_id"))
    return rows.agg(
        *(
            F.max(F.when(place == i, F.col("text"))).alias(column)
            for i, (column, _) in enumerate(SOURCE_COLUMNS)
        )
    ).withColumn("generation_method", _pick(F.col("row_id") % 3, GENERATION_METHODS))


def wide_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, generation_method) of `wide_corpus`, without reading a text."""
    rows = table(spark, sf_dir, "documents").select(_row_of().alias("row_id")).distinct()
    return rows.withColumn("generation_method", _pick(F.col("row_id") % 3, GENERATION_METHODS))


def wide_split(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    """One split as it lies in the raw files: row id and five text columns."""
    wide = wide_corpus(spark, sf_dir)
    return wide.filter(F.col("generation_method") == method).drop("generation_method")


def clean_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`long_corpus` without short texts, with cleaned text and lengths."""
    return min_clean_length_filter(with_clean_text(drop_null_short_text(long_corpus(spark, sf_dir))))


def styled_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`clean_corpus` with the four style counts."""
    return with_style_counts(clean_corpus(spark, sf_dir))


def feature_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, label, …): all documents, cleaned and counted, with the quality label of those that have one."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = arabic_documents(spark, sf_dir).join(labels, "doc_id", "left")
    return with_style_counts(min_clean_length_filter(with_clean_text(drop_null_short_text(docs))))


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label, score, prediction): a fixed rule in place of a model, for the metrics."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    rule = (F.length("text") % 97).cast("double")
    docs = table(spark, sf_dir, "documents").select("doc_id", rule.alias("score"))
    return docs.join(labels, "doc_id").withColumn("prediction", F.when(F.col("score") >= 48, 1.0).otherwise(0.0))


def word_vectors(spark: SparkSession, sf_dir: str, clean: DataFrame) -> DataFrame:
    """(word, vector): each corpus word with the embedding its hash points to, if there is one."""
    last = table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0]
    words = clean.select(F.explode(F.split("text_clean", r"\s+")).alias("word")).filter("word <> ''").distinct()
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return (
        words.withColumn("vec_id", hash_bucket("word", (last or 0) + 1))
        .join(vectors, "vec_id")
        .select("word", array_to_vector(F.col("embedding").cast("array<double>")).alias("vector"))
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, timestamp): every document as a message, plus some that are cut off or have a bad id."""
    docs = long_corpus(spark, sf_dir)
    doc_id = F.col("doc_id")
    tag = F.when(F.col("label") == 0, "human").otherwise("ai")
    good = message_json(doc_id, F.col("text"), tag, doc_id + F.lit(EPOCH))
    bad_id = F.to_json(F.struct(F.lit("x").alias("id"), "text", tag.alias("true_source")))
    extra = (
        F.when(doc_id % 50 == 0, F.array(good, F.substring(good, 1, 12)))
        .when(doc_id % 50 == 1, F.array(good, bad_id))
        .otherwise(F.array(good))
    )
    return docs.select(F.explode(extra).alias("json"), F.timestamp_seconds(doc_id + F.lit(EPOCH)).alias("timestamp")).select(
        F.encode("json", "UTF-8").alias("value"), "timestamp"
    )
