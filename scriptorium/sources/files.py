"""Readers and writers for CSV, TSV and Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.operators.reshape import GENERATION_METHODS, tag_generation_method, union_splits
from scriptorium.sources.split_csv import read_csv_in_parts


def read_csv_multiline(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV with quoted fields that may span lines; doubled quotes; all columns strings by default.

    Each file is read by one task, in order; see `split_csv.read_csv_in_parts` for large files.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def _csv_writer(df: DataFrame, separator: str = ","):
    return (
        df.write.mode("overwrite")
        .option("sep", separator)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in every part file, as many parts as there are tasks."""
    _csv_writer(df).option("header", True).csv(path)


def write_tsv_counts(counts: DataFrame, path: str) -> None:
    """``word<TAB>count`` lines without header."""
    _csv_writer(counts, "\t").option("header", False).csv(path)


def read_tsv_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("word string, n bigint").option("sep", "\t").option("escape", '"').csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def write_parquet(
    df: DataFrame, path: str, compression: str | None = "snappy", partition_by: Sequence[str] = ()
) -> None:
    """Overwrite a Parquet table, by default with Snappy."""
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def ingest_corpus(spark: SparkSession, raw_dir: str, target: str, methods: Sequence[str] = GENERATION_METHODS) -> DataFrame:
    """Per-split CSV files to one tagged Parquet corpus, partitioned by generation method."""
    splits = [tag_generation_method(read_csv_in_parts(spark, f"{raw_dir}/{m}.csv"), m) for m in methods]
    corpus = union_splits(splits)
    write_parquet(corpus, target, partition_by=("generation_method",))
    return spark.read.schema(corpus.schema).parquet(target)


def store_embeddings(df: DataFrame, path: str, key: str, embedding: str, keep: Sequence[str] = ()) -> DataFrame:
    """Persist document vectors with their key and tags, and read them back."""
    stored = df.select(key, *keep, F.col(embedding).cast("array<float>").alias(embedding))
    write_parquet(stored, path)
    return read_parquet(df.sparkSession, path, stored.schema)


def schema_preview(df: DataFrame) -> DataFrame:
    """(position, column_name, column_type, n_values): the schema with how many values each column holds."""
    fields = df.schema.fields
    counts = df.agg(*(F.count(F.col(f.name)).alias(f.name) for f in fields))
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.col(f.name).alias("n_values"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*entries)))
