"""Registered queries: readers and writers, each as a round trip through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions.messages import parse_messages
from scriptorium.operators import corpus_stats as stats
from scriptorium.operators.reshape import GENERATION_METHODS, SOURCE_COLUMNS
from scriptorium.operators.vectors import word_counts_per_document
from scriptorium.functions.text import clean_words
from scriptorium.plans import oracle_sql as o
from scriptorium.plans import tables as t
from scriptorium.plans.catalog import query
from scriptorium.plans.text_queries import PAYLOAD, payload
from scriptorium.session import new_path, through_table
from scriptorium.sources import files, split_csv
from scriptorium.sources.messages import send_payload

_EXPORT_COLUMNS = ("source", "label", "generation_method", "char_count", "text_clean")


@query("csv_scan_multiline", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def csv_scan_multiline(spark, sf_dir):
    path = new_path(spark, "documents-csv")
    files.write_csv(t.table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    return split_csv.read_csv_in_parts(spark, path)


@query("parquet_scan", "SELECT doc_id, source, n_chars FROM documents")
def parquet_scan(spark, sf_dir):
    return files.read_parquet(spark, f"{sf_dir}/documents.parquet").select("doc_id", "source", "n_chars")


@query("parquet_overwrite_sink", o.with_ctes("SELECT doc_id, source, char_count, text_clean FROM clean", o.CLEAN))
def parquet_overwrite_sink(spark, sf_dir):
    path = new_path(spark, "clean-corpus")
    clean = t.clean_corpus(spark, sf_dir).select("doc_id", "source", "char_count", "text_clean")
    files.write_parquet(clean, path)
    return files.read_parquet(spark, path, clean.schema)


@query(
    "csv_single_file_sink",
    o.with_ctes(
        "SELECT source, CAST(label AS VARCHAR) AS label, generation_method, CAST(char_count AS VARCHAR) AS char_count, "
        "text_clean FROM clean",
        o.CLEAN,
    ),
)
def csv_single_file_sink(spark, sf_dir):
    path = new_path(spark, "word-count-input")
    files.write_csv(t.clean_corpus(spark, sf_dir).select(*_EXPORT_COLUMNS), path)
    return files.read_csv_multiline(spark, path)


@query(
    "result_csv_sink",
    o.with_ctes(
        "SELECT label, round(avg(f_diacritics), 6) AS avg_diacritics, round(avg(f_colons), 6) AS avg_colons "
        "FROM styled GROUP BY label",
        o.STYLED,
    ),
)
def result_csv_sink(spark, sf_dir):
    path = new_path(spark, "style-summary")
    features = {"diacritics": "f_diacritics", "colons": "f_colons"}
    files.write_csv(stats.feature_summary(t.styled_corpus(spark, sf_dir), "label", features), path)
    schema = "label int, avg_diacritics double, avg_colons double"
    read = files.read_csv_multiline(spark, path, schema)
    return read.withColumns({c: F.round(c, 6) for c in ("avg_diacritics", "avg_colons")})


@query("tsv_count_sink", o.with_ctes("SELECT word, count(*) AS n FROM words GROUP BY word", o.CLEAN_WORDS))
def tsv_count_sink(spark, sf_dir):
    path = new_path(spark, "word-counts")
    files.write_tsv_counts(stats.word_frequency(t.clean_corpus(spark, sf_dir)), path)
    return files.read_tsv_counts(spark, path)


@query(
    "mapreduce_word_count",
    o.with_ctes("SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY word", o.CLEAN_WORDS),
)
def mapreduce_word_count(spark, sf_dir):
    """Every part file carries the header, so no part loses a row to it."""
    path = new_path(spark, "word-count-parts")
    files.write_csv(t.clean_corpus(spark, sf_dir).select(*_EXPORT_COLUMNS), path)
    return stats.delimited_word_count(files.read_csv_multiline(spark, path))


@query("sum_count_pairs", o.with_ctes("SELECT word, count(*) AS n FROM words GROUP BY word", o.CLEAN_WORDS))
def sum_count_pairs(spark, sf_dir):
    """Counts per document as text lines, among them one without a count and one with a bad count each."""
    path = new_path(spark, "count-pairs")
    clean = through_table(t.clean_corpus(spark, sf_dir).select("doc_id", "text_clean"), "clean-texts")
    counted = word_counts_per_document(clean.withColumn("w", clean_words("text_clean")), "doc_id", "w")
    good = counted.select(F.concat_ws("\t", "word", F.col("n").cast("string")).alias("value"))
    doc_id = F.col("doc_id").cast("string")
    bad = clean.select(F.explode(F.array(doc_id, F.concat(doc_id, F.lit("\tmany")))).alias("value"))
    good.union(bad).write.mode("overwrite").text(path)
    return stats.sum_count_pairs(spark.read.text(path))


_WIDE_COLUMNS = ", ".join(c for c, _ in SOURCE_COLUMNS)


@query(
    "corpus_ingest",
    o.with_ctes(f"SELECT CAST(row_id AS VARCHAR) AS row_id, {_WIDE_COLUMNS}, generation_method FROM wide", o.WIDE),
)
def corpus_ingest(spark, sf_dir):
    raw = new_path(spark, "raw-csv")
    for method in GENERATION_METHODS:
        files.write_csv(t.wide_split(spark, sf_dir, method), f"{raw}/{method}.csv")
    return files.ingest_corpus(spark, raw, new_path(spark, "raw-corpus"))


@query(
    "embedding_store",
    "SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS pos, CAST(embedding[i] AS DOUBLE) AS value "
    "FROM embeddings, unnest(range(1, len(embedding) + 1)) AS r(i)",
)
def embedding_store(spark, sf_dir):
    vectors = t.table(spark, sf_dir, "embeddings")
    stored = files.store_embeddings(vectors, new_path(spark, "embeddings"), "vec_id", "embedding", ("label",))
    return stored.select("vec_id", "label", F.posexplode("embedding").alias("pos", "value")).withColumn(
        "value", F.col("value").cast("double")
    )


@query(
    "schema_preview",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{kind}' AS column_type, count({c}) AS n_values FROM documents"
        for i, (c, kind) in enumerate(
            (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"))
        )
    ),
)
def schema_preview(spark, sf_dir):
    return files.schema_preview(t.table(spark, sf_dir, "documents"))


@query("kafka_payload_sink", o.with_ctes("SELECT id, text, true_source, timestamp FROM payload", o.WIDE, PAYLOAD))
def kafka_payload_sink(spark, sf_dir):
    path = new_path(spark, "payload")
    send_payload(payload(spark, sf_dir), "parquet", path)
    return parse_messages(files.read_parquet(spark, path)).drop("ingest_time")
