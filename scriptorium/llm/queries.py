"""The operators of this subpackage as registered queries over the whole `documents` table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import (
    byte_bpe,
    byte_repeats,
    collocations,
    fingerprints,
    jaccard,
    language,
    licenses,
    mixing,
    periods,
    quality,
    substrings,
    token_counts,
    token_files,
)
from scriptorium.llm.oracles import JACCARD_SQL, LICENSE_SQL, MIXING_SQL, QUALITY_SQL, SUBSTRING_SQL
from scriptorium.llm.sequence_oracles import BYTE_REPEATS_SQL, COLLOCATIONS_SQL, PERIODS_SQL
from scriptorium.plans.catalog import query
from scriptorium.plans.tables import table
from scriptorium.session import new_path


@query("op1_token_files")
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary, end_id=2)
    return token_files.read_documents(spark, path, with_ids=False)


def repository_path(doc_id: str = "doc_id", source: str = "source") -> Column:
    """A place for each document in the repository of its source: up to three folders deep, files at every depth."""
    depth = F.col(doc_id) % 7
    folders = [F.when(depth > level, F.expr(f"cast({doc_id} div {size} as string)")) for level, size in enumerate((500, 125, 25))]
    return F.concat_ws("/", source, *folders, F.concat(F.lit("file_"), F.col(doc_id).cast("string")))


@query("op2_license_scan", LICENSE_SQL)
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of repositories, one for each source."""
    docs = table(spark, sf_dir, "documents")
    return licenses.scan_licenses(docs.select("doc_id", repository_path().alias("path"), "text"))


@query("op3_substring_dedup", SUBSTRING_SQL)
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_report(table(spark, sf_dir, "documents"))


@query("op4_ngram_jaccard", JACCARD_SQL)
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.byte_bpe(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op8_quality_rules", QUALITY_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


@query("op9_language")
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = language.fold_of(F.col("doc_id"))
    model = language.fit_language_model(docs.filter(fold != 1))
    held_out = F.coalesce(fold == 1, F.lit(False)).alias("held_out")
    return language.predict_language(docs, model).select("doc_id", held_out, "lang_pred", "score", "rejected")


@query("op10_mixing", MIXING_SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix_sources(docs, epochs=1.0, seed=17)


def planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in about a tenth of the texts every word from some place on repeats with a period."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\t-\\r]+"), lambda word: word != "")
    chosen = docs.select("doc_id", "text", hashed.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    sized = chosen.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    placed = sized.withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n as int)")))
    period = placed.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    repeated = F.expr("transform(words, (word, i) -> if(i < a, word, get(words, a + (i - a) % p)))")
    return period.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs", PERIODS_SQL)
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_report(periods.collapse_runs(planted_periods(table(spark, sf_dir, "documents"))))


@query("op12_collocations", COLLOCATIONS_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_byte_repeats", BYTE_REPEATS_SQL)
def op13_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = byte_repeats.cut_repeated_bytes(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["length"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
