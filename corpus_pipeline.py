"""A training corpus from `documents`: rules, near-duplicates, repeated passages, mixture, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.byte_bpe import byte_bpe
from scriptorium.llm.jaccard import keep_one_per_component
from scriptorium.llm.mixing import mix_sources
from scriptorium.llm.quality import keep_good
from scriptorium.llm.substrings import drop_repeats
from scriptorium.plans.catalog import query
from scriptorium.session import through_table

SEED = 17

# No SQL gives the last stage's byte-pair ids; tests/llm compares all stages with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules of text and host; the others go."""
    return keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, that of least id."""
    return keep_one_per_component(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that occur earlier; lengths follow."""
    return drop_repeats(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as an equal mixture of the sources asks for, in random order."""
    return mix_sources(docs, seed=SEED).drop("copy", "shuffle_key")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every document."""
    return byte_bpe(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("substring_dedup", substring_stage),
    ("source_mixing", mixing_stage),
    ("byte_bpe", encoding_stage),
]


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is stored as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = through_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
