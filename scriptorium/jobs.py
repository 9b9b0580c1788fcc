"""The corpus stages as Spark jobs: ``spark-submit … -m scriptorium.jobs STAGE --option value``.

Each stage reads and writes tables by path, so stages can run in separate applications.
"""

from __future__ import annotations

import argparse
import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions.messages import PREDICTION_SCHEMA
from scriptorium.functions.stylometry import with_clean_text, with_style_counts
from scriptorium.operators import classifiers, corpus_stats, reshape, sampling, vectors
from scriptorium.session import build_session
from scriptorium.sources import files, messages
from scriptorium.sources import models as store
from scriptorium.streaming import ledger, scoring

KEY = "doc_key"
_TRAINING_COLUMNS = (KEY, "label", *vectors.STYLE_COLUMNS, "w2v_features")


def content_key(*columns: str) -> Column:
    """A key that depends on the content alone; copies of a row share it and stay in one split."""
    return F.md5(F.concat_ws("\x1f", *columns))


def ingest(spark: SparkSession, raw: str, corpus: str) -> DataFrame:
    """CSV files per generation method, below `raw`, to one tagged table."""
    return files.ingest_corpus(spark, raw, corpus)


def explore(spark: SparkSession, corpus: str, reports: str) -> None:
    """Row counts, missing values, lengths and word counts of the raw corpus, as CSV tables."""
    wide = files.read_parquet(spark, corpus)
    columns = [c for c, _ in reshape.SOURCE_COLUMNS]
    tables = {
        "split_row_counts": corpus_stats.split_row_counts(wide),
        "null_counts": corpus_stats.null_counts(wide),
        "avg_length": corpus_stats.avg_length_per_column(wide, columns),
        "word_count_stats": corpus_stats.word_count_stats(wide, columns),
        "class_balance": corpus_stats.class_balance(reshape.wide_to_long(wide)),
    }
    for name, table in tables.items():
        files.write_csv(table, f"{reports}/{name}")


def clean(spark: SparkSession, corpus: str, cleaned: str) -> None:
    """Wide to long, length filters, cleaned text."""
    long = reshape.drop_null_short_text(reshape.wide_to_long(files.read_parquet(spark, corpus)))
    keyed = long.withColumn(KEY, content_key("generation_method", "source", "text"))
    files.write_parquet(reshape.min_clean_length_filter(with_clean_text(keyed)), cleaned)


def statistics(spark: SparkSession, cleaned: str, reports: str) -> None:
    """Vocabulary per source, leading words and bigrams, word weights per class, as CSV tables."""
    corpus = files.read_parquet(spark, cleaned)
    tables = {
        "source_distribution": corpus_stats.count_by(corpus, "source"),
        "vocabulary_stats": corpus_stats.vocabulary_stats(corpus),
        "top_words": corpus_stats.top_words(corpus),
        "top_bigrams": corpus_stats.top_bigrams(corpus),
        "class_word_weights": corpus_stats.class_word_weights(corpus),
    }
    for name, table in tables.items():
        files.write_csv(table, f"{reports}/{name}")


def count_words(spark: SparkSession, cleaned: str, exported: str, counts: str) -> None:
    """Export the cleaned corpus as CSV and total its words as tab-separated text."""
    columns = ("source", "label", "generation_method", "char_count", "text_clean")
    files.write_csv(files.read_parquet(spark, cleaned).select(*columns), exported)
    files.write_tsv_counts(corpus_stats.delimited_word_count(files.read_csv_multiline(spark, exported)), counts)


def features(spark: SparkSession, cleaned: str, table: str, models: str, reports: str) -> None:
    """Style counts, term weights, word vectors and similarity variance, with the fitted models."""
    styled = with_style_counts(files.read_parquet(spark, cleaned))
    complete, terms, model, words = vectors.full_feature_table(styled)
    files.write_parquet(complete, table)
    store.save_model(terms, f"{models}/terms")
    store.save_model(model, f"{models}/words")
    files.write_parquet(words, f"{models}/word_table")
    stored = files.read_parquet(spark, table, complete.schema)
    names = {c.removeprefix("f_"): c for c in vectors.STYLE_COLUMNS[:5]}
    files.write_csv(corpus_stats.feature_summary(stored, "label", names), f"{reports}/style_by_label")
    files.write_csv(corpus_stats.feature_summary(stored, "source", names), f"{reports}/style_by_source")


def _training_rows(spark: SparkSession, table: str) -> DataFrame:
    return files.read_parquet(spark, table).select(*_TRAINING_COLUMNS)


def train(spark: SparkSession, table: str, models: str, reports: str, keep: str = classifiers.RANDOM_FOREST) -> str:
    """Fit the classifiers on the training split, compare them and save the one to keep."""
    split = sampling.stratified_split(_training_rows(spark, table), KEY)
    parts = {name: split.filter(F.col("split") == name).persist() for name in ("train", "validation", "test")}
    files.write_csv(corpus_stats.split_class_counts(split), f"{reports}/split_counts")
    fitted = {
        name: classifiers.train(parts["train"], estimator)
        for name, estimator in classifiers.default_estimators().items()
    }
    comparison = classifiers.model_comparison(fitted, parts["validation"], parts["test"])
    files.write_csv(comparison, f"{reports}/model_comparison")
    files.write_csv(
        classifiers.feature_importance_topk(spark, fitted[classifiers.RANDOM_FOREST]), f"{reports}/feature_importance"
    )
    best = classifiers.select_best_model(comparison, keep or None)
    store.save_model(fitted[best], f"{models}/best")
    for part in parts.values():
        part.unpersist()
    return best


def sweep(spark: SparkSession, table: str, reports: str) -> None:
    """Fit times over growing samples."""
    files.write_csv(classifiers.training_scale_sweep(_training_rows(spark, table)), f"{reports}/training_sweep")


def send(
    spark: SparkSession,
    raw: str,
    target: str,
    servers: str = "",
    column: str = "original_abstract",
    limit: int = 0,
) -> None:
    """Publish one text column of a CSV as messages, to a topic if `servers` is given, else to files.

    Rows are numbered in file order.
    """
    rows = files.read_csv_multiline(spark, raw).withColumn("__place", F.monotonically_increasing_id())
    now = F.unix_micros(F.current_timestamp()) / 1_000_000
    payload = reshape.payload_rows(rows, column, "__place", now, limit or None)
    if servers:
        messages.send_payload(payload, "kafka", **{"kafka.bootstrap.servers": servers, "topic": target})
    else:
        messages.send_payload(payload, "parquet", target)


def score_stream(
    spark: SparkSession, models: str, predictions: str, checkpoints: str, servers: str = "", topic: str = "", inbox: str = ""
) -> None:
    """Score arriving messages until stopped; an `inbox` folder is read to its end instead."""
    if servers:
        source = messages.message_stream(spark, "kafka", **messages.kafka_options(servers, topic))
    else:
        source = messages.message_stream(spark, "parquet", inbox)
    words = files.read_parquet(spark, f"{models}/word_table")
    compute = scoring.scorer(words, store.load_pipeline(f"{models}/best"))
    run = ledger.ledger_sink(source, compute, predictions, f"{checkpoints}/scores", "predictions", available_now=not servers)
    scoring.await_all([run])


def stream_accuracy(spark: SparkSession, predictions: str, reports: str) -> None:
    """Accuracy and throughput of a scored stream, as CSV tables."""
    records = ledger.read_records(spark, predictions, PREDICTION_SCHEMA)
    files.write_csv(scoring.stream_accuracy(records), f"{reports}/stream_accuracy")
    files.write_csv(ledger.throughput(ledger.read_ledger(spark, predictions)), f"{reports}/stream_throughput")


STAGES: dict[str, Callable] = {
    stage.__name__: stage
    for stage in (
        ingest, explore, clean, statistics, count_words, features, train, sweep, send, score_stream, stream_accuracy
    )
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="scriptorium.jobs")
    stages = parser.add_subparsers(dest="stage", required=True)
    for name, stage in STAGES.items():
        options = stages.add_parser(name, help=stage.__doc__)
        for option in list(inspect.signature(stage).parameters.values())[1:]:
            required = option.default is option.empty
            kind = str if required else type(option.default)
            options.add_argument(
                f"--{option.name}", required=required, type=kind, default=None if required else option.default
            )
    chosen = vars(parser.parse_args(arguments))
    STAGES[chosen.pop("stage")](build_session(), **chosen)


if __name__ == "__main__":
    main()
