"""Registered queries: streams over a file source, run to the end of their input and read back."""

from __future__ import annotations

import contextlib

from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scriptorium.functions.messages import PREDICTION_SCHEMA, parse_messages, prediction_record
from scriptorium.functions.text import text_preview
from scriptorium.operators.word_moments import word_table
from scriptorium.plans import oracle_sql as o
from scriptorium.plans import tables as t
from scriptorium.plans.catalog import query
from scriptorium.plans.model_queries import built_once, stored_corpus, stored_models
from scriptorium.session import new_path
from scriptorium.sources import messages
from scriptorium.sources import models as store
from scriptorium.streaming import ledger, scoring

_FEWEST_FILES_PER_BATCH = 4
_BATCHES_PER_RUN = 4


def message_files(spark, sf_dir):
    """The messages as files, written once per application."""

    def build():
        path = new_path(spark, "messages")
        t.envelopes(spark, sf_dir).write.parquet(path)
        return path

    return built_once(spark, sf_dir, "messages", build)


def source(spark, sf_dir):
    """The messages as a stream, whose batches keep all cores busy."""
    files = max(_FEWEST_FILES_PER_BATCH, spark.sparkContext.defaultParallelism)
    return messages.message_stream(spark, "parquet", message_files(spark, sf_dir), maxFilesPerTrigger=str(files))


def run_to_table(records, name):
    """Run a stream over all available input into a new table and return that table."""
    spark = records.sparkSession
    path = new_path(spark, name)
    running = messages.parquet_sink(records, None, path, new_path(spark, f"{name}-checkpoint"), available_now=True)
    scoring.await_all([running])
    return spark.read.schema(records.schema).parquet(path), running


def _seconds(df):
    """Ingest time as whole seconds, and -1 for a missing id, so that rows compare plainly."""
    return df.withColumn("ingest_seconds", F.unix_seconds("ingest_time")).drop("ingest_time").withColumn(
        "id", F.coalesce("id", F.lit(-1))
    )


_MESSAGE_ROWS = o.with_ctes(
    "SELECT coalesce(id, -1) AS id, text, true_source, timestamp, ingest_seconds FROM messages", o.MESSAGES
)


@query(
    "kafka_source",
    o.with_ctes("SELECT ingest_seconds, count(*) AS n_messages FROM messages GROUP BY ingest_seconds", o.MESSAGES),
)
def kafka_source(spark, sf_dir):
    received, _ = run_to_table(source(spark, sf_dir), "received")
    return received.groupBy(F.unix_seconds("timestamp").alias("ingest_seconds")).agg(F.count("value").alias("n_messages"))


@query("stream_parse", _MESSAGE_ROWS)
def stream_parse(spark, sf_dir):
    return _seconds(run_to_table(parse_messages(source(spark, sf_dir)), "parsed")[0])


@query(
    "stream_parquet_sink",
    o.with_ctes("SELECT coalesce(id, -1) AS id, true_source, ingest_seconds FROM messages", o.MESSAGES),
)
def stream_parquet_sink(spark, sf_dir):
    records = parse_messages(source(spark, sf_dir)).select("id", "true_source", "ingest_time")
    return _seconds(run_to_table(records, "sink")[0])


def run_ledger(spark, sf_dir, compute, name, **options):
    """Run the messages through a ledger sink to their end; the path of its table."""
    path = new_path(spark, name)
    run = ledger.ledger_sink(
        source(spark, sf_dir), compute, path, new_path(spark, f"{name}-checkpoint"), available_now=True, **options
    )
    scoring.await_all([run])
    return path


@query("stream_console_sink", o.with_ctes("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_unseen FROM messages", o.MESSAGES))
def stream_console_sink(spark, sf_dir):
    """Rows of the batches that were shown, and how many batches with rows showed too few of them.

    A batch is counted by the ledger, which names it after it was printed.
    """
    path = run_ledger(spark, sf_dir, lambda batch: parse_messages(batch).select("id", "true_source", "ingest_time"), "console")
    too_few = F.col("n_shown") < F.least(F.col("n_rows"), F.lit(ledger.SHOWN_ROWS))
    return ledger.read_ledger(spark, path).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(too_few.cast("bigint")), F.lit(0)).alias("n_unseen")
    )


@query(
    "stream_features",
    o.with_ctes(
        "SELECT coalesce(id, -1) AS id, ingest_seconds, text_clean, CAST(length(text_clean) AS INTEGER) AS char_count, "
        f"{o.word_count('text_clean')} AS word_count, {o.STYLE} "
        f"FROM (SELECT *, {o.preprocess('text')} AS text_clean FROM messages)",
        o.MESSAGES,
    ),
)
def stream_features(spark, sf_dir):
    featured = scoring.stream_features(parse_messages(source(spark, sf_dir)))
    return _seconds(run_to_table(featured, "featured")[0]).drop("text", "true_source", "timestamp")


def _models(spark, sf_dir):
    """The stored word table and the saved forest."""
    _, forest, words = stored_models(spark, sf_dir)
    return words, store.load_pipeline(forest)


def _message_vectors(spark, sf_dir):
    words = t.word_vectors(spark, sf_dir, stored_corpus(spark, sf_dir))

    def vectors(batch):
        featured = scoring.stream_features(parse_messages(batch)).select("id", "ingest_time", "text_clean")
        made = scoring.stream_vectors(featured, stored, t.VECTOR_DIMS)
        return made.select("id", "ingest_time", "f_embed_variance", vector_to_array("w2v_features").alias("vector"))

    stored = built_once(spark, sf_dir, "word table", lambda: word_table(words))
    return vectors


@query(
    "stream_vectors",
    o.with_ctes(
        "SELECT id, ingest_seconds, round(CAST(coalesce(f_embed_variance, 0) AS DOUBLE), 6) AS f_embed_variance, n_dims, "
        "round(coalesce(total, 0), 6) AS vector_total FROM vector_messages LEFT JOIN variances USING (m) LEFT JOIN means USING (m)",
        o.MESSAGE_VECTORS,
    ),
)
def stream_vectors(spark, sf_dir):
    """Mean vectors and variances of the messages' own words, over the word table that the embeddings give."""
    compute = _message_vectors(spark, sf_dir)
    path = run_ledger(spark, sf_dir, compute, "vectors")
    schema = StructType.fromDDL("id bigint, ingest_time timestamp, f_embed_variance float, vector array<double>")
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return _seconds(ledger.read_records(spark, path, schema)).select(
        "id",
        "ingest_seconds",
        F.round(F.col("f_embed_variance").cast("double"), 6).alias("f_embed_variance"),
        F.size("vector").alias("n_dims"),
        F.round(total, 6).alias("vector_total"),
    )


def scored_stream(spark, sf_dir):
    """The predictions of the saved forest over all messages, and the path of their table."""

    def build():
        path = run_ledger(spark, sf_dir, scoring.scorer(*_models(spark, sf_dir)), "predictions")
        return ledger.read_records(spark, path, PREDICTION_SCHEMA), path

    return built_once(spark, sf_dir, "stream predictions", build)


@query(
    "stream_score",
    o.with_ctes(
        "SELECT coalesce(id, -1) AS id, true_source, substr(text, 1, 80) AS text_preview, CAST(1 AS INTEGER) AS decided, ingest_seconds FROM messages",
        o.MESSAGES,
    ),
)
def stream_score(spark, sf_dir):
    """Every message with its prediction; `decided` tells that label and class agree."""
    decided = (F.col("predicted_class") == F.when(F.col("predicted_label") == 0, "human").otherwise("ai")).cast("int")
    scored = _seconds(scored_stream(spark, sf_dir)[0]).withColumn("decided", decided)
    return scored.drop("predicted_label", "predicted_class")


@query("stream_throughput")
def stream_throughput(spark, sf_dir):
    return ledger.throughput(ledger.read_ledger(spark, scored_stream(spark, sf_dir)[1]))


@query(
    "stream_batch_totals",
    o.with_ctes("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_missing_batches FROM messages", o.MESSAGES),
)
def stream_batch_totals(spark, sf_dir):
    """Rows of all metered micro-batches, and how many batch ids between 0 and the last have no entry."""
    batches = stream_throughput(spark, sf_dir)
    missing = F.coalesce(F.max("batch_id") + 1 - F.count_distinct("batch_id"), F.lit(0))
    return batches.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), missing.cast("bigint").alias("n_missing_batches"))


@query(
    "stream_dual_sink",
    o.with_ctes(
        "SELECT coalesce(id, -1) AS id, true_source, substr(text, 1, 80) AS text_preview, ingest_seconds FROM messages",
        o.MESSAGES,
    ),
)
def stream_dual_sink(spark, sf_dir):
    """Each micro-batch is computed once, for the table and for the rows that are shown."""

    def records(batch):
        return parse_messages(batch).select("id", "true_source", text_preview("text").alias("text_preview"), "ingest_time")

    path = run_ledger(spark, sf_dir, records, "dual")
    schema = StructType.fromDDL("id bigint, true_source string, text_preview string, ingest_time timestamp")
    return _seconds(ledger.read_records(spark, path, schema))


class _Interrupted(Exception):
    pass


@query("stream_restart", _MESSAGE_ROWS)
def stream_restart(spark, sf_dir):
    """A run that fails between storing its second batch and naming it, more messages, and a run to the end.

    Nothing is lost and nothing is there twice.
    """
    arriving, path, checkpoint = (new_path(spark, n) for n in ("arriving", "resumed", "resumed-checkpoint"))
    everything = t.envelopes(spark, sf_dir)
    early = F.unix_seconds("timestamp") % 2 == 0
    # A file per task that reads the documents, so that no task holds a fixed share of them.
    files = everything.rdd.getNumPartitions()

    def run(stored=None):
        at_once = max(1, files // _BATCHES_PER_RUN)
        messages_so_far = messages.message_stream(spark, "parquet", arriving, maxFilesPerTrigger=str(at_once))
        sink = ledger.ledger_sink(
            messages_so_far, parse_messages, path, checkpoint, available_now=True, stored=stored
        )
        scoring.await_all([sink])

    def fail(batch_id):
        if batch_id == 1:
            raise _Interrupted

    everything.filter(early).write.mode("append").parquet(arriving)
    with contextlib.suppress(StreamingQueryException):
        run(fail)
    everything.filter(~early).write.mode("append").parquet(arriving)
    run()
    schema = parse_messages(spark.read.parquet(arriving).limit(0)).schema
    return _seconds(ledger.read_records(spark, path, schema))


@query(
    "stream_accuracy",
    o.with_ctes(
        "SELECT coalesce(true_source, 'TOTAL') AS true_source, count(*) AS n_rows, round(avg(CASE WHEN true_source = "
        "CASE WHEN length(text) % 2 = 0 THEN 'human' ELSE 'ai' END THEN 1 ELSE 0 END), 6) AS accuracy "
        "FROM messages WHERE true_source IS NOT NULL GROUP BY ROLLUP (true_source)",
        o.MESSAGES,
    ),
)
def stream_accuracy(spark, sf_dir):
    """Accuracy over saved predictions; a fixed rule predicts here, so that SQL can repeat it."""
    parsed = parse_messages(source(spark, sf_dir))
    ruled = parsed.withColumn("prediction", (F.length("text") % 2).cast("double"))
    predictions, _ = run_to_table(prediction_record(ruled), "ruled")
    return scoring.stream_accuracy(predictions).withColumn("accuracy", F.round("accuracy", 6))
