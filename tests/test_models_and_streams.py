from types import SimpleNamespace

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scriptorium.operators import classifiers as c
from scriptorium.operators import corpus_stats, vectors
from scriptorium.plans import model_queries, stats_queries, stream_queries, tables
from scriptorium.session import CHECKPOINT_KEY, new_path, shared_dir, through_table
from scriptorium.sources import messages
from scriptorium.streaming import ledger, scoring


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    return model_queries.feature_table(spark, sf_dir)[0]


@pytest.fixture(scope="module")
def labelled(features):
    return features.filter("label IS NOT NULL")


def test_feature_table_keeps_rows_and_sizes(spark, sf_dir, features):
    assert features.count() == tables.feature_documents(spark, sf_dir).count() > features.filter("label IS NOT NULL").count() > 0
    sizes = features.select(
        F.size(vector_to_array("w2v_features")).alias("w"), F.size(vector_to_array("tfidf_features")).alias("t")
    ).distinct()
    assert [tuple(r) for r in sizes.collect()] == [(100, 10_000)]
    assert not {"words", "raw_features", "tokens_w2v"} & set(features.columns)


def test_vocabulary_equals_the_fitted_words(spark, sf_dir):
    fitted = model_queries.corpus_word_model(spark, sf_dir).getVectors().count()
    assert corpus_stats.vocabulary_size(tables.clean_corpus(spark, sf_dir)).first()[0] == fitted


def test_missing_scalar_is_refused(spark, features):
    broken = features.withColumn("f_colons", F.lit(None).cast("int"))
    with pytest.raises(Exception, match="null"):
        vectors.assembler().transform(broken).collect()


@pytest.mark.parametrize(
    "make, size", [(c.logistic_regression, (5,)), (c.random_forest, (3, 3)), (c.gradient_boosted, (2, 2))]
)
def test_training_is_repeatable_and_probabilities_add_up(features, labelled, make, size):
    first, second = (c.batch_score(c.train(labelled, make(*size)), features).orderBy("doc_id") for _ in range(2))
    rows = [(r.doc_id, r.prediction, list(r.probability)) for r in first.collect()]
    again = [(r.doc_id, r.prediction, list(r.probability)) for r in second.collect()]
    assert len(rows) == features.count()
    for (a, p, u), (b, q, v) in zip(rows, again):
        assert (a, p) == (b, q) and u == pytest.approx(v) and sum(u) == pytest.approx(1.0)


def test_quality_and_choice_of_model(spark, labelled):
    model = c.train(labelled, c.random_forest(3, 3))
    q = c.quality(c.batch_score(model, labelled))
    assert all(0 <= x <= 1 for x in (q.accuracy, q.f1, q.roc_auc))
    table = c.model_comparison({"a": model}, labelled, labelled)
    assert c.select_best_model(table) == "a" and c.select_best_model(table, prefer="b") == "b"
    top = c.feature_importance_topk(spark, model, 5).collect()
    assert len(top) == 5 and top[0].importance >= top[4].importance


def test_sweep_reports_every_fraction(labelled):
    rows = c.training_scale_sweep(labelled, (0.5, 1.0), trees=2, depth=2, max_iter=2).collect()
    assert [r.fraction for r in rows] == [0.5, 1.0] and rows[1].rows == labelled.count()


def test_stream_scores_equal_batch_scores(spark, sf_dir):
    streamed = stream_queries.scored_stream(spark, sf_dir)[0]
    words, forest = stream_queries._models(spark, sf_dir)
    assert words.count() > 1000
    stored = spark.read.parquet(stream_queries.message_files(spark, sf_dir))
    batch = scoring.score_messages(stored, words, forest)
    assert [(f.name, f.dataType) for f in streamed.schema] == [(f.name, f.dataType) for f in batch.schema]
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    assert streamed.filter(F.col("text_preview").isNull()).count() == 4


def test_kafka_options_name_servers_topic_and_start():
    assert messages.kafka_options("host:1", "texts") == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "texts",
        "startingOffsets": "latest",
    }


def test_a_failing_query_stops_the_others(spark):
    rate = spark.readStream.format("rate").load()
    bad = rate.select(F.raise_error(F.lit("broken")).cast("string").alias("x"))
    runs = [
        messages.parquet_sink(df, None, new_path(spark, "out"), new_path(spark, "ckpt"), every="1 second")
        for df in (rate, bad)
    ]
    with pytest.raises(Exception, match="broken"):
        scoring.await_all(runs)
    assert not any(run.isActive for run in runs)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get(CHECKPOINT_KEY)
    assert new_path(spark, "a").startswith(shared_dir(spark)) and new_path(spark, "a") != new_path(spark, "a")
    stored = through_table(spark.range(3), "ids")
    assert stored.count() == 3 and all(shared_dir(spark) in f for f in stored.inputFiles())


def test_only_a_local_session_may_do_without_a_shared_folder():
    def session(master):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}")
        return SimpleNamespace(conf={}, sparkContext=context)

    assert shared_dir(session("local[2]")) == shared_dir(session("local[2]"))
    with pytest.raises(ValueError, match=CHECKPOINT_KEY):
        shared_dir(session("spark://host:7077"))


def arriving_messages(spark, rows, files):
    path = new_path(spark, "arriving")
    spark.range(0, rows, 1, files).selectExpr("encode(id, 'UTF-8') AS value", "timestamp_seconds(id) AS timestamp").write.parquet(path)
    return path


SCHEMA = StructType().add("n", "long").add("at", "timestamp")


def numbers(batch):
    return batch.select(F.decode("value", "UTF-8").cast("bigint").alias("n"), F.col("timestamp").alias("at"))


def run_to_end(spark, arriving, path, checkpoint, compute=numbers, **options):
    stream = messages.message_stream(spark, "parquet", arriving, maxFilesPerTrigger="1")
    sink = ledger.ledger_sink(stream, compute, path, checkpoint, available_now=True, **options)
    scoring.await_all([sink])


def stored_numbers(spark, path):
    return sorted(r.n for r in ledger.read_records(spark, path, SCHEMA).collect())


def test_ledger_has_every_batch_under_its_id(spark):
    arriving, path, shown = arriving_messages(spark, 360, 120), new_path(spark, "numbers"), []
    run_to_end(spark, arriving, path, new_path(spark, "ckpt"), rows=2, show=lambda rows: shown.append(len(rows)))
    rows = ledger.throughput(ledger.read_ledger(spark, path)).collect()
    assert sorted((r.batch_id, r.n_rows) for r in rows) == [(i, 3) for i in range(120)]
    assert all(r.seconds > 0 and r.rows_per_second > 0 for r in rows) and shown == [2] * 120
    assert stored_numbers(spark, path) == list(range(360))


def test_empty_batches_are_in_the_ledger(spark):
    arriving, path = arriving_messages(spark, 12, 4), new_path(spark, "some")
    run_to_end(spark, arriving, path, new_path(spark, "ckpt"), lambda batch: numbers(batch).filter("n < 3"), show=lambda rows: None)
    rows = ledger.read_ledger(spark, path).collect()
    assert sorted((r.n_rows, r.n_shown) for r in rows) == [(0, 0)] * 3 + [(3, 3)]
    assert stored_numbers(spark, path) == [0, 1, 2]


@pytest.mark.parametrize("point", ["before", "stored", "shown"])
def test_a_failure_at_any_point_loses_and_doubles_nothing(spark, point):
    arriving, path, checkpoint = arriving_messages(spark, 15, 5), new_path(spark, "numbers"), new_path(spark, "ckpt")
    failed = []

    def fail(where, batch_id=2):
        if point == where and not failed and batch_id == 2:
            failed.append(True)
            raise RuntimeError("broken")

    seen = []

    def compute(batch):
        seen.append(len(seen))
        fail("before", len(seen) - 1)
        return numbers(batch)

    options = {"show": lambda rows: fail("shown", len(seen) - 1), "stored": lambda batch_id: fail("stored", batch_id)}
    with pytest.raises(Exception, match="broken"):
        run_to_end(spark, arriving, path, checkpoint, compute, **options)
    assert len(stored_numbers(spark, path)) == 6
    run_to_end(spark, arriving, path, checkpoint, compute, **options)
    assert stored_numbers(spark, path) == list(range(15))
    assert sorted(r.batch_id for r in ledger.read_ledger(spark, path).collect()) == list(range(5))


def test_a_table_belongs_to_one_checkpoint(spark):
    arriving, path = arriving_messages(spark, 3, 1), new_path(spark, "numbers")
    run_to_end(spark, arriving, path, new_path(spark, "ckpt"), show=lambda rows: None)
    with pytest.raises(Exception, match="belongs to the checkpoint"):
        run_to_end(spark, arriving, path, new_path(spark, "ckpt"), show=lambda rows: None)
    assert stored_numbers(spark, path) == [0, 1, 2]
    assert ledger.read_ledger(spark, new_path(spark, "nothing")).count() == 0


def test_the_console_gets_heads_only(spark):
    arriving = arriving_messages(spark, 360, 120)
    stream = messages.message_stream(spark, "parquet", arriving)
    shown = messages.console_sink(stream, None, new_path(spark, "ckpt"), rows=2, available_now=True)
    scoring.await_all([shown])
    progress = shown.lastProgress
    tasks = spark.read.parquet(arriving).rdd.getNumPartitions()
    assert progress["numInputRows"] == 360 and progress["sink"]["numOutputRows"] <= 2 * tasks


def test_restarted_stream_writes_a_file_per_task(spark, sf_dir, monkeypatch):
    folders = []
    whole = messages.message_stream
    monkeypatch.setattr(messages, "message_stream", lambda s, f, path, **options: folders.append(path) or whole(s, f, path, **options))
    stream_queries.stream_restart(spark, sf_dir)
    files = spark.read.parquet(folders[0]).select("_metadata.file_path").distinct().count()
    assert len(set(folders)) == 1 and files > 6


def test_variance_of_the_corpus_cleans_its_texts_once(spark, sf_dir, monkeypatch):
    calls = []
    whole = tables.clean_corpus
    monkeypatch.setattr(tables, "clean_corpus", lambda *given: calls.append(1) or whole(*given))
    stats_queries.style_with_variance(spark, f"{sf_dir}/.")
    assert len(calls) == 1
