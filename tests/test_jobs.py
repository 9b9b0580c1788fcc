"""The stages one after another on a small corpus, each reading what the one before wrote."""

from scriptorium import jobs
from scriptorium.functions.messages import PREDICTION_SCHEMA
from scriptorium.operators import classifiers, corpus_stats
from scriptorium.operators.reshape import GENERATION_METHODS
from scriptorium.plans import tables
from scriptorium.sources import files
from scriptorium.streaming import ledger


def test_stages_from_csv_to_stream_scores(spark, sf_dir, tmp_path, monkeypatch):
    at = {
        name: str(tmp_path / name)
        for name in "raw corpus cleaned exported counts table models reports inbox predictions checkpoints".split()
    }
    for method in GENERATION_METHODS:
        split = tables.wide_split(spark, sf_dir, method).drop("row_id")
        files.write_csv(split, f"{at['raw']}/{method}.csv")

    small = {
        classifiers.LOGISTIC_REGRESSION: lambda: classifiers.logistic_regression(5),
        classifiers.RANDOM_FOREST: lambda: classifiers.random_forest(4, 4),
    }
    monkeypatch.setattr(classifiers, "default_estimators", lambda: {n: make() for n, make in small.items()})

    def run(stage, *names, **more):
        return jobs.STAGES[stage](spark, **{n: at[n] for n in names}, **more)

    run("ingest", "raw", "corpus")
    run("explore", "corpus", "reports")
    run("clean", "corpus", "cleaned")
    run("statistics", "cleaned", "reports")
    run("count_words", "cleaned", "exported", "counts")
    run("features", "cleaned", "table", "models", "reports")
    assert run("train", "table", "models", "reports") == classifiers.RANDOM_FOREST
    jobs.send(spark, f"{at['raw']}/{GENERATION_METHODS[0]}.csv", at["inbox"], limit=10)
    run("score_stream", "models", "predictions", "checkpoints", "inbox")
    run("stream_accuracy", "predictions", "reports")

    direct = tables.clean_corpus(spark, sf_dir)
    cleaned = spark.read.parquet(at["cleaned"])
    assert cleaned.count() == direct.count()
    assert cleaned.select("text_clean").exceptAll(direct.select("text_clean")).isEmpty()
    counted = files.read_tsv_counts(spark, at["counts"])
    check = corpus_stats.word_count_crosscheck(counted, corpus_stats.word_frequency(direct)).first()
    assert check.n_words > 1000 and check.n_mismatches == 0
    assert spark.read.parquet(at["table"]).count() == cleaned.count()
    scored = ledger.read_records(spark, at["predictions"], PREDICTION_SCHEMA)
    assert sorted(r.id for r in scored.collect()) == list(range(10))
    total = files.read_csv_multiline(spark, f"{at['reports']}/stream_accuracy").filter("true_source = 'TOTAL'").first()
    assert total.n_rows == "10"
    names = "stream_throughput split_row_counts null_counts vocabulary_stats top_words model_comparison feature_importance style_by_label"
    for name in names.split():
        assert files.read_csv_multiline(spark, f"{at['reports']}/{name}").count() > 0
