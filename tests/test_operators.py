import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.feature import Tokenizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from scriptorium.functions.messages import message_json, parse_messages, predicted_class
from scriptorium.functions.text import ml_tokenize
from scriptorium.operators import corpus_stats as stats
from scriptorium.operators import partial_states as states
from scriptorium.operators import heavy_hitters, metrics, projected_vectors, reshape, sampling, similarity, vectors, word_moments
from scriptorium.plans import io_queries, tables
from scriptorium.plans.bounds import fits_in_memory, join_words
from scriptorium.plans.prefix import with_row_numbers, with_running_totals
from scriptorium.sources import files, split_csv
from scriptorium.session import new_path, through_table


def test_wide_to_long_equals_direct_derivation(spark, sf_dir):
    columns = ["text", "label", "source", "generation_method"]
    long = reshape.wide_to_long(tables.wide_corpus(spark, sf_dir)).select(columns)
    direct = tables.long_corpus(spark, sf_dir).select(columns)
    assert long.count() == 200
    assert long.exceptAll(direct).isEmpty() and direct.exceptAll(long).isEmpty()


def test_length_filters_are_strict(spark):
    rows = spark.createDataFrame([("x" * 10,), ("x" * 11,), (None,)], "text string")
    assert [r.text for r in reshape.drop_null_short_text(rows).collect()] == ["x" * 11]
    counted = spark.createDataFrame([(20,), (21,)], "char_count int")
    assert [r.char_count for r in reshape.min_clean_length_filter(counted).collect()] == [21]


def test_payload_rows_number_only_sent_texts(spark):
    rows = [(1, " a "), (2, None), (3, " \t"), (4, "b"), (9, "c")]
    df = spark.createDataFrame(rows, "k int, original_abstract string")
    sent = reshape.payload_rows(df, "original_abstract", "k", F.lit(5)).orderBy("id").collect()
    assert [(r.id, r.text, r.true_source, r.timestamp) for r in sent] == [
        (0, "a", "human", 5.0),
        (1, "b", "human", 5.0),
        (2, "c", "human", 5.0),
    ]
    limited = reshape.payload_rows(df.withColumnRenamed("original_abstract", "body"), "body", "k", F.lit(5), limit=2)
    assert sorted((r.id, r.text, r.true_source) for r in limited.collect()) == [(0, "a", "ai"), (1, "b", "ai")]


def test_missing_prediction_is_ai(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double").select(predicted_class(F.col("p")).alias("c"))
    assert [r.c for r in df.collect()] == ["human", "ai", "ai"]


def test_malformed_messages_stay_as_null_rows(spark):
    values = ['{"id":1,"text":"t","true_source":"ai","timestamp":2.5}', "nonsense", '{"id":"x","text":"t"}']
    df = spark.createDataFrame([(v,) for v in values], "v string").select(
        F.encode("v", "UTF-8").alias("value"), F.current_timestamp().alias("timestamp")
    )
    got = [tuple(r)[:4] for r in parse_messages(df).collect()]
    assert got == [(1, "t", "ai", 2.5), (None, None, None, None), (None, "t", None, None)]
    assert parse_messages(df, drop_malformed=True).count() == 2


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets", [1, 5])
def test_running_totals(spark, descending, buckets):
    rng = random.Random(3)
    rows = [(float(k), rng.randint(-5, 5)) for k in rng.sample(range(10_000), 500)]
    df = spark.createDataFrame(rows, "k double, v int").repartition(6)
    got = {r.k: r.t for r in with_running_totals(df, "k", {"t": "v"}, descending, buckets).collect()}
    total = 0
    for k, v in sorted(rows, reverse=descending):
        total += v
        assert got[k] == total


def test_row_numbers(spark):
    df = spark.range(0, 3000, 3).repartition(7)
    assert sorted((r.id, r.row_id) for r in with_row_numbers(df, "id").collect()) == [(3 * i, i) for i in range(1000)]


def test_word_count_skips_what_it_cannot_use(spark):
    short = spark.createDataFrame([("a", "b")], "x string, y string")
    assert stats.delimited_word_count(short).count() == 0
    by_place = spark.createDataFrame([("s", "l", "g", "n", "b a  b"), ("s", "l", "g", "n", None)], "a string, b string, c string, d string, e string")
    assert [tuple(r) for r in stats.delimited_word_count(by_place).collect()] == [("a", 1), ("b", 2)]
    lines = spark.createDataFrame([("w\t2",), ("w\t 3 ",), ("w\tx",), ("alone",), ("",), ("v\t1\t1",)], "value string")
    assert [tuple(r) for r in stats.sum_count_pairs(lines).collect()] == [("w", 5)]


def test_missing_abstracts_count_as_minus_one_word(spark):
    df = spark.createDataFrame([("a b",), (None,)], "t string")
    assert tuple(stats.word_count_stats(df, ["t"]).first()) == ("t", 0.5, -1, 2)
    assert tuple(stats.word_count_stats(df, ["t"], legacy_null_size=False).first()) == ("t", 2.0, 2, 2)
    empty = spark.createDataFrame([(None, "abc")], "a string, b string")
    assert [tuple(r) for r in stats.avg_length_per_column(empty, ["a", "b"]).collect()] == [("b", 3.0)]


def test_vocabulary_of_texts_without_words(spark):
    df = spark.createDataFrame([("s", "", 1), ("t", "a b a", 3)], "source string, text_clean string, word_count int")
    got = {r.source: tuple(r)[1:] for r in stats.vocabulary_stats(df).collect()}
    assert got == {"s": (0, 0, 0.0, 1.0), "t": (3, 2, 2 / 3, 3.0)}


def test_class_word_weights_can_sample_documents(spark):
    df = spark.createDataFrame([(1, "human", "a a b"), (2, "human", "c c c"), (3, "jais", "d")], "doc_id int, source string, text_clean string")
    got = {(r["class"], r.word): r.weight for r in stats.class_word_weights(df, documents=1).collect()}
    assert got == {("human", "a"): 1.0, ("human", "b"): 0.5, ("ai", "d"): 1.0}


def test_samples_have_exact_sizes_and_ignore_partitioning(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    draws = []
    for parts in (1, 9):
        sample = sampling.stratified_fixed_sample(df.repartition(parts), "label", "id", {0: 1600, 1: 400})
        rows = {(r.label, r.id) for r in sample.collect()}
        assert sum(label == 0 for label, _ in rows) == 1600 and sum(label == 1 for label, _ in rows) == 400
        draws.append(rows)
    assert draws[0] == draws[1]
    small = sampling.stratified_fixed_sample(df, "label", "id", {0: 10, 1: 99_999})
    assert {r.label: r.n for r in small.groupBy("label").agg(F.count("*").alias("n")).collect()} == {0: 10, 1: 1000}


def test_holdout_keeps_class_shares_exactly(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") < 3, 1).otherwise(0).alias("label"))
    split = sampling.stratified_holdout(df, "label", "id").groupBy("label", "split").count().collect()
    assert {(r.label, r.split): r["count"] for r in split} == {(0, "train"): 700, (0, "test"): 300, (1, "train"): 2, (1, "test"): 1}


def test_random_split_covers_every_row_once(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).cast("int").alias("label"))
    parts = sampling.random_stratified_split(df, "label")
    ids = sorted(r.id for part in parts for r in part.collect())
    assert ids == list(range(1000))
    assert [p.count() for p in sampling.random_stratified_split(df, "label")] == [p.count() for p in parts]


def brute_variance(vecs):
    if len(vecs) < 2:
        return 0.0
    unit = [v / (np.linalg.norm(v) or 1.0) for v in vecs]
    return float(np.var([unit[i] @ unit[j] for i in range(len(unit)) for j in range(i)]))


@pytest.fixture(scope="module")
def words(spark):
    rng = np.random.default_rng(5)
    table = {f"w{i}": rng.normal(size=6) for i in range(40)}
    table["zero"] = np.zeros(6)
    df = spark.createDataFrame([(w, Vectors.dense(v)) for w, v in table.items()], ["word", "vector"])
    return table, df.cache()


@pytest.fixture(scope="module")
def token_docs(spark):
    rng = random.Random(11)
    names = [f"w{i}" for i in range(45)] + ["zero"]
    docs = [(i, rng.choices(names, k=rng.randint(0, 60))) for i in range(80)]
    docs += [(1000, ["w1"]), (1001, ["w1", "w2"]), (1002, ["w1", "w1", "w1"]), (1003, []), (1004, ["none", "w3"])]
    return docs, spark.createDataFrame(docs, "doc_id int, tokens array<string>").repartition(5).cache()


def moments(df, vec_df):
    return word_moments.with_word_moments(df, "tokens", word_moments.word_table(vec_df), 6)


@pytest.mark.parametrize("slice_rows, doubles", [(1000, 4 << 20), (7, 40)])
def test_document_moments_equal_the_pairwise_form(words, token_docs, monkeypatch, slice_rows, doubles):
    table, vec_df = words
    docs, df = token_docs
    monkeypatch.setattr(word_moments, "SLICE_ROWS", slice_rows)
    out = moments(df, vec_df)
    assert dict(out.dtypes)["f_embed_variance"] == "float" and out.columns[:2] == ["doc_id", "tokens"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(docs)
    for key, tokens in docs:
        known = [table[w] for w in tokens if w in table]
        assert got[key].f_embed_variance == pytest.approx(brute_variance(known), abs=1e-6)
        mean = np.sum(known, axis=0) / len(tokens) if known else np.zeros(6)
        assert list(got[key].w2v_features) == pytest.approx(list(mean), abs=1e-6)


def test_moments_in_small_pieces_equal_the_whole(words, token_docs, monkeypatch):
    table, _ = words
    docs, _ = token_docs
    names = list(table)
    unit = word_moments.unit_rows(np.array([table[w] for w in names]))
    pairs = [(i, names.index(w)) for i, (_, tokens) in enumerate(docs) for w in tokens if w in table]
    doc, word = np.array(pairs).T
    whole = word_moments.pair_variances(unit, doc, word, len(docs))
    means = word_moments.mean_vectors(unit, doc, word, np.ones(len(docs)))
    monkeypatch.setattr(word_moments, "_HELD_DOUBLES", 50)
    assert word_moments.pair_variances(unit, doc, word, len(docs)) == pytest.approx(whole)
    assert word_moments.mean_vectors(unit, doc, word, np.ones(len(docs))) == pytest.approx(means)


def test_rows_of_one_key_get_the_moments_of_their_own_tokens(spark, words):
    table, vec_df = words
    rows = [["w1", "w2", "w3"], ["w4", "w5", "w6", "w7"], ["w1", "w2", "w3"], None]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(rows)], "doc_id int, place int, tokens array<string>")
    got = {r.place: r.f_embed_variance for r in moments(df, vec_df).collect()}
    assert got == {i: pytest.approx(brute_variance([table[w] for w in t or []]), abs=1e-6) for i, t in enumerate(rows)}
    assert moments(df.limit(0), vec_df).count() == 0
    assert [r.f_embed_variance for r in moments(df, vec_df.limit(0)).collect()] == [0.0] * 4


def test_means_alone_neither_form_variances_nor_send_tokens_back(spark, words, token_docs, monkeypatch):
    table, vec_df = words
    docs, df = token_docs
    monkeypatch.setattr(word_moments, "pair_variances", None)
    stored = word_moments.word_table(vec_df)
    out = word_moments.with_word_moments(df, "tokens", stored, 6, variance=None, keep_tokens=False)
    assert "tokens" not in out.columns and "f_embed_variance" not in out.columns
    got = {r.doc_id: (r.n_tokens, r.mean_vector) for r in vectors.mean_word_vector(df, "doc_id", "tokens", stored, 6).collect()}
    for key, tokens in docs:
        known = [table[w] for w in tokens if w in table]
        assert got[key][0] == len(tokens)
        assert got[key][1] == pytest.approx(list(np.sum(known, axis=0) / len(tokens) if known else np.zeros(6)), abs=1e-6)


def test_terms_hashed_once_weigh_like_those_of_the_pipeline(spark, monkeypatch):
    rows = [(i, "a b b" if i < 6 else "c  d" if i < 8 else "") for i in range(9)]
    docs = spark.createDataFrame([*rows, (0, "a b b")], "id int, text_clean string")
    stored = []
    monkeypatch.setattr(vectors, "through_table", lambda df, name: stored.append(through_table(df, name)) or stored[-1])
    weighted, model = vectors.tfidf_fit_transform(docs)
    whole = vectors.tfidf_fit(docs)
    assert stored[0].columns == ["id", "raw_features"]
    assert sorted(map(str, weighted.collect())) == sorted(map(str, whole.transform(docs).select("id", "tfidf_features").collect()))
    assert model.stages[-1].idf == whole.stages[-1].idf


def test_word_table_of_any_size_serves_without_a_broadcast(spark):
    rng = np.random.default_rng(3)
    size = 60_000
    numbers = spark.range(size).select(F.concat(F.lit("v"), "id").alias("word"), *(F.rand(i).alias(f"x{i}") for i in range(6)))
    stored = word_moments.word_table(numbers.select("word", F.array(*(f"x{i}" for i in range(6))).alias("vector")))
    table = {r.word: np.array(r.vector) for r in stored.collect()}
    docs = [(i, [f"v{n}" for n in rng.integers(0, size, 40)]) for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id int, tokens array<string>")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = word_moments.with_word_moments(df, "tokens", stored, 6)
        got = {r.doc_id: r.f_embed_variance for r in out.collect()}
        plan = out._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Broadcast" not in plan
    for key, tokens in docs:
        assert got[key] == pytest.approx(brute_variance([table[w] for w in tokens]), abs=1e-6)


def test_group_variance_with_one_hot_group(spark):
    rng = np.random.default_rng(2)
    rows = [(0 if i % 3 else i % 7, [float(x) for x in rng.normal(size=5)]) for i in range(400)] + [(9, [0.0] * 5), (9, [1.0] * 5), (10, [1.0] * 5)]
    df = spark.createDataFrame(rows, "g int, v array<double>").repartition(6)
    got = {r.g: r.f_embed_variance for r in similarity.group_similarity_variance(df, "g", "v", 5).collect()}
    for g in {r[0] for r in rows}:
        assert got[g] == pytest.approx(brute_variance([np.array(v) for k, v in rows if k == g]), abs=1e-6)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_broadcast_join(spark, how):
    pairs = spark.createDataFrame([(i, "hot" if i % 3 else f"w{i}", i) for i in range(300)], "doc int, word string, n int")
    table = spark.createDataFrame([("hot", 1), ("w3", 2), ("w9", 3)], "word string, x int")
    assert fits_in_memory(table, 10, 100) and not fits_in_memory(table, 10, 20)
    assert fits_in_memory(table, 10, 37, ("word",)) and not fits_in_memory(table, 10, 36, ("word",))
    columns = ["doc", "word", "n", "x"]
    small = join_words(pairs, table, 10, how).select(columns)
    for rows_per_task in (7, 1000):
        large = join_words(pairs, table, 10, how, max_bytes=1, rows_per_task=rows_per_task).select(columns)
        assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_mean_vector_divides_by_all_tokens_as_mllib_does(spark):
    docs = spark.createDataFrame([(1, "a b a zzz".split()), (2, ["zzz"]), (3, [])], "id int, tokens array<string>")
    train = spark.createDataFrame([(("a b c a b c " * 20).split(),)], "tokens array<string>")
    model = vectors.word2vec_fit(train, "tokens", vector_size=4, partitions=1)
    mllib = {r.id: list(r.w2v_features) for r in model.transform(docs).collect()}
    ours = vectors.mean_word_vector(docs, "id", "tokens", word_moments.word_table(model.getVectors()), 4)
    got = {r.id: (r.n_tokens, r.mean_vector) for r in ours.collect()}
    assert {k: v[0] for k, v in got.items()} == {1: 4, 2: 1, 3: 0}
    for key, vector in mllib.items():
        assert got[key][1] == pytest.approx(vector, abs=1e-6)


def test_term_weights_equal_the_formula(spark):
    docs = [(i, ["x", "x", "y"] if i < 6 else ["z"]) for i in range(9)]
    df = spark.createDataFrame(docs, "id int, tokens array<string>")
    got = {(r.id, r.word): (r.tf, r.tfidf) for r in vectors.tfidf_terms(df, "id", "tokens").collect()}
    assert got[(0, "x")] == (2, pytest.approx(2 * math.log(10 / 7)))
    assert got[(8, "z")] == (1, 0.0)


def test_scaling_equals_mllib_and_zeroes_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    ours = vectors.standard_scale(df, ["a", "b"]).select("scaled_a", "scaled_b").collect()
    raw = vectors.assembler(("a", "b")).transform(df)
    mllib = vectors.scaler().fit(raw).transform(raw).collect()
    for left, right in zip(ours, mllib):
        assert list(left) == pytest.approx(list(right.features))


def test_embedding_zero_rule(spark):
    df = spark.createDataFrame([("long enough", [1.0]), ("abcd", [1.0]), (None, [1.0]), ("long enough", None)], "t string, e array<float>")
    assert [r.e for r in vectors.embedding_features(df, "e", "t", 1).collect()] == [[1.0], [0.0], [0.0], [0.0]]


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(600):
        label = int(rng.random() < 0.8)
        score = min(max(round(rng.gauss(0.45 + 0.2 * label, 0.2), 2), 0.0), 1.0)
        rows.append((label, score, float(score > 0.5)))
    df = spark.createDataFrame(rows, "label int, score double, prediction double")
    return rows, df.withColumn("rawPrediction", array_to_vector(F.array(1 - F.col("score"), "score"))).cache()


def test_metrics_equal_mllib(scored):
    _, df = scored
    multi = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    assert metrics.accuracy(df).first()[0] == pytest.approx(multi.evaluate(df))
    f1 = multi.setMetricName("f1").evaluate(df)
    assert metrics.weighted_f1(df).first()[0] == pytest.approx(f1)
    quality = metrics.prediction_quality(df).first()
    assert quality.weighted_f1 == pytest.approx(f1)
    assert quality.positive_f1 == pytest.approx(metrics.positive_f1(df).first()[0])
    area = BinaryClassificationEvaluator(labelCol="label", numBins=0).evaluate(df)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(area)
    recall = multi.setMetricName("recallByLabel").setMetricLabel(1.0).evaluate(df)
    assert metrics.class_recall(df).first().ai_recall == pytest.approx(recall)


def test_roc_points_are_monotone_and_end_at_one(scored):
    rows, df = scored
    points = metrics.roc_points(df).orderBy(F.desc("threshold")).collect()
    assert len(points) == len({s for _, s, _ in rows})
    assert (points[-1].fpr, points[-1].tpr) == (1.0, 1.0)
    assert all(a.fpr <= b.fpr and a.tpr <= b.tpr for a, b in zip(points, points[1:]))


def test_metrics_of_a_single_class(spark):
    df = spark.createDataFrame([(1, 0.5, 1.0)], "label int, score double, prediction double")
    assert metrics.roc_auc(df).first()[0] == 0.0
    assert tuple(metrics.class_recall(df).first()) == (1.0, 0.0)
    cells = metrics.confusion_matrix(df).collect()
    assert [tuple(r) for r in cells] == [(1, 0, 1)]


def test_csv_keeps_quotes_newlines_and_blanks(spark):
    rows = [("1", 'say "hi", now'), ("2", "two\nlines"), ("3", "  padded  "), ("4", None)]
    path = new_path(spark, "csv")
    files.write_csv(spark.createDataFrame(rows, "id string, text string"), path)
    assert sorted(tuple(r) for r in files.read_csv_multiline(spark, path).collect()) == rows


def test_large_class_counts_do_not_overflow(spark, monkeypatch):
    points = spark.createDataFrame(
        [(0.9, 8_000_000_000, 0, 8_000_000_000, 0), (0.1, 0, 2_000_000_000, 8_000_000_000, 2_000_000_000)],
        "score double, pos bigint, neg bigint, tp bigint, fp bigint",
    )
    monkeypatch.setattr(metrics, "_by_score", lambda df, score: points)
    assert metrics.roc_auc(points).first()[0] == 1.0


def test_rows_without_an_order_come_last(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (2.0,)], "order double")
    found = {r.order: r.row_id for r in with_row_numbers(df, "order").collect()}
    assert found == {1.0: 0, 2.0: 1, 3.0: 2, None: 3}
    totals = with_running_totals(df.withColumn("one", F.lit(1)), "order", {"n": "one"}, descending=True)
    assert {r.order: r.n for r in totals.collect()} == {3.0: 1, 2.0: 2, 1.0: 3, None: 4}


def test_large_message_ids_survive(spark):
    row = spark.range(3_000_000_000, 3_000_000_001).select(
        F.encode(message_json(F.col("id"), F.lit("t"), F.lit("ai"), F.lit(1)), "UTF-8").alias("value"), F.current_timestamp().alias("timestamp")
    )
    assert parse_messages(row).first().id == 3_000_000_000


@pytest.mark.parametrize("text", ["a b ", "a  b", " a", "  ", "", "A\tB\n\n", "x"])
def test_ml_tokenize_equals_the_tokenizer(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    expected = Tokenizer(inputCol="text", outputCol="tokens").transform(df).first().tokens
    assert df.select(ml_tokenize("text").alias("tokens")).first().tokens == expected


@pytest.mark.parametrize("held", [10, 60, 100_000])
def test_leading_items_are_exact_with_bounded_counts(spark, held):
    rng = random.Random(held)
    names = [f"i{n:03d}" for n in range(400)]
    rows = [(g, rng.choices(names, [1 / (n + 1) ** e for n in range(400)], k=rng.randint(0, 60))) for g, e in (("a", 1.2), ("b", 1.5), ("flat", 0)) for _ in range(80)]
    rows += [("a", None), ("b", ["i399"] * 500)]
    df = spark.createDataFrame(rows, "g string, words array<string>").repartition(6)
    got = {(r["group"], r["rank"]): (r["item"], r.n) for r in heavy_hitters.leading_items(df, "words", 7, "g", held).collect()}
    for group in ("a", "b", "flat"):
        counts = Counter(w for g, words in rows if g == group for w in words or [])
        expected = sorted(counts.items(), key=lambda pair: (-pair[1], pair[0]))[:7]
        assert [got[group, i + 1] for i in range(7)] == expected
    one = heavy_hitters.leading_items(df, "words", 3, held=held).orderBy("rank").collect()
    everything = Counter(w for _, words in rows for w in words or [])
    assert [(r["item"], r.n) for r in one] == sorted(everything.items(), key=lambda pair: (-pair[1], pair[0]))[:3]


def test_bounded_counts_send_no_more_than_they_hold(spark):
    df = spark.range(4000).select(F.array(F.concat(F.lit("w"), F.col("id") % 1000), F.lit("often")).alias("words"), F.lit("all").alias("g")).repartition(5)
    parts = heavy_hitters.bounded_counts(df, "words", "g", 50).withColumn("task", F.spark_partition_id())
    sizes = parts.groupBy("task").agg(F.count("item").alias("items"), F.sum("taken_off").alias("off")).collect()
    assert len(sizes) == 5 and all(r["items"] <= 50 for r in sizes)
    off = sum(r.off for r in sizes)
    lower = parts.filter("item = 'often'").agg(F.sum("n")).first()[0]
    assert off > 0 and lower <= 4000 <= lower + off


def csv_texts(rng):
    """Files of two kinds of line ends with every trouble that quotes can make."""
    def field():
        if rng.random() < 0.3:
            return rng.choice(["", "abc", "x y", '5" disk', 'a"b"c', ' "lead', "é"])
        inner = ["a", "b\n", '""', ",", "\r\n", " ", "\n\n", "long text "]
        return '"' + "".join(rng.choice(inner) for _ in range(rng.randint(0, 30))) + '"' + rng.choice(["", "", "", "junk"])

    for i in range(4):
        rows = ["a,b,c"] + [",".join(field() for _ in range(rng.choice([3, 3, 3, 2, 4]))) for _ in range(rng.randint(5, 120))]
        yield ("\r\n" if i == 1 else "\n").join(rows[:4] + [""] + rows[4:]) + ("\n" if i == 2 else "")


def test_split_csv_equals_the_reader_of_whole_files(spark, tmp_path):
    for i, text in enumerate(csv_texts(random.Random(1))):
        (tmp_path / f"{i}.csv").write_bytes(text.encode())
    (tmp_path / "open.csv").write_bytes(b'a,b,c\n1,2,3\n4,"never closed\n5')
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for name in ("0.csv", "1.csv", "2.csv", "3.csv", "open.csv", ""):
            path = str(tmp_path / name)
            whole = spark.read.options(header="true", **split_csv.OPTIONS).csv(path)
            found = split_csv.read_csv_in_parts(spark, path)
            assert found.columns == whole.columns
            assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect())) and whole.count() > 0
            tasks = spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions()
            assert tasks > 3 or name == "open.csv"
        typed = split_csv.read_csv_in_parts(spark, str(tmp_path / "open.csv"), "a int, b string, c string")
        assert [r.a for r in typed.orderBy("a").collect()] == [1, 4]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_states_of_an_added_split_equal_a_full_recount(spark, sf_dir, tmp_path):
    columns = [c for c, _ in reshape.SOURCE_COLUMNS]
    wide, clean = tables.wide_corpus(spark, sf_dir), tables.clean_corpus(spark, sf_dir)
    path, done = str(tmp_path / "states"), []
    for method in reshape.GENERATION_METHODS:
        before = {p: p.stat().st_mtime_ns for p in (tmp_path / "states").rglob("*.parquet")}
        for _ in range(2 if not done else 1):  # storing a split again changes nothing
            states.store_split(path, method, *(df.filter(F.col("generation_method") == method) for df in (wide, clean)), columns)
        done.append(method)
        assert len(done) == 1 or all(p.stat().st_mtime_ns == at for p, at in before.items())
        some = clean.filter(F.col("generation_method").isin(*done))
        told = states.vocabulary_stats(spark, path)
        assert all("/states/" in f for f in told.inputFiles())
        found = {r.source: r for r in told.collect()}
        for r in stats.vocabulary_stats(some).collect():
            got = found[r.source]
            assert (got.total_words, got.unique_words) == (r.total_words, r.unique_words)
            assert (got.ttr, got.avg_words_per_abstract) == pytest.approx((r.ttr, r.avg_words_per_abstract))
        assert sorted(map(tuple, states.word_frequency(spark, path).collect())) == sorted(map(tuple, stats.word_frequency(some).collect()))
        assert states.text_counts(spark, path).first()[0] == some.count()
    whole = {r.column_name: r for r in stats.word_count_stats(wide, columns).collect()}
    for r in states.column_statistics(spark, path).collect():
        expected = whole[r.column_name]
        assert (r.avg_words, r.min_words, r.max_words) == (pytest.approx(expected.avg_words), expected.min_words, expected.max_words)


def test_bounded_roc_points_lie_on_the_exact_curve(spark):
    rng = random.Random(6)
    rows = [(int(s + rng.gauss(0, 0.4) > 0.5), s, 0.0) for s in (rng.choice([rng.random(), 0.25]) for _ in range(6000))] + [(0, None, 0.0)] * 5
    df = spark.createDataFrame(rows, "label int, score double, prediction double").repartition(5)
    exact = {r.threshold: (r.fpr, r.tpr) for r in metrics.roc_points(df, points=100_000).collect()}
    assert len(exact) == len({s for _, s, _ in rows})
    few = metrics.roc_points(df, points=50).orderBy(F.desc("threshold")).collect()
    assert 20 < len(few) <= 51 and all((r.fpr, r.tpr) == exact[r.threshold] for r in few if r.threshold is not None)
    assert (few[-1].fpr, few[-1].tpr) == (1.0, 1.0)
    scores = sorted(s for _, s, _ in rows if s is not None)
    cuts = sorted(r.threshold for r in few if r.threshold is not None)
    assert cuts[0] == scores[0]
    between = [sum(1 for s in scores if a < s < b) for a, b in zip(cuts, [*cuts[1:], 2.0])]
    assert max(between) <= 1.2 / 50 * len(scores)


def test_samples_are_exact_when_keys_repeat(spark):
    rows = [(0, "same", f"t{i % 2}") for i in range(5)] + [(1, f"k{i % 3}", "x") for i in range(30)] + [(2, "one", "y")] * 7
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "label int, key string, text string").repartition(parts)
        sample = stats.count_by(sampling.stratified_fixed_sample(df, "label", "key", {0: 3, 1: 17, 2: 7}), "label")
        assert [tuple(r) for r in sample.collect()] == [(0, 3), (1, 17), (2, 7)]
        kept = [tuple(r) for r in sampling.stratified_fixed_sample(df, "label", "key", {0: 3, 1: 17}).collect()]
        assert Counter(kept) <= Counter(rows) and len(kept) == 20
        if parts == 1:
            first = Counter(kept)
        assert Counter(kept) == first
        split = sampling.stratified_holdout(df, "label", "key", 60)
        assert Counter(tuple(r)[:3] for r in split.collect()) == Counter(rows)
        sizes = {(r.label, r.split): r.n_rows for r in stats.count_by(split, "label", "split").collect()}
        assert sizes == {(0, "train"): 3, (0, "test"): 2, (1, "train"): 18, (1, "test"): 12, (2, "train"): 4, (2, "test"): 3}


def test_projected_vectors_are_the_same_for_any_partitions(spark):
    rng = random.Random(9)
    kinds = {"animal": ["cat", "dog", "cow"], "tool": ["saw", "axe", "drill"]}
    around = {"animal": ["eats", "sleeps", "runs"], "tool": ["cuts", "rusts", "breaks"]}
    docs = []
    for i in range(300):
        kind = rng.choice(["animal", "tool"])
        docs.append((i, [w for _ in range(4) for w in (rng.choice(kinds[kind]), rng.choice(around[kind]), "the")] + [f"rare{i}"]))
    docs += [(1000, []), (1001, None), (1002, ["the"])]
    df = spark.createDataFrame(docs, "id int, tokens array<string>")
    found = [
        {r.word: r.vector for r in projected_vectors.projected_vectors(df.repartition(n), "tokens", dims=128, window=2).collect()}
        for n in (1, 7)
    ]
    assert found[0] == found[1] and all(len(v) == 128 for v in found[0].values()) and "rare1" not in found[0]

    def cosine(a, b):
        a, b = np.array(found[0][a]), np.array(found[0][b])
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    for near, far in (("dog", "axe"), ("cow", "drill")):
        assert cosine("cat", near) > cosine("cat", far) + 0.3
    with pytest.raises(ValueError):
        projected_vectors.projected_vectors(df, "tokens", dims=50)


def test_neighbours_are_all_pairs_within_the_window(spark):
    rows = [list("abcda"), ["x"], [], None]
    df = spark.createDataFrame([(t,) for t in rows], "tokens array<string>")
    for window in (1, 2, 9):
        got = [r[0] for r in df.select(projected_vectors.neighbours("tokens", window)).collect()]
        expected = Counter((t[i], t[j]) for t in rows[:1] for i in range(5) for j in range(i + 1, 5) if j - i <= window)
        assert Counter((p.a, p.b) for p in got[0]) == expected and got[1:] == [None] * 3


def test_group_variance_of_wide_vectors_travels_in_small_rows(spark, monkeypatch):
    rng = np.random.default_rng(8)
    dims = 768
    rows = [(g, [float(x) for x in rng.normal(size=dims) + g]) for g, n in ((0, 1700), (1, 40), (2, 1), (3, 900)) for _ in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, v array<double>").repartition(3)
    stored = []
    keep = similarity.through_table
    monkeypatch.setattr(similarity, "through_table", lambda rows, name: stored.append(keep(rows, name)) or stored[-1])
    got = {r.g: r.f_embed_variance for r in similarity.group_similarity_variance(df, "g", "v", dims).collect()}
    for g in range(4):
        unit = np.array([v for k, v in rows if k == g])
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        sims = (unit @ unit.T)[np.triu_indices(len(unit), 1)]
        assert got[g] == pytest.approx(float(np.var(sims)) if len(sims) else 0.0, abs=1e-6)
    widest = [table.agg(F.max(F.size("data"))).first()[0] for table in stored]
    assert max(widest) <= max(similarity.TILE**2, 3 + dims)
    assert any(table.filter("tile >= 0").count() for table in stored)


@pytest.mark.parametrize("tokens, tasks", [(0, 1), (374_309, 1), (4_100_000, 9), (26_035_968, 12), (280_000_000, 12), (1_680_000_000, 70)])
def test_training_tasks_send_few_copies_of_the_vocabulary(tokens, tasks):
    assert vectors.training_tasks(tokens) == tasks


def test_pieces_hold_few_items_with_the_groups_of_their_rows():
    lists = pa.array([["a", "b"], None, [], ["c"] * 5, ["d"]], pa.list_(pa.string()))
    found = list(heavy_hitters.pieces(pa.array(["x", "y", "y", "z", "x"]), lists, most=3))
    assert [len(items) for _, items in found] == [3, 3, 2]
    pairs = [pair for groups, items in found for pair in zip(groups.to_pylist(), items.to_pylist())]
    assert pairs == [("x", "a"), ("x", "b"), *[("z", "c")] * 5, ("x", "d")]


def test_words_and_texts_of_a_split_come_from_one_count(spark):
    rows = [("a", 0, 2, "x y"), ("a", 0, 1, ""), ("b", 1, 3, "x x z"), (None, None, None, None)]
    texts = states.text_state(spark.createDataFrame(rows, "source string, label int, word_count int, text_clean string"))
    assert {tuple(r) for r in states.source_state(texts).collect()} == {("a", 0, 2, 3), ("b", 1, 1, 3), (None, None, 1, None)}
    words = states.word_state(texts).select("source", "word", "n")
    assert {tuple(r) for r in words.collect()} == {("a", "x", 1), ("a", "y", 1), ("b", "x", 2), ("b", "z", 1)}


def test_pieces_of_neighbours_stay_within_their_lists():
    lists = pa.array([["a", "b", "c"], [], ["d"], None, ["e", "", "f", "g"]], pa.list_(pa.string()))
    groups = pa.array(["x", "x", "y", "y", "z"])
    expected = [("x", "a b"), ("x", "b c"), ("z", "e "), ("z", " f"), ("z", "f g")]
    for most in (1, 2, 3, 100):
        found = heavy_hitters.pieces(groups, lists, most=most, width=2)
        assert [pair for g, items in found for pair in zip(g.to_pylist(), items.to_pylist(), strict=True)] == expected


@pytest.mark.parametrize("held", [3, 1000])
def test_leading_bigrams_are_exact_and_clean_their_texts_once(spark, held):
    rng = random.Random(held)
    texts = [" ".join(rng.choices("abcdefgh", [2.0**-i for i in range(8)], k=rng.randint(0, 30))) for _ in range(200)]
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def cleaned(text):
        read.add(1)
        return text

    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    got = stats.top_bigrams(df.select(cleaned.asNondeterministic()("text").alias("text_clean")), 5, held=held).collect()
    pairs = Counter(f"{a} {b}" for t in texts for a, b in zip(t.split(), t.split()[1:]))
    assert [(r.bigram, r.n) for r in got] == sorted(pairs.items(), key=lambda pair: (-pair[1], pair[0]))[:5]
    assert read.value == len(texts)


def test_count_pairs_clean_their_texts_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def cleaned(text):
        read.add(1)
        return text

    rows = spark.createDataFrame([(1, "a b a"), (2, ""), (2, "b"), (None, "c")], "doc_id bigint, text string")
    clean = rows.select("doc_id", cleaned.asNondeterministic()("text").alias("text_clean"))
    monkeypatch.setattr(io_queries.t, "clean_corpus", lambda spark, sf_dir: clean)
    found = io_queries.sum_count_pairs(spark, "").collect()
    assert {tuple(r) for r in found} - {("", 0)} == {("a", 2), ("b", 2), ("c", 1)}
    assert read.value == 4


def test_stored_tables_are_compressed_well(spark):
    stored = through_table(spark.range(10), "numbers").inputFiles()
    assert stored and all(".zstd." in name for name in stored)
