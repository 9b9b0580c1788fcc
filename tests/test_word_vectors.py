import heapq
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scriptorium.operators import vectors, word_training
from scriptorium.session import new_path
from scriptorium.sources import models


def plain_code_cost(weights):
    """Bits of all words under an optimal code: the sum of all inner nodes' weights."""
    heap, cost = list(weights), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        merged = heapq.heappop(heap) + heapq.heappop(heap)
        cost += merged
        heapq.heappush(heap, merged)
    return cost


@pytest.mark.parametrize("weights", [[5], [1, 1], [3] * 7, [1, 1, 2, 3, 5, 8, 13], [3] * 50 + [4] * 31 + [6, 6, 9, 12, 100, 4000], list(range(3, 90))])
def test_tree_of_counts_is_an_optimal_code(weights):
    depths = word_training.leaf_depths(sorted(Counter(weights).items()))
    assert sum(depths.values()) == len(weights) and sum(m / 2**d for d, m in depths.items()) == 1
    lengths = [d for d, m in depths.items() for _ in range(m)]
    assert sum(w * d for w, d in zip(sorted(weights, reverse=True), lengths)) == plain_code_cost(weights)


def test_codes_are_free_of_prefixes_and_shorter_for_frequent_words(spark):
    rows = [(f"w{i}", 3 + i // 5 % 9 * i // 7) for i in range(300)]
    counts = spark.createDataFrame(rows, "word string, n bigint")
    found = word_training.ranked_codes(counts, list(Counter(n for _, n in rows).items())).collect()
    times = dict(rows)
    by_rank = sorted(found, key=lambda r: r.rank)
    assert [r.rank for r in by_rank] == list(range(300))
    assert all(times[a.word] >= times[b.word] and a.length <= b.length for a, b in zip(by_rank, by_rank[1:]))
    bits = sorted(format(r.code, f"0{r.length}b") for r in found)
    assert not any(b.startswith(a) for a, b in zip(bits, bits[1:]))


def topic_texts(spark, texts=600):
    topics = [[f"{t}{i}" for i in range(6)] for t in "ab"]
    draw = random.Random(3)
    rows = [([draw.choice(topics[i % 2]) for _ in range(40)],) for i in range(texts)]
    return spark.createDataFrame([*rows, (["once"],), ([],), (None,)], "tokens array<string>")


@pytest.mark.parametrize("partitions", [1, 3])
def test_words_of_one_topic_get_similar_vectors(spark, partitions):
    model = vectors.word2vec_fit(topic_texts(spark), "tokens", vector_size=8, partitions=partitions)
    unit = {r.word: r.vector.toArray() / np.linalg.norm(r.vector.toArray()) for r in model.getVectors().collect()}
    assert len(unit) == 12
    same = [unit[f"{t}{i}"] @ unit[f"{t}{j}"] for t in "ab" for i in range(6) for j in range(i)]
    other = [unit[f"a{i}"] @ unit[f"b{j}"] for i in range(6) for j in range(6)]
    assert np.mean(same) > np.mean(other) + 0.5


def test_word_vectors_do_not_depend_on_partitions_or_batches(spark):
    def fitted(texts):
        return {r.word: list(r.vector) for r in vectors.word2vec_fit(texts, "tokens", vector_size=4, partitions=2).getVectors().collect()}

    texts = topic_texts(spark, 300)
    first = fitted(texts)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert fitted(texts.repartition(5)) == first
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_block_of_one_pair_takes_the_step_of_the_formula():
    words = pa.table({"word": ["a", "b"], "rank": [0, 1], "length": pa.array([1, 1], pa.int32()), "code": [0, 1]})
    trainer = word_training.SliceTrainer(words, 3, 7, 0, 1, 2)
    start = trainer.inputs.copy()
    trainer.outputs[:] = out = np.array([[0.5, -0.25, 1.0]], np.float32)
    trainer._learn(np.array([0, 1]), np.array([2]))
    rate, step = 0.025, np.zeros((2, 1))
    step[1] = rate * (1 - 1 / (1 + np.exp(-start[1] @ out[0])))
    step[0] = rate * (0 - 1 / (1 + np.exp(-start[0] @ out[0])))
    damped = 1 + rate / 8 * np.sum(out**2)
    assert trainer.inputs == pytest.approx(start + step * out / damped, abs=1e-6)
    assert trainer.outputs == pytest.approx(out + (step.T @ start) / (1 + rate / 8 * np.sum(start**2)), abs=1e-6)


def test_saved_word_vectors_are_those_that_mllib_loads(spark):
    odd = [["x\x1fy", "x", "y"], [None, "x", "y"], ["x", "y"], [""] * 3]
    train = spark.createDataFrame([*((t,) for t in odd * 3)], "tokens array<string>")
    model = vectors.word2vec_fit(train, "tokens", vector_size=4, partitions=1)
    loaded = models.load_word_vectors(models.save_model(model, new_path(spark, "words")))
    assert sorted(r.word for r in loaded.getVectors().collect()) == ["", "x", "x\x1fy", "y"]
    docs = spark.createDataFrame([(1, ["x", "x\x1fy", "zzz"]), (2, ["zzz"]), (3, [])], "id int, tokens array<string>")
    theirs, ours = ({r.id: list(r.w2v_features) for r in m.transform(docs).collect()} for m in (loaded, model))
    assert all(ours[i] == pytest.approx(v, abs=1e-6) for i, v in theirs.items()) and any(ours[1])


def test_fitting_sends_the_driver_less_than_the_vocabulary(spark):
    words = 20_000
    listed = F.transform(F.sequence(F.lit(0), F.lit(399)), lambda i: F.concat(F.lit("w"), (F.col("id") % 50 * 400 + i).cast("string")))
    texts = spark.range(200).select(listed.alias("tokens"))
    conf = spark.sparkContext._jsc.sc().conf()
    conf.set("spark.driver.maxResultSize", "2m")
    try:
        model = vectors.word2vec_fit(texts, "tokens", vector_size=100, partitions=2)
    finally:
        conf.remove("spark.driver.maxResultSize")
    assert model.getVectors().count() == words
