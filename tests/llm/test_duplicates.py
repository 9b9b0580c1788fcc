"""Substring deduplication and Jaccard components against brute force."""

import hashlib
import random

import pytest

from scriptorium.llm import jaccard, substrings
from tests.llm.samples import SCHEMA, empty, frame, plain, rows


def removed(data, k):
    """(key, words, which go) of each row, in the operator's order of documents."""
    seen, out = {}, []
    for key, text, *_ in sorted(data, key=lambda r: (r[0] is None, r[0])):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        own = {}
        for at in range(len(words) - k + 1):
            gram = tuple(words[at : at + k])
            if gram in own or seen.get(gram, (key, text)) != (key, text):
                gone[at : at + k] = [True] * k
            own[gram] = True
            seen.setdefault(gram, (key, text))
        out.append((key, words, gone))
    return out


def digest(words, gone):
    return hashlib.sha256(b" ".join(w for w, g in zip(words, gone, strict=True) if not g)).hexdigest()


@pytest.mark.parametrize("window, anchor", [(20, 8), (6, 2), (5, 5)])
def test_repeated_windows_go(spark, window, anchor):
    expected = [(k, len(w), sum(g), digest(w, g)) for k, w, g in removed(rows(), window)]
    assert plain(substrings.substring_report(frame(spark), window, anchor).collect()) == plain(expected)
    assert sum(e[2] for e in expected) > 300


def test_cut_texts_keep_their_other_columns(spark):
    found = substrings.drop_repeats(frame(spark))
    assert found.columns == frame(spark).columns
    expected = {(k, tuple(w for w, g in zip(words, gone, strict=True) if not g)) for k, words, gone in removed(rows(), 20)}
    got = found.collect()
    assert {(r.doc_id, tuple((r.text or "").encode().split())) for r in got} == expected
    untouched = {k for k, _, gone in removed(rows(), 20) if not any(gone)}
    before = {r[0]: r[1] for r in rows()}
    assert all(r.text == before[r.doc_id] for r in got if r.doc_id in untouched)
    assert len(got) == len(rows())


def test_equal_rows_in_different_partitions_are_one_document(spark):
    own, shared = [f"own{i}" for i in range(50)], [f"both{i}" for i in range(30)]
    twice, nameless = " ".join(own + shared), " ".join(f"none{i}" for i in range(50))
    data = [(k, t, "en", "a", 0, "k", 7, "x") for k, t in [(7, twice), (7, twice), (None, nameless), (None, nameless), (9, " ".join(shared))]]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(data, 5), SCHEMA)
    assert docs.rdd.getNumPartitions() == 5
    found = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in substrings.substring_report(docs).collect())
    assert found == [(0, 50, 0), (0, 50, 0), (7, 80, 0), (7, 80, 0), (9, 30, 30)]
    assert sorted(r.text for r in substrings.drop_repeats(docs).collect()) == sorted([twice, twice, nameless, nameless, ""])


def test_empty_tables(spark):
    assert substrings.substring_report(empty(spark)).collect() == []
    assert substrings.drop_repeats(empty(spark)).collect() == []
    assert jaccard.jaccard_components(empty(spark)).collect() == []
    assert jaccard.keep_one_per_component(empty(spark)).collect() == []


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def least_keys(data):
    sets = [shingles(r[1]) for r in data]
    root = list(range(len(data)))
    for i, left in enumerate(sets):
        for j, right in enumerate(sets[:i]):
            both = len(left & right)
            if left and right and 100 * both >= 75 * (len(left) + len(right) - both):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    least = {}
    for r, row in zip(root, data, strict=True):
        if row[0] is not None:
            least[r] = min(least.get(r, row[0]), row[0])
    return [(row[0], len(s), least.get(r) if s else row[0]) for r, row, s in zip(root, data, sets, strict=True)]


def near_copies(seed, n):
    rng, pool, out = random.Random(seed), [], []
    hot = [f"hot{i}" for i in range(30)]
    for i in range(n):
        if pool and rng.random() < 0.6:
            words = list(rng.choice(pool[:4]))
            for _ in range(rng.randint(0, 4)):
                if words:
                    words[rng.randrange(len(words))] = f"e{rng.randint(0, 50)}"
            words += [f"z{rng.randint(0, 99)}" for _ in range(rng.choice([0, 0, 9]))]
        else:
            words = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([1, 3, 4, 5, 6, 9, 20, 60, 150]))]
        words += hot * (rng.random() < 0.3)
        pool.append(words)
        out.append((i * 3, rng.choice([" ", "\n"]).join(words), "en", "a", 0, "k", 7, "x"))
    return out


@pytest.mark.parametrize("block", [64, 3])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "VISITORS", 2 * block)
    data = near_copies(block, 160) + [r for r in rows() if len(r[1] or "") < 5000]
    expected = least_keys(data)
    found = jaccard.jaccard_components(frame(spark, data)).collect()
    assert plain(found) == plain(expected)
    assert len({e[2] for e in expected}) < len(expected) - 40


def test_one_row_of_a_component_stays(spark):
    data = near_copies(5, 80) + [r for r in rows() if len(r[1] or "") < 5000]
    found = jaccard.keep_one_per_component(frame(spark, data))
    stay = {k for k, _, c in least_keys(data) if k == c and k is not None}
    assert {r.doc_id for r in found.collect()} - {None} == stay
    assert found.columns == frame(spark).columns
    assert found.filter("doc_id = 1000").count() <= 1 and found.filter("doc_id in (1001, 1002, 1003)").count() == 3


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 90)], "left bigint, right bigint")
    found = {r.node: r.component for r in jaccard.components(edges).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 90: 90, 100: 90}
