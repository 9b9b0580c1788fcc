from collections import Counter

import pyarrow as pa
import pytest

from scriptorium.operators import projected_vectors as pv

TEXTS = [list("abcab"), ["x"], [], None, ["a", None, "a"], ["b", "a"], ["", "b", ""], ["é", "b", "z"] * 3]


def expected_pairs(window):
    pairs = Counter()
    for text in TEXTS:
        for i, x in enumerate(text or []):
            pairs[(x, None)] += x is not None
            for y in (text or [])[i + 1 : i + 1 + window]:
                if x is not None and y is not None:
                    pairs[tuple(sorted((x, y), key=str.encode))] += 1
    return +pairs


@pytest.mark.parametrize("window", [1, 2, 9])
def test_pairs_are_counted_one_way_with_their_tokens(spark, monkeypatch, window):
    found = pv.pair_counts(pa.array(TEXTS, pa.list_(pa.string())), window).to_pylist()
    assert Counter({(r["a"], r["b"]): r["n"] for r in found}) == expected_pairs(window) and len(found) == len(expected_pairs(window))
    assert pv.pair_counts(pa.array([None, []], pa.list_(pa.string())), window).num_rows == 0
    df = spark.createDataFrame([(t,) for t in TEXTS], "tokens array<string>")
    counted = {(r.a, r.b): r.n for r in pv.neighbour_counts(df.repartition(3), "tokens", window).collect()}
    assert counted == dict(expected_pairs(window))


def test_pieces_of_texts_give_the_same_pairs():
    texts = pa.array([t for t in TEXTS if t], pa.list_(pa.string()))
    whole, parts = pv.pair_counts(texts, 2), [pv.pair_counts(texts.slice(i, 2), 2) for i in range(0, len(texts), 2)]
    added = Counter()
    for row in pa.concat_tables(parts).to_pylist():
        added[(row["a"], row["b"])] += row["n"]
    assert added == Counter({(r["a"], r["b"]): r["n"] for r in whole.to_pylist()})


def test_texts_are_read_once_for_words_and_pairs(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(rows):
        for batch in rows:
            read.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame([(["a", "b", "a"],)] * 6, "tokens array<string>").mapInArrow(seen, "tokens array<string>")
    assert pv.projected_sums(pv.context_weights(docs, "tokens", 1, 1), 32).count() >= 0 and read.value == 6
