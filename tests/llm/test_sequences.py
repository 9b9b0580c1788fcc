"""Periodic runs, collocations and repeated bytes against brute force."""

import hashlib
import random
import tracemalloc
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from scriptorium.llm import byte_repeats, collocations, periods, queries
from scriptorium.llm.suffix_sort import deep_shallow_sort
from tests.llm.samples import SCHEMA, empty, frame, plain, rows


def brute_runs(x, least_length=6, exponent=4):
    n, out = len(x), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            stretch = x[i : j + q]
            smaller = any(all(a == b for a, b in zip(stretch, stretch[p:])) for p in range(1, q))
            if len(stretch) >= max(least_length, exponent * q) and not smaller:
                out.append((i, len(stretch), q))
            i = j
    return sorted(out, key=lambda run: (run[0], run[2]))


def collapsed(x, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(x) if i not in gone)


def periodic_texts(seed, n):
    rng, out = random.Random(seed), []
    for _ in range(n):
        letters, x = rng.choice(["ab", "abc", "abcdefgh"]), []
        for _ in range(rng.randint(0, 5)):
            root = [rng.choice(letters) for _ in range(rng.randint(1, 14))]
            x += (root * rng.randint(1, 8))[: rng.randint(0, 90)]
            x += [rng.choice(letters) for _ in range(rng.randint(0, 5))]
        out.append(x)
    return out


def test_runs_equal_brute_force():
    texts = periodic_texts(5, 400)
    first = np.cumsum([0, *map(len, texts)])
    codes = np.array([ord(w) for x in texts for w in x])
    for least, exponent in ((6, 4), (1, 4), (20, 6)):
        found = periods.find_runs(codes, first, least, exponent)
        assert [found.get(i, []) for i in range(len(texts))] == [brute_runs(x, least, exponent) for x in texts]


def test_planted_and_collapsed_texts_equal_brute_force(spark):
    texts = [(i, "\t ".join(x), *[None] * 6) for i, x in enumerate(periodic_texts(6, 60))]
    data = rows() + [(t[0] + 5000, *t[1:]) for t in texts]
    planted = queries.planted_periods(frame(spark, data))
    found = periods.run_report(periods.collapse_runs(planted)).collect()
    expected = []
    for key, text, *_ in data:
        x = [w.decode() for w in (text or "").encode().split()]
        h = zlib.crc32(str(key).encode()) if key is not None else 1
        n, g = len(x), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            x = [w if i < a else x[a + (i - a) % p] for i, w in enumerate(x)]
        runs = brute_runs(x)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        texts = ("".join(f"{s},{m},{q}\n" for s, m, q in runs), collapsed(x, runs))
        expected.append((key, len(runs), *best, milli, *(hashlib.sha256(t.encode()).hexdigest() for t in texts)))
    assert plain(found) == plain(expected)
    assert sum(e[1] for e in expected) > 60


def test_a_small_exponent_is_refused(spark):
    with pytest.raises(ValueError, match="four periods"):
        periods.collapse_runs(frame(spark), least_exponent=3)


def brute_collocations(data, least, top):
    grams, totals = Counter(), Counter()
    for _, text, lang, *_ in data:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for mark in ".,;:!?\n\v\f\r":
            lowered = lowered.replace(mark, "\n")
        for piece in lowered.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang or "und"] += len(words)
            for size, at in product((1, 2, 3), range(len(words))):
                if at + size <= len(words):
                    grams[lang or "und", tuple(words[at : at + size])] += 1
    out = []
    kept = {key: a for key, a in grams.items() if a >= least and len(key[1]) > 1}
    over = Counter()
    for (lang, p), a in kept.items():
        if len(p) == 3:
            for part in (p[:2], p[1:]):
                over[lang, part] = max(over[lang, part], a)
    for lang in totals:
        scored = []
        for (of, p), a in kept.items():
            if of == lang and not (len(p) == 2 and 100 * over[lang, p] >= 50 * a and over[lang, p]):
                cuts = [(10**6 * a * a // (grams[lang, p[:k]] * grams[lang, p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), grams[lang, p[:k]], grams[lang, p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def phrases(seed, n):
    rng = random.Random(seed)
    stock = [" ".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 4))) for _ in range(6)]
    texts = []
    for i in range(n):
        words = [rng.choice(stock) if rng.random() < 0.5 else rng.choice(["A", "b", "cé", "\x0b", "d\t", "|"]) for _ in range(rng.randint(0, 40))]
        texts.append((i, rng.choice([" ", ", ", " ", "\n"]).join(words), rng.choice(["x", "y", None, "und"]), "s", 0, "k", 1, "r"))
    return texts


@pytest.mark.parametrize("least, top", [(10, 2000), (3, 15), (1, 40)])
def test_collocations_equal_brute_force(spark, least, top):
    data = phrases(2, 150) + rows()
    found = collocations.collocations(frame(spark, data), least, top, tile=1024 if least == 10 else 4).collect()
    expected = brute_collocations(data, least, top)
    assert plain(found) == plain(expected) and len(expected) > 20


def test_tiles_count_pairs_in_either_way():
    rng = np.random.default_rng(4)
    left, right = rng.zipf(1.3, (2, 60_000)) % 3000
    for tile in (64, 8, 1024):
        tiles, cells, counts = collocations.tile_counts(left, right, tile)
        pairs = zip((tiles >> 31) * tile + cells // tile, (tiles & (1 << 31) - 1) * tile + cells % tile, strict=True)
        assert dict(zip(pairs, counts, strict=True)) == Counter(zip(left, right, strict=True))
        assert len(collocations.tile_counts(left[:0], right[:0])[0]) == 0


@pytest.mark.parametrize("depth", [1, 7, 8, 50])
def test_suffixes_are_sorted_to_their_depth(depth):
    rng = random.Random(depth)
    base = bytes(rng.choice(b"ab\x00\xff") for _ in range(300))
    text = b"".join(base[rng.randint(0, 300) :][: rng.randint(0, 90)] for _ in range(30)) + b"a" * 200
    at = np.array(rng.sample(range(len(text) - depth + 1), len(text) - depth + 1))
    for shallow in (8, 24):
        order, fresh = deep_shallow_sort(np.frombuffer(text, np.uint8), at, depth, shallow)
        found, expected = ([text[i : i + depth] for i in at[order]], sorted(text[i : i + depth] for i in at))
        assert found == expected
        assert list(fresh) == [i == 0 or expected[i] != expected[i - 1] for i in range(len(expected))]


def brute_bytes(data, window):
    first = {}
    keyed = [(2**63 - 1 if key is None else key, key, (text or "").encode()) for key, text, *_ in data]
    for order, _, raw in keyed:
        for i in range(len(raw) - window + 1):
            gram = raw[i : i + window]
            first[gram] = min(order, first.get(gram, order))
    out = []
    for order, key, raw in keyed:
        gone = bytearray(len(raw))
        for i in range(len(raw) - window + 1):
            if first[raw[i : i + window]] < order:
                gone[i : i + window] = b"\1" * window
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((key, len(raw), sum(gone), spans, kept))
    return out


def byte_rows():
    rng = random.Random(8)
    shared = "".join(rng.choice("abcdé ") for _ in range(400))
    data = rows()
    for i in range(60):
        cut = rng.randint(0, 300)
        tail = "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 60)))
        data.append((2000 + i, tail[::-1] + shared[cut : cut + rng.randint(20, 200)] + tail + "=" * rng.randint(0, 80), *[None] * 6))
    data += [(2000, "same key " + shared, *[None] * 6), (None, shared + "!", *[None] * 6), (-5, shared[:70], *[None] * 6)]
    return data


@pytest.mark.parametrize("window, anchor, hot", [(50, 20, 1000), (50, 20, 1), (12, 5, 3), (9, 9, 0)])
def test_repeated_bytes_equal_brute_force(spark, window, anchor, hot):
    docs = spark.createDataFrame(byte_rows(), SCHEMA).repartition(6)
    found = [
        (r.doc_id, r.n_bytes, sum(s.length for s in r.spans), len(r.spans), bytes(r.kept))
        for r in byte_repeats.cut_repeated_bytes(docs, window, anchor, hot=hot).collect()
    ]
    expected = brute_bytes(byte_rows(), window)
    assert plain(found) == plain(expected) and sum(e[2] for e in expected) > 5000


def test_what_buckets_tell_of_a_document_meets_in_one_row(spark, monkeypatch):
    stored, keep = {}, byte_repeats.through_table
    monkeypatch.setattr(byte_repeats, "through_table", lambda df, name: stored.setdefault(name, keep(df, name)))
    docs = spark.createDataFrame(byte_rows(), SCHEMA).repartition(6)
    assert byte_repeats.cut_repeated_bytes(docs).count() == docs.count()
    found = stored["byte-paths"].cache()
    assert found.count() == found.select("key", "digest").distinct().count() > 50
    assert found.filter("size(settled) > 0").count() > 0 and found.filter("size(asked) > 0").count() > 0


def test_empty_tables_have_empty_results(spark):
    docs = empty(spark)
    assert periods.run_report(periods.collapse_runs(queries.planted_periods(docs))).count() == 0
    assert collocations.collocations(docs).count() == 0
    assert byte_repeats.cut_repeated_bytes(docs).count() == 0


def test_byte_paths_of_pieces_equal_those_of_the_whole_in_less_memory():
    rng = np.random.default_rng(3)
    sizes = np.concatenate([rng.integers(0, 400, 300), [0, 49, 50, 51, 5000, 0]])
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    data = rng.integers(97, 101, offsets[-1], dtype=np.uint8)
    whole = byte_repeats.byte_paths(data, offsets, 50, 20, most=1 << 40)
    for most in (1, 100, 3000):
        pieces = byte_repeats.byte_paths(data, offsets, 50, 20, most)
        assert all(a.dtype == b.dtype and np.array_equal(a, b) for a, b in zip(whole, pieces, strict=True))

    data = rng.integers(97, 123, 2 << 20, dtype=np.uint8)
    tracemalloc.start()
    byte_repeats.byte_paths(data, np.arange(0, len(data) + 1, 4096, dtype=np.int64), 50, 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(data)
