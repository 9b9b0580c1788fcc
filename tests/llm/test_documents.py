"""Quality rules, fingerprints, language, licences and mixing on small documents."""

import hashlib
import math
import textwrap
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from scriptorium.llm import fingerprints, language, licenses, mixing, quality
from scriptorium.llm.license_texts import TEMPLATES
from scriptorium.llm.oracles import LICENSE_SQL, MIXING_SQL, QUALITY_SQL
from scriptorium.llm.queries import repository_path
from scriptorium.session import shared_dir
from tests.llm.samples import empty, frame, plain, rows


def by_sql(sql):
    documents = pd.DataFrame([r[:5] for r in rows()], columns=["doc_id", "text", "lang", "source", "n_chars"])
    documents = documents.astype({"doc_id": "Int64", "n_chars": "Int64"})
    con = duckdb.connect()
    con.register("documents", documents)
    return con.execute(sql).fetchall()


def test_quality_equals_sql(spark):
    found = quality.quality_report(frame(spark))
    assert plain(found.collect()) == plain(by_sql(QUALITY_SQL))
    assert quality.quality_report(empty(spark)).collect() == []


def test_bad_hosts_fail_with_all_their_documents(spark):
    text = " ".join(f"word{i}" for i in range(30))
    data = [(i, text if i % 10 == 0 else "short", None, "bad" if i < 200 else f"h{i % 7}", 0, "", 0, "") for i in range(200)]
    data += [(i, text if i % 10 else "short", None, f"h{i % 7}", 0, "", 0, "") for i in range(200, 400)] + [(900, text, None, None, 0, "", 0, "")]
    kept = {r.doc_id for r in quality.keep_good(frame(spark, data)).collect()}
    assert kept == {900, *(i for i in range(200, 400) if i % 10)}
    assert quality.keep_good(frame(spark, data)).columns == frame(spark).columns


def test_repeats_cover_first_and_later_windows():
    import pyarrow as pa

    counts = quality.count_texts(pa.array(["a b c d e a b c d e", "a a a a a a", "é é\né é\n \n \n# é é", None])).to_pylist()
    assert [c["n_repeat_words"] for c in counts] == [10, 6, 0, 0]
    assert counts[2] == {"n_words": 7, "word_chars": 7, "n_symbols": 1, "n_dup_lines": 1, "n_repeat_words": 0}


def test_fingerprints(spark):
    found = {}
    for r in fingerprints.fingerprint_report(frame(spark), samples=64).collect():
        found.setdefault(r.doc_id, r)
    data = sorted({(r[0], r[1] or "") for r in rows() if r[0] is not None}, reverse=True) + [(None, next(r[1] for r in rows() if r[0] is None))]
    prints, errors = {}, []
    for i, (key, text) in enumerate(data):
        after = data[(i + 1) % len(data)][1] if key != 1000 else text
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        row = found[key]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        left, right = Counter(text.split()), Counter(edited.split())
        union = sum((left | right).values())
        errors.append(row.near_edited - (sum((left & right).values()) / union if union else 1.0))
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    assert abs(np.mean(errors)) < 0.03 and np.sqrt(np.mean(np.square(errors))) < 0.09
    assert fingerprints.fingerprint_report(empty(spark)).collect() == []


def test_default_fingerprints_have_the_samples_judged_above(spark):
    found = fingerprints.fingerprint_report(frame(spark, rows()[:2])).collect()
    assert {len(r.fingerprint) for r in found} == {len(r.edited_fingerprint) for r in found} == {8 * 64}


def test_language_accuracy_on_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fold = language.fold_of(F.col("doc_id"))
    model = language.fit_language_model(docs.filter(fold != 1))
    found = language.predict_language(docs.filter(fold == 1), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def brute_language(text, model):
    """The nearest centroid by cosine, term by term."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    letters = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in f" {text.lower()} ".encode())
    letters = bytes(b for i, b in enumerate(letters) if b != 32 or i == 0 or letters[i - 1] != 32)
    counts = Counter()
    for n in (1, 2, 3):
        for at in range(len(letters) - n + 1):
            value = n
            for b in letters[at : at + n]:
                value = (value << 8 | b) % 2**32
            counts[value * 2654435761 % 2**32 >> 20] += 1
    weights = {slot: math.log(1 + n) * float(model.idf[slot]) for slot, n in counts.items()}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    cosines = [sum(w * float(row[slot]) for slot, w in weights.items()) / norm for row in model.centroids]
    best = max(range(len(cosines)), key=cosines.__getitem__)
    return model.languages[best], cosines[best]


def test_languages_equal_brute_force(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    docs = given.unionByName(frame(spark).select("doc_id", "text", "lang"))
    model = language.fit_language_model(given)
    assert len(model.languages) > 4
    found = language.predict_language(docs, model).collect()
    expected = [(r.doc_id, *brute_language(r.text, model)) for r in docs.collect()]
    told = sorted(((r.doc_id, r.lang_pred, r.score) for r in found), key=str)
    for (key, name, score), (other, wanted, cosine) in zip(told, sorted(expected, key=str), strict=True):
        assert key == other and score == pytest.approx(min(max(cosine, 0), 1), abs=1e-4)
        assert name == wanted or abs(score - cosine) < 1e-4


def test_a_key_that_is_there_often_does_not_widen_the_sample(spark, monkeypatch):
    data = [(1, f"hello world number {i}", "en", "a", 0, "", 0, "") for i in range(300)] + [(2, "bonjour le monde", "fr", "a", 0, "", 0, "")]
    sizes = []
    cluster = language.cluster
    monkeypatch.setattr(language, "cluster", lambda vectors, most: sizes.append(len(vectors)) or cluster(vectors, most))
    model = language.fit_language_model(frame(spark, data), sample=20)
    assert sizes == [20, 1] and set(model.languages) == {"en", "fr"}


def test_language_of_awkward_texts(spark):
    model = language.fit_language_model(frame(spark))
    found = language.predict_language(frame(spark), model).collect()
    assert len(found) == len(rows())
    assert {r.lang_pred for r in found if r.doc_id in (1001, 1002, 1003, 1006)} == {"und"}
    assert {r.lang_pred for r in found} <= {"en", "fr", "und"}
    assert language.fit_language_model(empty(spark)) is None
    assert {r.lang_pred for r in language.predict_language(frame(spark), None).collect()} == {"und"}
    assert language.predict_language(empty(spark), model).collect() == []
    far = [(1, "日本語" * 50, None, None, 0, "", 0, "")]
    assert language.predict_language(frame(spark, far), model).first().rejected


def test_licences_equal_sql(spark):
    data = [(r[0] + 7 * (i % 3), *r[1:]) for i, r in enumerate(rows()) if r[0] is not None and r[0] != 1000]
    data += [(2002, "MIT License", "en", "a", 0, "k", 7, "x"), (2009, "SPDX-License-Identifier: ISC", "en", "b", 0, "k", 7, "x")]
    docs = frame(spark, data).dropDuplicates(["doc_id"]).cache()
    found = licenses.scan_licenses(docs.select("*", repository_path().alias("path")))
    docs.toPandas().to_parquet(f"{shared_dir(spark)}/licence-rows.parquet")
    sql = LICENSE_SQL.replace("FROM documents", f"FROM '{shared_dir(spark)}/licence-rows.parquet'")
    expected = duckdb.execute(sql).fetchall()
    assert plain(found.collect()) == plain(expected)
    assert {e[4] for e in expected} == {"header", "inherited", "none"}


def test_query_has_every_origin_and_inherits_from_above(spark):
    found = entry_point.queries()["op2_license_scan"](spark, "/root/testdata/sf0.01").collect()
    assert len(found) == 1000 and {r.origin for r in found} == {"header", "inherited", "none"}
    assert any(r.from_dir is not None and r.from_dir != r.path.rsplit("/", 1)[0] for r in found)


def wrapped(text, width, mark=""):
    paragraphs = [" ".join(p.split()) for p in text.strip().split("\n\n")]
    lines = [line for p in paragraphs for line in [*textwrap.wrap(p, width), ""]]
    return "\n".join(f"{mark}{line}" for line in lines)


def test_genuine_texts_are_known_wrapped_or_not(spark):
    prose = "\n".join(" ".join(f"word{(7 * i * j) % 997}" for j in range(12)) for i in range(1, 40))
    by_text = {(name, text): 0 for name, text in TEMPLATES}
    data, expected = [], {}

    def add(name, text):
        data.append((len(data), f"p{len(data)}/x", text))
        expected[len(data) - 1] = name

    for name, text in by_text:
        if len(text) > 100:
            owner = "Copyright (c) 2019 The Authors\n\n" if len(text) > 600 else ""
            add(name, owner + text)
            add(name, owner + wrapped(text, 60))
            add(name, wrapped(text, 10_000))
            add(name, wrapped(text, 72, "# ") + "\n\nimport os\n\n" + prose)
            add(name, "/*\n" + wrapped(text, 50, " * ") + "\n */\n\n" + prose)
        else:
            add(name, text)
            add(name, f"// {text}\n\n{prose}")
            add(name, f"{prose}\n{text.upper()}\n{prose}")
    add(None, prose)
    add(None, "the license of the software and the rights of all people, with conditions that follow in this text")
    files = spark.createDataFrame(data, "doc_id int, path string, text string").repartition(4)
    found = {r.doc_id: r.license for r in licenses.scan_licenses(files).collect()}
    assert {k: (found[k], v) for k, v in expected.items() if found[k] != v} == {}


def test_units_of_files_are_named_by_bytes(spark, monkeypatch):
    stored = {}
    keep = licenses.through_table
    monkeypatch.setattr(licenses, "through_table", lambda df, name: stored.setdefault(name, keep(df, name)))
    text = next(t for _, t in TEMPLATES)
    files = spark.createDataFrame([(1, "a/x", text), (1, "a/x", text), (2, "a/y", text)], "doc_id int, path string, text string")
    assert len(licenses.scan_licenses(files).collect()) == 3
    for name in ("license-terms", "license-units"):
        assert {len(r.file) for r in stored[name].select("file").collect()} == {32}
    assert stored["license-units"].select("file").distinct().count() == 2


def test_units_of_files_are_dealt_out_once(spark, monkeypatch):
    monkeypatch.setattr(licenses, "through_table", lambda df, name: df)
    text = next(t for _, t in TEMPLATES)
    files = spark.createDataFrame([(b"1", text), (b"1", text), (b"2", f"# {text}")], "file binary, text string")
    units = licenses.license_units(files)
    plan = units._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    kinds = [(bytes(r.file), r.kind, r.place) for r in units.collect()]
    assert len(kinds) == len(set(kinds)) and {k[0] for k in kinds} == {b"1", b"2"}


def test_licences_of_awkward_rows(spark):
    data = [(1, "a/b/LICENSE", "Released under the MIT License."), (2, "a/b/c/x", "code"), (3, "a/y", None), (4, None, "All rights reserved.")]
    data += [(None, "a/b/z", ""), (2, "a/b/c/x", "code")]
    files = spark.createDataFrame(data, "doc_id bigint, path string, text string")
    found = {(r.doc_id, r.license, r.origin, r.from_dir) for r in licenses.scan_licenses(files).collect()}
    assert found == {
        (1, "MIT", "header", None),
        (2, "MIT", "inherited", "a/b"),
        (3, None, "none", None),
        (4, "proprietary", "header", None),
        (None, "MIT", "inherited", "a/b"),
    }
    assert licenses.scan_licenses(files).count() == 6 and licenses.scan_licenses(files.limit(0)).collect() == []


def test_mixing_equals_sql(spark):
    found = mixing.mix_sources(frame(spark).select("doc_id", "source", "text"), seed=17)
    names = ["doc_id", "source", "text", "copy", "shuffle_key"]
    assert found.columns == names
    assert plain(found.collect()) == plain(by_sql(MIXING_SQL))
    keys = [r.shuffle_key for r in found.collect()]
    assert keys == sorted(keys)


@pytest.mark.parametrize("epochs", [1.0, 3.0])
def test_sources_reach_their_targets(spark, epochs):
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('x', 50) AS text", "IF(id % 6 = 0, 'small', 'large') AS source")
    found = dict(mixing.mix_sources(docs, {"small": 0.5, "large": 0.5}, epochs).groupBy("source").count().collect())
    assert abs(found["small"] / (3000 * epochs) - 1) < 0.1 and abs(found["large"] / (3000 * epochs) - 1) < 0.1
    only = mixing.mix_sources(docs, {"small": 1.0}, 60.0).groupBy("source").count().collect()
    assert [r.source for r in only] == ["small"] and abs(only[0]["count"] / 360000 - 1) < 0.05


def test_mixing_of_empty_tables(spark):
    assert mixing.mix_sources(empty(spark)).collect() == []
    assert mixing.mix_sources(frame(spark), {"none": 1.0}).collect() == []
