"""The pipeline's stages against brute force on the smallest tables and on awkward rows."""

import hashlib

import numpy as np
import public_tokenizers as vocabularies

import __spark_entry__ as entry_point
import corpus_pipeline
from scriptorium.llm import byte_bpe
from tests.llm.samples import empty, frame, rows
from tests.llm.test_duplicates import least_keys, removed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def encoded(text):
    ids = np.array(byte_bpe.load_encoding(vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN).encode_ordinary(text), "<u4")
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_stages_follow_each_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    quality, near, substring, mixing, encoding = (stage for _, stage in corpus_pipeline.STAGES)
    good = quality(spark, docs, sf_dir)
    verdicts = {r.doc_id: r.kept for r in entry_point.queries()["op8_quality_rules"](spark, sf_dir).collect()}
    assert {r.doc_id for r in good.collect()} == {k for k, kept in verdicts.items() if kept}
    single = near(spark, good, sf_dir)
    data = [tuple(r) for r in good.collect()]
    assert {r.doc_id for r in single.collect()} == {k for k, _, c in least_keys(data) if k == c}
    cut = substring(spark, single, sf_dir)
    data = [tuple(r) for r in single.collect()]
    expected = {k: [w for w, g in zip(words, gone, strict=True) if not g] for k, words, gone in removed(data, 20)}
    assert {r.doc_id: r.text.encode().split() for r in cut.collect()} == expected
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    mixed = mixing(spark, cut, sf_dir)
    assert [f.columns for f in (good, single, cut, mixed)] == [COLUMNS] * 4
    texts = {r.doc_id: r.text for r in cut.collect()}
    found = encoding(spark, mixed, sf_dir).collect()
    assert len(found) == mixed.count()
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == encoded(texts[r.doc_id]) for r in found)


def test_run_gives_the_rows_of_the_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    found = corpus_pipeline.run(spark, sf_dir)
    names = ["doc_id", "n_tokens", "ids_sha256"]
    assert sorted(map(tuple, found.select(names).collect())) == sorted(map(tuple, docs.select(names).collect()))


def test_awkward_and_empty_documents_pass_through(spark):
    for docs in (frame(spark), empty(spark)):
        n = docs.count()
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
        assert docs.count() <= 4 * n
    assert len(rows()) > 80
