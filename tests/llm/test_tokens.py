"""Token counts, byte-level BPE and token files against the libraries themselves."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as vocabularies
import pytest
import regex
from tokenizers import Tokenizer

from scriptorium.llm import byte_bpe, token_counts, token_files
from scriptorium.session import new_path
from tests.llm.samples import empty, frame, plain, rows

RANKS = vocabularies.path("byte_bpe_50k.tiktoken")
BYTES = vocabularies.path("byte_bpe_50k.json")
WORDS = vocabularies.path("word_bpe_49k.json")
PATTERN = vocabularies.PATTERN


def little_endian(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


def test_token_counts_equal_the_library(spark):
    library = Tokenizer.from_file(BYTES)
    expected = []
    for key, text, *_ in rows():
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((key, len((text or "").encode()), n, n > 100))
    found = token_counts.token_counts(frame(spark), BYTES, PATTERN, limit=100)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert plain(found.collect()) == plain(expected)
    assert token_counts.token_counts(empty(spark), BYTES, PATTERN).collect() == []


def test_random_texts_have_the_library_counts():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab cde\n'stth 1290<|é日\x1c") for _ in range(rng.randint(0, 90))) for _ in range(800)]
    texts += ["a" * 3000, "ab" * 2000, "<|endoftext|>" * 5, " " * 500 + "x"]
    library = Tokenizer.from_file(BYTES)
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_counts._counter(BYTES, PATTERN)(texts).tolist() == expected


@pytest.mark.parametrize("chunk, overlap", [(8192, 512), (40, 7), (5, 5)])
def test_byte_bpe_equals_the_library(spark, chunk, overlap):
    library = byte_bpe.load_encoding(RANKS, PATTERN)
    expected = []
    for key, text, *_ in rows():
        ids = library.encode_ordinary(text or "")
        expected.append((key, len(ids), hashlib.sha256(little_endian(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    data = rows() if chunk > 5 else [r for r in rows() if len(r[1] or "") < 3000]
    if chunk == 5:
        expected = [e for e, r in zip(expected, rows(), strict=True) if len(r[1] or "") < 3000]
    found = byte_bpe.byte_bpe(frame(spark, data), RANKS, PATTERN, chunk=chunk, overlap=overlap)
    assert plain(found.collect()) == plain(expected)


def test_byte_bpe_of_an_empty_table(spark):
    assert byte_bpe.byte_bpe(empty(spark), RANKS, PATTERN, with_ids=True).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert byte_bpe.byte_bpe(empty(spark), RANKS, PATTERN).collect() == []


def test_chunks_stitch_to_the_pieces_of_the_whole():
    rng, pattern = random.Random(3), regex.compile(PATTERN)
    for _ in range(3000):
        text = "".join(rng.choice(rng.choice(["ab  \n\t", "abc '", "s't1 2", "   ", "aaaaaaa", "é日 "])) for _ in range(rng.randint(1, 60)))
        chunk = rng.randint(1, 12)
        overlap = rng.randint(1, chunk)
        starts = list(range(0, len(text), chunk))
        parts = [text[s : s + chunk + overlap] for s in starts]
        ends = [byte_bpe.piece_ends(p, pattern) for p in parts]
        assert [p for some in byte_bpe.stitch(starts, parts, ends, pattern) for p in some] == pattern.findall(text)


def test_token_files_round_trip(spark):
    library, path = Tokenizer.from_file(WORDS), new_path(spark, "token-files")
    token_files.write_token_files(frame(spark), path, WORDS, end_id=2)
    found = token_files.read_documents(spark, path).orderBy("start").collect()
    data = [(r[0], [*library.encode(r[1] or "", add_special_tokens=False).ids, 2]) for r in rows()]
    assert [r.doc_id for r in found] == sorted((k for k, _ in data), key=lambda k: (k is not None, k))
    assert plain((r.doc_id, r.ids, r.ids_crc32) for r in found) == plain((k, ids, zlib.crc32(little_endian(ids))) for k, ids in data)
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    flat = [i for r in found for i in r.ids]
    asked = spark.range(0, len(flat) + 50, 7).withColumnRenamed("id", "position")
    assert plain(token_files.read_tokens(spark, path, asked).collect()) == plain((p, flat[p]) for p in range(0, len(flat), 7))


def test_token_files_of_an_empty_table(spark):
    path = new_path(spark, "token-files")
    token_files.write_token_files(empty(spark), path, WORDS, end_id=2)
    assert token_files.read_documents(spark, path).collect() == []


def test_words_encode_as_in_their_text():
    rng, library = random.Random(4), Tokenizer.from_file(WORDS)
    letters = "ab cD.e\n'stTH 12́̌90<|>é日ΣJ \x1c…!"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["<|endoftext|><|ENDOFTEXT|> a<|endoftext|>", "J̌ İx", "ΣΑΣ ΣΑΣ."]
    expected = [little_endian(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert token_files._encoder(WORDS)(texts) == expected


def test_levels_give_every_id():
    ids = np.random.default_rng(0).integers(0, 1 << 25, 3000).astype(np.uint32)
    ids[:700] = 5
    levels = token_files.split_levels(ids)
    assert (token_files.join_levels(levels) == ids).all()
    assert [token_files.id_at(levels, i) for i in range(3000)] == ids.tolist()
    with pytest.raises(IndexError):
        token_files.id_at(levels, 3000)


def test_frequent_words_are_given_to_the_library_once(monkeypatch):
    library, given = Tokenizer.from_file(WORDS), []

    class Watched:
        @staticmethod
        def from_file(_):
            return Watched()

        def __getattr__(self, name):
            def call(texts, **options):
                given.append(texts if isinstance(texts, str) else texts[0])
                return getattr(library, name)(texts, **options)

            return call if name.startswith("encode") else getattr(library, name)

    monkeypatch.setattr(token_files, "CACHE_ENTRIES", 30)
    monkeypatch.setattr(token_files, "CORE_ENTRIES", 30, raising=False)
    monkeypatch.setattr(token_files, "_TOKENIZERS", {})
    monkeypatch.setattr(token_files, "Tokenizer", Watched)
    encode = token_files._encoder(WORDS)
    for i in range(20):
        text = "Frequent " + " ".join(f"rare{chr(97 + i)}{chr(97 + j)}" for j in range(20)) + " x1, l’été!"
        assert encode([text]) == [little_endian(library.encode(text, add_special_tokens=False).ids)]
        assert all(len(cache) <= 30 + 30 for cache in token_files._TOKENIZERS[WORDS][1:])
    assert sum(text.count("frequent") for text in given) == 1
