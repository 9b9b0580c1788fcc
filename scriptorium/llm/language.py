"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.batches import text_slices, whole_texts

DIMS = 4096
GRAMS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 200
CENTROIDS = 4
ROUNDS = 12
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_TABLE = np.arange(256, dtype=np.uint32)
_TABLE[[b for b in range(128) if not chr(b).isalpha()]] = 32


class Model(NamedTuple):
    """Unit centroids (rows), the language and the rejection distance of each, and the weights of the terms."""

    centroids: np.ndarray
    languages: list[str]
    radius: np.ndarray
    idf: np.ndarray


def gram_counts(texts: pa.Array) -> np.ndarray:
    """Hashed counts of the byte n-grams of each lower-cased text; runs of other signs are one blank."""
    out = np.zeros((len(texts), DIMS), np.float32)
    for i, text in enumerate(pc.utf8_lower(pc.fill_null(texts, "")).to_pylist()):
        raw = _TABLE[np.frombuffer(f" {text} ".encode(), np.uint8)]
        raw = raw[np.concatenate([[True], (raw[1:] != 32) | (raw[:-1] != 32)])]
        for n in GRAMS:
            if len(raw) >= n:
                gram = np.full(len(raw) - n + 1, n, np.uint32)
                for k in range(n):
                    gram = gram << np.uint32(8) | raw[k : len(raw) - n + 1 + k]
                slot = (gram * np.uint32(2654435761)) >> np.uint32(20)
                out[i] += np.bincount(slot, minlength=DIMS)
    return out


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length 1; the term frequency is damped by a logarithm."""
    vectors = np.log1p(counts) * idf
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


def cluster(vectors: np.ndarray, most: int, rounds: int = ROUNDS) -> np.ndarray:
    """Up to `most` unit centroids by cosine k-means, begun at the mean and then at what is farthest."""
    chosen = [int(np.argmax(vectors @ vectors.mean(0)))]
    while len(chosen) < min(most, len(vectors)):
        nearest = (vectors @ vectors[chosen].T).max(1)
        if nearest.min() > 1 - 1e-6:
            break
        chosen.append(int(np.argmin(nearest)))
    centroids = vectors[chosen]
    for _ in range(rounds):
        own = (vectors @ centroids.T).argmax(1)
        sums = np.stack([vectors[own == c].sum(0) if (own == c).any() else centroids[c] for c in range(len(centroids))])
        centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return centroids


def fit_language_model(
    docs: DataFrame,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    sample: int = SAMPLE_PER_LANGUAGE,
    most: int = CENTROIDS,
    slack: float = 1.2,
) -> Model | None:
    """Fit centroids to labelled rows; None if there are none.

    Term weights come from all labelled rows. Centroids are clustered on at most `sample` rows of each
    language, those with the lowest key hashes, then text hashes; this bounds what the driver receives. A centroid rejects
    what lies farther from it than `slack` times its farthest sample.
    """
    rows = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.col(label).alias("label"), F.col(text).alias("text")
    )

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                seen += (gram_counts(part.column("text")) > 0).sum(0)
                n += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([seen], pa.list_(pa.int64()))], ["n", "seen"])

    partial = rows.select("text").mapInArrow(frequencies, "n bigint, seen array<bigint>")
    found = partial.select("n", F.posexplode("seen").alias("slot", "seen")).groupBy("slot").agg(F.sum("seen"), F.sum("n")).collect()
    n_rows = found[0][2] if found else 0
    if not n_rows:
        return None
    seen = np.zeros(DIMS)
    seen[[r[0] for r in found]] = [r[1] for r in found]
    idf = (np.log((1 + n_rows) / (1 + seen)) + 1).astype(np.float32)

    order = Window.partitionBy("label").orderBy(F.xxhash64("key"), "key")
    picked = rows.select("key", "label").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= sample)
    sampled = rows.join(F.broadcast(picked.select("key", "label").distinct()), ["key", "label"])
    # A key may be there many times, so the rows themselves are bounded once more.
    again = Window.partitionBy("label").orderBy(F.xxhash64("key"), "key", F.xxhash64("text"))
    sampled = sampled.withColumn("place", F.row_number().over(again)).filter(F.col("place") <= sample).drop("place")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                vectors = [x.tobytes() for x in gram_counts(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("label"), pa.array(vectors)], ["key", "label", "counts"])

    kind = dict(docs.dtypes)
    collected = sampled.mapInArrow(counts, f"key {kind[key]}, label string, counts binary").collect()
    by_label: dict[str, list[tuple]] = {}
    for row in collected:
        by_label.setdefault(row["label"], []).append((str(row["key"]), bytes(row["counts"])))
    centroids, languages, radius = [], [], []
    for name in sorted(by_label):
        raw = np.stack([np.frombuffer(x, np.float32) for _, x in sorted(by_label[name])])
        vectors = unit_vectors(raw, idf)
        own = cluster(vectors, most)
        similarity = vectors @ own.T
        centroids.append(own)
        languages += [name] * len(own)
        radius += [float((1 - similarity[similarity.argmax(1) == c, c]).max(initial=0.0)) * slack for c in range(len(own))]
    return Model(np.concatenate(centroids).astype(np.float32), languages, np.array(radius), idf)


def predict_language(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score, rejected) of each row's whole text.

    The prediction is the language of the centroid of highest cosine, and the score that cosine. A text
    farther from its centroid than that rejects is `rejected`. A text that is missing, empty or without
    a letter, and any text without a model, is `und` with score 0 and rejected. Ties go to the language
    that sorts first; a missing key stays missing; repeated rows give repeated results; an empty table
    gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                readable = np.array([fitted is not None and _LETTER.search(x) is not None for x in whole_texts(part, "text")], bool)
                names, score = np.full(len(readable), UNDETERMINED, object), np.zeros(len(readable))
                rejected = np.ones(len(readable), bool)
                if readable.any():
                    texts = part.column("text").filter(pa.array(readable))
                    similarity = unit_vectors(gram_counts(texts), fitted.idf) @ fitted.centroids.T
                    best = similarity.argmax(1)
                    cosine = similarity[np.arange(len(best)), best].astype(float)
                    names[readable] = np.array(fitted.languages, object)[best]
                    score[readable] = np.clip(cosine, 0, 1)
                    rejected[readable] = 1 - cosine > fitted.radius[best]
                arrays = [part.column("key"), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "lang_pred", "score", "rejected"])

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, lang_pred string, score double, rejected boolean"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def fold_of(key: Column, folds: int = 3) -> Column:
    """The remainder of the CRC-32 of a key written as text; a missing key has none."""
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % folds
