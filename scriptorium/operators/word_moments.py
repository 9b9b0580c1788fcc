"""Mean vector and pairwise similarity of each document's words, for a word table of any size.

Documents are stored in slices of rows. Every distinct word of a slice meets its vector once, by a join
with the stored word table, and travels to the slice with it; so neither a broadcast nor a driver ever
holds the vocabulary, and a frequent word costs a row per slice, not one per use. Within a slice all tokens
are looked up at once, and documents are ragged arrays over the slice's vectors.

For the distinct known words of a document with unit vectors u and counts c let A have the rows sqrt(c) u.
The similarities of all pairs of its tokens sum to (|sum c u|^2 - sum c|u|^2) / 2 and their squares to
(|A A'|^2 - sum c|u|^4) / 2. A A' and A' A have the same norm, so the smaller of them is formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.session import through_table

SLICE_ROWS = 2000
VARIANCE = "f_embed_variance"
_SLICE = "__slice"
_HELD_DOUBLES = 4 * 1024 * 1024


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms == 0, 1.0, norms)


def _blocks(sizes: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Documents of similar size together, so that padding to the largest stays within bounded memory."""
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        upto = at + 1
        while upto < len(order) and (upto + 1 - at) * sizes[order[upto]] * width <= _HELD_DOUBLES:
            upto += 1
        yield order[at:upto]
        at = upto


def _square_of_products(rows: np.ndarray) -> np.ndarray:
    """|A A'|^2 of every A in a stack; a single tall A is taken piece by piece."""
    if len(rows) == 1 and rows[0].size > _HELD_DOUBLES:
        step = max(1, _HELD_DOUBLES // rows.shape[2])
        gram = sum(piece.T @ piece for piece in (rows[0][i : i + step] for i in range(0, rows.shape[1], step)))
        return np.array([np.sum(gram * gram)])
    turned = rows.transpose(0, 2, 1)
    products = rows @ turned if rows.shape[1] <= rows.shape[2] else turned @ rows
    return np.einsum("bij,bij->b", products, products)


def pair_variances(unit: np.ndarray, doc: np.ndarray, word: np.ndarray, docs: int) -> np.ndarray:
    """Variance of similarity over all pairs of tokens of each document; zero below two tokens.

    Token i belongs to document doc[i] and has the vector unit[word[i]].
    """
    found = np.zeros(docs)
    pair, count = np.unique(doc * max(len(unit), 1) + word, return_counts=True)
    doc, word = np.divmod(pair, max(len(unit), 1))
    tokens = np.bincount(doc, weights=count, minlength=docs)
    size = np.bincount(doc, minlength=docs)
    begin = np.cumsum(size) - size
    squares = np.einsum("ij,ij->i", unit, unit)[word]
    own = np.bincount(doc, weights=count * squares, minlength=docs)
    own_squared = np.bincount(doc, weights=count * squares**2, minlength=docs)
    many = np.flatnonzero(tokens >= 2)
    for block in _blocks(size[many], unit.shape[1]):
        block = many[block]
        sizes = size[block]
        owner = np.repeat(np.arange(len(block)), sizes)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        picked = np.repeat(begin[block], sizes) + inside
        root = np.zeros((len(block), sizes.max()))
        root[owner, inside] = np.sqrt(count[picked])
        rows = np.zeros((*root.shape, unit.shape[1]))
        rows[owner, inside] = unit[word[picked]] * root[owner, inside][:, None]
        total = np.einsum("bk,bkd->bd", root, rows)
        pairs = tokens[block] * (tokens[block] - 1) / 2
        first = (np.einsum("bd,bd->b", total, total) - own[block]) / 2 / pairs
        second = (_square_of_products(rows) - own_squared[block]) / 2 / pairs
        found[block] = np.maximum(second - first * first, 0.0)
    return found


def mean_vectors(vectors: np.ndarray, doc: np.ndarray, word: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Sum of the known tokens' vectors over the count of all tokens, per document; `doc` must not fall."""
    means = np.zeros((len(tokens), vectors.shape[1]))
    step = max(1, _HELD_DOUBLES // max(vectors.shape[1], 1))
    begin = np.flatnonzero(np.diff(doc, prepend=-1))
    for at, upto in zip(begin, np.append(begin[1:], len(doc))):
        for i in range(at, upto, step):
            means[doc[at]] += vectors[word[i : min(i + step, upto)]].sum(axis=0)
    return means / np.maximum(tokens, 1)[:, None]


def _slice_moments(tokens: pa.Array, words: pa.Array, vectors: np.ndarray, spread: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """(means, variances) of the documents of one slice; variances only if `spread`."""
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    place = pc.fill_null(pc.index_in(tokens.flatten(), value_set=words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    known = place >= 0
    doc, place = doc[known], place[known]
    variances = pair_variances(unit_rows(vectors), doc, place, len(sizes)) if spread else None
    return mean_vectors(vectors, doc, place, sizes), variances


def word_table(vectors: DataFrame, word: str = "word", vector: str = "vector") -> DataFrame:
    """(word, vector array<float>), stored; vectors may be MLlib vectors or arrays."""
    kind = vectors.schema[vector].dataType.simpleString()
    values = F.col(vector) if kind.startswith("array") else vector_to_array(vector)
    return through_table(vectors.select(F.col(word).alias("word"), values.cast("array<float>").alias("vector")), "word-table")


def with_word_moments(
    docs: DataFrame,
    tokens: str,
    words: DataFrame,
    dims: int,
    mean: str = "w2v_features",
    variance: str | None = VARIANCE,
    keep_tokens: bool = True,
) -> DataFrame:
    """Add the mean word vector (an MLlib vector) and, unless `variance` is None, the variance of token similarity to every row.

    `words` is a stored table (word, vector) with distinct words, `tokens` an array column; the other columns
    must have plain SQL types. Unknown tokens count for the mean's divisor only. A row without tokens
    gets the zero vector; one with fewer than two known tokens the variance 0. Rows with equal keys or
    equal tokens stay rows of their own. Without `keep_tokens` the tokens are not sent back.
    """
    sliced = docs.withColumn(_SLICE, F.expr(f"monotonically_increasing_id() div {SLICE_ROWS}"))
    rows = through_table(sliced, "word-slices")
    asked = rows.select(_SLICE, F.explode(tokens).alias("word")).distinct()
    known = asked.join(words.select("word", "vector"), "word").select(F.col(_SLICE).alias("__asked"), "word", "vector")
    columns = [c for c in rows.columns if c != _SLICE and (keep_tokens or c != tokens)]

    def moments(texts: pa.Table, held: pa.Table) -> pa.Table:
        flat = held.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        matrix = flat.astype(np.float64).reshape(-1, dims)
        listed, known = texts.column(tokens).combine_chunks(), held.column("word").combine_chunks()
        means, variances = _slice_moments(listed, known, matrix, variance is not None)
        ends = np.arange(len(means) + 1, dtype=np.int32) * dims
        out = texts.select(columns).append_column(mean, pa.ListArray.from_arrays(pa.array(ends), pa.array(means.ravel())))
        return out if variances is None else out.append_column(variance, pa.array(variances.astype(np.float32)))

    fields = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns]
    added = [f"`{mean}` array<double>", *([f"`{variance}` float"] if variance else [])]
    schema = ", ".join([*fields, *added])
    done = rows.groupBy(_SLICE).cogroup(known.groupBy("__asked")).applyInArrow(moments, schema)
    return done.withColumn(mean, array_to_vector(mean))
