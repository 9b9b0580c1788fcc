"""Word vectors without a vocabulary on the driver: co-occurrence weights under a random projection, by joins.

A word's row of positive pointwise mutual information with its context words is projected to few
dimensions. Each context has a sign for every dimension, which are bits of hashes of the context, so no
projection matrix is kept anywhere. Weights are whole numbers, whose sums do not depend on their order:
the vectors are the same for any number of tasks and for every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.hashing import HASH_BITS, key_hash
from scriptorium.session import through_table

WINDOW = 5
DIMS = 64
MIN_COUNT = 3
WEIGHT_UNITS = 1 << 16
PIECE_PAIRS = 4_000_000


def neighbours(tokens: Column | str, window: int) -> Column:
    """All pairs (a, b) of tokens at most `window` places apart, a before b."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    n = F.size(tokens)

    def at_distance(distance: Column) -> Column:
        left, right = F.slice(tokens, F.lit(1), n - distance), F.slice(tokens, distance + 1, n - distance)
        return F.arrays_zip(left.alias("a"), right.alias("b"))

    distances = F.sequence(F.lit(1), F.least(F.lit(window), n - 1))
    return F.when(n > 1, F.flatten(F.transform(distances, at_distance)))


def pair_counts(texts: pa.ListArray, window: int) -> pa.Table:
    """(a, b, n): how often two tokens, a not after b in order of their bytes, are at most `window` places apart in a text.

    Rows without b count the token a itself.
    """
    sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
    encoded = texts.flatten().dictionary_encode()
    order = pc.array_sort_indices(encoded.dictionary)
    words = encoded.dictionary.take(order)
    rank = np.full(len(words) + 1, -1, np.int64)
    rank[order.to_numpy()] = np.arange(len(words))
    token = rank[pc.fill_null(encoded.indices, len(words)).to_numpy(zero_copy_only=False)]
    text = np.repeat(np.arange(len(sizes)), sizes)
    keys = [token[:0]]
    for distance in range(1, min(window, max(len(token) - 1, 0)) + 1):
        left, right = token[:-distance], token[distance:]
        both = (text[:-distance] == text[distance:]) & (left >= 0) & (right >= 0)
        left, right = left[both], right[both]
        keys.append(np.minimum(left, right) * len(words) + np.maximum(left, right))
    pairs, n = np.unique(np.concatenate(keys), return_counts=True)
    a, b = np.divmod(pairs, max(len(words), 1))
    own = pa.table({"a": words, "b": pa.nulls(len(words), words.type), "n": np.bincount(token[token >= 0], minlength=len(words))})
    return pa.concat_tables([own, pa.table({"a": words.take(pa.array(a)), "b": words.take(pa.array(b)), "n": pa.array(n, pa.int64())})])


def neighbour_counts(docs: DataFrame, tokens: str, window: int) -> DataFrame:
    """(a, b, n) of `pair_counts` over all texts, stored; added up within pieces of a task's texts before they are sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < len(texts):
                most = (ends[at - 1] if at else 0) + PIECE_PAIRS // window
                upto = max(at + 1, int(np.searchsorted(ends, most, side="right")))
                yield from pair_counts(texts.slice(at, upto - at), window).to_batches()
                at = upto

    counted = docs.select(tokens).mapInArrow(run, "a string, b string, n bigint")
    return through_table(counted.groupBy("a", "b").agg(F.sum("n").alias("n")), "neighbour-counts")


def _both_ways(pairs: DataFrame, left: str, right: str, *others: str) -> DataFrame:
    """Each pair under either of its words; a word's pair with itself is there once."""
    forward = pairs.select(F.col("a").alias(left), F.col("b").alias(right), *others)
    return forward.unionAll(pairs.filter(F.col("a") != F.col("b")).select(F.col("b").alias(left), F.col("a").alias(right), *others))


def context_weights(docs: DataFrame, tokens: str, window: int = WINDOW, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, context, weight): positive pointwise mutual information in units of 1 / `WEIGHT_UNITS`.

    Words that occur fewer than `min_count` times are neither words nor contexts, but keep their places. Weights are
    the same either way round, so pairs are counted, joined and stored one way.
    """
    counts = neighbour_counts(docs, tokens, window)
    often = counts.filter(F.col("b").isNull() & (F.col("n") >= min_count)).select(F.col("a").alias("word"))
    known = counts.filter(F.col("b").isNotNull()).join(often.withColumnRenamed("word", "a"), "a").join(often.withColumnRenamed("word", "b"), "b")
    twice = F.when(F.col("a") == F.col("b"), F.col("n") * 2).otherwise(F.col("n"))
    known = through_table(known.select("a", "b", twice.alias("n")), "projected-pairs")
    margins = through_table(_both_ways(known, "a", "b", "n").groupBy("a").agg(F.sum("n").alias("margin")), "projected-margins")
    total = margins.agg(F.coalesce(F.sum("margin"), F.lit(0))).first()[0]
    joined = known.join(margins, "a").join(margins.select(F.col("a").alias("b"), F.col("margin").alias("other")), "b")
    share = F.col("n").cast("double") * F.lit(float(total)) / (F.col("margin").cast("double") * F.col("other").cast("double"))
    weight = F.floor(F.ln(share) * WEIGHT_UNITS).cast("bigint")
    weights = through_table(joined.filter(share > 1).select("a", "b", weight.alias("weight")), "projected-weights")
    return _both_ways(weights, "word", "context", "weight")


def projected_sums(weights: DataFrame, dims: int = DIMS, seed: int = 42) -> DataFrame:
    """(word, block, sums): of each block of 32 dimensions the sums of weights under the contexts' signs."""
    if dims % HASH_BITS:
        raise ValueError(f"dimensions come in blocks of {HASH_BITS}")
    contexts = weights.select("context").distinct()
    blocks = F.posexplode(F.array(*(key_hash(F.concat_ws(":", "context", F.lit(str(b))), seed) for b in range(dims // HASH_BITS))))
    signs = contexts.select("context", blocks.alias("block", "bits"))
    signed = weights.join(signs, "context")
    sums = [F.sum(F.when(F.shiftright("bits", j).bitwiseAND(F.lit(1)) == 1, -F.col("weight")).otherwise(F.col("weight"))) for j in range(HASH_BITS)]
    summed = signed.groupBy("word", "block").agg(*(s.alias(f"s{j}") for j, s in enumerate(sums)))
    return summed.select("word", "block", F.array(*(f"s{j}" for j in range(HASH_BITS))).alias("sums"))


def projected_vectors(
    docs: DataFrame, tokens: str, dims: int = DIMS, window: int = WINDOW, min_count: int = MIN_COUNT, seed: int = 42
) -> DataFrame:
    """(word, vector array<double>) of all words that occur often enough and have a context that tells something."""
    sums = projected_sums(context_weights(docs, tokens, window, min_count), dims, seed)
    gathered = sums.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("block", "sums"))).alias("blocks"))
    scale = WEIGHT_UNITS * float(dims) ** 0.5
    return gathered.select("word", F.transform(F.flatten("blocks.sums"), lambda x: x / F.lit(scale)).alias("vector"))
