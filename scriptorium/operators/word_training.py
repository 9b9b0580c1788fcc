"""Skip-gram word vectors with hierarchical softmax, trained side by side, with no vocabulary on the driver.

It is the model that MLlib's Word2Vec fits in one iteration: windows of random width, a Huffman tree over the
words' counts, a learning rate that falls with the tokens seen, and slices of the corpus that train from the same
start and are averaged over those that met a word. MLlib sends both matrices through the driver; here

* the tree follows from how many words have each count. Words are ranked by count, codes are canonical, and an
  inner node is named by its depth and the code's first bits; so a word's path follows from its code alone;
* a vector's start is a hash of the word's rank and the seed, so a slice gets the codes of its own words and no vectors;
* a slice holds the vectors of the words and nodes that it meets, and sends those of its words back once.

Centres are taken in blocks, whose pairs meet their nodes in one product of matrices. The steps of a row are divided
by one plus half the largest curvature they can have together: undamped they overshoot from 16 centres on.
"""

from __future__ import annotations

import heapq
import json
import time
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.operators.word_moments import with_word_moments
from scriptorium.session import through_table

# Those of MLlib.
WINDOW = 5
LEARNING_RATE = 0.025
LEAST_SHARE_OF_RATE = 0.0001
LARGEST_SCORE = 6.0
LONGEST_SENTENCE = 1000
# Our own choice.
BLOCK = 16
DAMPING = 0.125
CHUNK_TOKENS = 16_384
TEXTS_AT_ONCE = 1000
SENT_ROWS = 20_000
ROWS_PER_MEAN = 40_000
RANK_BUCKETS = 1024
SEPARATOR = "\x1f"

_SENT = "rank bigint, word string, slice int, met boolean, vector array<float>"


def leaf_depths(histogram: list[tuple[int, int]]) -> dict[int, int]:
    """How many leaves each depth of a Huffman tree has, from pairs (weight, how many leaves weigh that).

    Nodes of equal weight are merged together, so this takes about as many steps as there are weights.
    """
    name = count()
    heap = [(weight, next(name), m) for weight, m in histogram]
    heapq.heapify(heap)
    parts: dict[int, tuple] = {}
    while heap:
        weight, node, m = heapq.heappop(heap)
        if m > 1:
            parts[both := next(name)] = ((node, 2),)
            heapq.heappush(heap, (2 * weight, both, m // 2))
            if m % 2 == 0:
                continue
        if not heap:
            break
        other_weight, other, others = heapq.heappop(heap)
        if others > 1:
            heapq.heappush(heap, (other_weight, other, others - 1))
        parts[both := next(name)] = ((node, 1), (other, 1))
        heapq.heappush(heap, (weight + other_weight, both, 1))
    depths = [Counter() for _ in range(next(name))]
    depths[-1][0] = 1
    leaves: Counter = Counter()
    for node in reversed(range(len(depths))):
        if node not in parts:
            leaves.update(depths[node])
        for part, times in parts.get(node, ()):
            for depth, m in depths[node].items():
                depths[part][depth + 1] += m * times
    return dict(sorted(leaves.items()))


def ranked_codes(counts: DataFrame, histogram: list[tuple[int, int]]) -> DataFrame:
    """(word, rank, length, code) of a stored table (word, n): ranks follow falling counts, codes are canonical."""
    spark = counts.sparkSession
    before, rows = 0, []
    for n, m in sorted(histogram, reverse=True):
        rows.append((n, before))
        before += m
    firsts = spark.createDataFrame(rows, "n bigint, before bigint")
    dealt = counts.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(RANK_BUCKETS)))
    earlier = Window.partitionBy("n").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("n", "bucket").agg(F.count("*").alias("m"))
    sizes = sizes.select("n", "bucket", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("inside"))
    place = F.row_number().over(Window.partitionBy("n", "bucket").orderBy("word")) - 1
    placed = dealt.withColumn("place", place).join(sizes, ["n", "bucket"]).join(F.broadcast(firsts), "n")
    rank = F.col("before") + F.col("inside") + F.col("place")
    first_rank, first_code, shorter, codes = 0, 0, 0, []
    for length, m in leaf_depths(histogram).items():
        first_code <<= length - shorter
        named = F.struct(F.lit(length).alias("length"), (F.col("rank") + F.lit(first_code - first_rank)).alias("code"))
        codes.append(F.when(F.col("rank") < first_rank + m, named))
        first_rank, first_code, shorter = first_rank + m, first_code + m, length
    coded = placed.select("word", rank.alias("rank")).withColumn("named", F.coalesce(*codes))
    return coded.select("word", "rank", "named.length", "named.code")


def start_vectors(ranks: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Even values between -0.5 / size and 0.5 / size, from a hash (splitmix64) of rank, dimension and seed."""
    made = np.empty((len(ranks), size), np.float32)
    with np.errstate(over="ignore"):
        for at in range(0, len(ranks), SENT_ROWS):
            places = ranks[at : at + SENT_ROWS, None].astype(np.uint64) * np.uint64(size) + np.arange(size, dtype=np.uint64)
            bits = (places + np.uint64(seed % (1 << 32)) * np.uint64(0xD1342543DE82EF95)) * np.uint64(0x9E3779B97F4A7C15)
            bits = (bits ^ (bits >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            bits = (bits ^ (bits >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            bits ^= bits >> np.uint64(31)
            made[at : at + SENT_ROWS] = ((bits >> np.uint64(40)).astype(np.float64) / (1 << 24) - 0.5) / size
    return made


def inner_paths(lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, int]:
    """The inner nodes on each word's path from the root (-1 beyond its end), and how many there are.

    Words must be in order of their ranks; then those that share the first bits of their codes are neighbours.
    """
    paths = np.full((len(lengths), lengths.max(initial=0)), -1, np.int32)
    nodes = 0
    for depth in range(paths.shape[1]):
        deep = np.flatnonzero(lengths > depth)
        shared = np.cumsum(np.diff(codes[deep] >> (lengths[deep] - depth), prepend=-1) != 0)
        paths[deep, depth] = nodes + shared - 1
        nodes += int(shared[-1])
    return paths, nodes


def _grouped(block: np.ndarray, item: np.ndarray, items: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct items of each block, where those of each block begin, and each entry's place among its block's."""
    keys, place = np.unique(block * items + item, return_inverse=True)
    begin = np.searchsorted(keys, np.arange(blocks + 1) * items)
    return keys % items, begin, place - begin[block]


class SliceTrainer:
    """Vectors of the words of one slice of the corpus, and of the inner nodes on their paths."""

    def __init__(self, words: pa.Table, size: int, seed: int, part: int, parts: int, total: int):
        self.words = words.column("word").combine_chunks()
        self.ranks = words.column("rank").to_numpy()
        self.lengths = words.column("length").to_numpy().astype(np.int64)
        self.codes = words.column("code").to_numpy()
        self.paths, nodes = inner_paths(self.lengths, self.codes)
        self.inputs = start_vectors(self.ranks, size, seed)
        self.outputs = np.zeros((nodes, size), np.float32)
        self.met = np.zeros(len(self.ranks), bool)
        self.random = np.random.default_rng([seed % (1 << 32), part])
        self.part, self.parts, self.total, self.seen = part, parts, total, 0
        self.kept, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def read(self, texts: pa.ListArray) -> None:
        """Train on the known words of texts. What is left of a chunk waits for the next texts, so batches do not matter."""
        sizes = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
        found = pc.fill_null(pc.index_in(texts.flatten(), value_set=self.words), -1).to_numpy(zero_copy_only=False)
        known = found >= 0
        lengths = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[known], minlength=len(sizes))
        sentences = -(-lengths // LONGEST_SENTENCE)
        cut = np.full(sentences.sum(), LONGEST_SENTENCE)
        some = sentences > 0
        cut[np.cumsum(sentences)[some] - 1] = (lengths - (sentences - 1) * LONGEST_SENTENCE)[some]
        self.kept = np.concatenate([self.kept, found[known].astype(np.int64)])
        self.sizes = np.concatenate([self.sizes, cut])
        ends = np.cumsum(self.sizes)
        at = done = 0
        while done < len(ends) and ends[-1] - at >= CHUNK_TOKENS:
            upto = int(np.searchsorted(ends, at + CHUNK_TOKENS)) + 1
            self._learn(self.kept[at : ends[upto - 1]], self.sizes[done:upto])
            at, done = ends[upto - 1], upto
        self.kept, self.sizes = self.kept[at:].copy(), self.sizes[done:].copy()

    def finish(self) -> Iterator[pa.RecordBatch]:
        """Train on what is left; (rank, word, slice, met, vector) of every word of the slice."""
        if len(self.kept):
            self._learn(self.kept, self.sizes)
        del self.outputs, self.paths
        size = self.inputs.shape[1]
        for at in range(0, len(self.ranks), SENT_ROWS):
            rows = self.inputs[at : at + SENT_ROWS]
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * size)
            columns = [
                pa.array(self.ranks[at : at + SENT_ROWS]),
                self.words.slice(at, SENT_ROWS),
                pa.array(np.full(len(rows), self.part, np.int32)),
                pa.array(self.met[at : at + SENT_ROWS]),
                pa.ListArray.from_arrays(ends, pa.array(rows.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["rank", "word", "slice", "met", "vector"])

    def _learn(self, tokens: np.ndarray, sizes: np.ndarray) -> None:
        n = len(tokens)
        blocks = -(-n // BLOCK)
        begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
        end = begin + np.repeat(sizes, sizes)
        reach = self.random.integers(1, WINDOW + 1, n)
        offsets = np.concatenate([np.arange(-WINDOW, 0), np.arange(1, WINDOW + 1)])
        other = np.arange(n)[:, None] + offsets
        centre, column = np.nonzero((other >= begin[:, None]) & (other < end[:, None]) & (np.abs(offsets) <= reach[:, None]))
        context = tokens[centre + offsets[column]]
        self.met[context] = True
        words, word_begin, word_place = _grouped(centre // BLOCK, context, len(self.ranks), blocks)
        pair_begin = np.searchsorted(centre, np.arange(blocks + 1) * BLOCK)
        centre %= BLOCK

        deep = self.lengths[tokens]
        row = np.repeat(np.arange(n), deep)
        depth = np.arange(len(row)) - np.repeat(np.cumsum(deep) - deep, deep)
        word = tokens[row]
        wanted = (1 - ((self.codes[word] >> (deep[row] - depth - 1)) & 1)).astype(np.float32)
        nodes, node_begin, node_place = _grouped(row // BLOCK, self.paths[word, depth].astype(np.int64), max(len(self.outputs), 1), blocks)
        entry_begin = np.searchsorted(row, np.arange(blocks + 1) * BLOCK)
        row %= BLOCK

        for b in range(blocks):
            rate = LEARNING_RATE * max(1 - self.parts * self.seen / (self.total + 1), LEAST_SHARE_OF_RATE)
            self.seen += min(BLOCK, n - b * BLOCK)
            here, there = slice(pair_begin[b], pair_begin[b + 1]), slice(entry_begin[b], entry_begin[b + 1])
            if here.start < here.stop and there.start < there.stop:
                asked, met = words[word_begin[b] : word_begin[b + 1]], nodes[node_begin[b] : node_begin[b + 1]]
                near = np.bincount(word_place[here] * BLOCK + centre[here], minlength=len(asked) * BLOCK).reshape(-1, BLOCK)
                on_path = np.zeros((2, BLOCK, len(met)), np.float32)
                on_path[0, row[there], node_place[there]] = 1
                on_path[1, row[there], node_place[there]] = wanted[there]
                self._step(asked, met, near.astype(np.float32), on_path, rate)

    def _step(self, asked: np.ndarray, met: np.ndarray, near: np.ndarray, on_path: np.ndarray, rate: float) -> None:
        """All pairs of a block at once: `near` counts how often a word is near a centre, `on_path` has the centres' nodes."""
        x, y = self.inputs[asked], self.outputs[met]
        pairs, wanted = near @ on_path[0], near @ on_path[1]
        score = x @ y.T
        told = np.abs(score) < LARGEST_SCORE
        step = (wanted - pairs / (1 + np.exp(-np.clip(score, -LARGEST_SCORE, LARGEST_SCORE)))) * told
        step *= np.float32(rate)
        bend = np.float32(rate * DAMPING)
        self.inputs[asked] = x + (step @ y) / (1 + bend * (pairs @ np.einsum("ij,ij->i", y, y)))[:, None]
        self.outputs[met] = y + (step.T @ x) / (1 + bend * (np.einsum("ij,ij->i", x, x) @ pairs))[:, None]


def _token_lists(rows: pa.RecordBatch) -> pa.ListArray:
    joined, lists = rows.column("joined"), rows.column("tokens")
    split = pc.split_pattern(joined, SEPARATOR)
    if not joined.null_count:
        return split
    return pa.array([b if a is None else a for a, b in zip(split.to_pylist(), lists.to_pylist())], pa.list_(pa.string()))


def train_slices(batches: Iterator[pa.RecordBatch], size: int, seed: int, parts: int, total: int) -> Iterator[pa.RecordBatch]:
    """Rows of slices one after another, each the slice's words by rank and then its texts, to the words' vectors."""
    current, listed, trainer = None, [], None

    def done():
        if trainer is not None:
            yield from trainer.finish()

    for batch in batches:
        part, is_text = batch.column("slice").to_numpy(), batch.column("is_text").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(part * 2 + is_text)) + 1
        for at, upto in zip([0, *cuts], [*cuts, len(part)]):
            rows = batch.slice(at, upto - at)
            if part[at:upto].size and part[at] != current:
                yield from done()
                current, listed, trainer = part[at], [], None
            if not is_text[at:upto].any():
                listed.append(rows.select(["word", "rank", "length", "code"]))
                continue
            if trainer is None and listed:
                trainer = SliceTrainer(pa.Table.from_batches(listed), size, seed, int(current), parts, total)
                listed = []
            for first in range(0, rows.num_rows if trainer else 0, TEXTS_AT_ONCE):
                trainer.read(_token_lists(rows.slice(first, TEXTS_AT_ONCE)))
    yield from done()


def mean_of_slices(sent: pa.Table, size: int) -> pa.Table:
    """(word, vector): the mean over the slices in which a word was near another; else the vector it started with."""
    ranks = sent.column("rank").to_numpy()
    order = np.lexsort((sent.column("slice").to_numpy(), ranks))
    begin = np.flatnonzero(np.diff(ranks[order], prepend=-1))
    vectors = sent.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, size)[order]
    met = sent.column("met").to_numpy()[order]
    found = np.add.reduceat(met.astype(np.int64), begin)
    sums = np.add.reduceat(vectors * met[:, None], begin, dtype=np.float64)
    means = np.where(found[:, None] > 0, sums / np.maximum(found, 1)[:, None], vectors[begin]).astype(np.float32)
    ends = pa.array(np.arange(len(means) + 1, dtype=np.int32) * size)
    words = sent.column("word").take(pa.array(order[begin]))
    return pa.table({"word": words, "vector": pa.ListArray.from_arrays(ends, pa.array(means.ravel()))})


def train_word_vectors(texts: DataFrame, tokens: str, size: int, min_count: int, parts: int, seed: int) -> DataFrame:
    """(word, vector array<float>), stored, of the words that occur `min_count` times; `parts` slices train side by side.

    Texts are dealt out and ordered by their content, so the vectors do not depend on the cluster.
    """
    joined = F.array_join(tokens, SEPARATOR)
    kept_whole = F.length(joined) - F.length(F.replace(joined, F.lit(SEPARATOR), F.lit(""))) == F.size(tokens) - 1
    named = texts.select(
        F.pmod(F.xxhash64(tokens), F.lit(parts)).cast("int").alias("slice"),
        F.when(kept_whole, joined).alias("joined"),
        F.when(~kept_whole, F.col(tokens)).alias("tokens"),
        F.col(tokens).alias("listed"),
    ).filter(F.size("listed") > 0)
    met = named.select("slice", F.explode("listed").alias("word")).filter(F.col("word").isNotNull())
    met = through_table(met.groupBy("slice", "word").agg(F.count("*").alias("n")), "slice-words")
    counts = met.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    counts = through_table(counts, "word-counts")
    histogram = [(r.n, r.m) for r in counts.groupBy("n").agg(F.count("*").alias("m")).collect()]
    if not histogram:
        raise ValueError(f"no word occurs {min_count} times")
    total = sum(n * m for n, m in histogram)
    codes = through_table(ranked_codes(counts, histogram), "word-codes")

    words = met.select("slice", "word").join(codes, "word").select(
        "slice", F.lit(False).alias("is_text"), F.col("rank").alias("place"), "word", "rank", "length", "code",
        F.lit(None).cast("string").alias("joined"), F.lit(None).cast("array<string>").alias("tokens"),
    )
    rows = named.select(
        "slice", F.lit(True).alias("is_text"), F.xxhash64("listed").alias("place"), F.lit(None).cast("string").alias("word"),
        *(F.lit(None).cast(kind).alias(c) for c, kind in (("rank", "bigint"), ("length", "int"), ("code", "bigint"))), "joined", "tokens",
    )
    dealt = words.unionAll(rows).repartitionById(parts, "slice").sortWithinPartitions("slice", "is_text", "place", "joined", "tokens")
    sent = dealt.mapInArrow(lambda batches: train_slices(batches, size, seed, parts, total), _SENT)
    buckets = max(1, met.count() // ROWS_PER_MEAN)
    means = sent.groupBy(F.pmod("rank", F.lit(buckets)).alias("bucket")).applyInArrow(
        lambda sent: mean_of_slices(sent, size), "word string, vector array<float>"
    )
    return through_table(means, "word-vectors")


class WordVectors:
    """Fitted word vectors as a stored table; saved in the form of MLlib's Word2VecModel, which can load them."""

    def __init__(self, table: DataFrame, tokens: str, output: str, **params: int):
        self.table, self.tokens, self.output, self.params = table, tokens, output, params

    def getVectors(self) -> DataFrame:
        return self.table.select("word", array_to_vector(F.col("vector").cast("array<double>")).alias("vector"))

    def getVectorSize(self) -> int:
        return self.params["vectorSize"]

    def transform(self, docs: DataFrame) -> DataFrame:
        """Add the mean vector of each row's tokens."""
        return with_word_moments(docs, self.tokens, self.table, self.getVectorSize(), mean=self.output, variance=None)

    def save(self, path: str) -> None:
        spark = self.table.sparkSession
        uid = f"Word2Vec_{uuid.uuid4().hex[:12]}"
        metadata = {
            "class": "org.apache.spark.ml.feature.Word2VecModel",
            "timestamp": int(time.time() * 1000),
            "sparkVersion": spark.version,
            "uid": uid,
            "paramMap": {"inputCol": self.tokens, "outputCol": self.output, **self.params},
            "defaultParamMap": {},
        }
        self.table.write.mode("overwrite").parquet(f"{path}/data")
        described = spark.createDataFrame([(json.dumps(metadata),)], "value string")
        described.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
