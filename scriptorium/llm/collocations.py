"""Collocations of two and three words, counted in direct-address tiles of ranked ids.

Texts are cut into slices, each stored once as codes into its own list of words. Words that occur often
enough get an id, by language and falling frequency, through a join of the slices' word lists, so no task
and no broadcast ever holds the vocabulary. The pairs of neighbouring ids of a slice fall into square
tiles of `tile` x `tile` cells, the frequent words into the first ones: a tile with many pairs is counted
by a dense bincount over its cells, the pairs of all other tiles as sorted coordinates. Cells add up over
the slices. Pairs that are frequent get ids by falling frequency in the same way, and (pair, next word)
is counted as a pair of ids again.

A phrase is only as frequent as its rarest part, so words and pairs below the least count can be left
out without losing a candidate or a count that a candidate needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.batches import text_slices
from scriptorium.llm.codes import row_positions, word_codes
from scriptorium.llm.words import flat_bytes, split_words
from scriptorium.session import through_table

LEAST_COUNT = 10
TOP = 2000
TILE = 1024
SLICE_BYTES = 8 << 20
SLICE_ROWS = 20_000
UNKNOWN = "und"
_TILE_BITS = 31
_BREAK = ord("\n")
# One letter for another: capitals A-Z become small, every mark that ends a piece becomes a line feed.
_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[ord("A") : ord("Z") + 1] += 32
_LETTERS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = _BREAK


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<i8").tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, 8 * n, codec="zstd", asbytes=True), "<i8")


def coded_pieces(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Word codes of all rows in order, -1 behind the last word of each piece, and the words they point to."""
    data, offsets = flat_bytes(column)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(_LETTERS[data])]
    words = split_words(pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers))
    codes, distinct = word_codes(words)
    breaks = np.flatnonzero(words.data == _BREAK)
    piece = np.searchsorted(breaks, words.begin) + row_positions(words.first)
    last = np.flatnonzero(np.append(piece[1:] != piece[:-1], True)) if len(piece) else piece
    return np.insert(codes, last + 1, -1), distinct


_SLICES = "slice bigint, lang string, n_words bigint, n_codes bigint, words array<string>, counts array<bigint>, codes binary"


def _slices(docs: DataFrame) -> DataFrame:
    """Slices of one language each: its words, how often each occurs, and the text as codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            langs = pc.fill_null(batch.column("lang"), UNKNOWN)
            batch = batch.take(pc.sort_indices(langs))
            langs = langs.take(pc.sort_indices(langs)).dictionary_encode()
            cuts = np.flatnonzero(np.diff(langs.indices.to_numpy())) + 1 if batch.num_rows else []
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                for part in text_slices(batch.slice(begin, end - begin), "text", SLICE_BYTES, SLICE_ROWS):
                    codes, words = coded_pieces(part.column("text"))
                    if not len(words):
                        continue
                    counts = np.bincount(codes[codes >= 0], minlength=len(words))
                    row = {
                        "slice": [number],
                        "lang": [langs[begin].as_py()],
                        "n_words": [int(counts.sum())],
                        "n_codes": [len(codes)],
                        "words": pa.ListArray.from_arrays([0, len(words)], words.cast(pa.large_string()).cast(pa.string())),
                        "counts": [counts],
                        "codes": [_packed(codes)],
                    }
                    number += 1
                    yield pa.RecordBatch.from_pydict(row)

    return docs.mapInArrow(run, _SLICES)


def _ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Store `rows` with ids 0, 1, 2 … along `order`: sorted by ranges, each shifted by the rows before it."""
    partitions = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    sorted_rows = rows.repartitionByRange(int(partitions), *order).sortWithinPartitions(*order)
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    stored = through_table(sorted_rows.select("*", F.spark_partition_id().alias("range"), local.alias("place")), name)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("range").agg(F.count("*").alias("size"))
    shifts = sizes.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"))
    return stored.join(F.broadcast(shifts), "range").withColumn("id", F.col("place") + F.col("shift")).drop("range", "place", "shift")


def tile_counts(left: np.ndarray, right: np.ndarray, side: int = TILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tile, cell, n) of the pairs: dense counts where a tile is well filled, sorted coordinates elsewhere."""
    tile = (left // side << _TILE_BITS) | right // side
    cell = left % side * side + right % side
    order = np.argsort(tile, kind="stable")
    tile, cell = tile[order], cell[order]
    begin = np.flatnonzero(np.append(True, tile[1:] != tile[:-1])) if len(tile) else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, len(tile)))
    dense = size >= side * side // 16
    tiles, cells, counts = [], [], []
    for at, n in zip(begin[dense], size[dense], strict=True):
        filled = np.bincount(cell[at : at + n], minlength=side * side)
        held = np.flatnonzero(filled)
        tiles.append(np.full(len(held), tile[at]))
        cells.append(held)
        counts.append(filled[held])
    sparse = np.repeat(~dense, size)
    tile, cell = tile[sparse], cell[sparse]
    order = np.lexsort((cell, tile))
    tile, cell = tile[order], cell[order]
    begin = np.flatnonzero(np.append(True, (tile[1:] != tile[:-1]) | (cell[1:] != cell[:-1]))) if len(tile) else order
    tiles.append(tile[begin])
    cells.append(cell[begin])
    counts.append(np.diff(np.append(begin, len(tile))))
    return np.concatenate(tiles), np.concatenate(cells), np.concatenate(counts)


def _cells(left: np.ndarray, right: np.ndarray, side: int) -> pa.RecordBatch:
    tile, cell, n = tile_counts(left, right, side)
    return pa.RecordBatch.from_arrays([pa.array(tile), pa.array(cell.astype(np.int32)), pa.array(n.astype(np.int64))], ["tile", "cell", "n"])


def _frequent(cells: DataFrame, least: int, side: int) -> DataFrame:
    """(left, right, a): the pairs of ids with their counts over all slices, from `least` on."""
    total = cells.groupBy("tile", "cell").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
    left = F.expr(f"shiftright(tile, {_TILE_BITS}) * {side} + cell div {side}")
    right = F.expr(f"(tile & {(1 << _TILE_BITS) - 1}) * {side} + cell % {side}")
    return total.select(left.alias("left"), right.alias("right"), "a")


def _with_ids(slices: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(slice, n_codes, ids): each slice with ids for codes; -1 for rare words and behind pieces."""
    asked = slices.select("slice", "lang", F.posexplode("words").alias("code", "word"))
    known = asked.join(vocabulary.select("lang", "word", "id"), ["lang", "word"])
    answers = known.groupBy("slice").agg(F.collect_list(F.struct("code", "id")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch.column("n_codes")[i].as_py()
                codes = _unpacked(batch.column("codes")[i].as_py(), n)
                pairs = batch.column("known")[i].values
                ids = np.full(codes.max(initial=-1) + 2, -1, np.int64)
                ids[pairs.field("code").to_numpy()] = pairs.field("id").to_numpy()
                ids[-1] = -1
                row = {"slice": [batch.column("slice")[i].as_py()], "n_codes": [n], "ids": [_packed(ids[codes])]}
                yield pa.RecordBatch.from_pydict(row)

    joined = slices.select("slice", "n_codes", "codes").join(answers, "slice")
    return joined.mapInArrow(run, "slice bigint, n_codes bigint, ids binary")


def _neighbours(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of row i, and (left, right) of the neighbours that both have an id."""
    ids = _unpacked(batch.column("ids")[i].as_py(), batch.column("n_codes")[i].as_py())
    both = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
    return ids, both, ids[both]


def _pair_cells(coded: DataFrame, side: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, both, left = _neighbours(batch, i)
                yield _cells(left, ids[both + 1], side)

    return coded.mapInArrow(run, "tile bigint, cell int, n bigint")


def _distinct(tile: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (tile, cell) in order, and which of them each given one is."""
    order = np.lexsort((cell, tile))
    fresh = np.append(True, (np.diff(tile[order]) != 0) | (np.diff(cell[order]) != 0)) if len(order) else np.zeros(0, bool)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(fresh) - 1
    return tile[order][fresh], cell[order][fresh], which


def _triple_cells(coded: DataFrame, pairs: DataFrame, side: int) -> DataFrame:
    """Cells of (pair id, id of the next word), where both pairs of the three words are frequent."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, both, left = _neighbours(batch, i)
                left, right, _ = _distinct(left, ids[both + 1])
                columns = [pa.array(np.full(len(left), batch.column("slice")[i].as_py(), np.int64)), pa.array(np.arange(len(left), dtype=np.int32))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(left), pa.array(right)], ["slice", "place", "left", "right"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, both, left = _neighbours(batch, i)
                distinct, _, which = _distinct(left, ids[both + 1])
                answers = batch.column("known")[i].values
                named = np.full(len(distinct), -1, np.int64)
                named[answers.field("place").to_numpy()] = answers.field("id").to_numpy()
                pair = np.full(len(ids), -1, np.int64)
                pair[both] = named[which]
                threes = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0))
                yield _cells(pair[threes], ids[threes + 2], side)

    asked = coded.mapInArrow(ask, "slice bigint, place int, left bigint, right bigint")
    known = asked.join(pairs.select("left", "right", "id"), ["left", "right"])
    answers = known.groupBy("slice").agg(F.collect_list(F.struct("place", "id")).alias("known"))
    return coded.join(answers, "slice").mapInArrow(count, "tile bigint, cell int, n bigint")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)) in whole numbers of up to 38 digits."""
    a, left, right = (f"cast({c} as decimal(18,0))" for c in (a, left, right))
    return F.expr(f"({a} * {a} * 1000000) div ({left} * {right})")


def _words_of(rows: DataFrame, vocabulary: DataFrame, *places: str) -> DataFrame:
    """Attach the word and its frequency for each id column: `word_left`, `f_left` and so on."""
    for place in places:
        words = vocabulary.select(F.col("id").alias(place), F.col("word").alias(f"word_{place}"), F.col("f").alias(f"f_{place}"))
        rows = rows.join(words, place)
    return rows


def collocations(
    docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP, text: str = "text", lang: str = "lang", tile: int = TILE
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's leading phrases of two and three words.

    Capitals A-Z count as small letters; texts are cut into pieces at `.,;:!?` and line ends and pieces into
    words at blanks and tabs. n counts the words of the language, a the phrase within pieces, overlaps
    included; only phrases with a >= `least` are candidates. A phrase is cut into two parts with counts l
    and r; of its cuts the one with the least floor(1000000 a a / (l r)) counts, then the first. A pair that
    lies in a candidate of three words with at least half its count goes. The first `top` by score, a
    (both falling) and phrase (by bytes) are returned. A missing text is empty, a missing language `und`;
    repeated rows count each time; a language without candidates and an empty table have no rows.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    slices = through_table(_slices(rows), "collocation-slices")
    counted = slices.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    frequent = counted.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f")).filter(F.col("f") >= least)
    vocabulary = through_table(_ranked(frequent, [F.col("lang"), F.col("f").desc(), F.col("word")], "collocation-words"), "collocation-ids")
    coded = through_table(_with_ids(slices, vocabulary), "collocation-texts")
    two = _frequent(_pair_cells(coded, tile), least, tile)
    pairs = through_table(_ranked(two, [F.col("a").desc(), F.col("left"), F.col("right")], "collocation-pairs"), "collocation-pair-ids")
    three = _frequent(_triple_cells(coded, pairs, tile), least, tile).select(F.col("left").alias("id"), F.col("right").alias("third"), F.col("a").alias("a3"))
    back = pairs.select(F.col("left").alias("right"), F.col("right").alias("third"), F.col("id").alias("id_back"), F.col("a").alias("f_back"))
    triples = through_table(three.join(pairs, "id").join(back, ["right", "third"]), "collocation-triples")

    over = triples.select("id", "a3").unionAll(triples.select("id_back", "a3")).groupBy("id").agg(F.max("a3").alias("a3"))
    free = pairs.join(over, "id", "left").filter(F.coalesce(100 * F.col("a3") < 50 * F.col("a"), F.lit(True)))
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    lang_of = vocabulary.select(F.col("id").alias("left"), "lang")
    scored_two = (
        _words_of(free, vocabulary, "left", "right")
        .join(lang_of, "left")
        .withColumns({"phrase": F.concat_ws(" ", "word_left", "word_right"), "l": F.col("f_left"), "r": F.col("f_right")})
        .withColumn("score", _score("a", "l", "r"))
        .select(columns)
    )
    first_cut, second_cut = _score("a3", "f_left", "f_back"), _score("a3", "a", "f_third")
    scored_three = (
        _words_of(triples, vocabulary, "left", "right", "third")
        .join(lang_of, "left")
        .withColumns({"cut1": first_cut, "cut2": second_cut, "phrase": F.concat_ws(" ", "word_left", "word_right", "word_third")})
        .select(
            "lang",
            "phrase",
            F.col("a3").alias("a"),
            F.when(F.col("cut1") <= F.col("cut2"), F.col("f_left")).otherwise(F.col("a")).alias("l"),
            F.when(F.col("cut1") <= F.col("cut2"), F.col("f_back")).otherwise(F.col("f_third")).alias("r"),
            F.least("cut1", "cut2").alias("score"),
        )
    )
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    leading = scored_two.unionByName(scored_three).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    totals = slices.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return leading.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
