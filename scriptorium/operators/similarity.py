"""Variance of pairwise cosine similarity, without forming the pairs.

For unit rows u let N be their number, S = sum u and G = sum u u'. The similarities of all pairs then sum to
(|S|^2 - sum |u|^2) / 2 and their squares to (|G|^2 - sum |u|^4) / 2. These moments add up over parts of a
group, so a group of any size is reduced piecewise. G travels in tiles of `TILE` x `TILE` entries, each added up
by itself under (group, tile), so no row grows with the square of the dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.operators.word_moments import unit_rows
from scriptorium.session import through_table

TILE = 64
_HELD_DOUBLES = 4 * 1024 * 1024
_VECTOR, _HEAD, _SQUARES = -1, -2, -3
_NAMES = ["key", "tile", "data"]


def tiles_of(dims: int) -> list[tuple[slice, slice]]:
    """The tiles of a symmetric matrix on and above its diagonal."""
    edges = [slice(at, min(at + TILE, dims)) for at in range(0, dims, TILE)]
    return [(rows, columns) for i, rows in enumerate(edges) for columns in edges[i:]]


class _Moments:
    """The moments of the vectors seen so far: N, sum |u|^2, sum |u|^4, S and the upper triangle of G."""

    def __init__(self, dims: int, with_gram: bool = True):
        self.head = np.zeros(3 + dims)
        self.gram = np.zeros((dims, dims)) if with_gram else None

    def add(self, unit: np.ndarray) -> None:
        squares = np.einsum("ij,ij->i", unit, unit)
        self.head += np.concatenate([[len(unit), squares.sum(), (squares**2).sum()], unit.sum(axis=0)])
        if self.gram is not None:
            self.gram += unit.T @ unit

    def rows(self, tiles: list[tuple[slice, slice]]) -> list[tuple[int, np.ndarray]]:
        return [(_HEAD, self.head), *((i, self.gram[at].ravel()) for i, at in enumerate(tiles))]


def _weighted_square(values: np.ndarray, at: tuple[slice, slice]) -> float:
    """A tile's share of |G|^2; a tile above the diagonal stands for the one below it too."""
    return float(values @ values) * (1 if at[0] == at[1] else 2)


def _batch(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    keys, tiles, data = zip(*rows, strict=True)
    ends = np.cumsum([0, *map(len, data)])
    listed = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(data)))
    return pa.RecordBatch.from_arrays([pa.array(keys, key_type), pa.array(tiles, pa.int32()), listed], _NAMES)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _smaller_form(dims: int, tiles: list) -> Callable:
    """Each task sends its vectors of a group as they are, or in their place the moments where that is less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        kind = None

        def flushed() -> Iterator[pa.RecordBatch]:
            for key, moments in held.items():
                yield _batch([(key, *row) for row in moments.rows(tiles)], kind)
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.column("key").type
            unit = unit_rows(_matrix(batch.column("vector"), dims))
            codes = batch.column("key").dictionary_encode()
            place = codes.indices.to_numpy()
            order = np.argsort(place, kind="stable")
            cuts = np.flatnonzero(np.diff(place[order])) + 1
            sent = []
            for rows in np.split(order, cuts):
                key = codes.dictionary[int(place[rows[0]])].as_py()
                if key not in held and 2 * len(rows) <= dims:
                    sent.append(rows)
                    continue
                held.setdefault(key, _Moments(dims)).add(unit[rows])
            if sent:
                rows = np.concatenate(sent)
                yield _batch([(key, _VECTOR, unit[i]) for key, i in zip(batch.column("key").take(pa.array(rows)).to_pylist(), rows, strict=True)], kind)
            if len(held) * dims * dims > _HELD_DOUBLES:
                yield from flushed()
        yield from flushed()

    return run


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, int, np.ndarray, pa.DataType]]:
    """(key, tile, rows as a matrix, key type) of each stretch of rows with the same key and tile."""
    for batch in batches:
        if not batch.num_rows:
            continue
        place = batch.column("key").dictionary_encode().indices.to_numpy()
        tile = batch.column("tile").to_numpy()
        cuts = np.flatnonzero((place[1:] != place[:-1]) | (tile[1:] != tile[:-1])) + 1
        for begin, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            rows = batch.column("data").slice(begin, end - begin).flatten().to_numpy(zero_copy_only=False)
            yield batch.column("key")[begin].as_py(), int(tile[begin]), rows.reshape(end - begin, -1), batch.column("key").type


def _heads(dims: int, tiles: list) -> Callable:
    """Heads and vectors sorted by key: each group's head, and |G|^2 where only few vectors came, else their tiles."""

    def group(key, kind, moments: _Moments | None, vectors: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate([np.zeros((0, dims)), *vectors])
        if moments is None:
            products = rows @ rows.T
            moments = _Moments(dims, with_gram=False)
            moments.add(rows)
            return _batch([(key, _HEAD, moments.head), (key, _SQUARES, np.array([np.sum(products * products)]))], kind)
        moments.add(rows)
        found = moments.rows(tiles)
        return _batch([(key, *row) for row in (found if moments.gram.any() else found[:1])], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, moments, vectors, held = None, None, [], 0
        for key, tile, rows, kind in _segments(batches):
            if current is not None and key != current[0]:
                yield group(*current, moments, vectors)
                moments, vectors, held = None, [], 0
            current = (key, kind)
            if tile == _HEAD:
                moments = moments or _Moments(dims)
                moments.head += rows.sum(axis=0)
                continue
            vectors.append(rows)
            held += len(rows)
            if held > dims:
                moments = moments or _Moments(dims)
                moments.add(np.concatenate(vectors))
                vectors, held = [], 0
        if current is not None:
            yield group(*current, moments, vectors)

    return run


def _tile_squares(tiles: list) -> Callable:
    """Tiles sorted by key and place: each one's share of |G|^2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, kind = None, None, None

        def share() -> pa.RecordBatch:
            columns = [pa.array([current[0]], kind), pa.array([_weighted_square(total, tiles[current[1]])])]
            return pa.RecordBatch.from_arrays(columns, ["key", "squares"])

        for key, tile, rows, kind in _segments(batches):
            if current is not None and (key, tile) != current:
                yield share()
                total = None
            current, total = (key, tile), rows.sum(axis=0) + (0 if total is None else total)
        if current is not None:
            yield share()

    return run


def group_similarity_variance(
    df: DataFrame, key: str, vector: str, dims: int, name: str = "f_embed_variance"
) -> DataFrame:
    """(key, variance) over all vector pairs of each group, for non-NULL keys and groups of any size.

    Every task sends each of its groups in the smaller form: the vectors themselves, or their moments. A group
    which fills a third of the table so arrives as a few rows per task, its tiles in as many places as there are
    tiles; many small groups cost no more than their vectors. No row holds more than `TILE` x `TILE` or 3 + `dims` numbers.
    """
    rows = df.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector")
    )
    key_type = rows.schema["key"].dataType.simpleString()
    schema, tiles = f"key {key_type}, tile int, data array<double>", tiles_of(dims)
    parts = through_table(rows.mapInArrow(_smaller_form(dims, tiles), schema), "similarity-parts")
    whole = parts.filter(F.col("tile") < 0).repartition("key").sortWithinPartitions("key", "tile")
    heads = through_table(whole.mapInArrow(_heads(dims, tiles), schema), "similarity-heads")
    spread = parts.filter(F.col("tile") >= 0).unionAll(heads.filter(F.col("tile") >= 0))
    by_tile = spread.repartition("key", "tile").sortWithinPartitions("key", "tile")
    squares = by_tile.mapInArrow(_tile_squares(tiles), f"key {key_type}, squares double")
    told = heads.filter(F.col("tile") == _SQUARES).select("key", F.get("data", F.lit(0)).alias("squares"))
    total = squares.unionAll(told).groupBy("key").agg(F.sum("squares").alias("squares"))
    head = heads.filter(F.col("tile") == _HEAD).select("key", "data").join(total, "key")
    n = F.get("data", F.lit(0))
    pairs = n * (n - 1) / 2
    length = F.aggregate(F.slice("data", 4, dims), F.lit(0.0), lambda a, x: a + x * x)
    first = (length - F.get("data", F.lit(1))) / 2 / pairs
    second = (F.col("squares") - F.get("data", F.lit(2))) / 2 / pairs
    variance = F.when(n < 2, F.lit(0.0)).otherwise(F.greatest(second - first * first, F.lit(0.0)))
    return head.select(F.col("key").alias(key), variance.cast("float").alias(name))
