"""The most frequent items, exactly, without a shuffle of all distinct ones.

First every task counts in a bounded table: when it holds too many items, the count of the first one that
does not fit is taken off all of them and the used up ones go. An item's count is then too small by at
most what its task has taken off, and an item that no task kept occurs at most as often as all tasks
have taken off together. Items that may still be among the leading ones under these bounds are counted
again, exactly. Where the bounds exclude nothing, because no item stands out, everything is counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.plans.bounds import WORD_BYTES, fits_in_memory
from scriptorium.session import through_table

HELD_ITEMS = 200_000
PIECE_ITEMS = 1_000_000


def counted(groups: pa.Array, items: pa.Array) -> pa.Table:
    """(group, item, n) of the given pairs."""
    each = pa.table({"group": groups.cast(pa.string()), "item": items.cast(pa.string()), "n": np.ones(len(items), np.int64)})
    return each.group_by(["group", "item"]).aggregate([("n", "sum")]).rename_columns(["group", "item", "n"])


class BoundedCounts:
    """Counts of (group, item) that hold at most `most` entries and know by how much they may be too small."""

    def __init__(self, most: int):
        self.most = most
        self.taken_off = 0
        self.table = pa.table({"group": pa.array([], pa.string()), "item": pa.array([], pa.string()), "n": pa.array([], pa.int64())})

    def add(self, groups: pa.Array, items: pa.Array) -> None:
        both = pa.concat_tables([self.table, counted(groups, items)])
        self.table = both.group_by(["group", "item"]).aggregate([("n", "sum")]).rename_columns(["group", "item", "n"])
        if len(self.table) > self.most:
            n = self.table.column("n").to_numpy()
            cut = int(np.partition(n, len(n) - self.most - 1)[len(n) - self.most - 1])
            self.taken_off += cut
            left = self.table.set_column(2, "n", pc.subtract(self.table.column("n"), cut))
            self.table = left.filter(pc.greater(left.column("n"), 0)).combine_chunks()


def pieces(groups: pa.Array, lists: pa.Array, most: int = PIECE_ITEMS, width: int = 1) -> Iterator[tuple[pa.Array, pa.Array]]:
    """The items of all lists with their rows' groups, at most `most` at a time.

    With a `width` above one, an item is that many neighbours of one list, joined by spaces.
    """
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    named, items, ends = groups.dictionary_encode(), lists.flatten(), np.cumsum(sizes)
    for at in range(0, len(items), most):
        here = np.arange(at, min(at + most, len(items)))
        owners = np.searchsorted(ends, here, side="right")
        whole = here + width <= ends[owners]
        if not whole.all():
            here, owners = here[whole], owners[whole]
        parts = [items.slice(at + i, most).filter(pa.array(whole[: len(items) - at - i])) for i in range(width)]
        yield named.take(pa.array(owners)), parts[0] if width == 1 else pc.binary_join_element_wise(*parts, " ")


def bounded_counts(rows: DataFrame, items: str, by: str, held: int = HELD_ITEMS, width: int = 1) -> DataFrame:
    """(group, item, n, taken_off): each task's counts, and one row without an item with what it has taken off."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = BoundedCounts(held)
        for batch in batches:
            for groups, found in pieces(batch.column("by"), batch.column("items"), width=width):
                counts.add(groups, found)
        table = counts.table.append_column("taken_off", pa.array(np.zeros(len(counts.table), np.int64)))
        yield from table.to_batches()
        last = {"group": pa.array([None], pa.string()), "item": pa.array([None], pa.string()), "n": [0], "taken_off": [counts.taken_off]}
        yield pa.RecordBatch.from_pydict(last)

    schema = "group string, item string, n bigint, taken_off bigint"
    return rows.select(F.col(by).cast("string").alias("by"), F.col(items).alias("items")).mapInArrow(run, schema)


def piece_counts(rows: DataFrame, items: str, by: str, width: int = 1) -> DataFrame:
    """(group, item, n): exact counts within each piece of a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for groups, found in pieces(batch.column("by"), batch.column("items"), width=width):
                yield from counted(groups, found).to_batches()

    return rows.select(F.col(by).cast("string").alias("by"), F.col(items).alias("items")).mapInArrow(run, "group string, item string, n bigint")


def leading_items(rows: DataFrame, items: str, k: int, by: str | None = None, held: int = HELD_ITEMS, width: int = 1) -> DataFrame:
    """(group, item, n, rank): the `k` most frequent items of each group, ties by item.

    `items` is an array of strings without NULL, `by` a column with few values that are not NULL (one group `all` without it).
    With a `width` above one, that many neighbours of an array, joined by spaces, are an item. The arrays are stored, as
    they are read again where tasks took something off.
    """
    named = rows.select(F.col(items).alias("items"), (F.col(by) if by else F.lit("all")).cast("string").alias("by"))
    named = through_table(named, "item-lists")
    parts = through_table(bounded_counts(named, "items", "by", held, width), "bounded-counts")
    taken_off = parts.agg(F.coalesce(F.sum("taken_off"), F.lit(0))).first()[0]
    totals = parts.filter(F.col("item").isNotNull()).groupBy("group", "item").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("group").orderBy(F.desc("n"), "item")
    if taken_off:
        totals = through_table(totals, "bounded-totals")
        leading = totals.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k)
        bars = leading.filter(F.col("n") > taken_off).select("group", F.col("n").alias("bar"))
        candidates = totals.join(F.broadcast(bars), "group").filter(F.col("n") + taken_off >= F.col("bar")).select("group", "item")
        candidates = through_table(candidates, "heavy-candidates")
        known = F.broadcast(candidates) if fits_in_memory(candidates, WORD_BYTES, texts=("group", "item")) else candidates
        each = piece_counts(named, "items", "by", width).join(known.withColumn("sure", F.lit(True)), ["group", "item"], "left")
        marked = each.join(F.broadcast(bars.select("group", F.lit(True).alias("barred"))), "group", "left")
        wanted = marked.filter(F.col("sure").isNotNull() | F.col("barred").isNull())
        totals = wanted.groupBy("group", "item").agg(F.sum("n").alias("n"))
    return totals.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
