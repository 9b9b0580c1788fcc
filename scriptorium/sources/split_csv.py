"""CSV files with fields that span lines, read by many tasks per file.

Files are read as lines, in blocks, as any text file. What a line does depends on whether it begins inside a
quoted field, so each line is a function of two states; the functions of a block's lines make up that of
the block. One row per block and a running composition along each file tell in which state every block
begins. Then each task puts the lines of its blocks together to records. A record that crosses blocks is
left in parts, at most two per block, which are joined by their places.

Lines end with a line feed, or with carriage return and line feed where the first line of the file does; the
latter then count as a line feed also within fields.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.plans.bounds import BROADCAST_BYTES
from scriptorium.session import through_table

OPTIONS = {"multiLine": "true", "escape": '"'}
_BLOCK_ROW_BYTES = 1024
# A line that begins outside of quotes ends inside if its last field opens a quote and does not close it.
# Within quotes two quotes are one; what follows a closing quote belongs to the field, up to the comma.
_CLOSED = r'"[^"]*+(?:""[^"]*+)*+"[^,]*+'
_OPENS = re.compile(rf'(?:(?:{_CLOSED}|[^",][^,]*+)?+,)*+"[^"]*+(?:""[^"]*+)*+', re.DOTALL)


def line_states(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line ends inside quotes if it begins outside of them, and if it begins inside."""
    outside = np.zeros(len(lines), bool)
    inside = np.ones(len(lines), bool)
    for i in np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)):
        line = lines[i].as_py()
        outside[i] = _OPENS.fullmatch(line) is not None
        inside[i] = _OPENS.fullmatch('"' + line) is not None
    return outside, inside


def states_before(outside: np.ndarray, inside: np.ndarray, first: bool) -> np.ndarray:
    """The state before each line and after the last one, from the state before the first."""
    fixed = np.concatenate([[True], outside == inside])
    value = np.concatenate([[first], outside])
    turns = np.concatenate([[0], np.cumsum(outside & ~inside)])
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), 0))
    return value[last] ^ ((turns - turns[last]) % 2 == 1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Batches cut where a new block begins, each with whether it is the first part of its block."""
    current = None
    for batch in batches:
        at = 0
        files, starts = batch.column("file"), batch.column("block").to_numpy()
        names = files.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((starts[1:] != starts[:-1]) | (names[1:] != names[:-1])) + 1
        for upto in [*cuts, batch.num_rows]:
            if upto == at:
                continue
            key = (files[at].as_py(), int(starts[at]))
            yield key != current, batch.slice(at, upto - at)
            current, at = key, upto


def _block_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, place, outside, inside, returns) of each part of a block: the state at its end, for both states
    before it, and whether the part begins the file with a line that ends in a carriage return."""
    for fresh, part in _blocks(batches):
        outside, inside = line_states(part.column("line"))
        ends = [bool(states_before(outside, inside, first)[-1]) for first in (False, True)]
        returns = fresh and part.column("block")[0].as_py() == 0 and part.column("line")[0].as_py().endswith("\r")
        columns = [part.column(name).slice(0, 1) for name in ("file", "block", "place")]
        columns += [pa.array([told]) for told in (*ends, returns)]
        yield pa.RecordBatch.from_arrays(columns, ["file", "block", "place", "outside", "inside", "returns"])


def _block_states(lines: DataFrame) -> DataFrame:
    """(file, block, begins, returns): whether the block begins inside quotes, and whether the file's lines end in
    carriage return and line feed, as its first line does."""
    parts = lines.mapInArrow(_block_functions, "file string, block bigint, place bigint, outside boolean, inside boolean, returns boolean")
    in_file = Window.partitionBy("file").orderBy("block", "place")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum((F.col("outside") & ~F.col("inside")).cast("bigint"))
    counted = parts.withColumns({"turns": turns.over(in_file), "before": F.coalesce(turns.over(before), F.lit(0))})
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct("outside", "turns"))
    last = F.last(fixed, ignorenulls=True).over(before)
    told = counted.withColumn("last", last)
    odd = (F.col("before") - F.coalesce("last.turns", F.lit(0))) % 2 == 1
    returns = F.max("returns").over(Window.partitionBy("file")).alias("returns")
    states = told.select("file", "block", "place", (F.coalesce("last.outside", F.lit(False)) != odd).alias("begins"), returns)
    return states.groupBy("file", "block").agg(F.min_by("begins", "place").alias("begins"), F.max("returns").alias("returns"))


_PIECE = "file string, block bigint, place bigint, header boolean, begins boolean, ends boolean, record string"
_NAMES = [field.split()[0] for field in _PIECE.split(", ")]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each block, with whether they begin and end in it; the first record of a file is its header."""
    key, state = (None, None), False
    held: list[str] = []
    place, header, begins = 0, False, False

    def piece(ends: bool) -> tuple:
        return (*key, place, header, begins, ends, "\n".join(held))

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
        columns = [pa.array(column, kind) for column, kind in zip(zip(*found, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, _NAMES)

    for fresh, part in _blocks(batches):
        found = []
        if fresh:
            if held:
                found.append(piece(not state))
            key, state, held = (part.column("file")[0].as_py(), part.column("block")[0].as_py()), part.column("begins")[0].as_py(), []
        before = states_before(*line_states(part.column("line")), state)
        places = part.column("place").to_numpy()
        returns = part.column("returns")[0].as_py()
        for i, line in enumerate(part.column("line").to_pylist()):
            if held and not before[i]:
                found.append(piece(True))
                held = []
            if not held:
                place, begins, header = int(places[i]), not before[i], fresh and i == 0 and key[1] == 0
            held.append(line.removesuffix("\r") if returns else line)
        state = bool(before[-1])
        if found:
            yield rows(found)
    if held:
        yield rows([piece(not state)])


def _joined(parts: DataFrame) -> DataFrame:
    """Records from their parts: a part that begins a record, with all that follow up to the next such part."""
    in_file = Window.partitionBy("file").orderBy("block", "place")
    numbered = parts.withColumn("nth", F.sum(F.col("begins").cast("bigint")).over(in_file))
    ordered = F.sort_array(F.collect_list(F.struct("block", "place", "header", "record"))).alias("parts")
    whole = numbered.groupBy("file", "nth").agg(ordered)
    return whole.select(F.get("parts", F.lit(0)).getField("header").alias("header"), F.array_join("parts.record", "\n").alias("record"))


def read_csv_in_parts(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV with quoted fields that may span lines, as the multi-line reader gives it, but split as text files are.

    All columns are strings by default; `schema` names and types them otherwise. Doubled quotes within quotes are
    one; a quote elsewhere than at the start of a field is an ordinary character. Every file has a header.
    Blank lines between records are left out; missing trailing fields are NULL; no order is kept. A file that ends
    within quotes ends its last record. The state of each block is broadcast, one row per block, or joined if
    that is large.
    """
    if schema is None:
        schema = spark.read.options(header="true", **OPTIONS).csv(path).schema
    place = F.monotonically_increasing_id().alias("place")
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.option("lineSep", "\n").text(path).select(*at, place, F.col("value").alias("line"))
    states = through_table(_block_states(lines), "csv-blocks")
    if states.count() * _BLOCK_ROW_BYTES <= BROADCAST_BYTES:
        told = lines.join(F.broadcast(states), ["file", "block"])
    else:
        told = lines.join(states.hint("merge"), ["file", "block"]).sortWithinPartitions("file", "block", "place")
    pieces = told.select("file", "block", "place", "line", "begins", "returns").mapInArrow(_pieces, _PIECE)
    crossing = through_table(pieces.filter(~F.col("begins") | ~F.col("ends")), "csv-parts")
    records = pieces.filter(F.col("begins") & F.col("ends")).select("header", "record").unionAll(_joined(crossing))
    ended = records.filter(~F.col("header") & (F.col("record") != ""))
    ddl = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return ended.select(F.from_csv("record", ddl.toDDL(), OPTIONS).alias("row")).select("row.*")
