"""Token ids in files of directly addressable codes.

A file is a Parquet folder of segments, each a run of whole documents in ascending key order. A
segment splits its ids into chunks of `CHUNK_BITS` bits: level 0 holds the lowest chunk of every id,
level i + 1 those of the ids that go on. A bitmap per level says which ids go on, and a rank directory
counts the bitmap's ones before every block of `RANK_BITS` bits. Any id is thus read by itself, a chunk
and a rank per level, with no block to decode. A second folder, `parts`, holds the running start of each
partition's first token.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scriptorium.llm.batches import AgingDict, BoundedDict, text_slices, whole_texts

CHUNK_BITS = 8
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 20
CACHE_ENTRIES = 200_000
CORE_ENTRIES = 300_000
PIECES_A_CALL = 100
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_LEVEL = "struct<chunks: binary, more: binary, ranks: binary>"
_SEGMENT = (
    f"part int, seq int, part_start bigint, n_tokens bigint, keys array<{{key}}>, ends array<bigint>, levels array<{_LEVEL}>"
)


def split_levels(ids: np.ndarray) -> list[dict[str, bytes]]:
    """The levels of an array of ids."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest):
        more = rest >> CHUNK_BITS > 0
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (RANK_BITS // 8), np.uint8)])
        ones = np.bitwise_count(bits).reshape(-1, RANK_BITS // 8).sum(1)
        ranks = (np.cumsum(ones) - ones).astype("<u8")
        chunks = (rest & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8)
        levels.append({"chunks": chunks.tobytes(), "more": bits.tobytes(), "ranks": ranks.tobytes()})
        rest = rest[more] >> np.uint32(CHUNK_BITS)
    return levels


def id_at(levels: list[dict[str, bytes]], i: int) -> int:
    """The id at position `i` of a segment, from one chunk and one rank per level."""
    value, shift = 0, 0
    for level in levels:
        value |= level["chunks"][i] << shift
        if not level["more"][i >> 3] >> (i & 7) & 1:
            return value
        block = i // RANK_BITS
        before = int.from_bytes(level["ranks"][8 * block : 8 * block + 8], "little")
        begin = block * RANK_BITS // 8
        within = int.from_bytes(level["more"][begin : begin + RANK_BITS // 8], "little") & ((1 << i % RANK_BITS) - 1)
        i, shift = before + within.bit_count(), shift + CHUNK_BITS
    raise IndexError(i)


def join_levels(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids of a segment."""
    ids = np.zeros(0, np.uint32)
    for level in reversed(levels):
        out = np.frombuffer(level["chunks"], np.uint8).astype(np.uint32)
        more = np.unpackbits(np.frombuffer(level["more"], np.uint8), count=len(out), bitorder="little").astype(bool)
        out[more] |= ids << np.uint32(CHUNK_BITS)
        ids = out
    return ids


_TOKENIZERS: dict[str, tuple[Tokenizer, BoundedDict, AgingDict]] = {}


def _encoder(vocabulary: str):
    """A function from texts to their ids as little-endian bytes, for tokenizers that drop blanks.

    Frequent words are given to the library once: what it makes of them outlives that of rare ones. ASCII words are lower-cased, and punctuation at the
    end of a word in Latin letters is encoded apart, as the tokenizer itself does both.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives a core to each task
    if vocabulary not in _TOKENIZERS:
        _TOKENIZERS[vocabulary] = Tokenizer.from_file(vocabulary), BoundedDict(CACHE_ENTRIES), AgingDict(CORE_ENTRIES)
    tokenizer, known, cores = _TOKENIZERS[vocabulary]
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    opening = re.compile(b"[" + b"".join({re.escape(s[0].encode()) for s in special}) + b"]")
    between = special[0]
    between_id = tokenizer.token_to_id(between)

    def core_of(word: bytes) -> bytes:
        """The word without what can be encoded apart; empty if it has to be taken as it is."""
        if opening.search(word):
            return b""
        core = word.rstrip(_PUNCTUATION)
        if not core or core[-1:].isalnum():
            return (core or word).lower() if word.isascii() else core or word
        return core if (last := core.decode()[-1]).isalpha() and ord(last) < 0x250 else b""

    def encode_apart(pieces: list[bytes]) -> None:
        """Encode many pieces in one call, held apart by a special token that none of them holds; no offsets are asked for."""
        for at in range(0, len(pieces), PIECES_A_CALL):
            some = pieces[at : at + PIECES_A_CALL]
            text = between.join(map(bytes.decode, some))
            ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            raw, cuts = ids.tobytes(), (np.flatnonzero(ids == between_id) * 4).tolist()
            begins, ends = [0, *(c + 4 for c in cuts)], [*cuts, len(raw)]
            cores.update(zip(some, map(raw.__getitem__, map(slice, begins, ends)), strict=True))

    def learn(words: list[bytes]) -> None:
        plain = {w: w.lower() for w in words if w.isalnum()}
        other = [w for w in words if w not in plain]
        core = list(map(core_of, other))
        rest = [w[len(c) :] if c else b"" for w, c in zip(other, core, strict=True)]
        encode_apart([p for p in cores.unknown({*plain.values(), *core, *rest}) if p])
        cores[b""] = b""
        known.update(zip(plain, map(cores.__getitem__, plain.values()), strict=True))
        for w, c, r in zip(other, core, rest, strict=True):
            known[w] = cores[c] + cores[r] if c else np.array(tokenizer.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def encode(texts: list[str]) -> list[bytes]:
        known.trim()
        cores.trim()
        split = [text.encode().split() for text in texts]
        learn([w for w in set().union(*split) if w not in known])
        return [b"".join(map(known.__getitem__, words)) for words in split]

    return encode


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode every whole text, append `end_id`, and write the ids below `path` in ascending key order.

    Missing keys come first, equal keys in order of a hash of their texts. A missing or empty text gives the end id
    alone; an empty table gives folders without rows. `vocabulary` is a word-level tokenizers file that
    drops blanks and has a special token; every executor must be able to read it.
    """
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = _encoder(vocabulary), TaskContext.get().partitionId()
        keys, ids, held, seq, start = [], [], 0, 0, 0
        tail = np.array([end_id], "<u4").tobytes()

        def segment() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(ids), "<u4")
            ends = np.cumsum([len(x) // 4 for x in ids])
            row = {"part": part, "seq": seq, "part_start": start, "n_tokens": len(flat), "ends": ends, "levels": split_levels(flat)}
            row["keys"] = pa.concat_arrays(keys)
            columns = [
                pa.array([part], pa.int32()),
                pa.array([seq], pa.int32()),
                pa.array([start], pa.int64()),
                pa.array([len(flat)], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(row["keys"])], pa.int32()), row["keys"]),
                pa.array([ends], pa.list_(pa.int64())),
                pa.array([row["levels"]], pa.list_(pa.struct([(x, pa.binary()) for x in ("chunks", "more", "ranks")]))),
            ]
            return pa.RecordBatch.from_arrays(columns, ["part", "seq", "part_start", "n_tokens", "keys", "ends", "levels"])

        for batch in batches:
            for some in text_slices(batch, "text"):
                new = [x + tail for x in encode(whole_texts(some, "text"))]
                keys.append(some.column("key"))
                ids += new
                held += sum(map(len, new)) // 4
                if held >= SEGMENT_TOKENS:
                    yield segment()
                    start, seq, held = start + held, seq + 1, 0
                    keys, ids = [], []
        if ids:
            yield segment()

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    order = ["key", F.xxhash64("text"), "text"]
    ordered = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    ordered.mapInArrow(run, _SEGMENT.format(key=kind)).write.mode("overwrite").parquet(f"{path}/segments")
    totals = docs.sparkSession.read.parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", "n_tokens", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    parts.write.mode("overwrite").parquet(f"{path}/parts")


def _segments(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Segments with their global start. The parts are one row per partition of the writing job."""
    parts = spark.read.parquet(f"{path}/parts").select("part", "start")
    rows = spark.read.parquet(f"{path}/segments").select("part", "part_start", *columns)
    return rows.join(F.broadcast(parts), "part").withColumn("start", F.col("start") + F.col("part_start"))


def read_documents(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """(key, start, n_tokens, ids_crc32[, ids]) of every document in the files below `path`."""
    kind = dict(spark.read.parquet(f"{path}/segments").dtypes)["keys"].removeprefix("array<").removesuffix(">")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = join_levels(batch.column("levels")[i].as_py())
                raw = memoryview(ids.astype("<u4")).cast("B")
                ends = batch.column("ends").slice(i, 1).flatten().to_numpy()
                begins = np.concatenate([[0], ends[:-1]])
                cut = [raw[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                columns = [
                    batch.column("keys").slice(i, 1).flatten(),
                    pa.array(begins + batch.column("start")[i].as_py()),
                    pa.array(ends - begins),
                    pa.array([zlib.crc32(x) for x in cut], pa.int64()),
                ]
                names = ["key", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([x.cast("I").tolist() if len(x) else [] for x in cut], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = _segments(spark, path, "keys", "ends", "levels").select("start", "keys", "ends", "levels")
    schema = f"key {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def read_tokens(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, token_id) for each global position of `positions`; positions outside the files are left out.

    Positions meet segments by an equi-join on blocks of `SEGMENT_TOKENS` positions, then each id is
    looked up by itself.
    """
    block = F.lit(SEGMENT_TOKENS)
    rows = _segments(spark, path, "n_tokens", "levels").withColumn("stop", F.col("start") + F.col("n_tokens"))
    held = rows.withColumn("block", F.explode(F.sequence(F.expr(f"start div {SEGMENT_TOKENS}"), F.expr(f"(stop - 1) div {SEGMENT_TOKENS}"))))
    asked = positions.select(F.col("position").cast("bigint").alias("position")).distinct()
    asked = asked.withColumn("block", F.floor(F.col("position") / block))
    met = held.join(asked, "block").filter((F.col("position") >= F.col("start")) & (F.col("position") < F.col("stop")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                levels, start = batch.column("levels")[i].as_py(), batch.column("start")[i].as_py()
                at = batch.column("at")[i].as_py()
                found = [id_at(levels, p - start) for p in at]
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(found, pa.int64())], ["position", "token_id"])

    grouped = met.groupBy("start").agg(F.first("levels").alias("levels"), F.collect_list("position").alias("at"))
    return grouped.mapInArrow(run, "position bigint, token_id bigint")
