"""Byte-level BPE encoding and decoding of texts in overlapping chunks."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.batches import BoundedDict, split_segments, text_slices, whole_texts

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
CACHE_ENTRIES = 300_000
_CACHES: dict[tuple[str, str], BoundedDict] = {}


@lru_cache(maxsize=4)
def load_encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file: a base64 token and its rank in each line."""
    with open(ranks, "rb") as file:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(ranks, pat_str=pattern, mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(ranks: str, pattern: str) -> list[bytes]:
    encoding = load_encoding(ranks, pattern)
    table = [b""] * (encoding.max_token_value + 1)
    for token in encoding.token_byte_values():
        table[encoding.encode_single_token(token)] = token
    return table


def decode(ids: np.ndarray, ranks: str, pattern: str) -> bytes:
    """The raw bytes of all ids, one after the other."""
    return b"".join(map(token_bytes(ranks, pattern).__getitem__, ids.tolist()))


def encode_pieces(pieces: list[str], encoding: tiktoken.Encoding, known: BoundedDict) -> bytes:
    """The ids of the pieces, each encoded by itself, as little-endian unsigned 32-bit integers."""
    for piece in {p for p in pieces if p not in known}:
        known[piece] = np.array(encoding.encode_ordinary(piece), "<u4").tobytes()
    return b"".join(map(known.__getitem__, pieces))


def encode_short(text: str, encoding: tiktoken.Encoding, known: BoundedDict) -> bytes:
    """The ids of a text of one chunk, whose pre-tokens never reach across a single space."""
    first, *rest = split_segments(text)
    head = np.array(encoding.encode_ordinary(first), "<u4").tobytes()
    return head + encode_pieces([" " + segment for segment in rest], encoding, known)


def piece_ends(text: str, pattern: regex.Pattern) -> np.ndarray:
    """Where each pre-token of a chunk ends."""
    return np.fromiter((m.end() for m in pattern.finditer(text)), np.int32)


def stitch(starts: list[int], texts: list[str], ends: list[np.ndarray], pattern: regex.Pattern) -> Iterator[list[str]]:
    """The pre-tokens of a text from those of its overlapping chunks, a list at a time.

    What a chunk says is final except for its last pre-token, which the missing rest may lengthen. The
    next chunk begins at an arbitrary place; from the first end that both know, its pre-tokens are
    those of the whole text. Where they share none, chunks are joined and split again from the last end
    that is certain.
    """
    at, held, chunk = 0, 0, starts[1] - starts[0] if len(starts) > 1 else 0
    while held < len(starts):
        base, text, own = starts[held], texts[held], ends[held].astype(np.int64) + starts[held]
        upto, step = held + 1, 1
        while True:
            if upto == len(starts):
                stop = base + len(text)
                own = own[own > at]
                upto += 1
                break
            sure = own[(own > at) & (own < base + len(text))]
            both = np.intersect1d(sure, ends[upto].astype(np.int64) + starts[upto], assume_unique=True)
            if len(both):
                stop = int(both[0])
                own = sure[sure <= stop]
                break
            more = range(upto, min(upto + step, len(starts)))
            text = "".join([text[: starts[upto] - base], *(texts[i][:chunk] for i in more[:-1]), texts[more[-1]]])
            certain = max(at, base)
            own = piece_ends(text[certain - base :], pattern).astype(np.int64) + certain
            upto, step = more.stop, step * 2
        cuts = np.concatenate([[at], own]) - base
        yield [text[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        at, held = stop, upto


def byte_bpe(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
    with_ids: bool = False,
) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256[, ids]) of each row's whole text.

    Texts of at most `chunk` characters are encoded where they are read. Longer ones are cut into chunks
    that overlap, dealt out chunk by chunk, pre-tokenised side by side, stitched and encoded. The digest
    of the ids is that of little-endian unsigned 32-bit integers; decoding concatenates raw bytes.
    A missing or empty text has no ids; a missing key stays missing; repeated rows give repeated results;
    an empty table gives none. `ranks` is a path that every executor can read.
    """
    if not 0 < overlap <= chunk:
        raise ValueError("overlap must lie between 1 and chunk")
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    names = ["n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids binary"

    def digests(ids: bytes) -> tuple[int, str, str, bytes | None]:
        raw = decode(np.frombuffer(ids, "<u4"), ranks, pattern)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(raw).hexdigest(), ids if with_ids else None

    def run_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(ranks, pattern)
        known = _CACHES.setdefault((ranks, pattern), BoundedDict(CACHE_ENTRIES))
        for batch in batches:
            for part in text_slices(batch, "text"):
                known.trim()
                out = zip(*(digests(encode_short(x, encoding, known)) for x in whole_texts(part, "text")), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), *map(pa.array, out, (pa.int64(), pa.string(), pa.string(), pa.binary()))], ["key", *names]
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                for i, whole in enumerate(whole_texts(part, "text")):
                    starts = np.arange(0, len(whole), chunk)
                    one = part.slice(i, 1).select(["key", "copies"])
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(pa.concat_arrays([c] * len(starts)) for c in one.columns),
                            pa.array([hashlib.sha256(whole.encode()).digest()] * len(starts)),
                            pa.array(starts, pa.int64()),
                            pa.array([whole[s : s + chunk + overlap] for s in starts.tolist()]),
                        ],
                        ["key", "copies", "digest", "start", "part"],
                    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in batches:
            lengths = [np.diff(piece_ends(x, compiled), prepend=0) for x in batch.column("part").to_pylist()]
            yield batch.append_column("lengths", pa.array(lengths, pa.list_(pa.int32())))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("start")
        encoding, compiled = load_encoding(ranks, pattern), regex.compile(pattern)
        known = _CACHES.setdefault((ranks, pattern), BoundedDict(CACHE_ENTRIES))
        ids = []
        for pieces in stitch(group["start"].tolist(), group["part"].tolist(), [np.cumsum(x) for x in group["lengths"]], compiled):
            known.trim()
            ids.append(encode_pieces(pieces, encoding, known))
        first = group.iloc[:1]
        return pd.DataFrame([digests(b"".join(ids))], columns=names).assign(key=first["key"].array, copies=first["copies"].array)

    short = rows.filter(F.coalesce(F.char_length("text"), F.lit(0)) <= chunk).mapInArrow(run_short, f"key {kind}, {schema}")
    long = rows.filter(F.char_length("text") > chunk).groupBy("key", "text").agg(F.count("*").alias("copies"))
    chunks = long.mapInArrow(cut, f"key {kind}, copies bigint, digest binary, start bigint, part string")
    dealt = chunks.repartition("digest", "start").mapInArrow(split, f"{chunks._jdf.schema().toDDL()}, lengths array<int>")
    joined = dealt.groupBy("key", "digest").applyInPandas(join, f"{schema}, key {kind}, copies bigint")
    copies = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).drop("copy", "copies")
    both = short.unionByName(copies).withColumnRenamed("key", key)
    return both if with_ids else both.drop("ids")
