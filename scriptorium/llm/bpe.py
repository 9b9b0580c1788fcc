"""Byte-pair merging of many pre-tokens at once on ragged numpy arrays."""

from __future__ import annotations

import json
from functools import lru_cache
from typing import NamedTuple

import numpy as np

_NONE = np.iinfo(np.int32).max


class Merges(NamedTuple):
    """`pairs` (left id * 2^32 + right id) in order, with the rank of each and the id it becomes."""

    byte_ids: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    made: np.ndarray
    byte_ranks: np.ndarray
    special: tuple[str, ...]


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Bytes that print as themselves in Latin-1 keep their letter; the others follow from U+0100 on.
    """
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


@lru_cache(maxsize=4)
def load_merges(path: str) -> Merges:
    """Merges of a byte-level tokenizer file in JSON form."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab = spec["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    left = np.array([vocab[a] for a, _ in pairs], np.int64)
    right = np.array([vocab[b] for _, b in pairs], np.int64)
    made = np.array([vocab[a + b] for a, b in pairs], np.int32)
    keys, order = np.unique(left << 32 | right, return_index=True)
    byte_ids = np.array([vocab[x] for x in _byte_letters()], np.int64)
    merges = Merges(byte_ids, keys, order.astype(np.int32), made, np.zeros(0, np.int32), ())
    grid = (byte_ids[:, None] << 32 | byte_ids[None, :]).ravel()
    special = tuple(t["content"] for t in spec.get("added_tokens") or ())
    return merges._replace(byte_ranks=_rank(merges, grid), special=special)


def _rank(merges: Merges, keys: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(merges.pairs, keys), len(merges.pairs) - 1)
    return np.where(merges.pairs[at] == keys, merges.ranks[at], _NONE).astype(np.int32)


def surviving_counts(pieces: list[bytes], merges: Merges) -> np.ndarray:
    """Number of symbols left of each pre-token after all merges.

    All sequences advance together: each applies its pair of lowest rank, at all places from the left
    without overlap, until no sequence has a pair left. A pair made by a merge ranks behind that merge,
    so this equals merging one place at a time.
    """
    counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    live = np.flatnonzero(counts > 1)
    ids = merges.byte_ids[raw]
    grid = np.full(len(raw), _NONE, np.int32)
    grid[:-1] = merges.byte_ranks[raw[:-1].astype(np.int64) * 256 + raw[1:]]
    last = np.cumsum(counts) - 1
    grid[last[counts > 0]] = _NONE
    taken = np.repeat(counts > 1, counts)
    ids, rank, size = ids[taken], grid[taken], counts[live]
    while len(live):
        first = np.cumsum(size) - size
        lowest = np.minimum.reduceat(rank, first)
        open_ = lowest < _NONE
        if not open_.all():
            counts[live[~open_]] = size[~open_]
            keep = np.repeat(open_, size)
            ids, rank, live, size, lowest = ids[keep], rank[keep], live[open_], size[open_], lowest[open_]
            continue
        hits = np.flatnonzero(rank == np.repeat(lowest, size))
        fresh = np.ones(len(hits), bool)
        fresh[1:] = np.diff(hits) != 1
        in_run = np.arange(len(hits)) - np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))
        hits = hits[in_run % 2 == 0]
        ids[hits] = merges.made[rank[hits]]
        stay = np.ones(len(ids), bool)
        stay[hits + 1] = False
        size = size - np.bincount(np.searchsorted(first, hits, side="right") - 1, minlength=len(size))
        last_of = np.zeros(len(ids), bool)
        last_of[first[1:] - 1] = last_of[-1] = True
        last_of[hits] |= last_of[hits + 1]
        ids, rank, last_of = ids[stay], rank[stay], last_of[stay]
        at = hits - np.arange(len(hits))
        changed = np.zeros(len(ids), bool)
        changed[at] = changed[at[at > 0] - 1] = True
        again = np.flatnonzero(changed)
        right = ids[np.minimum(again + 1, len(ids) - 1)]
        rank[again] = np.where(last_of[again], _NONE, _rank(merges, ids[again] << 32 | right))
    return counts
