"""Row hashes that do not depend on partitioning, so samples can be repeated anywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 32


def key_hash(key: Column | str, seed: int | None = None) -> Column:
    """The first 32 bits of the key's MD5 as a bigint."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    if seed is not None:
        text = F.concat_ws(":", F.lit(str(seed)), text)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: Column | str, buckets: int, seed: int | None = None) -> Column:
    return key_hash(key, seed) % F.lit(buckets)
