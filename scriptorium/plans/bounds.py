"""Plan shapes that depend on size: what is computed once, spread out, broadcast or salted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 256 * 1024 * 1024
WORD_BYTES = 64


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once per row.

    A filter on a projected column is pushed below the projection together with a copy of the
    expression, and every later use may copy it again. Generated columns are left where they are.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def spread_small_input(df: DataFrame) -> DataFrame:
    """Redistribute a scan with fewer partitions than the cluster has cores; others stay as they are.

    Meant for a few files that cannot be split further. A large table has more splits than cores and
    is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fits_in_memory(table: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_BYTES, texts: tuple[str, ...] = ()) -> bool:
    """Whether `table`, at `row_bytes` per row and the bytes of its columns `texts`, stays within `max_bytes`.

    Counts the table in parallel; give it a stored one.
    """
    held = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in texts]
    found = table.agg(F.count("*").alias("n"), *(h.alias(f"b{i}") for i, h in enumerate(held))).first()
    return found["n"] * row_bytes + sum(found[f"b{i}"] for i in range(len(texts))) <= max_bytes


def join_words(
    pairs: DataFrame,
    table: DataFrame,
    row_bytes: int,
    how: str = "inner",
    word: str = "word",
    max_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Attach the row of `table` for each word.

    A frequent word can hold a large share of `pairs`. Without a broadcast the rows of a word are therefore
    spread over partitions, as many as its most frequent word needs at `rows_per_task` rows each; every one of
    them receives a copy of the word's single table row.
    """
    if fits_in_memory(table, row_bytes, max_bytes, (word,)):
        return pairs.join(F.broadcast(table), word, how)
    hottest = pairs.groupBy(word).agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    salt = max(1, -(-hottest // rows_per_task))
    others = [c for c in pairs.columns if c != word]
    spread = pairs.withColumn("__salt", F.pmod(F.xxhash64(*others), F.lit(salt)).cast("int"))
    copies = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return spread.join(copies, [word, "__salt"], how).drop("__salt")
