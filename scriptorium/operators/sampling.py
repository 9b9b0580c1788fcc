"""Splits and samples that are pure functions of a row key.

Every operator here decides by hashes, so a lost task recomputes the same rows and
the result does not depend on how the input is partitioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions.hashing import HASH_BITS, hash_bucket, key_hash

_COARSE_BITS = 16


def stratified_split(
    df: DataFrame, key: str, train: int = 70, validation: int = 15, name: str = "split"
) -> DataFrame:
    """Tag each row train, validation or test by percent of the key hash; no shuffle.

    The bucket is independent of the label, so each class is split in the same shares.
    """
    bucket = hash_bucket(key, 100)
    return df.withColumn(
        name,
        F.when(bucket < train, "train").when(bucket < train + validation, "validation").otherwise("test"),
    )


def random_stratified_split(
    df: DataFrame, label: str, classes: tuple[int, ...] = (0, 1), seed: int = 42
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bernoulli 70/15/15 per class with Spark's seeded ``randomSplit``; depends on partitioning."""
    parts: list[DataFrame] | None = None
    for value in classes:
        drawn = df.filter(F.col(label) == value).randomSplit([0.70, 0.15, 0.15], seed=seed)
        parts = drawn if parts is None else [a.union(b) for a, b in zip(parts, drawn)]
    return tuple(parts)


def fraction_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample; the whole table for a fraction of one or more."""
    return df if fraction >= 1 else df.sample(fraction=fraction, seed=seed)


def fraction_sample_by_key(df: DataFrame, key: str, percent: int) -> DataFrame:
    """Repeatable form of the sample: rows whose key hash falls below `percent` of the range."""
    return df.filter(hash_bucket(key, 100) < percent)


def _quota_cut(df: DataFrame, label: str, key: str, quota: DataFrame) -> DataFrame:
    """Per label, the (hash, key) of the row that fills the quota, and how many rows of that key it takes.

    `quota` has (label, quota). Counting rows per leading hash bits finds the one bucket in which the
    quota is reached; only that bucket, a 2^-16 share of a class, is ranked.
    """
    rows = df.select(
        label,
        F.col(key).alias("__key"),
        key_hash(key).alias("__hash"),
    ).withColumn("__coarse", F.shiftright("__hash", HASH_BITS - _COARSE_BITS))
    in_order = Window.partitionBy(label).orderBy("__coarse")
    sizes = rows.groupBy(label, "__coarse").agg(F.count("*").alias("__n"))
    reached = (
        sizes.withColumn("__upto", F.sum("__n").over(in_order))
        .join(F.broadcast(quota), label)
        .filter((F.col("__upto") >= F.col("quota")) & (F.col("__upto") - F.col("__n") < F.col("quota")))
        .select(label, "__coarse", (F.col("quota") - F.col("__upto") + F.col("__n")).alias("__rank"))
    )
    fine = Window.partitionBy(label, "__coarse").orderBy("__hash", "__key")
    keys = rows.join(F.broadcast(reached), [label, "__coarse"]).groupBy(label, "__coarse", "__hash", "__key", "__rank").agg(F.count("*").alias("__n"))
    counted = keys.withColumn("__upto", F.sum("__n").over(fine))
    need = F.col("__rank") - F.col("__upto") + F.col("__n")
    return counted.filter((F.col("__upto") >= F.col("__rank")) & (need > 0)).select(
        label, F.struct("__hash", "__key").alias("__cut"), need.alias("__need")
    )


def _at_quota(df: DataFrame, label: str, key: str, quota: DataFrame) -> DataFrame:
    """`df` with `__within`: whether a row is among the first of its class that make up the quota.

    One broadcast row per class tells rows below and above the cut apart, without a shuffle. Only the rows of
    the one key that lies on the cut are gathered, equal rows as one with their number, and divided.
    """
    cut = _quota_cut(df, label, key, quota)
    marked = df.join(F.broadcast(cut), label, "left")
    mine = F.struct(key_hash(key).alias("__hash"), F.col(key).alias("__key"))
    on_cut = F.coalesce(mine == F.col("__cut"), F.lit(False))
    clear = marked.filter(~on_cut).select(*df.columns, (mine < F.col("__cut")).alias("__within"))
    equal = marked.filter(on_cut).groupBy(*df.columns, "__need").agg(F.count("*").alias("__n"))
    along = Window.partitionBy(label).orderBy(F.xxhash64(*df.columns), *df.columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    divided = equal.withColumn("__left", F.col("__need") - F.sum("__n").over(along) + F.col("__n"))
    each = divided.withColumn("__nth", F.explode(F.sequence(F.lit(1).cast("bigint"), "__n")))
    return clear.unionByName(each.select(*df.columns, (F.col("__nth") <= F.col("__left")).alias("__within")))


def stratified_fixed_sample(df: DataFrame, label: str, key: str, sizes: dict[int, int]) -> DataFrame:
    """Exactly ``sizes[label]`` rows of each class, or the whole class where it is smaller, also if keys repeat.

    The rows themselves are not shuffled: each class contributes one threshold. Which of several rows of
    the key on the threshold are taken depends on their content alone.
    """
    wanted = F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair))
    quota = (
        df.filter(F.col(label).isin(*sizes))
        .groupBy(label)
        .agg(F.count("*").alias("__n"))
        .select(label, F.least(F.col("__n"), wanted[F.col(label)].cast("bigint")).alias("quota"))
    )
    return _at_quota(df, label, key, quota).filter("__within").drop("__within")


def stratified_holdout(
    df: DataFrame, label: str, key: str, train_percent: int = 70, name: str = "split"
) -> DataFrame:
    """Tag an exact share of every class train and the rest test, also if keys repeat."""
    quota = df.groupBy(label).agg(
        F.floor(F.count("*") * F.lit(train_percent) / 100).cast("bigint").alias("quota")
    )
    marked = _at_quota(df, label, key, quota)
    return marked.withColumn(name, F.when(F.col("__within"), "train").otherwise("test")).drop("__within")
