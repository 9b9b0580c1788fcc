"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.session import through_table

LARGEST_MEAN = 32
BROADCAST_BYTES = 32 << 20


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *(p.cast("string") for p in parts)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def repetition_rates(
    docs: DataFrame, targets: Mapping[str | None, float] | None, epochs: float, text: str, source: str
) -> DataFrame:
    """(source, size, draws, cumulative): how often a document of each source is repeated on average.

    A source of `size` characters that shall have the share w of `epochs` times the whole size is
    repeated w · epochs · whole / size times. Sources without a target have weight 0 if targets are
    given; without targets all have the same weight. A mean above `LARGEST_MEAN` becomes a sum of
    `draws` smaller ones; `cumulative` is the distribution of one draw.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(F.coalesce(F.char_length(text), F.lit(0))).alias("size"))
    if targets is None:
        weighted = sizes.withColumn("weight", F.lit(1.0))
    else:
        pairs = [F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))) for name, w in targets.items()]
        weighted = sizes.withColumn("weight", F.coalesce(*pairs, F.lit(0.0)))
    whole, weights = weighted.filter("size > 0").agg(F.sum("size"), F.sum("weight")).first()
    if not whole or not weights:
        mean = F.lit(0.0)
    else:
        mean = F.when(F.col("size") > 0, F.col("weight") / F.lit(weights) * F.lit(epochs * whole) / F.col("size")).otherwise(0.0)
    one = F.col("mean") / F.col("draws")
    last = F.ceil(one + 12 * F.sqrt(one) + 20).cast("int")
    terms = F.transform(
        F.sequence(F.lit(0), last), lambda k: F.exp(k * F.log(one) - one - F.aggregate(F.sequence(F.lit(0), k), F.lit(0.0), _log_step))
    )
    cumulative = F.transform(terms, lambda _, i: F.aggregate(F.slice("terms", 1, i + 1), F.lit(0.0), lambda a, x: a + x))
    return (
        weighted.withColumn("mean", mean)
        .filter("mean > 0")
        .withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("mean") / LARGEST_MEAN)).cast("int"))
        .withColumn("terms", terms)
        .select("source", "size", "mean", "draws", cumulative.alias("cumulative"))
    )


def _log_step(total: Column, k: Column) -> Column:
    return total + F.when(k > 0, F.log(k.cast("double"))).otherwise(0.0)


def mix_sources(
    docs: DataFrame,
    targets: Mapping[str | None, float] | None = None,
    epochs: float = 1.0,
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Each row of `docs` as often as a Poisson number says, with `copy` (1, 2, …), in random order.

    The number inverts the Poisson distribution of the row's source at a uniform hash of seed, key and
    text, so it does not depend on partitions or retries, and equal rows repeat alike. Rows are dealt to
    ranges of a second hash and sorted by it, which is a uniform shuffle (`shuffle_key`). A missing
    source is a source of its own; the rates of all sources are sent to every task while their measured size is at most
    `BROADCAST_BYTES`, else joined; a missing or empty text has size 0, and a source of such texts alone
    gives no rows; a missing key counts as an empty string; an empty table gives none. Columns `copy`
    and `shuffle_key` of the input are replaced.
    """
    identity = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit(""))))
    rates = repetition_rates(docs, targets, epochs, text, source)
    rates = rates.select(F.col("source").alias("__source"), F.col("draws").alias("__draws"), F.col("cumulative").alias("__cumulative"))
    rates = through_table(rates, "mixing-rates")
    width = F.coalesce(F.octet_length("__source"), F.lit(0)) + 8 * F.size("__cumulative") + 64
    if (rates.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES:
        rates = F.broadcast(rates)
    joined = docs.drop("copy", "shuffle_key").join(rates, F.col(source).eqNullSafe(F.col("__source")))
    draw = lambda i: F.size(F.filter("__cumulative", lambda c: c <= uniform(seed, F.col("__identity"), i)))
    copies = F.aggregate(F.sequence(F.lit(1), F.col("__draws")), F.lit(0), lambda n, i: n + draw(i))
    counted = joined.withColumn("__identity", identity).withColumn("__copies", copies).filter("__copies > 0")
    rows = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), "__copies")))
    keyed = rows.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(f"shuffle {seed}"), "__identity", F.col("copy").cast("string"))))
    return keyed.drop("__source", "__draws", "__cumulative", "__identity", "__copies").orderBy("shuffle_key")
