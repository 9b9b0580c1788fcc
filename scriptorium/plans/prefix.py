"""Running totals and row numbers over a whole table without a single-task window."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "__range"


def with_running_totals(
    df: DataFrame, order: str, totals: dict[str, str], descending: bool = False, buckets: int | None = None
) -> DataFrame:
    """Add inclusive running sums ``{new column: summed column}`` along the numeric column `order`.

    The rows are cut into value ranges of about equal size. Each range is summed on its own in one
    window partition and then shifted by the total of the ranges before it; the shifts are one row
    per range, which bounds the broadcast. `order` should be unique: group ties first. Rows without it
    form a range of their own, which comes last.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    inner = [i / buckets for i in range(1, buckets)]
    cuts = df.approxQuantile(order, inner, 1 / (4 * buckets)) if inner else []
    if cuts:
        splits = [-math.inf, *sorted(set(cuts)), math.inf]
        ranged = Bucketizer(splits=splits, inputCol=order, outputCol=_BUCKET, handleInvalid="keep").transform(df)
    else:
        ranged = df.withColumn(_BUCKET, F.lit(0.0))
    last = F.lit(-math.inf if descending else math.inf)
    ranged = ranged.withColumn(_BUCKET, F.when(F.col(order).isNull(), last).otherwise(F.col(_BUCKET)))

    along = F.col(_BUCKET).desc() if descending else F.col(_BUCKET).asc()
    before = Window.orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy(_BUCKET)
        .agg(*(F.sum(source).alias(name) for name, source in totals.items()))
        .select(
            _BUCKET,
            *(F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"__before_{name}") for name in totals),
        )
    )
    inside = (
        Window.partitionBy(_BUCKET)
        .orderBy(F.col(order).desc() if descending else F.col(order).asc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        ranged.join(F.broadcast(shifts), _BUCKET)
        .withColumns(
            {
                name: F.sum(source).over(inside) + F.col(f"__before_{name}")
                for name, source in totals.items()
            }
        )
        .drop(_BUCKET, *(f"__before_{name}" for name in totals))
    )


def with_row_numbers(df: DataFrame, order: str, name: str = "row_id") -> DataFrame:
    """Number the rows 0, 1, 2 … along the unique numeric column `order`."""
    counted = with_running_totals(df.withColumn("__one", F.lit(1).cast("bigint")), order, {name: "__one"})
    return counted.withColumn(name, F.col(name) - 1).drop("__one")
