"""Classifier metrics in relational form: one aggregation, then arithmetic on four counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.plans.prefix import with_running_totals
from scriptorium.session import through_table

ROC_POINTS = 1000


def _cells(df: DataFrame) -> DataFrame:
    """One row with the four cells of the binary confusion matrix."""
    wrong_or_right = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    return df.agg(
        *(
            F.count(F.when((F.col("label") == actual) & (F.col("prediction") == said), 1)).alias(name)
            for name, (actual, said) in wrong_or_right.items()
        ),
        F.count("*").alias("total"),
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _f1(hit: Column, false_alarm: Column, missed: Column) -> Column:
    return _ratio(2 * hit, 2 * hit + false_alarm + missed)


def accuracy(df: DataFrame) -> DataFrame:
    """Share of rows whose prediction is the label."""
    return df.agg(F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("accuracy"))


def _weighted_f1() -> Column:
    tn, fp, fn, tp, total = (F.col(c) for c in ("tn", "fp", "fn", "tp", "total"))
    return _ratio(_f1(tp, fp, fn) * (tp + fn) + _f1(tn, fn, fp) * (tn + fp), total)


def weighted_f1(df: DataFrame) -> DataFrame:
    """F1 of both classes, weighted by their number of rows."""
    return _cells(df).select(_weighted_f1().alias("weighted_f1"))


def positive_f1(df: DataFrame) -> DataFrame:
    """F1 of class 1 alone."""
    return _cells(df).select(_f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("positive_f1"))


def prediction_quality(df: DataFrame) -> DataFrame:
    """Accuracy and both kinds of F1 in one pass."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return _cells(df).select(
        _ratio(tp + tn, F.col("total")).alias("accuracy"),
        _weighted_f1().alias("weighted_f1"),
        _f1(tp, fp, fn).alias("positive_f1"),
    )


def confusion_matrix(df: DataFrame) -> DataFrame:
    """Rows are labels, columns are predictions."""
    return (
        df.groupBy("label")
        .pivot("prediction", [0, 1])
        .agg(F.count(F.lit(1)))
        .na.fill(0)
        .select("label", F.col("0").alias("predicted_0"), F.col("1").alias("predicted_1"))
    )


def class_recall(df: DataFrame) -> DataFrame:
    """Recall of class 1 (ai) and class 0 (human); zero for an empty class."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return _cells(df).select(_ratio(tp, tp + fn).alias("ai_recall"), _ratio(tn, tn + fp).alias("human_recall"))


def _per_score(df: DataFrame, score: str) -> DataFrame:
    """(score, pos, neg): positives and negatives of each distinct score."""
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col("label").cast("bigint")).alias("pos"),
        F.sum((1 - F.col("label")).cast("bigint")).alias("neg"),
    )


def _by_score(df: DataFrame, score: str) -> DataFrame:
    """Positives and negatives per distinct score, with running totals from the highest score down.

    The grouped scores are stored: they are read three times, their input only once.
    """
    per_score = through_table(_per_score(df, score), "scores")
    return with_running_totals(per_score, "score", {"tp": "pos", "fp": "neg"}, descending=True)


def _cuts(df: DataFrame, score: str, points: int) -> DataFrame:
    """(cut): at most `points` thresholds, the least score among them, between which few scores lie.

    From a quantile sketch that tasks merge. Its rank error is a tenth of the distance between two quantiles.
    """
    shares = [i / points for i in range(points)]
    sketch = F.percentile_approx(F.col(score).cast("double"), shares, 10 * points)
    least = F.min(F.col(score).cast("double"))
    found = df.agg(F.array_distinct(F.concat(F.array(least.alias("least")), F.slice(sketch, 2, points))).alias("cuts"))
    return found.select(F.explode("cuts").alias("cut")).filter("cut IS NOT NULL")


def roc_points(df: DataFrame, score: str = "score", points: int = ROC_POINTS) -> DataFrame:
    """(threshold, fpr, tpr) of the ROC curve, highest threshold first; at most `points` of them.

    Every point lies on the exact curve: its rates are those of all rows that score at least the threshold. With up
    to `points` distinct scores each has its point. With more, thresholds come from a quantile sketch: fewer than
    1.2 / `points` of the rows score between two neighbouring ones, so that no rate in between is further than that
    share of all rows, over its class's share, from its neighbours. Rows without a score come last. The exact area is
    `roc_auc`'s.
    """
    per_score = through_table(_per_score(df, score), "scores")
    if per_score.count() > points:
        cuts = [row.cut for row in _cuts(df, score, points).collect()]
        bounds = F.array(*(F.lit(cut) for cut in sorted(cuts)))
        at = F.array_max(F.filter(bounds, lambda cut: cut <= F.col("score")))
        per_score = per_score.withColumn("score", at).groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        per_score = through_table(per_score, "scores-between-points")
    upto = Window.orderBy(F.desc("score"))
    whole = Window.partitionBy()
    return per_score.select(
        F.col("score").alias("threshold"),
        _ratio(F.sum("neg").over(upto), F.sum("neg").over(whole)).alias("fpr"),
        _ratio(F.sum("pos").over(upto), F.sum("pos").over(whole)).alias("tpr"),
    ).orderBy(F.desc("threshold"))


def roc_auc(df: DataFrame, score: str = "score") -> DataFrame:
    """Exact area under the ROC curve: the trapezoids, summed over the distinct scores."""
    points = _by_score(df, score)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return points.agg(area.alias("area"), F.sum("pos").alias("p"), F.sum("neg").alias("n")).select(
        _ratio(F.col("area"), F.col("p").cast("double") * F.col("n")).alias("roc_auc")
    )
