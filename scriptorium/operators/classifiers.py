"""Training, scoring and comparison of MLlib classifiers over the assembled features."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators import metrics
from scriptorium.operators.sampling import fraction_sample
from scriptorium.operators.vectors import SEED, STYLE_COLUMNS, VECTOR_SIZE, assembler, scaler
from scriptorium.session import shared_dir

RANDOM_FOREST = "Random Forest"
LOGISTIC_REGRESSION = "Logistic Regression"
GRADIENT_BOOSTED = "Gradient Boosted"
SWEEP_FRACTIONS = (0.10, 0.25, 0.50, 0.75, 1.00)


def logistic_regression(max_iter: int = 50, reg_param: float = 0.01) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features", labelCol="label", maxIter=max_iter, regParam=reg_param, elasticNetParam=0.0
    )


def random_forest(trees: int = 50, depth: int = 10, features: str = "features") -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=features, labelCol="label", numTrees=trees, maxDepth=depth, seed=SEED
    )


def gradient_boosted(iterations: int = 50, depth: int = 6) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=iterations, maxDepth=depth, seed=SEED)


def default_estimators() -> dict[str, Estimator]:
    return {
        LOGISTIC_REGRESSION: logistic_regression(),
        RANDOM_FOREST: random_forest(),
        GRADIENT_BOOSTED: gradient_boosted(),
    }


def train(features: DataFrame, estimator: Estimator) -> PipelineModel:
    """Assemble, scale and fit. Boosting cuts its growing lineage in the shared folder."""
    context = features.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(features.sparkSession))
    return Pipeline(stages=[assembler(), scaler(), estimator]).fit(features)


def batch_score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Add rawPrediction, probability and prediction."""
    return model.transform(features)


def train_on_embeddings(
    df: DataFrame, embedding: str = "embedding", trees: int = 50, depth: int = 10
) -> tuple[PipelineModel, DataFrame]:
    """Random forest over document vectors; returns the model and the table with vector features."""
    features = df.withColumn("features", array_to_vector(embedding))
    return Pipeline(stages=[random_forest(trees, depth)]).fit(features), features


def with_positive_score(scored: DataFrame) -> DataFrame:
    """Add ``score``, the probability of class 1."""
    return scored.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))


@dataclass(frozen=True)
class Quality:
    accuracy: float
    f1: float
    roc_auc: float


def quality(scored: DataFrame, positive_only: bool = False) -> Quality:
    """Accuracy, F1 (weighted, or of class 1 alone) and exact ROC area of scored rows."""
    judged = with_positive_score(scored).select("label", "prediction", "score").persist()
    try:
        found = metrics.prediction_quality(judged).first()
        f1 = found["positive_f1"] if positive_only else found["weighted_f1"]
        return Quality(found["accuracy"], f1, metrics.roc_auc(judged).first()[0])
    finally:
        judged.unpersist()


def model_comparison(models: dict[str, PipelineModel], validation: DataFrame, test: DataFrame) -> DataFrame:
    """One row per model with validation and test quality, rounded to four digits."""
    rows = []
    for name, model in models.items():
        found = [quality(batch_score(model, part)) for part in (validation, test)]
        rows.append((name, *(round(v, 4) for q in found for v in (q.accuracy, q.f1, q.roc_auc))))
    columns = [f"{part}_{metric}" for part in ("val", "test") for metric in ("accuracy", "f1", "auc")]
    return validation.sparkSession.createDataFrame(
        rows, "model string, " + ", ".join(f"{c} double" for c in columns)
    )


def feature_importance_topk(
    spark: SparkSession, model: PipelineModel, k: int = 15, vector_size: int = VECTOR_SIZE
) -> DataFrame:
    """The leading features of a fitted forest by name."""
    names = [*STYLE_COLUMNS, *(f"w2v_{i}" for i in range(vector_size))]
    weights = [float(x) for x in model.stages[-1].featureImportances.toArray()]
    table = spark.createDataFrame(list(zip(names, weights)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def select_best_model(comparison: DataFrame, prefer: str | None = None) -> str:
    """Name of the model to keep: the preferred one, else the greatest validation ROC area."""
    if prefer is not None:
        return prefer
    return comparison.orderBy(F.desc("val_auc"), "model").select("model").first()[0]


def embedding_comparison(
    spark: SparkSession, families: Sequence[tuple[str, Quality, int]], model: str = RANDOM_FOREST
) -> DataFrame:
    """One row per feature family: quality on its test rows and the number of training rows."""
    rows = [(name, model, q.accuracy, q.f1, q.roc_auc, size) for name, q, size in families]
    return spark.createDataFrame(
        rows,
        "embedding string, model string, test_accuracy double, test_f1 double, test_auc double, train_rows bigint",
    )


def training_scale_sweep(
    features: DataFrame,
    fractions: Sequence[float] = SWEEP_FRACTIONS,
    trees: int = 50,
    depth: int = 10,
    max_iter: int = 50,
) -> DataFrame:
    """Fit times per sample fraction: (fraction, rows, lr_time_sec, rf_time_sec).

    The sample is persisted so that the times are those of fitting; losing an executor recomputes it.
    """
    estimators = (logistic_regression(max_iter, reg_param=0.0), random_forest(trees, depth))
    rows = []
    for fraction in fractions:
        sample = fraction_sample(features, fraction).persist()
        size = sample.count()
        times = []
        for estimator in estimators:
            begin = time.monotonic()
            train(sample, estimator)
            times.append(round(time.monotonic() - begin, 2))
        sample.unpersist()
        rows.append((float(fraction), size, *times))
    return features.sparkSession.createDataFrame(
        rows, "fraction double, rows bigint, lr_time_sec double, rf_time_sec double"
    )
