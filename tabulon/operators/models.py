"""Classifiers and regressors: thin, typed entry points to Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators.evaluate import accuracy, positive_rate
from tabulon.operators.features import column_limits, scale, unscale
from tabulon.operators.series import sliding_windows


def logistic(max_iter: int = 10, threshold: float = 0.5, **params) -> LogisticRegression:
    return LogisticRegression(labelCol="label", featuresCol="features", maxIter=max_iter, threshold=threshold, **params)


def boosted_trees(max_iter: int = 10, seed: int = 7, **params) -> GBTClassifier:
    return GBTClassifier(labelCol="label", featuresCol="features", maxIter=max_iter, seed=seed, **params)


def random_forest(num_trees: int = 10, seed: int = 7, **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=num_trees, seed=seed, **params)


def decision_tree(seed: int = 7, **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol="label", featuresCol="features", seed=seed, **params)


def fit(estimator, train: DataFrame):
    """Fit on a cached table and release it: fitting reads the table many times."""
    cached = train.persist()
    try:
        return estimator.fit(cached)
    finally:
        cached.unpersist()


def threshold_from_rate(train: DataFrame, label: str = "label") -> float:
    """The positive rate of the training part, one number."""
    return float(positive_rate(train, label).first()[0])


def score(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Label, prediction and the probability of class 1 for new rows."""
    return model.transform(df).select(
        *keep,
        F.col("label").cast("double").alias("label"),
        F.col("prediction"),
        vector_to_array("probability")[1].alias("probability"),
    )


def linear_scores(df: DataFrame, weights: dict[str, float], intercept: float = 0.0, threshold: float = 0.5) -> DataFrame:
    """Probability and prediction of a logistic model given by its coefficients, as one expression over raw columns.

    A row with a null in a weighted column has neither.
    """
    margin = F.lit(float(intercept))
    for name, weight in weights.items():
        margin = margin + F.lit(float(weight)) * F.col(name)
    probability = 1.0 / (1.0 + F.exp(-margin))
    scored = df.withColumn("probability", probability)
    return scored.withColumn("prediction", (F.col("probability") > threshold).cast("double"))


def compare_models(models: dict, test: DataFrame) -> DataFrame:
    """Accuracy of every model on the same rows, best first."""
    parts = None
    for name, model in models.items():
        row = accuracy(model.transform(test)).select(F.lit(name).alias("model"), "accuracy")
        parts = row if parts is None else parts.unionByName(row)
    return parts.orderBy(F.desc("accuracy"), "model")


def next_step_regression(
    series: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    size: int = 60,
    method: str = "linear",
    seed: int = 7,
) -> DataFrame:
    """Predict each test value from the ``size`` values before it.

    ``series`` carries a ``part`` column (train/test). Scaling and the model
    are fitted on the train part; windows of the first test rows reach back
    into it.
    """
    limits = column_limits(series.where(F.col("part") == "train"), [value])
    scaled = scale(series, limits, [value], "_scaled")
    windows = sliding_windows(
        scaled.select(*by, *order, "part", value, f"{value}_scaled"), by, order, f"{value}_scaled", size
    )
    ready = windows.withColumn("features", array_to_vector("window")).withColumn("label", F.col(f"{value}_scaled"))
    if method == "linear":
        estimator = LinearRegression(regParam=0.001, maxIter=50)
    elif method == "boosted":
        estimator = GBTRegressor(maxIter=10, seed=seed)
    else:
        raise ValueError(f"unknown method {method!r}")
    model = fit(estimator, ready.where(F.col("part") == "train"))
    predicted = model.transform(ready.where(F.col("part") == "test"))
    back = unscale(predicted, limits, "prediction", value, "forecast")
    return back.select(*by, *order, F.col(value).alias("actual"), "forecast")
