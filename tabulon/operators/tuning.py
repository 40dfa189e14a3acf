"""Parameter grids, cross-validation and sweeps."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.operators.models import fit
from tabulon.operators.ordered import with_group_values
from tabulon.session import side_by_side, written

#: Rows of a partition where a fit is hundreds of small jobs, each with a task for every partition.
PACK_ROWS = 60_000


def grid(estimator, **values: Sequence) -> list[dict]:
    """Every combination of the given parameter values."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


# The settings that the searches try.


def logistic_grid(estimator) -> list[dict]:
    return grid(estimator, regParam=[0.01, 0.5, 2.0], elasticNetParam=[0.0, 0.5, 1.0], maxIter=[2, 5])


def boosted_grid(estimator, iterations: Sequence[int] = (10, 100)) -> list[dict]:
    return grid(estimator, maxDepth=[2, 5], maxIter=iterations)


def tree_grid(
    estimator,
    max_depth: Sequence[int] = (2, 3, 4, 5),
    min_rows: Sequence[int] = (5, 10, 15, 20, 25),
    min_gain: Sequence[float] = (0.0, 0.001, 0.01),
) -> list[dict]:
    """Grid for a tree or forest. A smallest gain stands in for limits on split size and leaf count."""
    return grid(estimator, maxDepth=max_depth, minInstancesPerNode=min_rows, minInfoGain=min_gain)


def fold_by_hash(df: DataFrame, key: str, folds: int, name: str = "fold") -> DataFrame:
    """Fold numbers from a hash of the key, the same on any layout and even for any number of folds."""
    return df.withColumn(name, F.pmod(F.xxhash64(F.lit("fold"), F.col(key).cast("string")), F.lit(folds)).cast("int"))


def pooled(df: DataFrame, columns: Sequence[str], weight: str = "weight") -> DataFrame:
    """Equal rows over the given columns as one row with their number as its weight.

    For estimators that draw no rows and set no least number of rows in a node, to which a weight is as good as copies.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias(weight))


def cross_validate(
    estimator,
    params: list[dict],
    df: DataFrame,
    folds: int = 2,
    fold_column: str = "fold",
    evaluator: Evaluator | None = None,
    parallelism: int = 4,
    weight: str | None = None,
) -> CrossValidatorModel:
    """Fit every combination on every fold; keep the one with the best average.

    Only the label, the features, the fold and the weight are kept, since every fold is cached.
    """
    validator, columns = _validator(estimator, params, folds, fold_column, evaluator, parallelism, weight)
    return fit(validator, df.select(*columns))


def _validator(estimator, params, folds, fold_column, evaluator, parallelism, weight) -> tuple[CrossValidator, list[str]]:
    measure = {"weightCol": weight} if weight else {}
    columns = [estimator.getLabelCol(), estimator.getFeaturesCol(), fold_column, *([weight] if weight else [])]
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=params,
        evaluator=evaluator or BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", **measure),
        numFolds=folds,
        foldCol=fold_column,
        parallelism=parallelism,
    )
    return validator, columns


def cross_validate_at_once(
    estimator,
    params: list[dict],
    df: DataFrame,
    folds: int = 2,
    fold_column: str = "fold",
    evaluator: Evaluator | None = None,
    parallelism: int = 8,
    weight: str | None = None,
) -> CrossValidatorModel:
    """:func:`cross_validate` for fits that are hundreds of small jobs one after the other, like boosted trees.

    The folds run side by side as well, and their rows lie in as few partitions as ``PACK_ROWS`` allows.
    """
    validator, columns = _validator(estimator, params, folds, fold_column, evaluator, parallelism, weight)
    rows, measure = written(df.select(*columns)), validator.getEvaluator()
    sizes = {r[fold_column]: r["count"] for r in rows.groupBy(fold_column).count().collect()}  # one row for each fold
    if any(not 0 <= f < folds for f in sizes):
        raise ValueError(f"fold numbers must be in 0 to {folds - 1}")
    total, parts = sum(sizes.values()), []
    for f in range(folds):
        for name, n in (("training", total - sizes.get(f, 0)), ("validation", sizes.get(f, 0))):
            if not n:
                raise ValueError(f"the {name} rows of fold {f} are empty")
        parts.append((_packed(rows.where(F.col(fold_column) != f), total - sizes[f]), _packed(rows.where(F.col(fold_column) == f), sizes[f])))
    everything = _packed(rows, total)

    def measured(job: tuple[int, int]) -> float:
        fold, i = job
        train, validation = parts[fold]
        return measure.evaluate(estimator.fit(train, params[i]).transform(validation))

    try:
        jobs = [(fold, i) for fold in range(folds) for i in range(len(params))]
        scores = np.reshape(side_by_side(measured, jobs, parallelism), (folds, len(params)))
        means = scores.mean(axis=0)
        best = int(means.argmax() if measure.isLargerBetter() else means.argmin())
        model = CrossValidatorModel(estimator.fit(everything, params[best]), means.tolist(), stdMetrics=scores.std(axis=0).tolist())
    finally:
        for table in (everything, *[t for pair in parts for t in pair]):
            table.unpersist()
    return validator._copyValues(model)


def _packed(df: DataFrame, rows: int) -> DataFrame:
    return df.repartition(math.ceil(rows / PACK_ROWS)).persist()


def grid_results(spark, model: CrossValidatorModel) -> DataFrame:
    """One row per combination: its parameters, average score, and whether it won."""
    best = max(model.avgMetrics) if model.getEvaluator().isLargerBetter() else min(model.avgMetrics)
    winner = model.avgMetrics.index(best)
    rows = [
        (i, ", ".join(f"{p.name}={v}" for p, v in sorted(values.items(), key=lambda kv: kv[0].name)), float(metric), i == winner)
        for i, (values, metric) in enumerate(zip(model.getEstimatorParamMaps(), model.avgMetrics))
    ]
    return spark.createDataFrame(rows, "combination int, params string, score double, best boolean")


def best_params(spark, model: CrossValidatorModel) -> DataFrame:
    """The winning combination, one row per parameter, read from the refitted model."""
    names = sorted({p.name for values in model.getEstimatorParamMaps() for p in values})
    fitted = model.bestModel
    rows = [(name, str(fitted.getOrDefault(fitted.getParam(name)))) for name in names]
    return spark.createDataFrame(rows, "param string, value string")


def elbow(sweep: DataFrame, k: str = "k", cost: str = "sse") -> DataFrame:
    """The point of a sweep farthest from the straight line between its ends.

    A sweep has one row per k tried, so its window is small by construction.
    """
    ends = sweep.agg(
        F.min_by(cost, k).alias("y0"), F.max_by(cost, k).alias("y1"), F.min(k).alias("x0"), F.max(k).alias("x1")
    )
    wide = with_group_values(sweep.select(k, cost), ends, [])
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    gap = F.abs(dy * F.col(k) - dx * F.col(cost) + F.col("x1") * F.col("y0") - F.col("y1") * F.col("x0"))
    distance = F.try_divide(gap, F.sqrt(dx * dx + dy * dy))
    ranked = wide.withColumn("distance", distance)
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("distance"), F.asc(k))
    return ranked.select(k, cost, "distance", (F.row_number().over(order) == 1).alias("elbow"))
