"""What a fitted model looks at: coefficients, importances, partial dependence, trees."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.session import scratch_path, spread


def slot_names(df: DataFrame, features: str = "features") -> list[str]:
    """Feature name of each vector slot, from the column's metadata."""
    groups = df.schema[features].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for a in chain.from_iterable(groups.values()))
    return [name for _, name in slots]


def slot_table(df: DataFrame, features: str = "features") -> DataFrame:
    return df.sparkSession.createDataFrame(list(enumerate(slot_names(df, features))), "slot int, feature string")


def _weights(spark: SparkSession, names: Sequence[str], values: Sequence[float], column: str) -> DataFrame:
    rows = [(i, n, float(v)) for i, (n, v) in enumerate(zip(names, values))]
    return spark.createDataFrame(rows, f"slot int, feature string, {column} double")


def coefficients(model, df: DataFrame, features: str = "features") -> DataFrame:
    """Intercept and coefficients, largest first."""
    names = slot_names(df, features)
    table = _weights(df.sparkSession, names, model.coefficients.toArray(), "coefficient")
    intercept = df.sparkSession.createDataFrame(
        [(-1, "(intercept)", float(model.intercept))], "slot int, feature string, coefficient double"
    )
    return intercept.unionByName(table).orderBy(F.desc("coefficient"), "slot")


def importances(model, df: DataFrame, features: str = "features") -> DataFrame:
    """Feature importances of a tree model, largest first."""
    table = _weights(df.sparkSession, slot_names(df, features), model.featureImportances.toArray(), "importance")
    return table.orderBy(F.desc("importance"), "slot")


def partial_dependence(
    fitted, model, df: DataFrame, grids: dict[str, Sequence[float]]
) -> DataFrame:
    """Average probability of class 1 when one or two columns are set to each grid value.

    ``fitted`` turns raw columns into features. Trees and forests are read as tables: a row reaches a leaf at some
    grid value exactly if it passes the splits on other columns, so one pass over the rows, however long the
    grid is, counts the rows for each leaf, and a grid value takes the leaves whose splits on the grid
    columns it passes. Other models score each row once for each grid value.
    """
    if isinstance(model, (DecisionTreeClassificationModel, RandomForestClassificationModel)):
        return _dependence_by_leaves(fitted, model, df, grids)
    return dependence_by_rows(fitted, model, df, grids)


def dependence_by_rows(fitted, model, df: DataFrame, grids: dict[str, Sequence[float]]) -> DataFrame:
    """The same for any model. The grid is a literal array, so nothing is joined."""
    replaced = spread(df)
    for name, values in grids.items():
        points = F.array(*[F.lit(float(v)) for v in values])
        replaced = replaced.drop(name).withColumn(name, F.explode(points))
    scored = model.transform(fitted.transform(replaced))
    return scored.groupBy(*grids).agg(
        F.avg(vector_to_array("probability")[1]).alias("mean_probability"), F.count(F.lit(1)).alias("rows")
    )


def _dependence_by_leaves(fitted, model, df: DataFrame, grids: dict[str, Sequence[float]]) -> DataFrame:
    spark, features = df.sparkSession, model.getFeaturesCol()
    ready = fitted.transform(df)
    names = slot_names(ready, features)
    own = {i for i, name in enumerate(names) if any(name == c or name.startswith(f"{c}_") for c in grids)}
    if not all(any(n == c or n.startswith(f"{c}_") for n in names) for c in grids):
        return dependence_by_rows(fitted, model, df, grids)
    trees = {}
    # As many rows as the model has nodes.
    for r in _split_nodes(model, spark).collect():
        trees.setdefault(r["tree"], {})[r["id"]] = r

    def reach(x: np.ndarray, nodes: dict, both) -> dict[int, np.ndarray]:
        """Rows of x at each leaf; at splits on a slot in ``both`` they go to either side."""
        found, todo = {}, [(0, np.ones(len(x), bool))]
        while todo:
            at, mask = todo.pop()
            node = nodes[at]
            if node["left"] is None:
                found[at] = mask
                continue
            value, limits = x[:, node["feature"]], node["limits"]
            left = np.isin(value, limits) if node["categories"] > 0 else value <= limits[0]
            free = node["feature"] in both
            todo += [(node["left"], mask if free else mask & left), (node["right"], mask if free else mask & ~left)]
        return found

    def count(parts):
        for part in parts:
            if len(part):
                x = np.stack(part["x"].to_numpy())
                rows = [(t, leaf, int(m.sum())) for t, nodes in trees.items() for leaf, m in reach(x, nodes, own).items()]
                yield pd.DataFrame([*rows, (-1, 0, len(x))], columns=["tree", "leaf", "n"])

    held = spread(ready.select(vector_to_array(features).alias("x"))).mapInPandas(count, "tree int, leaf int, n bigint")
    counts = {(r["tree"], r["leaf"]): r["n"] for r in held.groupBy("tree", "leaf").agg(F.sum("n").alias("n")).collect()}
    total = counts.get((-1, 0), 0)
    points = df.limit(1).drop(*grids)
    for name, values in grids.items():
        points = points.withColumn(name, F.explode(F.array(*[F.lit(float(v)) for v in values])))
    at = fitted.transform(points).select(*grids, vector_to_array(features).alias("x")).collect()  # the grid
    x = np.array([r["x"] for r in at])
    others = set(range(len(names))) - own
    mean = np.zeros(len(at))
    for t, nodes in trees.items():
        for leaf, mask in reach(x, nodes, others).items() if len(at) else ():
            stats = nodes[leaf]["class_counts"]
            mean += mask * (stats[1] / sum(stats)) * counts.get((t, leaf), 0) / total / len(trees)
    rows = [(*[float(r[c]) for c in grids], float(m), total) for r, m in zip(at, mean)]
    schema = ", ".join([*[f"`{c}` double" for c in grids], "mean_probability double", "rows bigint"])
    return spark.createDataFrame(rows, schema)


def _split_nodes(model, spark: SparkSession) -> DataFrame:
    """Nodes with the limits of their splits: the threshold, or the categories that go left."""
    leaf = F.col("leftChild") < 0
    return _saved_nodes(model, spark).select(
        "tree", "id", F.col("impurityStats").alias("class_counts"),
        F.when(~leaf, F.col("leftChild")).alias("left"), F.when(~leaf, F.col("rightChild")).alias("right"),
        F.col("split.featureIndex").alias("feature"), F.col("split.leftCategoriesOrThreshold").alias("limits"),
        F.col("split.numCategories").alias("categories"),
    )


def _saved_nodes(model, spark: SparkSession) -> DataFrame:
    path = scratch_path(spark, "tree")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        return nodes.select(F.col("treeID").alias("tree"), "nodeData.*")
    return nodes.withColumn("tree", F.lit(0))


def tree_nodes(model, spark: SparkSession) -> DataFrame:
    """Nodes of a fitted tree or forest: split, impurity, rows and class counts.

    Reads the table that saving the model writes.
    """
    nodes, leaf = _saved_nodes(model, spark), F.col("leftChild") < 0
    return nodes.select(
        "tree",
        "id",
        "prediction",
        "impurity",
        F.col("rawCount").cast("bigint").alias("rows"),
        F.col("impurityStats").alias("class_counts"),
        "gain",
        F.when(~leaf, F.col("leftChild")).alias("left"),
        F.when(~leaf, F.col("rightChild")).alias("right"),
        F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf, F.element_at("split.leftCategoriesOrThreshold", 1)).alias("threshold"),
    )


def param_docs(estimator, spark: SparkSession) -> DataFrame:
    """Name, documentation and current value of every parameter of an estimator."""
    rows = [
        (p.name, p.doc, str(estimator.getOrDefault(p)) if estimator.hasDefault(p) or estimator.isSet(p) else None)
        for p in estimator.params
    ]
    return spark.createDataFrame(rows, "param string, doc string, value string")
