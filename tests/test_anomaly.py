import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import anomaly as Q


@pytest.fixture(scope="module")
def spike(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(10, 1, 400)
    y[50] = 40.0
    y[51] = -20.0
    return spark.createDataFrame([(i, float(v), float(v) ** 2) for i, v in enumerate(y)], "id bigint, x double, z double")


def test_sigma_rules(spike):
    assert [r["id"] for r in Q.sigma_outliers(spike, "x").collect()] == [50]
    assert sorted(r["id"] for r in Q.sigma_outliers(spike, "x", two_sided=True).collect()) == [50, 51]


def test_top_and_bottom(spike):
    assert [r["id"] for r in Q.top_rows(spike, "x", "id", 1).collect()] == [50]
    bottom = Q.bottom_rows(spike, "x", "id", 3).collect()
    assert bottom[-1]["id"] == 51 and [r["x"] for r in bottom] == sorted((r["x"] for r in bottom), reverse=True)


def test_isolation_finds_the_spike_on_any_layout(spike):
    def flagged(df):
        found = Q.isolation_outliers(df, "id", ["x"], contamination=0.01)
        return {r["id"]: r["score"] for r in found.where("outlier").collect()}

    a, b = flagged(spike.repartition(1)), flagged(spike.repartition(7))
    assert a == b and {50, 51} <= set(a) and len(a) <= 4


def test_isolation_samples_and_tree_sizes(spike):
    nodes = Q.isolation_forest(spike, "id", ["x", "z"], trees=20, sample=64)
    roots = nodes.where("node = 0")
    assert roots.count() == 20 and roots.where("size <> 64").count() == 0
    assert nodes.agg(F.max("depth")).first()[0] <= 6
    leaves = nodes.where("feature < 0").groupBy("tree").agg(F.sum("size").alias("n"))
    assert leaves.where("n <> 64").count() == 0


def test_scores_follow_the_published_formula():
    assert float(Q._average_path(np.array([2.0]))[0]) == 1.0
    assert float(Q._average_path(np.array([256.0]))[0]) == pytest.approx(10.244770920116851)
    assert float(Q._average_path(np.array([1.0]))[0]) == 0.0


def test_large_cluster_rule():
    assert Q.large_clusters([50, 45, 5]) == [True, True, False]
    assert Q.large_clusters([60, 10, 10, 20]) == [True, True, False, True]
    assert Q.large_clusters([100, 10, 9, 8]) == [True, False, False, False]


def test_cluster_scores_send_small_clusters_to_a_large_centre(spark):
    rows = [(i, [0.0, float(i % 3)]) for i in range(95)] + [(100 + i, [10.0, 0.0]) for i in range(5)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    scored = {r["id"]: r["score"] for r in Q.cluster_outlier_scores(df, "v", [[0.0, 1.0], [10.0, 0.0]]).collect()}
    assert scored[1] == 0.0 and scored[100] == pytest.approx(math.sqrt(101))


def test_reconstruction_finds_rows_off_the_line(spark):
    rows = [(i, [i / 10, i / 5 + (5.0 if i == 77 else 0.0)]) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    found = Q.reconstruction_outliers(df, "v", 1, 0.005)
    assert [r["id"] for r in found.where("outlier").collect()] == [77]


def test_detectors_side_by_side(spark):
    a = spark.createDataFrame([(1, True), (2, False)], "id int, outlier boolean")
    b = spark.createDataFrame([(1, True), (3, True)], "id int, outlier boolean")
    wide, agreement = Q.compare_detectors({"a": a, "b": b}, "id")
    assert wide.count() == 3
    assert {(r["a"], r["b"]): r["both"] for r in agreement.collect()} == {("a", "a"): 1, ("a", "b"): 1, ("b", "b"): 2}


# Rosner's published example for the generalised test.
ROSNER = [
    -0.25, 0.68, 0.94, 1.15, 1.20, 1.26, 1.26, 1.34, 1.38, 1.43, 1.49, 1.49, 1.55, 1.56, 1.58, 1.65, 1.69, 1.70,
    1.76, 1.77, 1.81, 1.91, 1.94, 1.96, 1.99, 2.06, 2.09, 2.10, 2.14, 2.15, 2.23, 2.24, 2.26, 2.35, 2.37, 2.40,
    2.47, 2.54, 2.62, 2.64, 2.90, 2.92, 2.92, 2.93, 3.21, 3.26, 3.30, 3.59, 3.68, 4.30, 4.64, 5.34, 5.42, 6.01,
]


def test_extreme_deviates_on_the_published_example(spark):
    df = spark.createDataFrame(list(enumerate(ROSNER)), "id bigint, x double")
    rows = Q.extreme_deviates(df, "id", "x", 10).orderBy("step").collect()
    assert [r["outlier"] for r in rows] == [True] * 3 + [False] * 7
    assert rows[0]["statistic"] == pytest.approx(3.118, abs=0.002)
    assert rows[0]["critical"] == pytest.approx(3.158, abs=0.002)
    assert rows[2]["statistic"] == pytest.approx(3.179, abs=0.002)


def test_unit_grid(spark):
    grid = Q.unit_grid(spark, ("a", "b"), 100)
    assert grid.count() == 10000 and grid.distinct().count() == 10000
    row = grid.agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).first()
    assert tuple(row) == (0.0, 1.0, 0.0, 1.0)
