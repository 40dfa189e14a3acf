"""Clustering: k-means and relatives, and the choice of k."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.expressions import squared_distance, vectors_literal
from tabulon.operators import affinity, ward
from tabulon.operators.neighbours import BLOCK_ROWS, mean_silhouettes, nearest
from tabulon.session import settle, side_by_side

LEAST_WEIGHT = 1e-300
#: Rounds of messages between two writes.
ROUNDS_PER_WRITE = 5


def kmeans_model(
    df: DataFrame, k: int, seed: int = 5, features: str = "features", max_iter: int = 20, name: str = "cluster"
) -> KMeansModel:
    return KMeans(k=k, seed=seed, featuresCol=features, predictionCol=name, maxIter=max_iter).fit(df)


def kmeans(df: DataFrame, k: int, seed: int = 5, features: str = "features") -> DataFrame:
    """Rows with their cluster number."""
    return kmeans_model(df, k, seed, features).transform(df)


def centroids(model: KMeansModel) -> list[list[float]]:
    return [c.tolist() for c in model.clusterCenters()]


def assign(df: DataFrame, vector: str, centres: Sequence[Sequence[float]], name: str = "cluster") -> DataFrame:
    """Nearest of the given centres for each row, with the squared distance to it. Ties go to the lower number."""
    options = F.transform(
        vectors_literal(centres), lambda c, i: F.struct(squared_distance(F.col(vector), c).alias("d"), i.alias("i"))
    )
    best = F.array_min(options)
    chosen = df.withColumn("_best", best)
    return chosen.select(*df.columns, F.col("_best.i").alias(name), F.col("_best.d").alias("sq_distance"))


def inertia(assigned: DataFrame) -> DataFrame:
    """Sum of squared distances to the assigned centres."""
    return assigned.agg(F.sum("sq_distance").alias("sse"))


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("count"))


def label_per_k(df: DataFrame, ks: Sequence[int], seed: int = 42, features: str = "features") -> DataFrame:
    """One cluster column per k, added without a join."""
    out = df = settle(df)
    for model in side_by_side(lambda k: kmeans_model(df, k, seed, features, name=f"clusters_{k}"), ks):
        out = model.transform(out)
    return out


def sweep_k(
    df: DataFrame, key: str, ks: Sequence[int], seed: int = 5, features: str = "features", with_silhouette: bool = False
) -> DataFrame:
    """Sum of squares, and the mean silhouette when asked, for each k on one cached table."""
    cached = settle(df.select(key, features))
    models = side_by_side(lambda k: kmeans_model(cached, k, seed, features, name=f"clusters_{k}"), ks)
    scores = {}
    if with_silhouette:
        labeled = cached
        for model in models:
            labeled = model.transform(labeled)
        names = [f"clusters_{k}" for k in ks]
        means = mean_silhouettes(labeled.withColumn("_v", vector_to_array(features)), key, "_v", names)
        scores = {r["labeling"]: r["silhouette"] for r in means.collect()}
    rows = [(k, float(m.summary.trainingCost), scores.get(f"clusters_{k}")) for k, m in zip(ks, models)]
    return df.sparkSession.createDataFrame(rows, "k int, sse double, silhouette double")


def gap_statistic(
    df: DataFrame, ks: Sequence[int], references: int = 3, seed: int = 5, features: str = "features"
) -> DataFrame:
    """Gap of log sum-of-squares against uniform boxes; ``chosen`` marks the smallest k within one error of the next."""
    spark = df.sparkSession
    vectors = df.select(vector_to_array(features).alias("v")).persist()
    try:
        n = vectors.count()
        limits = vectors.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(
            F.min("x").alias("lo"), F.max("x").alias("hi")
        )
        box = sorted(limits.collect())
        table = vectors.select(array_to_vector("v").alias("features")).persist()
        boxes = [
            spark.range(n)
            .select(
                array_to_vector(
                    F.array(
                        *[
                            F.lit(b["lo"]) + F.lit(b["hi"] - b["lo"]) * _uniform("id", f"{seed}:{r}:{b['i']}")
                            for b in box
                        ]
                    )
                ).alias("features")
            )
            .persist()
            for r in range(references)
        ]
        fits = [(k, part) for k in ks for part in (table, *boxes)]
        costs = side_by_side(lambda fit: np.log(kmeans_model(fit[1], fit[0], seed).summary.trainingCost), fits)
        rows = []
        for i, k in enumerate(ks):
            observed, *logs = costs[i * (references + 1) : (i + 1) * (references + 1)]
            rows.append((k, float(np.mean(logs) - observed), float(np.std(logs) * np.sqrt(1 + 1 / references))))
        for b in [*boxes, table]:
            b.unpersist()
    finally:
        vectors.unpersist()
    chosen = next(
        (rows[i][0] for i in range(len(rows) - 1) if rows[i][1] >= rows[i + 1][1] - rows[i + 1][2]), rows[-1][0]
    )
    return spark.createDataFrame([(*r, r[0] == chosen) for r in rows], "k int, gap double, error double, chosen boolean")


def _uniform(key: str, salt: str):
    """A number in [0, 1) from a hash, the same on any layout."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def gaussian_mixture(df: DataFrame, k: int, seed: int = 5, features: str = "features") -> DataFrame:
    return GaussianMixture(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df).transform(df)


def bisecting_kmeans(df: DataFrame, k: int, seed: int = 5, features: str = "features") -> DataFrame:
    return BisectingKMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df).transform(df)


def similarity_edges(df: DataFrame, key: str, vector: str, neighbours: int, gamma: float | None = None) -> DataFrame:
    """Nearest-neighbour graph with weights exp(−gamma·d²); each undirected edge once.

    A weight too small for a float counts as the smallest one, so a far row keeps its edges and
    every row is in the graph.
    """
    width = len(df.select(vector).first()[0])
    rate = gamma if gamma is not None else 1.0 / width
    found = nearest(df, key, vector, neighbours)
    weight = F.exp(F.lit(-rate) * F.col("distance") * F.col("distance"))
    return (
        found.select(F.least(key, "neighbour").alias("src"), F.greatest(key, "neighbour").alias("dst"), weight.alias("weight"))
        .groupBy("src", "dst")
        .agg(F.greatest(F.max("weight"), F.lit(LEAST_WEIGHT)).alias("weight"))
    )


def power_vector(edges: DataFrame, max_iter: int = 20) -> DataFrame:
    """The vector of power iteration on a weighted graph: ``(id, x)``.

    Each round takes the weighted mean over a row's neighbours, starting from its degree. It is stopped
    early, while parts of the graph still have values of their own. Means need no scaling between rounds.
    """
    both = settle(edges.select("src", "dst", "weight").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")))
    degree = settle(both.groupBy("src").agg(F.sum("weight").alias("d")))
    steps = settle(both.join(degree, "src").select("src", "dst", (F.col("weight") / F.col("d")).alias("weight")))
    x = degree.select(F.col("src").alias("id"), F.col("d").alias("x"))
    for done in range(1, max_iter + 1):
        x = steps.join(x.withColumnRenamed("id", "dst"), "dst").groupBy(F.col("src").alias("id")).agg(F.sum(F.col("weight") * F.col("x")).alias("x"))
        if done % ROUNDS_PER_WRITE == 0 or done == max_iter:
            x = settle(x)
    return x


def spectral_clusters(edges: DataFrame, ks: Sequence[int], max_iter: int = 20, seed: int = 5) -> DataFrame:
    """Power-iteration clustering of a similarity graph: ``(k, id, cluster)``; one iteration serves every k."""
    found = power_vector(settle(edges), max_iter)
    scale = found.agg(F.sum(F.abs("x")).alias("s"), F.count(F.lit(1)).alias("n")).first()
    scaled = F.col("x") * float((scale["n"] or 1) / (scale["s"] or 1.0))
    points = settle(found.select("id", array_to_vector(F.array(scaled)).alias("features")))
    models = side_by_side(lambda k: kmeans_model(points, k, seed), ks)
    parts = [m.transform(points).select(F.lit(k).alias("k"), "id", "cluster") for k, m in zip(ks, models)]
    return reduce(DataFrame.unionByName, parts)


def spectral_columns(edges: DataFrame, ks: Sequence[int], max_iter: int = 20) -> DataFrame:
    """The same labels with one column per k."""
    long = spectral_clusters(edges, ks, max_iter)
    return long.groupBy("id").agg(*[F.max(F.when(F.col("k") == k, F.col("cluster"))).alias(f"clusters_{k}") for k in ks])


# ------------------------------------------------------------------ agglomerative


def agglomerative(df: DataFrame, key: str, vector: str, ks: Sequence[int], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Ward's method over all distinct vectors: ``(key, clusters_k…)``; see :mod:`tabulon.operators.ward`."""
    return ward.labels(df, key, vector, ks, block_rows=block_rows)


# ------------------------------------------------------------------ affinity propagation


def affinity_propagation(
    df: DataFrame,
    key: str,
    vector: str,
    damping: float = 0.5,
    neighbours: int | None = None,
    preference: float | None = None,
    max_iter: int = 200,
    patience: int = 15,
) -> DataFrame:
    """Exemplar clustering by message passing: ``(key, exemplar, converged)``; see :func:`affinity_sweep`."""
    return affinity_sweep(df, key, vector, [damping], neighbours, preference, max_iter, patience).drop("damping")


def affinity_sweep(
    df: DataFrame,
    key: str,
    vector: str,
    dampings: Sequence[float],
    neighbours: int | None = None,
    preference: float | None = None,
    max_iter: int = 200,
    patience: int = 15,
) -> DataFrame:
    """Affinity propagation for several dampings in the same rounds: ``(damping, key, exemplar, converged)``.

    Without ``neighbours`` every row sends messages to every other, as the algorithm is defined, and the
    preference is the median of all similarities; see :mod:`tabulon.operators.affinity`. With a number, messages go to that many nearest rows
    only; the preference then has to be given, since the near rows alone would put it too high. A damping
    ends when its exemplars have not changed for ``patience`` rounds (``converged``), or after ``max_iter``.
    Rows end at the nearest exemplar; a damping without any exemplar has null for all rows.
    """
    if neighbours is not None and preference is None:
        raise ValueError("messages to the nearest rows only need a preference")
    rows = settle(df.select(F.col(key).alias("i"), F.col(vector).alias("v")))
    if neighbours is None:
        found = affinity.exemplars(rows, [float(d) for d in dampings], preference, max_iter, patience)
        ended = [_exemplars(rows, chosen, d, converged) for d, chosen, converged in found]
        return reduce(DataFrame.unionByName, ended).withColumnRenamed("i", key)
    found = nearest(rows, "i", "v", neighbours)
    edges = settle(found.select("i", F.col("neighbour").alias("k"), (-F.col("distance") * F.col("distance")).alias("s")))
    own = F.lit(float(preference))
    # A tiny key-dependent shift settles ties between equally good exemplars.
    jitter = 1.0 + F.pmod(F.xxhash64("i", "k"), F.lit(1000)) * F.lit(1e-12)
    links = edges.unionByName(rows.select("i", F.col("i").alias("k"), own.alias("s")))
    zero = F.lit(0.0)
    state = settle(
        links.select(
            F.explode(F.array(*[F.lit(float(d)) for d in dampings])).alias("d"), "i", "k", (F.col("s") * jitter).alias("s"),
            zero.alias("r"), zero.alias("a"),
        )
    )
    ended, stable, last = [], dict.fromkeys(map(float, dampings), 0), {}
    for done in range(ROUNDS_PER_WRITE, max_iter + ROUNDS_PER_WRITE, ROUNDS_PER_WRITE):
        for _ in range(min(ROUNDS_PER_WRITE, max_iter - done + ROUNDS_PER_WRITE)):
            state = _messages(state)
        state = settle(state)
        marks = state.where((F.col("i") == F.col("k")) & (F.col("r") + F.col("a") > 0)).groupBy("d").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("k").cast("decimal(38,0)")).alias("h")
        )
        now = {r["d"]: (r["n"], r["h"]) for r in marks.collect()}  # one row for each damping
        for d in list(stable):
            stable[d] = stable[d] + ROUNDS_PER_WRITE if d in now and now[d] == last.get(d) else 0
            if stable[d] >= patience or done >= max_iter:
                marked = state.where((F.col("d") == d) & (F.col("i") == F.col("k")) & (F.col("r") + F.col("a") > 0))
                ended.append(_exemplars(rows, marked.select("i", F.lit(True).alias("ok")), d, stable[d] >= patience))
                del stable[d]
        last = now
        if not stable:
            break
        state = state.where(F.col("d").isin(list(stable)))
    return reduce(DataFrame.unionByName, ended).withColumnRenamed("i", key)


def _messages(state: DataFrame) -> DataFrame:
    """One round: what every row asks of its candidates, then what they offer."""
    row = Window.partitionBy("d", "i")
    zero, old = F.lit(0.0), F.col("d")
    new = 1.0 - old
    ranked = state.withColumn("m", F.col("a") + F.col("s")).withColumn("rank", F.row_number().over(row.orderBy(F.desc("m"), F.asc("k"))))
    tops = ranked.select(
        "*",
        F.max(F.when(F.col("rank") == 1, F.col("m"))).over(row).alias("m1"),
        F.max(F.when(F.col("rank") == 2, F.col("m"))).over(row).alias("m2"),
    )
    rival = F.when(F.col("rank") == 1, F.coalesce("m2", zero)).otherwise(F.col("m1"))
    asked = tops.select("d", "i", "k", "s", "a", (old * F.col("r") + new * (F.col("s") - rival)).alias("r"))
    candidate = Window.partitionBy("d", "k")
    own = F.col("i") == F.col("k")
    support = F.sum(F.when(~own, F.greatest("r", zero)).otherwise(zero)).over(candidate)
    itself = F.max(F.when(own, F.col("r"))).over(candidate)
    offered = asked.select("*", support.alias("p"), itself.alias("rkk"))
    offer = F.when(own, F.col("p")).otherwise(F.least(zero, F.col("rkk") + F.col("p") - F.greatest("r", zero)))
    return offered.select("d", "i", "k", "s", "r", (old * F.col("a") + new * offer).alias("a"))


def _exemplars(rows: DataFrame, chosen: DataFrame, damping: float, converged: bool) -> DataFrame:
    marked = rows.join(chosen, "i", "left").withColumn("ok", F.coalesce("ok", F.lit(False)))
    closest = nearest(marked, "i", "v", 1, among="ok", include_self=True).select("i", F.col("neighbour").alias("exemplar"))
    return rows.select("i").join(closest, "i", "left").select(
        F.lit(damping).alias("damping"), "i", "exemplar", F.lit(converged).alias("converged")
    )


def sweep_damping(
    df: DataFrame, key: str, vector: str, dampings: Sequence[float], neighbours: int | None = None,
    preference: float | None = None, max_iter: int = 200,
) -> DataFrame:
    """Exemplars found, mean silhouette, and whether it settled, for each damping."""
    found = settle(affinity_sweep(df, key, vector, dampings, neighbours, preference, max_iter))
    names = {float(d): f"exemplar_{i}" for i, d in enumerate(dampings)}
    wide = found.groupBy(key).agg(*[F.max(F.when(F.col("damping") == d, F.col("exemplar"))).alias(n) for d, n in names.items()])
    scored = mean_silhouettes(wide.join(df.select(key, vector), key), key, vector, list(names.values()))
    label = F.element_at(F.create_map(*[F.lit(x) for d, n in names.items() for x in (n, d)]), F.col("labeling"))
    state = found.groupBy("damping").agg(F.bool_and("converged").alias("converged"))
    return scored.select(label.alias("damping"), "clusters", "silhouette").join(state, "damping")
