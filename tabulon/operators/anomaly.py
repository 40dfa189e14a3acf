"""Outlier detection: thresholds, isolation forest, cluster distance, reconstruction error."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expressions import squared_distance, vector_literal, vectors_literal
from tabulon.operators.clustering import assign
from tabulon.operators.features import as_vector, principal_model
from tabulon.operators.ordered import exact_quantiles, one_row
from tabulon.session import settle, spread, spread_groups

EULER = 0.5772156649015329


# ------------------------------------------------------------------ sigma rules


def sigma_limits(df: DataFrame, column: str, width: float = 3.0) -> DataFrame:
    """One row: mean ± width sample deviations."""
    mean, spread = F.avg(column), F.stddev_samp(column) * width
    return df.agg((mean - spread).alias("low"), (mean + spread).alias("high"))


def outside_limits(df: DataFrame, column: str, width: float = 3.0, two_sided: bool = False) -> Column:
    """True for rows above the upper limit, or outside both. The limits are one scalar subquery."""
    limits = one_row(sigma_limits(df, column, width))
    above = F.col(column) > limits["high"]
    return above | (F.col(column) < limits["low"]) if two_sided else above


def sigma_outliers(df: DataFrame, column: str, width: float = 3.0, two_sided: bool = False) -> DataFrame:
    return df.where(outside_limits(df, column, width, two_sided))


def sigma_flags(df: DataFrame, key: str, column: str, width: float = 3.0) -> DataFrame:
    return df.select(key, F.coalesce(outside_limits(df, column, width, True), F.lit(False)).alias("outlier"))


def top_rows(df: DataFrame, column: str, key: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(column), F.asc(key)).limit(n)


def bottom_rows(df: DataFrame, column: str, key: str, n: int) -> DataFrame:
    """The n smallest, shown largest first. Nulls are not smaller than anything: they come last."""
    return df.orderBy(F.asc_nulls_last(column), F.desc(key)).limit(n).orderBy(F.desc(column), F.asc(key))


def above_share(scored: DataFrame, score: str, contamination: float = 0.01) -> DataFrame:
    """Flag rows whose score lies above the (1 − contamination) quantile; ``margin`` is negative outside.

    ``scored`` is read twice.
    """
    cut = exact_quantiles(scored, score, [1.0 - contamination], names=["cut"])
    return scored.withColumn("margin", cut.scalar() - F.col(score)).withColumn("outlier", F.col("margin") < 0)


# ------------------------------------------------------------------ isolation forest


def _average_path(n):
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    value = 2.0 * (np.log(big - 1.0) + EULER) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, value, np.where(n == 2, 1.0, 0.0))


NODE_SCHEMA = "tree int, node int, feature int, cut double, depth int, size int"


def _grow(tree: int, x: np.ndarray, seed: int) -> pd.DataFrame:
    """One tree over its sample: random feature, random cut, depth up to log2 of the sample."""
    rng = np.random.default_rng([seed, tree])
    limit = max(1, math.ceil(math.log2(max(len(x), 2))))
    nodes, open_nodes = [], [(0, 0, np.arange(len(x)))]
    while open_nodes:
        node, depth, rows = open_nodes.pop()
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(usable):
            nodes.append((tree, node, -1, 0.0, depth, len(rows)))
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = part[:, feature] < cut
        nodes.append((tree, node, feature, cut, depth, len(rows)))
        if goes_left.all() or not goes_left.any():
            nodes[-1] = (tree, node, -1, 0.0, depth, len(rows))
            continue
        open_nodes.append((2 * node + 2, depth + 1, rows[~goes_left]))
        open_nodes.append((2 * node + 1, depth + 1, rows[goes_left]))
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "depth", "size"])


def isolation_forest(
    df: DataFrame, key: str, columns: Sequence[str], trees: int = 100, sample: int = 256, seed: int = 42
) -> DataFrame:
    """Node table of a forest grown on hashed samples: at most ``trees`` × (2·``sample``) rows.

    Each row decides by hash, without a shuffle, which trees it may join; only
    those few rows are shuffled, and each tree takes its ``sample`` lowest hashes.
    """
    n = df.count()
    share = min(n, sample + 8 * math.ceil(math.sqrt(sample)))
    draw = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.pmod(F.xxhash64(F.col(key), t, F.lit(seed)), F.lit(max(n, 1))) < share,
    )
    drawn = df.select(
        F.explode(draw).alias("tree"), F.col(key).alias("_key"), F.array(*[F.col(c).cast("double") for c in columns]).alias("x")
    )

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        picked = pdf.sort_values(["h", "_key"]).head(sample)
        return _grow(tree, np.stack(picked["x"].map(np.asarray)), seed)

    hashed = drawn.withColumn("h", F.xxhash64("_key", "tree", F.lit(seed + 1)))
    return spread_groups(hashed, "tree", trees).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


class ForestScorer:
    """Scores rows by a node table. The table is small by construction and travels with the tasks."""

    def __init__(self, nodes: DataFrame, columns: Sequence[str]):
        rows = nodes.toPandas()
        self.columns = list(columns)
        trees = sorted(rows["tree"].unique())
        forest = []
        for tree in trees:
            part = rows[rows["tree"] == tree].sort_values("node")
            width = int(part["node"].max()) + 1
            feature = np.full(width, -1, dtype=np.int64)
            cut, path = np.zeros(width), np.zeros(width)
            where = part["node"].to_numpy()
            feature[where] = part["feature"]
            cut[where] = part["cut"]
            path[where] = part["depth"].to_numpy() + _average_path(part["size"].to_numpy())
            forest.append((feature, cut, path))
        samples = rows.loc[rows["node"] == 0, "size"]
        normal = float(_average_path(np.array([samples.mean() if len(samples) else 1.0]))[0]) or 1.0
        self.handle = nodes.sparkSession.sparkContext.broadcast((forest, normal))

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        """Add 2^(−mean path / normal path): near 1 is easy to isolate."""
        handle = self.handle

        @F.pandas_udf(T.DoubleType())
        def anomaly(x: pd.Series) -> pd.Series:
            forest, normal = handle.value
            values = np.stack(x.map(np.asarray)) if len(x) else np.zeros((0, 1))
            total = np.zeros(len(values))
            rows = np.arange(len(values))
            for feature, cut, path in forest:
                at = np.zeros(len(values), dtype=np.int64)
                while True:
                    f = feature[at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    right = values[rows, np.maximum(f, 0)] >= cut[at]
                    at = np.where(inner, 2 * at + 1 + right, at)
                total += path[at]
            return pd.Series(np.exp2(-total / max(len(forest), 1) / normal))

        return spread(df).withColumn(name, anomaly(F.array(*[F.col(c).cast("double") for c in self.columns])))


def isolation_outliers(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    contamination: float = 0.01,
    trees: int = 100,
    sample: int = 256,
    seed: int = 42,
) -> DataFrame:
    """Rows with their isolation score and whether they are in the most isolated share."""
    forest = settle(isolation_forest(df, key, columns, trees, sample, seed))
    scored = settle(ForestScorer(forest, columns).score(df))
    return above_share(scored, "score", contamination)


# ------------------------------------------------------------------ cluster distance


def large_clusters(sizes: Sequence[int], alpha: float = 0.9, beta: float = 5.0) -> list[bool]:
    """Which clusters are large: the biggest ones up to a share alpha, or up to a drop by factor beta."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    total, running, large = sum(sizes), 0, [False] * len(sizes)
    for place, i in enumerate(order):
        running += sizes[i]
        large[i] = True
        after = sizes[order[place + 1]] if place + 1 < len(order) else 0
        if running >= alpha * total or (after and sizes[i] >= beta * after):
            break
    return large


class ClusterScorer:
    """Centres, and which of their clusters were large among the rows it was fitted on."""

    def __init__(self, centres: Sequence[Sequence[float]], large: Sequence[bool]):
        self.centres, self.large = centres, large

    def score(self, df: DataFrame, vector: str) -> DataFrame:
        """Distance to the own centre for rows of large clusters, else to the nearest large centre."""
        placed = assign(df, vector, self.centres)
        wide = vectors_literal([c for c, big in zip(self.centres, self.large) if big])
        to_large = F.array_min(F.transform(wide, lambda c: squared_distance(F.col(vector), c)))
        own_is_large = F.col("cluster").isin([i for i, big in enumerate(self.large) if big])
        distance = F.sqrt(F.when(own_is_large, F.col("sq_distance")).otherwise(to_large))
        return placed.withColumn("score", distance).drop("sq_distance")


def fit_clusters(
    df: DataFrame, vector: str, centres: Sequence[Sequence[float]], alpha: float = 0.9, beta: float = 5.0
) -> ClusterScorer:
    """Decide from these rows which clusters are large; any rows can be scored against that."""
    sizes = assign(df, vector, centres).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["cluster"]: r["n"] for r in sizes.collect()}
    return ClusterScorer(centres, large_clusters([counts.get(i, 0) for i in range(len(centres))], alpha, beta))


def cluster_outlier_scores(
    df: DataFrame, vector: str, centres: Sequence[Sequence[float]], alpha: float = 0.9, beta: float = 5.0
) -> DataFrame:
    """Rows scored against the clusters that are large among themselves."""
    return fit_clusters(df, vector, centres, alpha, beta).score(df, vector)


# ------------------------------------------------------------------ reconstruction error


def reconstruction_scores(
    df: DataFrame, vector: str, mean: Sequence[float], components: Sequence[Sequence[float]]
) -> DataFrame:
    """Distance of each row from its projection on the given unit directions."""
    off = F.transform(
        F.arrays_zip(F.col(vector).alias("x"), vector_literal(mean).alias("m")), lambda s: s["x"] - s["m"]
    )
    centred = df.withColumn("_off", off)

    def along(u) -> Column:
        return F.aggregate(F.zip_with("_off", vector_literal(u), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)

    power = F.aggregate(F.transform("_off", lambda x: x * x), F.lit(0.0), lambda s, x: s + x)
    kept = sum((along(u) * along(u) for u in components), F.lit(0.0))
    return centred.withColumn("score", F.sqrt(F.greatest(power - kept, F.lit(0.0)))).drop("_off")


def reconstruction_outliers(df: DataFrame, vector: str, k: int, contamination: float = 0.01) -> DataFrame:
    """Rows with the error left by the first k principal directions, and whether it is in the top share."""
    mean, components = principal_model(as_vector(df, vector), "features", k)
    scored = settle(reconstruction_scores(df, vector, mean, components))
    return above_share(scored, "score", contamination)


# ------------------------------------------------------------------ grids and comparison


def unit_grid(spark, names: tuple[str, str], steps: int = 100) -> DataFrame:
    """A square grid over [0, 1]², one row per point."""
    at = F.col("id")
    scale = F.lit(float(steps - 1))
    return spark.range(steps * steps).select(
        ((at % steps) / scale).alias(names[0]), (F.floor(at / steps) / scale).alias(names[1])
    )


def value_line(df: DataFrame, column: str) -> DataFrame:
    """As many evenly spaced values between the smallest and largest as there are rows."""
    row = df.agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count(column).alias("n")).first()
    step = (row["high"] - row["low"]) / max(row["n"] - 1, 1)
    return df.sparkSession.range(row["n"]).select((F.lit(row["low"]) + F.col("id") * step).alias(column))


def compare_detectors(flags: dict[str, DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """All flags side by side by row, and how often each pair of detectors agrees on an outlier.

    The flags are stacked and grouped once by row; nothing is joined.
    """
    names = list(flags)
    long = reduce(DataFrame.unionByName, [df.select(key, F.lit(n).alias("detector"), "outlier") for n, df in flags.items()])
    flagged = [F.coalesce(F.bool_or(F.when(F.col("detector") == n, F.col("outlier"))), F.lit(False)).alias(n) for n in names]
    wide = long.groupBy(key).agg(*flagged)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    counted = wide.agg(*[F.count_if(F.col(a) & F.col(b)).alias(f"{a}__{b}") for a, b in pairs])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("both")) for a, b in pairs]
    agreement = counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return wide, agreement


# ------------------------------------------------------------------ extreme studentised deviate


def _t_quantile(p: float, df: float) -> float:
    """Quantile of Student's t, by bisection on its distribution function."""
    def upper(t: float) -> float:
        x = df / (df + t * t)
        return 0.5 * _incomplete_beta(df / 2.0, 0.5, x)

    low, high = 0.0, 1e3
    for _ in range(200):
        mid = (low + high) / 2.0
        if upper(mid) > 1.0 - p:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


def _incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _incomplete_beta(b, a, 1.0 - x)
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return front * h / a


def extreme_deviates(df: DataFrame, key: str, column: str, most: int = 10, alpha: float = 0.05) -> DataFrame:
    """Generalised ESD test for up to ``most`` outliers, one row per step.

    A removed value is always the smallest or largest left, so ``most`` rows
    from each end and the overall sums are all the test needs. Rows without a value take no part.
    """
    df = df.where(F.col(column).isNotNull())
    total = df.agg(F.count(column).alias("n"), F.avg(column).alias("m"), F.var_pop(column).alias("v")).first()
    ends = (
        df.orderBy(F.desc(column), F.asc(key)).limit(most).select(key, column)
        .unionByName(df.orderBy(F.asc(column), F.asc(key)).limit(most).select(key, column))
        .distinct()
        .toPandas()
    )
    n, mean = int(total["n"]), float(total["m"])
    left = ends.assign(x=ends[column].astype(float) - mean).sort_values(["x", key])
    s1, s2, rows = 0.0, float(total["v"]) * n, []
    for step in range(1, min(most, n - 2) + 1):
        size = n - step + 1
        centre = s1 / size
        spread = math.sqrt(max(s2 - size * centre * centre, 0.0) / (size - 1))
        gap = (left["x"] - centre).abs()
        at = gap.idxmax()
        statistic = float(gap[at] / spread) if spread else 0.0
        p = 1.0 - alpha / (2.0 * size)
        t = _t_quantile(p, size - 2)
        critical = (size - 1) * t / math.sqrt((size - 2 + t * t) * size)
        rows.append((step, int(left.at[at, key]), float(left.at[at, column]), statistic, critical))
        x = float(left.at[at, "x"])
        s1, s2 = s1 - x, s2 - x * x
        left = left.drop(index=at)
    count = max([r[0] for r in rows if r[3] > r[4]], default=0)
    return df.sparkSession.createDataFrame(
        [(*r, r[0] <= count) for r in rows],
        "step int, id bigint, value double, statistic double, critical double, outlier boolean",
    )
