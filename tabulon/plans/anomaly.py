"""Outliers of the store table: sales, profit, and discount with profit."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expressions import tidy
from tabulon.operators import anomaly as Q
from tabulon.operators import clustering as C
from tabulon.operators import features as K
from tabulon.operators.ordered import exact_quantiles
from tabulon.plans import standins as S
from tabulon.plans.features import scaled_pair
from tabulon.plans.registry import query, r4
from tabulon.session import settle

_T = S.with_sql(S.STORE_SQL)
_UP = "sales > (SELECT avg(sales) + 3 * stddev_samp(sales) FROM store)"
_BOTH = """(profit > (SELECT avg(profit) + 3 * stddev_samp(profit) FROM store)
  OR profit < (SELECT avg(profit) - 3 * stddev_samp(profit) FROM store))"""


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settled, for detectors that read it in many rounds."""
    return settle(S.store(spark, sf_dir))


def pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(scaled_pair(spark, sf_dir).withColumn("v", F.array("discount", "profit")))


@query("q01_high_sales", _T + f"SELECT id, category, sales FROM store WHERE {_UP}")
def high_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.sigma_outliers(S.sales(spark, sf_dir), "sales").select("id", "category", "sales")


@query("q02_two_sided_profit", _T + f"SELECT id, category, profit FROM store WHERE {_BOTH}")
def two_sided_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.sigma_outliers(S.store(spark, sf_dir), "profit", two_sided=True).select("id", "category", "profit")


@query("c06_scalar_threshold", _T + f"SELECT count(*) AS n, {r4('min(sales)')} AS smallest FROM store WHERE {_UP}")
def scalar_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Q.sigma_outliers(S.sales(spark, sf_dir), "sales")
    return found.agg(F.count(F.lit(1)).alias("n"), tidy(F.min("sales")).alias("smallest"))


@query("b03_either_side", _T + f"SELECT id, profit FROM store WHERE NOT {_BOTH}")
def either_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.store(spark, sf_dir)
    return rows.where(~Q.outside_limits(rows, "profit", two_sided=True)).select("id", "profit")


@query("f05_top_outliers", _T + f"SELECT id, sales, profit, discount FROM store WHERE {_UP} ORDER BY sales DESC, id LIMIT 10")
def top_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Q.sigma_outliers(S.store(spark, sf_dir), "sales")
    return Q.top_rows(found, "sales", "id", 10).select("id", "sales", "profit", "discount")


@query("c05_bottom_outliers", _T + f"""
SELECT * FROM (SELECT id, category, sales, profit, discount FROM store WHERE {_UP} ORDER BY sales, id DESC LIMIT 10)
ORDER BY sales DESC, id""")
def bottom_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full rows ride along with the filter, so nothing is looked up again."""
    found = Q.sigma_outliers(S.store(spark, sf_dir), "sales")
    return Q.bottom_rows(found, "sales", "id", 10).select("id", "category", "sales", "profit", "discount")


@query("q03_isolated_sales")
def isolated_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Q.isolation_outliers(settle(S.sales(spark, sf_dir)), "id", ["sales"])
    return found.where("outlier").select("id", "category", "sales", "score").orderBy(F.desc("sales"), "id")


@query("q03_isolated_profit")
def isolated_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Q.isolation_outliers(store(spark, sf_dir), "id", ["profit"])
    return found.where("outlier").select("id", "category", "profit", "score").orderBy(F.desc("profit"), "id")


@query("q04_isolated_pairs")
def isolated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Q.isolation_outliers(pair(spark, sf_dir), "id", ["discount", "profit"])
    return found.where("outlier").select("id", "discount", "profit", "score").orderBy(F.desc("profit"), F.desc("discount"))


_CBLOF = """l AS (SELECT min(discount) AS d0, max(discount) - min(discount) AS dw, min(profit) AS p0,
  max(profit) - min(profit) AS pw FROM store),
s AS (SELECT id, category, (discount - d0) / dw AS x, (profit - p0) / pw AS y FROM store, l),
c AS (SELECT CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS i, cx, cy FROM
  (SELECT category, round(avg(x), 2) + 0.17::DOUBLE * (row_number() OVER (ORDER BY category) - 3) AS cx,
     round(avg(y), 2) AS cy FROM s GROUP BY 1)),
d AS (SELECT id, x, y, i, (x - cx) * (x - cx) + (y - cy) * (y - cy) AS sq FROM s CROSS JOIN c),
a AS (SELECT id, arg_min(i, (sq, i)) AS cluster, min(sq) AS own FROM d GROUP BY 1),
z AS (SELECT c.i, count(a.id) AS n FROM c LEFT JOIN a ON c.i = a.cluster GROUP BY 1),
r AS (SELECT i, n, row_number() OVER (ORDER BY n DESC, i) AS k, sum(n) OVER (ORDER BY n DESC, i) AS run,
  lead(n) OVER (ORDER BY n DESC, i) AS after FROM z),
big AS (SELECT i FROM r WHERE k <= (SELECT min(k) FROM r WHERE run >= 0.9::DOUBLE * (SELECT sum(n) FROM z)
  OR n >= 5 * after)),
f AS (SELECT d.id, a.cluster, sqrt(CASE WHEN a.cluster IN (SELECT i FROM big) THEN a.own ELSE
  min(CASE WHEN d.i IN (SELECT i FROM big) THEN d.sq END) END) AS score
  FROM d JOIN a ON d.id = a.id GROUP BY d.id, a.cluster, a.own)"""


@query("q05_cluster_distance_given_centres", S.with_sql(S.STORE_SQL, _CBLOF) + f"""
SELECT id, cluster, {r4('score')} AS score FROM f""")
def cluster_distance_given_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pair(spark, sf_dir)
    scored = Q.cluster_outlier_scores(rows, "v", _given_centres(rows))
    return scored.select("id", "cluster", tidy(F.col("score")).alias("score"))


def _given_centres(rows: DataFrame) -> list[list[float]]:
    means = rows.groupBy("category").agg(F.round(F.avg("discount"), 2).alias("x"), F.round(F.avg("profit"), 2).alias("y"))
    return [[r["x"] + 0.17 * (i - 2), r["y"]] for i, r in enumerate(means.orderBy("category").collect())]


def _cluster_flags(rows: DataFrame) -> DataFrame:
    model = C.kmeans_model(rows.withColumn("features", array_to_vector("v")), 8, seed=42)
    return Q.above_share(settle(Q.cluster_outlier_scores(rows, "v", C.centroids(model))), "score")


@query("q05_cluster_outliers")
def cluster_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _cluster_flags(pair(spark, sf_dir))
    return found.where("outlier").select("id", "discount", "profit", "score").orderBy(F.desc("profit"), F.desc("discount"))


@query("q06_scored_rows")
def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with its isolation score and flag."""
    found = Q.isolation_outliers(store(spark, sf_dir), "id", ["sales", "profit"])
    return found.select("id", "score", "margin", "outlier")


@query("q06_scored_line")
def scored_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores along the range of sales, and where they lie outside."""
    rows = settle(S.sales(spark, sf_dir))
    scorer = Q.ForestScorer(Q.isolation_forest(rows, "id", ["sales"]), ["sales"])
    cut = exact_quantiles(settle(scorer.score(rows)), "score", [0.99], names=["cut"])
    line = scorer.score(Q.value_line(rows, "sales"))
    return line.withColumn("outside", F.col("score") > cut.scalar())


_NODES = [
    (0, 0, 0, 250.0, 0, 256), (0, 1, 1, 100.0, 1, 150), (0, 2, -1, 0.0, 1, 106), (0, 3, -1, 0.0, 2, 149), (0, 4, -1, 0.0, 2, 1),
    (1, 0, 1, -50.0, 0, 256), (1, 1, -1, 0.0, 1, 2), (1, 2, 0, 900.0, 1, 254), (1, 5, -1, 0.0, 2, 200), (1, 6, -1, 0.0, 2, 54),
]
_PATHS = """f AS (SELECT n, 2 * (ln(n - 1) + 0.5772156649015329::DOUBLE) - 2.0::DOUBLE * (n - 1) / n AS c
  FROM (VALUES (256), (149), (106), (200), (54)) t(n)),
p AS (SELECT id, (CASE WHEN sales >= 250 THEN 1 + (SELECT c FROM f WHERE n = 106) WHEN profit < 100 THEN 2 + (SELECT c FROM f WHERE n = 149) ELSE 2 END
  + CASE WHEN profit < -50 THEN 1 + 1 WHEN sales < 900 THEN 2 + (SELECT c FROM f WHERE n = 200) ELSE 2 + (SELECT c FROM f WHERE n = 54) END) / 2 AS path
  FROM store),
scored AS (SELECT id, pow(2, -path / (SELECT c FROM f WHERE n = 256)) AS score FROM p)"""


@query("q06_given_forest", S.with_sql(S.STORE_SQL, _PATHS) + f"SELECT id, {r4('score')} AS score FROM scored")
def given_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path lengths and scores of every row under a given table of nodes."""
    nodes = spark.createDataFrame(_NODES, Q.NODE_SCHEMA)
    rows = S.store(spark, sf_dir).select("id", "sales", "profit")
    return Q.ForestScorer(nodes, ["sales", "profit"]).score(rows).select("id", tidy(F.col("score")).alias("score"))


@query("q03_given_forest_outliers", S.with_sql(S.STORE_SQL, """scored AS (SELECT id, pow(2, -CASE WHEN sales < 250 THEN 2.0::DOUBLE WHEN sales < 900 THEN 2.5::DOUBLE
  ELSE 2.0::DOUBLE END / (2 * (ln(255) + 0.5772156649015329::DOUBLE) - 2.0::DOUBLE * 255 / 256)) AS score FROM store)""") + f"""
SELECT id, {r4('score')} AS score FROM scored WHERE round(score, 9) > (SELECT quantile_cont(round(score, 9), 0.5) FROM scored)""")
def given_forest_outliers_of_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose sales a given table of nodes isolates soonest: above the median score."""
    nodes = [(0, 0, 0, 250.0, 0, 256), (0, 1, -1, 0.0, 1, 1), (0, 2, 0, 900.0, 1, 3), (0, 5, -1, 0.0, 2, 1), (0, 6, -1, 0.0, 2, 1),
             (1, 0, 0, 250.0, 0, 256), (1, 1, 0, -1e9, 1, 255), (1, 3, -1, 0.0, 2, 1), (1, 4, -1, 0.0, 3, 1), (1, 2, 0, 900.0, 1, 1),
             (1, 5, -1, 0.0, 3, 1), (1, 6, -1, 0.0, 2, 1)]
    rows = S.store(spark, sf_dir).select("id", "sales")
    scored = Q.ForestScorer(spark.createDataFrame(nodes, Q.NODE_SCHEMA), ["sales"]).score(rows)
    scored = settle(scored.select("id", F.round("score", 9).alias("score")))
    return Q.above_share(scored, "score", 0.5).where("outlier").select("id", tidy(F.col("score")).alias("score"))


@query("q04_given_forest_outliers", S.with_sql(S.STORE_SQL, _PATHS) + f"""
SELECT id, {r4('score')} AS score FROM scored WHERE round(score, 9) > (SELECT quantile_cont(round(score, 9), 0.9) FROM scored)""")
def given_forest_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tenth of the rows that a given table of nodes isolates soonest; only keys and scores are written."""
    nodes = spark.createDataFrame(_NODES, Q.NODE_SCHEMA)
    rows = S.store(spark, sf_dir).select("id", "sales", "profit")
    scored = Q.ForestScorer(nodes, ["sales", "profit"]).score(rows).select("id", F.round("score", 9).alias("score"))
    return Q.above_share(settle(scored), "score", 0.1).where("outlier").select("id", tidy(F.col("score")).alias("score"))


_PC1 = """l AS (SELECT min(discount) AS d0, max(discount) - min(discount) AS dw, min(profit) AS p0,
  max(profit) - min(profit) AS pw FROM store),
s AS (SELECT id, (discount - d0) / dw AS x, (profit - p0) / pw AS y FROM store, l),
c AS (SELECT avg(x) AS mx, avg(y) AS my, atan2(2 * covar_samp(x, y), var_samp(x) - var_samp(y)) / 2 AS t FROM s),
e AS (SELECT id, abs((y - my) * cos(t) - (x - mx) * sin(t)) AS score FROM s, c)"""


@query("q07_reconstruction_scores", S.with_sql(S.STORE_SQL, _PC1) + f"SELECT id, {r4('score')} AS score FROM e")
def reconstruction_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Q.reconstruction_outliers(pair(spark, sf_dir), "v", 1)
    return found.select("id", tidy(F.col("score")).alias("score"))


@query("q07_reconstruction_outliers", S.with_sql(S.STORE_SQL, _PC1) + """
SELECT id FROM e WHERE score > (SELECT quantile_cont(score, 0.99) FROM e)""")
def reconstruction_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.reconstruction_outliers(pair(spark, sf_dir), "v", 1).where("outlier").select("id")


@query("q08_scored_grid")
def scored_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three detectors and their cuts from the data; a 100×100 grid over its range is scored against them."""
    rows = pair(spark, sf_dir)
    columns = ["discount", "profit"]
    grid = Q.unit_grid(spark, ("discount", "profit")).withColumn("v", F.array(*columns))
    forest = Q.ForestScorer(Q.isolation_forest(rows, "id", columns), columns)
    clusters = Q.fit_clusters(rows, "v", C.centroids(C.kmeans_model(rows.withColumn("features", array_to_vector("v")), 8, seed=42)))
    mean, directions = K.principal_model(rows.withColumn("features", array_to_vector("v")), "features", 1)
    scorers = {
        "isolation": forest.score,
        "clusters": lambda df: clusters.score(df, "v"),
        "reconstruction": lambda df: Q.reconstruction_scores(df, "v", mean, directions),
    }
    parts = []
    for name, score in scorers.items():
        cut = exact_quantiles(settle(score(rows).select("score")), "score", [0.99], names=["cut"])
        scored = score(grid).select(F.lit(name).alias("detector"), *columns, "score")
        parts.append(scored.withColumn("outside", F.col("score") > cut.scalar()))
    return reduce(DataFrame.unionByName, parts)


_GRID = """g AS (SELECT (k % 100) / 99.0::DOUBLE AS gx, (k // 100) / 99.0::DOUBLE AS gy FROM range(10000) t(k))"""


@query("q05_grid_given_centres", S.with_sql(S.STORE_SQL, _CBLOF, _GRID, """gd AS (SELECT gx, gy, i,
  (gx - cx) * (gx - cx) + (gy - cy) * (gy - cy) AS sq FROM g CROSS JOIN c)""") + f"""
SELECT discount, profit, cluster, {r4('score')} AS score FROM (SELECT round(gx, 6) AS discount, round(gy, 6) AS profit,
  arg_min(i, (sq, i)) AS cluster, sqrt(CASE WHEN arg_min(i, (sq, i)) IN (SELECT i FROM big) THEN min(sq)
  ELSE min(CASE WHEN i IN (SELECT i FROM big) THEN sq END) END) AS score FROM gd GROUP BY gx, gy)""")
def grid_given_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid scored against clusters that were judged large among the rows, not among the grid."""
    rows = pair(spark, sf_dir)
    grid = Q.unit_grid(spark, ("discount", "profit")).withColumn("v", F.array("discount", "profit"))
    scored = Q.fit_clusters(rows, "v", _given_centres(rows)).score(grid, "v")
    return scored.select(
        F.round("discount", 6).alias("discount"), F.round("profit", 6).alias("profit"), "cluster", tidy(F.col("score")).alias("score")
    )


@query("q07_grid_scores", S.with_sql(S.STORE_SQL, _PC1, _GRID) + f"""
SELECT round(gx, 6) AS discount, round(gy, 6) AS profit, {r4('abs((gy - my) * cos(t) - (gx - mx) * sin(t))')} AS score FROM g, c""")
def grid_reconstruction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pair(spark, sf_dir)
    mean, directions = K.principal_model(rows.withColumn("features", array_to_vector("v")), "features", 1)
    grid = Q.unit_grid(spark, ("discount", "profit")).withColumn("v", F.array("discount", "profit"))
    scored = Q.reconstruction_scores(grid, "v", mean, directions)
    return scored.select(F.round("discount", 6).alias("discount"), F.round("profit", 6).alias("profit"), tidy(F.col("score")).alias("score"))


_FLAGS = """f AS (SELECT id, coalesce(sales > (SELECT avg(sales) + 3 * stddev_samp(sales) FROM store)
    OR sales < (SELECT avg(sales) - 3 * stddev_samp(sales) FROM store), false) AS a,
  coalesce(profit > (SELECT avg(profit) + 3 * stddev_samp(profit) FROM store)
    OR profit < (SELECT avg(profit) - 3 * stddev_samp(profit) FROM store), false) AS b FROM store)"""


@query("q09_agreement_of_rules", S.with_sql(S.STORE_SQL, _FLAGS) + """
SELECT 'sales' AS a, 'sales' AS b, count(*) FILTER (WHERE a) AS both FROM f
UNION ALL SELECT 'sales', 'profit', count(*) FILTER (WHERE a AND b) FROM f
UNION ALL SELECT 'profit', 'profit', count(*) FILTER (WHERE b) FROM f""")
def agreement_of_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store(spark, sf_dir)
    return Q.compare_detectors({c: Q.sigma_flags(rows, "id", c) for c in ("sales", "profit")}, "id")[1]


@query("q09_compared_detectors")
def compared_detectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pair(spark, sf_dir)
    flags = {
        "clusters": _cluster_flags(rows),
        "isolation": Q.isolation_outliers(rows, "id", ["discount", "profit"]),
        "reconstruction": Q.reconstruction_outliers(rows, "v", 1),
    }
    return Q.compare_detectors(flags, "id")[1]


@query("q10_extreme_deviates")
def extreme_deviates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.extreme_deviates(S.sales(spark, sf_dir), "id", "sales", most=10)
