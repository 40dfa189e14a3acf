"""Auto-correlation, unit roots, autoregression and forecast accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expressions import tidy
from tabulon.operators import forecast as A, models, series as O
from tabulon.operators.ordered import RUN_ROWS
from tabulon.plans import standins as S
from tabulon.plans.registry import query, r4
from tabulon.plans.series import GAPS_SQL, KEYS, ORDER, SHORT_RUN, daily, gaps, hourly
from tabulon.session import settle

LAGS = 20
_LAGGED = ", ".join(f"lag(d, {k}) OVER (PARTITION BY series_id ORDER BY t) AS l{k}" for k in range(1, LAGS + 1))
_ACF = " UNION ALL ".join(
    [f"SELECT series_id, 0 AS lag, 1.0::DOUBLE AS acf FROM c GROUP BY 1"]
    + [f"SELECT series_id, {k}, {r4(f'sum(d * l{k}) / sum(d * d)')} FROM c GROUP BY 1" for k in range(1, LAGS + 1)]
)
_CENTRED = """m AS (SELECT series_id, t, y - avg(y) OVER (PARTITION BY series_id) AS d FROM hourly),
c AS (SELECT series_id, d, """ + _LAGGED + " FROM m)"


@query("r01_autocorrelation", S.with_sql(S.HOURLY_SQL, _CENTRED) + _ACF)
def autocorrelation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.autocorrelation(hourly(spark, sf_dir), KEYS, ORDER, "y", LAGS).withColumn("acf", tidy(F.col("acf")))


@query("r02_partial_autocorrelation_2", S.with_sql(S.HOURLY_SQL, _CENTRED) + f"""
, a AS (SELECT series_id, sum(d * l1) / sum(d * d) AS r1, sum(d * l2) / sum(d * d) AS r2 FROM c GROUP BY 1)
SELECT series_id, 0 AS lag, 1.0::DOUBLE AS pacf FROM a
UNION ALL SELECT series_id, 1, {r4('r1')} FROM a
UNION ALL SELECT series_id, 2, {r4('(r2 - r1 * r1) / (1 - r1 * r1)')} FROM a""")
def partial_autocorrelation_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.partial_autocorrelation(hourly(spark, sf_dir), KEYS, ORDER, "y", 2).withColumn("pacf", tidy(F.col("pacf")))


@query("r02_partial_autocorrelation")
def partial_autocorrelation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.partial_autocorrelation(daily(spark, sf_dir), KEYS, ORDER, "y", LAGS)


_DF0 = """p AS (SELECT series_id, lag(y) OVER (PARTITION BY series_id ORDER BY t) AS x, y FROM hourly),
g AS (SELECT series_id, count(*) AS n, regr_slope(y - x, x) AS b, regr_sxx(y - x, x) AS sxx,
  regr_syy(y - x, x) - regr_sxy(y - x, x) * regr_sxy(y - x, x) / regr_sxx(y - x, x) AS rss
  FROM p WHERE x IS NOT NULL GROUP BY 1)"""


@query("r03_unit_root_lag0", S.with_sql(S.HOURLY_SQL, _DF0) + f"""
SELECT series_id, {r4('b / sqrt(rss / (n - 2) / sxx)')} AS statistic, 0 AS lags, n AS n_obs FROM g""")
def unit_root_lag0(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = A.unit_root_test(hourly(spark, sf_dir), KEYS, ORDER, "y", maxlag=0)
    return found.select("series_id", tidy(F.col("statistic")).alias("statistic"), "lags", "n_obs")


@query("r03_unit_root_lag0_gaps", S.with_sql(S.HOURLY_SQL, GAPS_SQL, _DF0.replace("hourly", "gaps").replace("x IS NOT NULL", "x IS NOT NULL AND y IS NOT NULL")) + f"""
SELECT series_id, {r4('b / sqrt(rss / (n - 2) / sxx)')} AS statistic, 0 AS lags, n AS n_obs FROM g""")
def unit_root_lag0_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose value or lag is missing stay out."""
    found = A.unit_root_test(gaps(spark, sf_dir), KEYS, ORDER, "y", maxlag=0)
    return found.select("series_id", tidy(F.col("statistic")).alias("statistic"), "lags", "n_obs")


@query("r03_unit_root_test")
def unit_root_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series and its first difference, lags chosen by AIC."""
    both = both_series(daily(spark, sf_dir))
    return A.unit_root_test(both, KEYS, ORDER, "y")


def both_series(df: DataFrame) -> DataFrame:
    diffs = O.difference(df, KEYS, ORDER, "y")
    return settle(
        df.unionByName(
            diffs.select(F.concat("series_id", F.lit(" (differenced)")).alias("series_id"), "t", F.col("diff").alias("y"))
        )
    )


def differenced(spark: SparkSession, sf_dir: str, hours: bool = True) -> DataFrame:
    base = hourly(spark, sf_dir) if hours else daily(spark, sf_dir)
    return settle(O.difference(base, KEYS, ORDER, "y"))


_Z = """z AS (SELECT series_id, t, y, y - lag(y) OVER (PARTITION BY series_id ORDER BY t) AS z FROM hourly),
w AS (SELECT *, lag(z) OVER (PARTITION BY series_id ORDER BY t) AS z1,
  row_number() OVER (PARTITION BY series_id ORDER BY t) AS pos, count(*) OVER (PARTITION BY series_id) AS n
  FROM z WHERE z IS NOT NULL)"""


@query("r04_autoregression_1", S.with_sql(S.HOURLY_SQL, _Z) + f"""
SELECT series_id, 1 AS lag, {r4('sum(z * z1) / sum(z1 * z1)')} AS coefficient FROM w WHERE z1 IS NOT NULL GROUP BY 1""")
def autoregression_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = A.ar_fit(differenced(spark, sf_dir), KEYS, ORDER, "diff", 1)
    return fit.select("series_id", "lag", tidy(F.col("coefficient")).alias("coefficient"))


_ZG = """zg AS (SELECT series_id, t, y - lag(y) OVER (PARTITION BY series_id ORDER BY t) AS z,
  row_number() OVER (PARTITION BY series_id ORDER BY t) AS rn FROM gaps),
w AS (SELECT *, lag(z) OVER (PARTITION BY series_id ORDER BY t) AS z1,
  row_number() OVER (PARTITION BY series_id ORDER BY t) AS pos, count(*) OVER (PARTITION BY series_id) AS n FROM zg WHERE rn > 1)"""
_GAPPY = S.with_sql(S.HOURLY_SQL, GAPS_SQL, _ZG)


@query("r04_autoregression_1_gaps", _GAPPY + f"""
SELECT series_id, 1 AS lag, {r4('sum(z * z1) / sum(z1 * z1)')} AS coefficient FROM w WHERE z1 IS NOT NULL AND z IS NOT NULL GROUP BY 1""")
def autoregression_1_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = A.ar_fit(O.difference(gaps(spark, sf_dir), KEYS, ORDER, "y"), KEYS, ORDER, "diff", 1)
    return fit.select("series_id", "lag", tidy(F.col("coefficient")).alias("coefficient"))


_FORECAST_GAPS = """s AS (SELECT *, sum(z * z1) OVER e / sum(CASE WHEN z IS NOT NULL THEN z1 * z1 END) OVER e * z1 AS forecast FROM w
  WINDOW e AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT series_id, t, z AS actual, forecast FROM s WHERE pos > floor(n * 0.8::DOUBLE))"""
_WALK_GAPS = S.with_sql(S.HOURLY_SQL, GAPS_SQL, _ZG, _FORECAST_GAPS) + f"""
SELECT series_id, t, {r4('actual')} AS actual, {r4('forecast')} AS forecast FROM f"""


def _walked(df: DataFrame, run_rows: int) -> DataFrame:
    out = A.walk_forward(O.difference(df, KEYS, ORDER, "y"), KEYS, ORDER, "diff", 1, run_rows=run_rows)
    return out.select("series_id", "t", tidy(F.col("actual")).alias("actual"), tidy(F.col("forecast")).alias("forecast"))


@query("r05_walk_forward_1_gaps", _WALK_GAPS)
def walk_forward_1_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values stay out of the sums; a row without its lag has no forecast."""
    return _walked(gaps(spark, sf_dir), RUN_ROWS)


@query("r05_walk_forward_1_gaps_short_runs", _WALK_GAPS)
def walk_forward_1_gaps_short_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _walked(gaps(spark, sf_dir), SHORT_RUN)


@query("r04_autoregression_5")
def autoregression_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.ar_fit(differenced(spark, sf_dir, hours=False), KEYS, ORDER, "diff", 5)


_FORECAST1 = """s AS (SELECT *, sum(z * z1) OVER e / sum(z1 * z1) OVER e * z1 AS forecast FROM w
  WINDOW e AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT series_id, t, z AS actual, forecast, pos FROM s WHERE pos > floor(n * 0.8::DOUBLE))"""


@query("r05_walk_forward_1", S.with_sql(S.HOURLY_SQL, _Z, _FORECAST1) + f"""
SELECT series_id, t, {r4('actual')} AS actual, {r4('forecast')} AS forecast FROM f""")
def walk_forward_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.walk_forward(differenced(spark, sf_dir), KEYS, ORDER, "diff", 1)
    return out.select("series_id", "t", tidy(F.col("actual")).alias("actual"), tidy(F.col("forecast")).alias("forecast"))


@query("r05_walk_forward_5")
def walk_forward_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.walk_forward(differenced(spark, sf_dir, hours=False), KEYS, ORDER, "diff", 5)


def _restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast prices: the first test price plus the summed forecast changes."""
    base = hourly(spark, sf_dir)
    diffs = settle(O.difference(base, KEYS, ORDER, "y"))
    steps = settle(A.walk_forward(diffs, KEYS, ORDER, "diff", 1).drop("pos"))
    first = steps.groupBy("series_id").agg(F.min("t").alias("_from"))
    prices = diffs.join(first, "series_id").where(F.col("t") >= F.col("_from")).drop("_from")
    changes = steps.join(first, "series_id").where(F.col("t") > F.col("_from")).drop("_from")
    restored = O.undo_difference(prices, KEYS, "t", "y", changes, "forecast")
    return restored.join(prices.select("series_id", "t", "y"), ["series_id", "t"])


_RESTORED = """x AS (SELECT f.*, hourly.y, row_number() OVER (PARTITION BY f.series_id ORDER BY f.t) AS k,
  first_value(hourly.y) OVER (PARTITION BY f.series_id ORDER BY f.t) AS seed
  FROM f JOIN hourly ON f.series_id = hourly.series_id AND f.t = hourly.t),
v AS (SELECT series_id, t, y, seed + sum(forecast) OVER (PARTITION BY series_id ORDER BY t) AS restored
  FROM x WHERE k > 1)"""


@query("r06_restored_forecast", S.with_sql(S.HOURLY_SQL, _Z, _FORECAST1, _RESTORED) + f"""
SELECT series_id, t, y, {r4('restored')} AS restored FROM v""")
def restored_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _restored(spark, sf_dir).select("series_id", "t", "y", tidy(F.col("restored")).alias("restored"))


@query("r08_forecast_accuracy", S.with_sql(S.HOURLY_SQL, _Z, _FORECAST1, _RESTORED) + f"""
SELECT series_id, {r4('avg((y - restored) * (y - restored))')} AS mse,
  {r4('avg(200 * abs(restored - y) / (abs(restored) + abs(y)))')} AS smape FROM v GROUP BY 1""")
def forecast_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.forecast_accuracy(_restored(spark, sf_dir), KEYS, "y", "restored")
    return out.select("series_id", tidy(F.col("mse")).alias("mse"), tidy(F.col("smape")).alias("smape"))


@query("r07_next_step_linear")
def next_step_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = settle(O.chronological_split(daily(spark, sf_dir), KEYS, ORDER).drop("pos"))
    out = models.next_step_regression(parts, KEYS, ORDER, "y", 60)
    return A.forecast_accuracy(out, KEYS)


@query("r07_next_step_boosted")
def next_step_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = settle(O.chronological_split(daily(spark, sf_dir), KEYS, ORDER).drop("pos"))
    return models.next_step_regression(parts, KEYS, ORDER, "y", 60, method="boosted")


@query("r09_aligned_forecast", S.with_sql(S.HOURLY_SQL, _Z, _FORECAST1) + f"""
, p AS (SELECT series_id, t, y, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY t)
  <= floor(count(*) OVER (PARTITION BY series_id) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM hourly)
SELECT coalesce(p.series_id, f.series_id) AS series_id, coalesce(p.t, f.t) AS t, p.part, p.y,
  {r4('f.forecast')} AS forecast FROM p FULL JOIN f ON p.series_id = f.series_id AND p.t = f.t""")
def aligned_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = hourly(spark, sf_dir)
    parts = O.chronological_split(base, KEYS, ORDER).drop("pos")
    diffs = settle(O.difference(base, KEYS, ORDER, "y"))
    steps = A.walk_forward(diffs, KEYS, ORDER, "diff", 1).select("series_id", "t", tidy(F.col("forecast")).alias("forecast"))
    return A.align(parts, steps, ["series_id", "t"])
