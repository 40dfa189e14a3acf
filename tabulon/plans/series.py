"""Series questions on the daily order value and the hourly event values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expressions import tidy
from tabulon.operators import features, series as O
from tabulon.operators.ordered import RUN_ROWS
from tabulon.plans import standins as S
from tabulon.plans.registry import query, r4
from tabulon.session import settle

KEYS, ORDER = ["series_id"], ["t"]
_D = S.with_sql(S.DAILY_SQL)
_H = S.with_sql(S.HOURLY_SQL)
_W = "(PARTITION BY series_id ORDER BY t)"


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settled, because the operators look at the group sizes before they run."""
    return settle(S.daily(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(S.hourly(spark, sf_dir))


_ROLL = "(PARTITION BY series_id ORDER BY t ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
_ROLLING = f"""SELECT series_id, t, y,
  CASE WHEN count(y) OVER {_ROLL} = 7 THEN {r4(f'avg(y) OVER {_ROLL}')} END AS rolling_mean,
  CASE WHEN count(y) OVER {_ROLL} = 7 THEN {r4(f'stddev_samp(y) OVER {_ROLL}')} END AS rolling_std FROM """


def _rolled(df: DataFrame) -> DataFrame:
    out = O.rolling(df, KEYS, ORDER, "y", 7)
    return out.withColumn("rolling_mean", tidy(F.col("rolling_mean"))).withColumn("rolling_std", tidy(F.col("rolling_std")))


@query("e01_rolling_daily", _D + _ROLLING + "daily")
def rolling_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(daily(spark, sf_dir))


@query("e01_rolling_hourly", _H + _ROLLING + "hourly")
def rolling_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(hourly(spark, sf_dir))


#: A forced short run: the same question through the path for long groups.
SHORT_RUN = 100


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly series with nulls: the first two values of each, and every hour three of a day."""
    early = F.col("t") < F.lit("2024-01-01 02:00:00").cast("timestamp_ntz")
    gone = early | (F.hour("t") % 5 == 3)
    return settle(S.hourly(spark, sf_dir).withColumn("y", F.when(~gone, F.col("y"))))


GAPS_SQL = """gaps AS (SELECT series_id, t,
  CASE WHEN t < TIMESTAMP '2024-01-01 02:00:00' OR hour(t) % 5 = 3 THEN NULL ELSE y END AS y FROM hourly)"""
_G = S.with_sql(S.HOURLY_SQL, GAPS_SQL)


def _diff_sql(table: str) -> str:
    return f"""SELECT series_id, t, {r4(f'y - lag(y) OVER {_W}')} AS diff FROM {table}
QUALIFY row_number() OVER {_W} > 1"""


def _differences(df: DataFrame, run_rows: int) -> DataFrame:
    out = O.difference(df, KEYS, ORDER, "y", run_rows=run_rows)
    return out.select("series_id", "t", tidy(F.col("diff")).alias("diff"))


@query("e02_difference", _H + _diff_sql("hourly"))
def difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _differences(hourly(spark, sf_dir), RUN_ROWS)


@query("e02_difference_gaps", _G + _diff_sql("gaps"))
def difference_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _differences(gaps(spark, sf_dir), RUN_ROWS)


@query("e02_difference_gaps_short_runs", _G + _diff_sql("gaps"))
def difference_gaps_short_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _differences(gaps(spark, sf_dir), SHORT_RUN)


def _pairs_sql(table: str) -> str:
    return f"""SELECT series_id, t, lag(y, 5) OVER {_W} AS y_lag, y AS y_now FROM {table}
QUALIFY row_number() OVER {_W} > 5"""


@query("e03_lag_pairs_gaps", _G + _pairs_sql("gaps"))
def lag_pairs_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.lag_pairs(gaps(spark, sf_dir), KEYS, ORDER, "y", 5)


@query("e03_lag_pairs_gaps_short_runs", _G + _pairs_sql("gaps"))
def lag_pairs_gaps_short_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.lag_pairs(gaps(spark, sf_dir), KEYS, ORDER, "y", 5, 3)


@query("e03_lag_pairs", _H + f"""
SELECT * FROM (SELECT series_id, t, lag(y, 5) OVER {_W} AS y_lag, y AS y_now FROM hourly) WHERE y_lag IS NOT NULL""")
def lag_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.lag_pairs(hourly(spark, sf_dir), KEYS, ORDER, "y", 5)


@query("e03_lag_correlation", _H + f"""
, p AS (SELECT series_id, y, lag(y, 1) OVER {_W} AS l1, lag(y, 5) OVER {_W} AS l5 FROM hourly)
SELECT series_id, 1 AS lag, {r4('corr(y, l1)')} AS corr FROM p GROUP BY 1
UNION ALL SELECT series_id, 5, {r4('corr(y, l5)')} FROM p GROUP BY 1""")
def lag_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.lag_correlation(hourly(spark, sf_dir), KEYS, ORDER, "y", [1, 5]).withColumn("corr", tidy(F.col("corr")))


@query("e04_undo_difference", _H + """
SELECT series_id, t, round(y, 2) AS restored FROM hourly
QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY t) > 1""")
def undo_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = hourly(spark, sf_dir)
    diffs = O.difference(base, KEYS, ORDER, "y")
    return O.undo_difference(base, KEYS, "t", "y", diffs, "diff").select("series_id", "t", F.round("restored", 2).alias("restored"))


@query("e05_chronological_split", _H + """
SELECT series_id, t, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY t)
  <= floor(count(*) OVER (PARTITION BY series_id) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM hourly""")
def chronological_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.chronological_split(hourly(spark, sf_dir), KEYS, ORDER).select("series_id", "t", "part")


@query("e06_last_rows", _D + """
SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY t DESC) <= 60""")
def last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.last_rows(daily(spark, sf_dir), KEYS, ORDER, 60)


_W60 = "(PARTITION BY series_id ORDER BY t ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)"


@query("e07_sliding_windows", _D + f"""
SELECT t, y, 60 AS size, first_value(y) OVER {_W60} AS oldest, lag(y) OVER (PARTITION BY series_id ORDER BY t) AS newest,
  round(sum(y) OVER {_W60}, 2) AS total FROM daily QUALIFY count(y) OVER {_W60} = 60""")
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = O.sliding_windows(daily(spark, sf_dir), KEYS, ORDER, "y", 60)
    total = F.aggregate("window", F.lit(0.0), lambda s, x: s + x)
    return w.select(
        "t", "y", F.size("window").alias("size"), F.element_at("window", 1).alias("oldest"),
        F.element_at("window", -1).alias("newest"), F.round(total, 2).alias("total"),
    )


@query("e08_cumulative", _H + f"SELECT series_id, t, round(sum(y) OVER {_W}, 2) AS total FROM hourly")
def cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.cumulate(hourly(spark, sf_dir), KEYS, ORDER, "y").select("series_id", "t", F.round("total", 2).alias("total"))


_GAP_TOTAL = _G + f"SELECT series_id, t, round(sum(y) OVER {_W}, 2) AS total FROM gaps"


@query("e08_cumulative_gaps", _GAP_TOTAL)
def cumulative_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null until the first value of a series; later nulls add nothing."""
    return O.cumulate(gaps(spark, sf_dir), KEYS, ORDER, "y").select("series_id", "t", F.round("total", 2).alias("total"))


@query("e08_cumulative_gaps_short_runs", _GAP_TOTAL)
def cumulative_gaps_short_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = O.cumulate(gaps(spark, sf_dir), KEYS, ORDER, "y", run_rows=SHORT_RUN)
    return out.select("series_id", "t", F.round("total", 2).alias("total"))


@query("g01_concat_series", _D + """
, p AS (SELECT *, row_number() OVER (ORDER BY t) AS rn, floor(count(*) OVER () * 0.8::DOUBLE) AS cut FROM daily)
SELECT t, y FROM p WHERE rn > cut - 60""")
def concat_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 60 training rows in front of the test rows."""
    parts = settle(O.chronological_split(daily(spark, sf_dir), KEYS, ORDER))
    train, test = parts.where(F.col("part") == "train"), parts.where(F.col("part") == "test")
    tail = O.last_rows(train.drop("pos"), KEYS, ORDER, 60)
    return O.concat_series(tail, test.drop("pos")).select("t", "y")


@query("h09_absolute_change", _H + f"""
SELECT series_id, t, {r4(f'abs(y - lag(y) OVER {_W})')} AS change FROM hourly""")
def absolute_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = O.previous(hourly(spark, sf_dir), KEYS, ORDER, "y", "before")
    return out.select("series_id", "t", tidy(F.abs(F.col("y") - F.col("before"))).alias("change"))


@query("h10_text_to_date", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS t FROM orders")
def text_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = S.table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d")).distinct()
    return text.select(F.to_date("d").alias("t"))


@query("k06_min_max_scale", _D + f"""
, p AS (SELECT *, row_number() OVER (ORDER BY t) AS rn, floor(count(*) OVER () * 0.8::DOUBLE) AS cut FROM daily)
, l AS (SELECT min(y) AS lo, max(y) - min(y) AS span FROM p WHERE rn <= cut)
SELECT t, CASE WHEN rn <= cut THEN 'train' ELSE 'test' END AS part, {r4('(y - lo) / span')} AS y_scaled,
  round(y, 2) AS y_back FROM p, l""")
def min_max_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits from the train part, applied to both parts, and undone."""
    parts = O.chronological_split(daily(spark, sf_dir), KEYS, ORDER)
    limits = features.column_limits(parts.where(F.col("part") == "train"), ["y"])
    scaled = features.scale(parts, limits, ["y"])
    back = features.unscale(scaled, limits, "y_scaled", "y", "y_back")
    return back.select("t", "part", tidy(F.col("y_scaled")).alias("y_scaled"), F.round("y_back", 2).alias("y_back"))
