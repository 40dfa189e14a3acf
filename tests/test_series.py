import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import forecast as A, models, series as O


def frame(spark, values, name="a"):
    return spark.createDataFrame([(name, t, float(v)) for t, v in enumerate(values)], "s string, t int, y double")


def test_difference_and_back(spark):
    df = frame(spark, [3, 4, 8, 1])
    diffs = O.difference(df, ["s"], ["t"], "y")
    assert [r["diff"] for r in diffs.orderBy("t").collect()] == [1.0, 4.0, -7.0]
    back = O.undo_difference(df, ["s"], "t", "y", diffs, "diff")
    assert [r["restored"] for r in back.orderBy("t").collect()] == [4.0, 8.0, 1.0]


def test_rolling_is_null_until_full(spark):
    rows = O.rolling(frame(spark, range(1, 11)), ["s"], ["t"], "y", 7).orderBy("t").collect()
    assert [r["rolling_mean"] for r in rows][:7] == [None] * 6 + [4.0]
    assert rows[6]["rolling_std"] == pytest.approx(2.160246899)


def test_window_counts_and_split(spark):
    df = frame(spark, range(100))
    windows = O.sliding_windows(df, ["s"], ["t"], "y", 60)
    assert windows.count() == 40
    first = windows.orderBy("t").first()
    assert first["window"][0] == 0.0 and first["window"][-1] == 59.0 and first["y"] == 60.0
    parts = O.chronological_split(df, ["s"], ["t"])
    assert parts.where("part = 'train'").count() == 80
    assert [r["t"] for r in O.last_rows(df, ["s"], ["t"], 3).orderBy("t").collect()] == [97, 98, 99]


def ar1(phi, n, seed):
    rng = np.random.default_rng(seed)
    y = np.zeros(n)
    for t in range(1, n):
        y[t] = phi * y[t - 1] + rng.normal()
    return y


def test_autoregression_finds_the_planted_coefficient(spark):
    df = frame(spark, ar1(0.6, 3000, 1))
    assert A.ar_fit(df, ["s"], ["t"], "y", 1).first()["coefficient"] == pytest.approx(0.6, abs=0.05)
    pacf = {r["lag"]: r["pacf"] for r in A.partial_autocorrelation(df, ["s"], ["t"], "y", 4).collect()}
    assert pacf[1] == pytest.approx(0.6, abs=0.05) and abs(pacf[2]) < 0.06 and pacf[0] == 1.0


def test_walk_forward_refits_at_every_step(spark):
    y = ar1(0.5, 120, 2)
    p, split = 2, 96
    found = {r["t"]: r["forecast"] for r in A.walk_forward(frame(spark, y), ["s"], ["t"], "y", p).collect()}
    assert sorted(found) == list(range(split, 120))
    for t in (96, 100, 119):
        rows = np.arange(p, t)
        x = np.column_stack([y[rows - k] for k in range(1, p + 1)])
        phi = np.linalg.lstsq(x, y[rows], rcond=None)[0]
        assert found[t] == pytest.approx(phi @ y[[t - 1, t - 2]], abs=1e-9)


def brute_adf(y):
    """Least squares on explicit matrices, lags by AIC on the common sample."""
    n = len(y)
    dy = np.diff(y)
    most = A.default_maxlag(n)

    def fit(lag, start):
        rows = np.arange(start, len(dy))
        x = np.column_stack([y[rows], *[dy[rows - k] for k in range(1, lag + 1)], np.ones(len(rows))])
        beta, *_ = np.linalg.lstsq(x, dy[rows], rcond=None)
        rss = ((dy[rows] - x @ beta) ** 2).sum()
        return x, beta, rss, len(rows)

    scores = []
    for lag in range(most + 1):
        x, _, rss, m = fit(lag, most)
        scores.append(m * math.log(rss / m) + 2 * x.shape[1])
    lag = int(np.argmin(scores))
    x, beta, rss, m = fit(lag, lag)
    se = math.sqrt(rss / (m - x.shape[1]) * np.linalg.inv(x.T @ x)[0, 0])
    return beta[0] / se, lag, m


@pytest.mark.parametrize("phi,seed", [(1.0, 4), (0.5, 5), (0.95, 6)])
def test_unit_root_matches_explicit_regression(spark, phi, seed):
    y = ar1(phi, 200, seed) + 50
    row = A.unit_root_test(frame(spark, y), ["s"], ["t"], "y").first()
    statistic, lag, n = brute_adf(y)
    assert row["statistic"] == pytest.approx(statistic, abs=1e-6)
    assert (row["lags"], row["n_obs"]) == (lag, n)
    assert row["crit_5"] == pytest.approx(-2.876, abs=0.005)
    assert (row["p_value"] < 0.05) == (statistic < row["crit_5"])


def test_unit_root_p_values_at_published_points():
    assert A.unit_root_p_value(-2.86154) == pytest.approx(0.05, abs=0.002)
    assert A.unit_root_p_value(-3.43035) == pytest.approx(0.01, abs=0.001)
    assert A.unit_root_p_value(3.0) == 1.0 and A.unit_root_p_value(-20.0) == 0.0


def test_short_series_give_no_statistic(spark):
    row = A.unit_root_test(frame(spark, [1, 2, 1]), ["s"], ["t"], "y").first()
    assert row["statistic"] is None


def test_next_step_regression_learns_a_sine(spark):
    df = O.chronological_split(frame(spark, [math.sin(t / 5) * 10 + 50 for t in range(400)]), ["s"], ["t"]).drop("pos")
    out = models.next_step_regression(df, ["s"], ["t"], "y", 60)
    assert out.count() == 80
    assert A.forecast_accuracy(out, ["s"]).first()["mse"] < 1.0


def test_accuracy_of_zero_forecasts(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0), ("a", 1.0, 3.0)], "s string, actual double, forecast double")
    row = A.forecast_accuracy(df, ["s"]).first()
    assert row["mse"] == 2.0 and row["smape"] == 50.0


def test_autocorrelation_of_a_constant_is_null(spark):
    rows = A.autocorrelation(frame(spark, [2, 2, 2, 2]), ["s"], ["t"], "y", 1).orderBy("lag").collect()
    assert rows[1]["acf"] is None
    assert O.lag_pairs(frame(spark, [1, 2, 3]), ["s"], ["t"], "y", 1).agg(F.count(F.lit(1))).first()[0] == 2
