"""Long groups are cut into runs; the answer must not depend on where."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import forecast as A, ordered, series as O
from tabulon.operators.evaluate import area_under_pr, area_under_roc, best_threshold

SHORT = 40


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = [("hot", t, rng.gauss(0, 5) + t * 0.01) for t in range(700)]
    rows += [(f"s{i}", t, rng.gauss(i, 1)) for i in range(5) for t in range(25 + i)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "s string, t int, y double").repartition(7).cache()


def same(a, b, digits=8):
    def rows(df):
        return sorted(
            [
                tuple(str(round(v, digits) + 0.0) if isinstance(v, float) else v for v in r)
                for r in df.select(*sorted(df.columns)).collect()
            ],
            key=lambda r: [str(v) for v in r],
        )

    return rows(a) == rows(b)


def test_running_totals(table):
    plain = ordered.running_totals(table, ["s"], ["t"], {"total": "y"})
    cut = ordered.running_totals(table, ["s"], ["t"], {"total": "y"}, SHORT)
    assert same(plain, cut)


def test_positions_without_keys_and_descending(table):
    unique = table.withColumn("k", F.concat_ws(":", "s", "t"))
    plain = ordered.positions(unique, [], [F.desc("y"), F.asc("k")])
    assert same(plain, ordered.positions(unique, [], [F.desc("y"), F.asc("k")], run_rows=SHORT))
    assert plain.agg(F.max("pos")).first()[0] == table.count() - 1


@pytest.mark.parametrize(
    "run",
    [
        lambda df, n: O.rolling(df, ["s"], ["t"], "y", 7, n),
        lambda df, n: O.difference(df, ["s"], ["t"], "y", run_rows=n),
        lambda df, n: O.lag_pairs(df, ["s"], ["t"], "y", 5, n),
        lambda df, n: O.lag_correlation(df, ["s"], ["t"], "y", [1, 5], n),
        lambda df, n: O.cumulate(df, ["s"], ["t"], "y", run_rows=n),
        lambda df, n: O.chronological_split(df, ["s"], ["t"], run_rows=n),
        lambda df, n: O.last_rows(df, ["s"], ["t"], 10, n),
        lambda df, n: O.sliding_windows(df, ["s"], ["t"], "y", 20, n).select("s", "t", F.array_join("window", ",").alias("w")),
        lambda df, n: A.autocorrelation(df, ["s"], ["t"], "y", 6, n),
        lambda df, n: A.partial_autocorrelation(df, ["s"], ["t"], "y", 6, n),
        lambda df, n: A.ar_fit(df, ["s"], ["t"], "y", 3, n),
        lambda df, n: A.walk_forward(df, ["s"], ["t"], "y", 3, run_rows=n),
        lambda df, n: A.unit_root_test(df, ["s"], ["t"], "y", run_rows=n).drop("p_value"),
    ],
)
def test_series_operators(table, run):
    assert same(run(table, ordered.RUN_ROWS), run(table, SHORT), 6)


def test_quantiles(table, spark):
    plain = ordered.exact_quantiles(table, "y", [0.0, 0.25, 0.5, 0.99, 1.0], ["s"])
    assert same(plain, ordered.exact_quantiles(table, "y", [0.0, 0.25, 0.5, 0.99, 1.0], ["s"], run_rows=SHORT))
    exact = table.groupBy("s").agg(F.expr("percentile(y, 0.25)").alias("q25"), F.expr("percentile(y, 0.99)").alias("q99"))
    assert same(plain.select("s", "q25", "q99"), exact)


def test_measures(table):
    scored = table.select((F.pmod(F.hash("s", "t"), F.lit(2))).alias("label"), F.round("y", 1).alias("score"))
    for measure in (area_under_roc, area_under_pr, best_threshold):
        assert same(measure(scored), measure(scored, run_rows=SHORT))


def test_layout_does_not_matter(table):
    a = O.rolling(table.repartition(1), ["s"], ["t"], "y", 7)
    assert same(a, O.rolling(table.repartition(8), ["s"], ["t"], "y", 7))


def test_windows_longer_than_a_run(table):
    """A chunk borrows from several chunks before it."""
    assert same(O.rolling(table, ["s"], ["t"], "y", 25), O.rolling(table, ["s"], ["t"], "y", 25, 6))
    assert same(O.lag_pairs(table, ["s"], ["t"], "y", 50), O.lag_pairs(table, ["s"], ["t"], "y", 50, SHORT))


@pytest.fixture(scope="module")
def gappy(spark):
    """Nulls first, in between, a group of nulls only, a null key, and not-a-number."""
    rng = random.Random(8)
    rows = [("hot", t, None if t < 90 or rng.random() < 0.3 else rng.gauss(0, 1)) for t in range(400)]
    rows += [("none", t, None) for t in range(100)] + [(None, t, float(t) if t % 3 else None) for t in range(130)]
    rows += [("nan", t, float("nan") if t == 60 else 1.0) for t in range(90)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "s string, t int, y double").repartition(5).cache()


@pytest.mark.parametrize(
    "run",
    [
        lambda df, n: ordered.running_totals(df, ["s"], ["t"], {"total": "y", "rows": F.lit(1)}, n),
        lambda df, n: O.difference(df, ["s"], ["t"], "y", run_rows=n),
        lambda df, n: O.lag_pairs(df, ["s"], ["t"], "y", 5, n),
        lambda df, n: O.rolling(df, ["s"], ["t"], "y", 4, n),
        lambda df, n: ordered.exact_quantiles(df.where("s <> 'nan'"), "y", [0.1, 0.5], ["s"], run_rows=n),
    ],
)
def test_nulls_do_not_depend_on_runs(gappy, run):
    assert same(run(gappy, ordered.RUN_ROWS), run(gappy, SHORT), 6)


def test_rows_beside_a_gap_stay(gappy):
    assert O.difference(gappy, ["s"], ["t"], "y").count() == gappy.count() - 4
    assert O.lag_pairs(gappy, ["s"], ["t"], "y", 5).count() == gappy.count() - 20


def brute_unit_root(y):
    """Least squares on explicit rows, one for each place whose value and lags exist."""
    n = int(np.isfinite(y).sum())
    limit = A.default_maxlag(n)
    dy = np.diff(y, prepend=np.nan)

    def rows(lag, start):
        out = [[y[t - 1], *[dy[t - k] for k in range(1, lag + 1)], 1.0, dy[t]] for t in range(start, len(y))]
        return np.array([r for r in out if np.isfinite(r).all()])

    def fit(x):
        beta, *_ = np.linalg.lstsq(x[:, :-1], x[:, -1], rcond=None)
        rest = x[:, -1] - x[:, :-1] @ beta
        return beta, float(rest @ rest)

    scores = []
    for lag in range(limit + 1):
        x = rows(limit, limit + 1)
        x = np.column_stack([x[:, : lag + 1], x[:, limit + 1 :]])
        scores.append(len(x) * np.log(fit(x)[1] / len(x)) + 2 * (lag + 2))
    lag = int(np.argmin(scores))
    common, early = rows(limit, limit + 1), rows(lag, lag + 1)[:0]
    early = [[y[t - 1], *[dy[t - k] for k in range(1, lag + 1)], 1.0, dy[t]] for t in range(lag + 1, limit + 1)]
    early = np.array([r for r in early if np.isfinite(r).all()]).reshape(-1, lag + 3)
    x = np.concatenate([early, np.column_stack([common[:, : lag + 1], common[:, limit + 1 :]])])
    beta, rss = fit(x)
    inverse = np.linalg.inv(x[:, :-1].T @ x[:, :-1])
    return lag, len(x), beta[0] / np.sqrt(rss / (len(x) - lag - 2) * inverse[0, 0])


@pytest.mark.parametrize("run_rows", [ordered.RUN_ROWS, 40])
def test_gaps_and_lengths_of_series(spark, run_rows):
    """Series of different length, with missing values, against explicit least squares."""
    rng = np.random.default_rng(8)
    series = {f"s{k}": np.cumsum(rng.normal(size=n)) for k, n in enumerate((60, 300, 25))}
    for y, gone in zip(series.values(), ([30], [0, 5, 6, 150, 299], [])):
        y[gone] = np.nan
    rows = [(s, t, None if np.isnan(v) else float(v)) for s, y in series.items() for t, v in enumerate(y)]
    df = spark.createDataFrame(rows, "s string, t int, y double")
    found = {r["s"]: r for r in A.unit_root_test(df, ["s"], ["t"], "y", run_rows=run_rows).collect()}
    forecasts = {(r["s"], r["t"]): r["forecast"] for r in A.walk_forward(df, ["s"], ["t"], "y", 2, run_rows=run_rows).collect()}
    fits = {(r["s"], r["lag"]): r for r in A.ar_fit(df, ["s"], ["t"], "y", 2, run_rows).collect()}
    for s, y in series.items():
        lag, n, tau = brute_unit_root(y)
        assert (found[s]["lags"], found[s]["n_obs"]) == (lag, n)
        assert found[s]["statistic"] == pytest.approx(tau, rel=1e-6)
        x = np.array([[y[t - 1], y[t - 2], y[t]] for t in range(2, len(y))])
        whole = x[np.isfinite(x).all(axis=1)]
        beta, rss, *_ = np.linalg.lstsq(whole[:, :2], whole[:, 2], rcond=None)
        assert [fits[s, k]["coefficient"] for k in (1, 2)] == pytest.approx(beta.tolist())
        assert fits[s, 1]["sigma2"] == pytest.approx(float(rss[0]) / len(whole))
        for t in range(int(len(y) * 0.8), len(y)):
            before = x[: t - 2]
            before = before[np.isfinite(before).all(axis=1)]
            want = float(np.linalg.lstsq(before[:, :2], before[:, 2], rcond=None)[0] @ x[t - 2, :2])
            got = forecasts[s, t]
            assert got is None if np.isnan(want) else got == pytest.approx(want)


def test_quantiles_by_selection(spark, monkeypatch):
    """Skewed, tied, infinite and few values, null groups and empty tables, with one pass and with two."""
    rng = np.random.default_rng(3)
    groups = {
        "skew": np.exp(rng.normal(size=3000) * 6), "ties": rng.integers(0, 3, 2000).astype(float), "one": np.array([5.0]), "same": np.full(50, -2.0),
        "far": np.concatenate([rng.normal(size=1500), [1e308, -1e308]]), None: rng.normal(size=700), "ends": np.array([float("-inf"), 1.0, 2.0, 3.0, float("inf")]),
    }
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [("skew", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, y double")
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for run_rows in (ordered.RUN_ROWS, 60):
        found = {r["g"]: list(r)[1:] for r in ordered.exact_quantiles(df, "y", shares, ["g"], list("abcdef"), run_rows).collect()}
        assert set(found) == set(groups)
        for g, x in groups.items():
            if g == "ends":
                assert found[g][3] == 2.0
                continue
            low = np.sort(x)
            for got, p in zip(found[g], shares):
                spot = (len(x) - 1) * p
                a, b = low[int(np.floor(spot))], low[int(np.ceil(spot))]
                assert got == pytest.approx(a + (b - a) * (spot - np.floor(spot)), rel=1e-12)
        whole = ordered.exact_quantiles(df.where("g <> 'ends'"), "y", [0.5], names=["m"], run_rows=run_rows).first()["m"]
        assert whole == pytest.approx(np.median(np.concatenate([x for g, x in groups.items() if g not in ("ends", None)])))
    assert ordered.exact_quantiles(df.where("false"), "y", [0.5], ["g"]).count() == 0


def test_selection_sorts_no_table(spark):
    df = spark.range(100_000).selectExpr("id", "(id * 7919 % 100003) * 1.0D AS y")
    plans, plain = [], ordered.running_totals
    ordered.running_totals = lambda counts, *a, **k: plans.append(counts.count()) or plain(counts, *a, **k)
    try:
        row = ordered.exact_quantiles(df, "y", [0.25, 0.5, 0.75]).first()
    finally:
        ordered.running_totals = plain
    assert plans[0] < 100_000 * 6 / ordered.BINS
    assert row["q50"] == pytest.approx(np.median([i * 7919 % 100003 for i in range(100_000)]))
