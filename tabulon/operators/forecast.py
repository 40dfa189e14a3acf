"""Auto-correlation, stationarity, and autoregressive forecasting.

Fits are sums of cross-products, so a series is cut into chunks, each chunk
yields a small matrix, and the matrices are added. NumPy works inside the
tasks, on one bounded chunk at a time; solves act on matrices of lag size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expressions import symmetric_error
from tabulon.operators.ordered import RUN_ROWS, frames, null_safe_join, with_group_values
from tabulon.operators.series import shifted

# MacKinnon's published response surfaces for a unit-root test
# with a constant (1994 p-value polynomials, 2010 critical values).
TAU_MAX, TAU_MIN, TAU_STAR = 2.74, -18.83, -1.61
TAU_SMALL = (2.1659, 1.4412, 0.038269)
TAU_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
TAU_CRITICAL = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10": (-2.56677, -1.5384, -2.809, 0.0),
}


def centred(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """The value minus the mean of its series."""
    means = df.groupBy(*by).agg(F.avg(value).alias("_mean"))
    return with_group_values(df, means, by).withColumn(name, F.col(value) - F.col("_mean")).drop("_mean")


def autocorrelation(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, lags: int, run_rows: int = RUN_ROWS
) -> DataFrame:
    """Auto-correlation at lags 0..lags: one array per series, then one row per lag."""
    arrays = autocorrelation_arrays(df, by, order, value, lags, run_rows)
    return arrays.select(*by, F.posexplode("acf").alias("lag", "acf"))


def autocorrelation_arrays(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, lags: int, run_rows: int = RUN_ROWS
) -> DataFrame:
    base = centred(df.select(*by, *order, value), by, value, "_d")
    lagged = shifted(base, by, order, "_d", {f"_l{k}": k for k in range(1, lags + 1)}, run_rows)
    power = F.sum(F.col("_d") * F.col("_d"))
    products = [F.try_divide(F.sum(F.col("_d") * F.col(f"_l{k}")), power) for k in range(1, lags + 1)]
    return lagged.groupBy(*by).agg(F.array(F.lit(1.0), *products).alias("acf"))


def _levinson(acf: np.ndarray) -> np.ndarray:
    """Partial auto-correlations from auto-correlations (Durbin's recursion)."""
    out = np.zeros(len(acf))
    out[0] = 1.0
    phi = np.zeros(0)
    for k in range(1, len(acf)):
        error = 1.0 - float(phi @ acf[1:k])
        top = acf[k] - float(phi @ acf[k - 1 : 0 : -1])
        reflection = top / error if error else float("nan")
        phi = np.append(phi - reflection * phi[::-1], reflection)
        out[k] = reflection
    return out


def partial_autocorrelation(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, lags: int, run_rows: int = RUN_ROWS
) -> DataFrame:
    """Partial auto-correlation at lags 0..lags, solved per series on its short array."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(acf: pd.Series) -> pd.Series:
        return acf.map(lambda a: _levinson(np.asarray(a, dtype=float)).tolist())

    arrays = autocorrelation_arrays(df, by, order, value, lags, run_rows)
    return arrays.select(*by, solve("acf").alias("pacf")).select(*by, F.posexplode("pacf").alias("lag", "pacf"))


# ------------------------------------------------------------ cross-product sums


def _lag_columns(y: np.ndarray, rows: np.ndarray, p: int) -> np.ndarray:
    return np.column_stack([y[rows - k] for k in range(1, p + 1)]) if p else np.empty((len(rows), 0))


def chunk_sums(framed: DataFrame, keys: Sequence[str], design) -> DataFrame:
    """X'X of each chunk as one flat array; ``design`` builds X from a sorted chunk."""
    fields = [f for f in framed.schema.fields if f.name in keys]
    schema = T.StructType([*fields, T.StructField("_gram", T.ArrayType(T.DoubleType()))])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = design(pdf.sort_values("pos"))
        first = pdf.iloc[:1]
        return pd.DataFrame({**{k: first[k].to_numpy() for k in keys}, "_gram": [(x.T @ x).ravel()]})

    return framed.groupBy(*keys).applyInPandas(run, schema)


def summed_matrix(chunks: DataFrame, by: Sequence[str], name: str = "_gram") -> DataFrame:
    """Chunk matrices added up: one flat array per series."""
    return chunks.groupBy(*by).agg(vector_to_array(Summarizer.sum(array_to_vector("_gram"))).alias(name))


def earlier_matrix(chunks: DataFrame, by: Sequence[str], name: str = "_carry") -> DataFrame:
    """For each chunk, the sum of the matrices of the chunks before it."""
    before = Window.partitionBy(*by, "_cell").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    cells = chunks.select(*by, "_chunk", F.posexplode("_gram").alias("_cell", "_s"))
    carried = cells.withColumn("_s", F.coalesce(F.sum("_s").over(before), F.lit(0.0)))
    ordered = F.array_sort(F.collect_list(F.struct("_cell", "_s")))
    return carried.groupBy(*by, "_chunk").agg(F.transform(ordered, lambda c: c["_s"]).alias(name))


# ------------------------------------------------------------ autoregression


#: Rows whose running sums a chunk holds at a time.
STEP_ROWS = 2048


def ar_design(p: int, value: str = "_z", counted: bool = False):
    """Columns: p lagged values and the value, and a one when ``counted``; only rows where all of them exist."""

    def build(pdf: pd.DataFrame) -> np.ndarray:
        z = pdf[value].to_numpy(dtype=float)
        rows = np.flatnonzero(pdf["_home"].to_numpy() & (pdf["pos"].to_numpy() >= p))
        x = np.column_stack([_lag_columns(z, rows, p), z[rows]]) if len(rows) else np.empty((0, p + 1))
        x = x[np.isfinite(x).all(axis=1)]
        return np.column_stack([x, np.ones(len(x))]) if counted else x

    return build


def _solve(gram: np.ndarray, p: int) -> np.ndarray:
    return np.linalg.lstsq(gram[:p, :p], gram[:p, p], rcond=None)[0]


def ar_fit(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, p: int, run_rows: int = RUN_ROWS
) -> DataFrame:
    """Least-squares autoregression of order p without constant, one row per series and term.

    Give it the differenced series for an integrated model. A row enters where its value and all its lags exist.
    """
    cut = frames(df.select(*by, *order, F.col(value).alias("_z")), by, order, p, run_rows, with_pos=True)
    grams = summed_matrix(chunk_sums(cut.df, cut.keys, ar_design(p, counted=True)), by)

    @F.pandas_udf("array<double>")
    def coefficients(gram: pd.Series) -> pd.Series:
        def one(flat):
            g = np.asarray(flat, dtype=float).reshape(p + 2, p + 2)
            phi = _solve(g, p)
            return [*phi.tolist(), float(g[p, p] - phi @ g[:p, p]), float(g[p + 1, p + 1])]

        return gram.map(one)

    solved = grams.withColumn("_fit", coefficients("_gram"))
    return solved.select(
        *by,
        F.posexplode(F.slice("_fit", 1, p)).alias("_i", "coefficient"),
        F.try_divide(F.element_at("_fit", p + 1), F.element_at("_fit", p + 2)).alias("sigma2"),
    ).select(*by, (F.col("_i") + 1).alias("lag"), "coefficient", "sigma2")


def walk_forward(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    p: int,
    share: float = 0.8,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """One-step forecasts over the last part of each series, refitted at every step.

    Expanding sums of cross-products give the coefficients of every step from
    one pass: each chunk starts from the sums of the chunks before it, and holds the sums of ``STEP_ROWS``
    rows at a time. A row enters the sums where its value and all its lags exist; a forecast is
    null where a lag is missing, or where no row has entered yet.
    """
    cut = frames(df.select(*by, *order, F.col(value).alias("_z")), by, order, p, run_rows, with_pos=True)
    fields = [f for f in cut.df.schema.fields if f.name in (*by, *order)]
    schema = T.StructType(
        [*fields, T.StructField("pos", T.LongType()), T.StructField("actual", T.DoubleType()),
         T.StructField("forecast", T.DoubleType())]
    )
    columns = schema.names
    width = p + 1

    def steps(rows: pd.DataFrame, gram: np.ndarray, n: int) -> pd.DataFrame:
        """Forecasts within one sorted chunk, given the sums of all earlier rows."""
        z, pos, home = rows["_z"].to_numpy(dtype=float), rows["pos"].to_numpy(), rows["_home"].to_numpy()
        split = math.floor(n * share)
        usable = np.flatnonzero(home & (pos >= p))
        forecast = np.full(len(z), np.nan)
        for at in range(0, len(usable), STEP_ROWS):
            part = usable[at : at + STEP_ROWS]
            lags, own = _lag_columns(z, part, p), z[part]
            known = np.isfinite(lags).all(axis=1)
            x = np.where((known & np.isfinite(own))[:, None], np.column_stack([lags, own]), 0.0)
            outer = np.einsum("ij,ik->ijk", x, x)
            sums = gram + np.cumsum(outer, axis=0)
            test = np.flatnonzero((pos[part] >= split) & known)
            if len(test):
                until = sums[test] - outer[test]  # sums over rows strictly before
                a, b = until[:, :p, :p], until[:, :p, p]
                phi = np.einsum("ijk,ik->ij", np.linalg.pinv(a, hermitian=True), b)
                phi[np.einsum("ijj->i", until) == 0] = np.nan
                forecast[part[test]] = np.einsum("ij,ij->i", phi, lags[test])
            gram = sums[-1]
        out = rows.assign(actual=z, forecast=forecast)
        return out.loc[home & (pos >= split), columns]

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        return steps(rows.sort_values("pos").reset_index(drop=True), np.zeros((width, width)), len(rows))

    def continued(rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame(columns=columns)
        rows = rows.sort_values("pos").reset_index(drop=True)
        gram = np.asarray(start["_carry"].iloc[0], dtype=float).reshape(width, width)
        return steps(rows, gram, int(rows["_n"].iloc[0]))

    if cut.split:
        carry = earlier_matrix(chunk_sums(cut.df, cut.keys, ar_design(p)), by)
        sized = with_group_values(cut.df, df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")), by)
        done = sized.groupBy(*cut.keys).cogroup(carry.groupBy(*cut.keys)).applyInPandas(continued, schema)
    else:
        done = cut.df.groupBy(*cut.keys).applyInPandas(whole, schema)
    return done.withColumn("forecast", F.nanvl("forecast", F.lit(None).cast("double")))


# ------------------------------------------------------------ unit-root test


def _adf_design(maxlag: int, start: int):
    """Columns: lagged level, lagged differences, constant, difference; rows from ``start`` on."""

    def build(pdf: pd.DataFrame) -> np.ndarray:
        y = pdf["_z"].to_numpy(dtype=float)
        rows = np.flatnonzero(pdf["_home"].to_numpy() & (pdf["pos"].to_numpy() >= start))
        if not len(rows):
            return np.empty((0, maxlag + 3))
        dy = np.diff(y, prepend=np.nan)
        return np.column_stack([y[rows - 1], _lag_columns(dy, rows, maxlag), np.ones(len(rows)), dy[rows]])

    return build


def _regress(gram: np.ndarray, keep: list[int], target: int) -> tuple[np.ndarray, float, np.ndarray]:
    a, b = gram[np.ix_(keep, keep)], gram[keep, target]
    inverse = np.linalg.pinv(a, hermitian=True)
    beta = inverse @ b
    return beta, max(float(gram[target, target] - beta @ b), 0.0), inverse


def best_lag(gram: np.ndarray, maxlag: int) -> int:
    """The number of lagged differences with the lowest AIC, on a common sample."""
    target = maxlag + 2
    n = gram[maxlag + 1, maxlag + 1]
    scores = []
    for lag in range(maxlag + 1):
        keep = [0, *range(1, lag + 1), maxlag + 1]
        _, rss, _ = _regress(gram, keep, target)
        scores.append(n * math.log(max(rss, 1e-300) / n) + 2 * len(keep))
    return int(np.argmin(scores))


def unit_root_p_value(tau: float) -> float:
    if tau > TAU_MAX:
        return 1.0
    if tau < TAU_MIN:
        return 0.0
    terms = TAU_SMALL if tau <= TAU_STAR else TAU_LARGE
    z = sum(c * tau**i for i, c in enumerate(terms))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def unit_root_test(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    maxlag: int | None = None,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """Augmented Dickey–Fuller with a constant; lags by AIC unless ``maxlag=0``.

    The default lag limit follows the number of values of each series,
    12·(n/100)^¼ rounded up. Values are centred and scaled first, which leaves the
    statistic unchanged and the sums well conditioned. With missing values a row enters only
    where its own value and all its lags exist (up to the limit while lags are chosen, as many
    as were chosen after that). A series' sums travel as the upper triangle of a matrix of its own width.
    """
    stats = df.groupBy(*by).agg(
        F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_std"), F.count(value).alias("_n")
    )
    longest = int(stats.agg(F.max("_n")).first()[0] or 0)
    limit = default_maxlag(longest) if maxlag is None else maxlag
    base = with_group_values(df.select(*by, *order, value), stats, by).select(
        *by, *order, "_n",
        F.when(F.col(value).isNotNull(), F.coalesce(F.try_divide(F.col(value) - F.col("_mean"), F.col("_std")), F.lit(0.0))).alias("_z"),
    )
    cut = frames(base, by, order, limit + 1, run_rows, with_pos=True)
    keys = cut.keys
    # Lag choice needs one common sample, but the final regression also uses
    # the few rows before it: their values travel as a short array.
    schema = T.StructType(
        [*[f for f in cut.df.schema.fields if f.name in keys],
         T.StructField("_gram", T.ArrayType(T.DoubleType())), T.StructField("_early", T.ArrayType(T.DoubleType()))]
    )

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        own = own_limit(int(pdf["_n"].iloc[0]))
        x = _adf_design(own, own + 1)(pdf)
        x = x[np.isfinite(x).all(axis=1)]
        first = pdf.iloc[:1]
        early = pdf["_z"].to_numpy(dtype=float)[: own + 1] if int(first["pos"].iloc[0]) == 0 else None
        packed = (x.T @ x)[np.triu_indices(own + 3)]
        return pd.DataFrame({**{k: first[k].to_numpy() for k in keys}, "_gram": [packed], "_early": [early]})

    def own_limit(n: int) -> int:
        return min(limit, default_maxlag(n)) if maxlag is None else limit

    chunks = cut.df.groupBy(*keys).applyInPandas(run, schema)
    packed = chunks.groupBy(*by).agg(
        vector_to_array(Summarizer.sum(array_to_vector("_gram"))).alias("_gram"),
        F.first("_early", ignorenulls=True).alias("_early"),
    )

    result = T.StructType(
        [T.StructField("statistic", T.DoubleType()), T.StructField("p_value", T.DoubleType()),
         T.StructField("lags", T.IntegerType()), T.StructField("n_obs", T.LongType()),
         *[T.StructField(name, T.DoubleType()) for name in TAU_CRITICAL]]
    )

    @F.pandas_udf(result)
    def solve(gram: pd.Series, early: pd.Series) -> pd.DataFrame:
        found = [_unit_root(np.asarray(g, dtype=float), np.asarray(e, dtype=float)) for g, e in zip(gram, early)]
        return pd.DataFrame(found, columns=result.names)

    return packed.select(*by, solve("_gram", "_early").alias("_r")).select(*by, "_r.*")


def default_maxlag(n: int) -> int:
    return max(0, min(math.ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2))


def _unit_root(packed: np.ndarray, early: np.ndarray) -> tuple:
    """``early`` holds the values before the common sample, one more than the lag limit of the series."""
    width = (math.isqrt(8 * len(packed) + 1) - 1) // 2
    limit = width - 3
    gram = np.zeros((width, width))
    gram[np.triu_indices(width)] = packed
    gram = gram + np.triu(gram, 1).T
    if gram[limit + 1, limit + 1] < limit + 4:
        return (None,) * 7
    lag = best_lag(gram, limit)
    dy = np.diff(early, prepend=np.nan)
    for at in range(lag + 1, len(early)):
        x = np.zeros(width)
        x[0], x[limit + 1], x[limit + 2] = early[at - 1], 1.0, dy[at]
        x[1 : lag + 1] = dy[at - 1 : at - lag - 1 : -1]
        if np.isfinite(x).all():
            gram = gram + np.outer(x, x)
    keep = [0, *range(1, lag + 1), limit + 1]
    beta, rss, inverse = _regress(gram, keep, limit + 2)
    n = int(round(gram[limit + 1, limit + 1]))
    free = n - len(keep)
    if free <= 0 or rss <= 0.0:
        return (None, None, lag, n, None, None, None)
    tau = float(beta[0] / math.sqrt(rss / free * inverse[0, 0]))
    critical = [sum(c / n**i for i, c in enumerate(terms)) for terms in TAU_CRITICAL.values()]
    return (tau, unit_root_p_value(tau), lag, n, *critical)


# ------------------------------------------------------------ accuracy and alignment


def forecast_accuracy(df: DataFrame, by: Sequence[str], actual: str = "actual", forecast: str = "forecast") -> DataFrame:
    """Mean squared error and symmetric percentage error per series."""
    error = F.col(actual) - F.col(forecast)
    return df.groupBy(*by).agg(
        F.avg(error * error).alias("mse"), F.avg(symmetric_error(actual, forecast)).alias("smape")
    )


def align(actual: DataFrame, forecast: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Actual, part and forecast side by side for every date that has any."""
    return actual.join(forecast, list(keys), "full_outer")
