"""Series operators: everything is per series, along an explicit order.

``by`` names the series, ``order`` the time key(s); together they identify a
row. Frames come from :mod:`tabulon.operators.ordered`, so one very long
series is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.operators.ordered import (
    RUN_ROWS,
    frames,
    running_totals,
    sized_positions,
    with_group_values,
)

WORK = ("pos", "_chunk", "_home")


def _finish(df: DataFrame) -> DataFrame:
    return df.where("_home").drop(*WORK)


def shifted(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    lags: dict[str, int],
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """Add earlier values of the series: ``{new column: lag}``."""
    cut = frames(df, by, order, max(lags.values()), run_rows)
    w = Window.partitionBy(*cut.keys).orderBy(*cut.order)
    out = cut.df.select("*", *[F.lag(value, lag).over(w).alias(name) for name, lag in lags.items()])
    return _finish(out)


def previous(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str, run_rows: int = RUN_ROWS) -> DataFrame:
    return shifted(df, by, order, value, {name: 1}, run_rows)


def rolling(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, size: int, run_rows: int = RUN_ROWS
) -> DataFrame:
    """Mean and sample deviation of the last ``size`` values, null until the window is full."""
    cut = frames(df, by, order, size - 1, run_rows)
    w = Window.partitionBy(*cut.keys).orderBy(*cut.order).rowsBetween(-(size - 1), 0)
    full = F.count(value).over(w) == size
    out = cut.df.select(
        "*",
        F.when(full, F.avg(value).over(w)).alias("rolling_mean"),
        F.when(full, F.stddev_samp(value).over(w)).alias("rolling_std"),
    )
    return _finish(out)


def _with_earlier(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, lag: int, run_rows: int) -> DataFrame:
    """Add ``_earlier``, a struct of the earlier value: null only where the series has no such row."""
    boxed = df.withColumn("_box", F.struct(F.col(value).alias("v")))
    return shifted(boxed, by, order, "_box", {"_earlier": lag}, run_rows).drop("_box")


def difference(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str = "diff", run_rows: int = RUN_ROWS
) -> DataFrame:
    """First difference; the first row of each series has none and is dropped.

    A null value gives null differences beside it; its row and the next one stay.
    """
    out = _with_earlier(df, by, order, value, 1, run_rows)
    return out.where(F.col("_earlier").isNotNull()).withColumn(name, F.col(value) - F.col("_earlier.v")).drop("_earlier")


def lag_pairs(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, lag: int, run_rows: int = RUN_ROWS
) -> DataFrame:
    """Pairs (value, value ``lag`` steps later), for every row that has one so far back; nulls stay."""
    out = _with_earlier(df, by, order, value, lag, run_rows).where(F.col("_earlier").isNotNull())
    return out.select(*by, *order, F.col("_earlier.v").alias("y_lag"), F.col(value).alias("y_now"))


def lag_correlation(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, lags: Sequence[int], run_rows: int = RUN_ROWS
) -> DataFrame:
    """Pearson correlation of the series with itself at each lag, from one pass."""
    out = shifted(df, by, order, value, {f"_l{k}": k for k in lags}, run_rows)
    wide = out.groupBy(*by).agg(*[F.corr(value, f"_l{k}").alias(f"_l{k}") for k in lags])
    rows = [F.struct(F.lit(k).alias("lag"), F.col(f"_l{k}").alias("corr")) for k in lags]
    return wide.select(*by, F.explode(F.array(*rows)).alias("row")).select(*by, "row.*")


def cumulate(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str = "total",
    seed: Column | None = None,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """Running sum, starting from ``seed`` when given: undoes a difference."""
    out = running_totals(df, by, order, {name: value}, run_rows)
    return out if seed is None else out.withColumn(name, F.col(name) + seed)


def first_values(df: DataFrame, by: Sequence[str], order: str, value: str, name: str = "first_value") -> DataFrame:
    """The first value of each series, as an aggregate (no sort, no window)."""
    return df.groupBy(*by).agg(F.min_by(value, order).alias(name))


def undo_difference(
    original: DataFrame, by: Sequence[str], order: str, value: str, diffs: DataFrame, diff: str, run_rows: int = RUN_ROWS
) -> DataFrame:
    """Values rebuilt from the first value of a series and its differences."""
    seeds = first_values(original, by, order, value, "_seed")
    summed = running_totals(diffs, by, [order], {"_sum": diff}, run_rows)
    return (
        with_group_values(summed, seeds, by)
        .withColumn("restored", F.col("_seed") + F.col("_sum"))
        .drop("_seed", "_sum")
    )


def chronological_split(
    df: DataFrame, by: Sequence[str], order: Sequence[str], share: float = 0.8, run_rows: int = RUN_ROWS
) -> DataFrame:
    """Mark the first ``share`` of each series as train, the rest as test."""
    sized = sized_positions(df, by, order, run_rows)
    part = F.when(F.col("pos") < F.floor(F.col("_n") * F.lit(float(share))), "train").otherwise("test")
    return sized.withColumn("part", part).drop("_n")


def last_rows(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int, run_rows: int = RUN_ROWS) -> DataFrame:
    """The last n rows of each series."""
    sized = sized_positions(df, by, order, run_rows)
    return sized.where(F.col("pos") >= F.col("_n") - n).drop("_n", "pos")


def sliding_windows(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, size: int = 60, run_rows: int = RUN_ROWS
) -> DataFrame:
    """The ``size`` values before each row as an array, for rows that have that many."""
    cut = frames(df, by, order, size, run_rows)
    w = Window.partitionBy(*cut.keys).orderBy(*cut.order).rowsBetween(-size, -1)
    out = cut.df.withColumn("window", F.collect_list(value).over(w))
    return _finish(out.where(F.size("window") == size))


def concat_series(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)
