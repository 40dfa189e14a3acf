"""Positions, running totals and frames over an order, for groups of any length.

A window without a bounded partition sends a whole group to one task. Here a
group longer than ``run_rows`` is range-partitioned into runs; each run is
summed on its own and the totals of earlier runs are carried in. Groups at or
below the limit use one plain window. Both ways give the same sums: null until
the first value, and nulls add nothing.

The columns in ``by`` and ``order`` together must identify a row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.session import settle

RUN_ROWS = 250_000
RUNS_PER_CORE = 8


def as_column(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match; keeps one copy of the keys."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def group_extent(df: DataFrame, by: Sequence[str]) -> tuple[int, int]:
    """Rows in the longest group and rows in all: two numbers, whatever the size."""
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.max("n").alias("longest"), F.sum("n").alias("total")).first()
    return int(row["longest"] or 0), int(row["total"] or 0)


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    sums: dict[str, str | Column],
    run_rows: int = RUN_ROWS,
    extent: tuple[int, int] | None = None,
) -> DataFrame:
    """Add inclusive running sums ``{new column: value}`` within ``by`` along ``order``.

    ``extent`` is the result of :func:`group_extent` when the caller has it already.
    """
    by = list(by)
    order = [as_column(o) for o in order]
    values = {f"_v_{name}": as_column(value) for name, value in sums.items()}
    base = df.select("*", *[value.alias(v) for v, value in values.items()])
    longest, total = extent or group_extent(df, by)

    if longest <= run_rows:
        frame = (
            Window.partitionBy(*by)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return base.select(*df.columns, *[F.sum(f"_v_{name}").over(frame).alias(name) for name in sums])

    # No more runs than a few for each core: a window inside a run streams, however long it is.
    runs = min(max(2, math.ceil(total / run_rows)), RUNS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)
    ranged = settle(
        base.repartitionByRange(runs, *[F.col(k) for k in by], *order).withColumn("_run", F.spark_partition_id())
    )
    before = Window.partitionBy(*by).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        ranged.groupBy(*by, "_run")
        .agg(*[F.sum(v).alias(v) for v in values])
        .select(*by, "_run", *[F.sum(v).over(before).alias(f"_c{v}") for v in values])
    )
    within = (
        Window.partitionBy(*by, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = null_safe_join(ranged, carry, [*by, "_run"])

    def total_of(name: str) -> Column:
        carried, inside = F.col(f"_c_v_{name}"), F.sum(f"_v_{name}").over(within)
        return F.coalesce(carried + inside, carried, inside).alias(name)

    return joined.select(*df.columns, *[total_of(name) for name in sums])


def positions(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    name: str = "pos",
    run_rows: int = RUN_ROWS,
    extent: tuple[int, int] | None = None,
) -> DataFrame:
    """Add the zero-based position of each row within its group."""
    counted = running_totals(df, by, order, {name: F.lit(1)}, run_rows, extent)
    return counted.withColumn(name, F.col(name).cast("bigint") - 1)


def sized_positions(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], run_rows: int = RUN_ROWS) -> DataFrame:
    """Add ``pos`` and the number of rows of the group as ``_n``."""
    extent = group_extent(df, by)
    placed = positions(df, by, order, run_rows=run_rows, extent=extent)
    if extent[0] <= run_rows:
        return placed.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*by)))
    return with_group_values(placed, group_sizes(df, by, "_n"), by)


class Frames(NamedTuple):
    """A table cut for windows: partition by ``keys``, order by ``order``, keep rows where ``_home``."""

    df: DataFrame
    keys: list[str]
    order: list[Column]
    split: bool


def frames(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    back: int,
    run_rows: int = RUN_ROWS,
    with_pos: bool = False,
) -> Frames:
    """Prepare windows that reach ``back`` rows into the past.

    Groups within ``run_rows`` stay whole. Longer ones are cut into chunks
    that also hold the ``back`` rows before them, from one or more earlier
    chunks; those borrowed rows have
    ``_home = false`` and are dropped after the window is computed.
    """
    extent = group_extent(df, by)
    if extent[0] <= run_rows:
        whole = positions(df, by, order, run_rows=run_rows, extent=extent) if with_pos else df
        return Frames(whole.withColumn("_home", F.lit(True)), list(by), [as_column(o) for o in order], False)
    placed = positions(df, by, order, run_rows=run_rows, extent=extent)
    own = F.floor(F.col("pos") / F.lit(run_rows)).cast("bigint")
    # A chunk borrows from as many chunks before it as the window reaches over.
    furthest = F.floor((F.col("pos") + F.lit(back)) / F.lit(run_rows)).cast("bigint")
    chunked = placed.select("*", own.alias("_own"), F.explode(F.sequence(own, furthest)).alias("_chunk")).withColumn("_home", F.col("_own") == F.col("_chunk"))
    return Frames(chunked.drop("_own"), [*by, "_chunk"], [F.col("pos")], True)


def group_sizes(df: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def one_row(values: DataFrame) -> Column:
    """A one-row table as one scalar subquery; read its columns as fields."""
    return values.select(F.struct(*values.columns).alias("row")).scalar()


def with_group_values(df: DataFrame, values: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach per-group values; without keys they are one row, read as a scalar subquery."""
    if by:
        return null_safe_join(df, values, list(by))
    row = one_row(values)
    return df.select("*", *[row[c].alias(c) for c in values.columns])


#: Bins that a histogram pass cuts the values of a group into.
BINS = 1024


def _bin(value: Column, low: Column, high: Column) -> Column:
    """The bin of a value, rising with it; infinite values and NaN have bins of their own at the ends."""
    share = (value / 2 - low / 2) / (high / 2 - low / 2)
    inside = F.least(F.lit(BINS - 1), F.floor(share * BINS).cast("int"))
    infinite = F.when(value == F.lit(float("inf")), BINS).when(value == F.lit(float("-inf")), -1)
    return F.when(F.isnan(value), BINS + 1).otherwise(F.coalesce(infinite, F.when(high > low, inside).otherwise(0)))


def _limits() -> list[Column]:
    x = F.col("_value")
    finite = F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)
    return [F.min(finite).alias("_low"), F.max(finite).alias("_high")]


def _narrowed(
    rows: DataFrame, keys: Sequence[str], limits: DataFrame, ranks: DataFrame, name: str
) -> tuple[DataFrame, DataFrame, int]:
    """The rows of the bins that hold a rank asked for, those bins' ranks, and the most rows of such a bin.

    ``ranks`` has for each group the ranks asked for as ``_ranks``. The bins become one more key, and
    ranks count from the begin of their bin.
    """
    placed = with_group_values(rows, limits.select(*keys, "_low", "_high"), keys)
    placed = placed.withColumn(name, _bin(F.col("_value"), F.col("_low"), F.col("_high"))).drop("_low", "_high")
    counts = placed.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("_n"))
    # At most as many rows as bins in each group.
    upto = Window.partitionBy(*keys).orderBy(name).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = with_group_values(counts.withColumn("_upto", F.sum("_n").over(upto)), ranks, keys)
    before = F.col("_upto") - F.col("_n")
    held = F.filter("_ranks", lambda r: (r["at"] >= before) & (r["at"] < F.col("_upto")))
    local = F.transform(held, lambda r: F.struct(r["id"].alias("id"), (r["at"] - before).alias("at")))
    wanted = settle(counts.where(F.size(held) > 0).select(*keys, name, "_n", local.alias("_ranks")))
    most = wanted.agg(F.max("_n")).first()[0] or 0
    return null_safe_join(placed, wanted.select(*keys, name), [*keys, name], "left_semi"), wanted.drop("_n"), most


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """Linear-interpolated quantiles, one row per group.

    Selection by histograms: a pass finds the bins that hold the ranks asked for, and only rows of those bins
    go on; a second pass divides them again where one is still long. What is left is ordered, as (value, count)
    pairs. The table is read once for the sizes, twice for each pass and once to the end, but not sorted.
    """
    by = list(by)
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probabilities])
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_value"))
    totals = settle(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_total"), *_limits()))
    spots = [(F.col("_total") - 1) * F.lit(float(p)) for p in probabilities]
    asked = [F.struct(F.lit(2 * i + k).alias("id"), end(spot).cast("bigint").alias("at"))
             for i, spot in enumerate(spots) for k, end in enumerate((F.floor, F.ceil))]
    rest, ranks, most = _narrowed(rows, by, totals, totals.select(*by, F.array(*asked).alias("_ranks")), "_bin1")
    keys = [*by, "_bin1"]
    if most > run_rows:
        rest, ranks, _ = _narrowed(rest, keys, settle(rest.groupBy(*keys).agg(*_limits())), ranks, "_bin2")
        keys.append("_bin2")
    counts = settle(rest.groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("_n")))
    placed = null_safe_join(running_totals(counts, keys, ["_value"], {"_upto": "_n"}, run_rows), ranks, keys)
    here = F.filter("_ranks", lambda r: (r["at"] >= F.col("_upto") - F.col("_n")) & (r["at"] < F.col("_upto")))
    found = placed.select(*by, "_value", F.explode(F.transform(here, lambda r: r["id"])).alias("_id"))
    at = [F.max(F.when(F.col("_id") == i, F.col("_value"))).alias(f"_v{i}") for i in range(2 * len(names))]
    found = with_group_values(totals, found.groupBy(*by).agg(*at), by)
    low = lambda i: F.col(f"_v{2 * i}")
    outputs = [(low(i) + (F.col(f"_v{2 * i + 1}") - low(i)) * (s - F.floor(s))).alias(n) for i, (s, n) in enumerate(zip(spots, names))]
    return found.select(*by, *outputs)
