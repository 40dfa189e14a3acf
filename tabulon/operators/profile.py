"""Profiles of a table: counts, nulls, blanks, summaries, histograms, reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions.expressions import blank
from tabulon.operators.ordered import exact_quantiles, null_safe_join, with_group_values


def long_form(wide: DataFrame, columns: Sequence[str], measures: Sequence[str], key: str = "column_name") -> DataFrame:
    """A one-row table with ``<column>__<measure>`` fields as one row per column."""
    rows = [
        F.struct(F.lit(c).alias(key), *[F.col(f"`{c}__{m}`").alias(m) for m in measures]) for c in columns
    ]
    return wide.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls, blanks and rows of every column, from one pass.

    Text that failed to parse is blank, not null, so both are counted.
    """
    columns = list(columns or df.columns)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    measures = []
    for c in columns:
        measures += [
            F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
            (F.count_if(blank(c)) if c in text else F.lit(0).cast("bigint")).alias(f"{c}__blanks"),
            F.count(F.lit(1)).alias(f"{c}__rows"),
        ]
    return long_form(df.agg(*measures), columns, ["nulls", "blanks", "rows"])


def has_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: is any value of the table null?"""
    found = F.lit(False)
    for c in columns or df.columns:
        found = found | F.col(c).isNull()
    return df.agg(F.coalesce(F.bool_or(found), F.lit(False)).alias("any_null"))


def integrity(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Row count, column check and total null count before a load."""
    nulls = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(nulls).alias("nulls")).select(
        "rows",
        "nulls",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(list(df.columns) == list(expected)).alias("columns_match"),
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def table_schema(df: DataFrame) -> DataFrame:
    """Name, type and non-null count of each column."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    measured = df.agg(*[F.count(c).alias(f"{c}__non_null") for c in df.columns])
    with_types = measured.select("*", *[F.lit(types[c]).alias(f"{c}__type") for c in df.columns])
    return long_form(with_types, df.columns, ["type", "non_null"])


def global_stats(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.min(c).alias(f"min_{column}"),
        F.max(c).alias(f"max_{column}"),
        F.avg(c).alias(f"mean_{column}"),
        F.stddev_samp(c).alias(f"std_{column}"),
        F.count(c).alias(f"count_{column}"),
    )


def summary_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), quartiles: bool = True) -> DataFrame:
    """count, mean, std, min, quartiles and max as numbers, one row per group and column."""
    by = list(by)
    measures = ["count", "mean", "std", "min", "max"]
    aggregates = []
    for c in columns:
        x = F.col(c).cast("double")
        aggregates += [
            F.count(x).alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    wide = df.groupBy(*by).agg(*aggregates)
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}__{m}`").alias(m) for m in measures]) for c in columns
    ]
    long = wide.select(*by, F.explode(F.array(*rows)).alias("row")).select(*by, "row.*")
    if not quartiles:
        return long
    names = ["q25", "q50", "q75"]
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    tall = df.select(*by, F.explode(F.array(*pairs)).alias("row")).select(*by, "row.*")
    cuts = exact_quantiles(tall, "value", [0.25, 0.5, 0.75], [*by, "column_name"], names)
    return null_safe_join(long, cuts, [*by, "column_name"], "left")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and largest value, empty bins left out."""
    x = F.col(column).cast("double")
    limits = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    placed = with_group_values(df.where(x.isNotNull()).select(x.alias("_x")), limits, [])
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    step = F.coalesce(F.floor(F.try_divide(F.col("_x") - F.col("_lo"), width)).cast("int"), F.lit(0))
    return (
        placed.select(F.least(F.lit(bins), step + 1).alias("bin"), "_lo", width.alias("_width"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"), F.min("_lo").alias("_lo"), F.min("_width").alias("_width"))
        .select(
            "bin",
            (F.col("_lo") + (F.col("bin") - 1) * F.col("_width")).alias("bin_start"),
            (F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_end"),
            "count",
        )
    )


def mean_per_x(df: DataFrame, x: str | Column, y: str) -> DataFrame:
    """Mean, spread and count of y for every repeated x: the data behind a line plot."""
    return df.groupBy(F.col(x).alias("x") if isinstance(x, str) else x.alias("x")).agg(
        F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"), F.count(y).alias("count")
    )


def indicator_matrix(df: DataFrame, row: str, column: str, values: Sequence, cell: str, prefix: str = "c") -> DataFrame:
    """Rows by column values, mean of ``cell``, 0 where nothing was seen.

    The values are given, so no extra pass looks for them and the schema is fixed.
    """
    cells = [
        F.coalesce(F.avg(F.when(F.col(column) == F.lit(v), F.col(cell))), F.lit(0.0)).alias(f"{prefix}{v}")
        for v in values
    ]
    return df.groupBy(row).agg(*cells)


def cross_tab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows for each pair of keys, sorted by both keys descending."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("value")).orderBy(F.desc(a), F.desc(b))


def unstack(pairs: DataFrame, row: str, column: str, value: str, values: Sequence, prefix: str) -> DataFrame:
    """A two-key count as a wide table; pairs never seen stay null."""
    cells = [F.sum(F.when(F.col(column) == F.lit(v), F.col(value))).alias(f"{prefix}{v}") for v in values]
    return pairs.groupBy(row).agg(*cells)


def rows_at_max(df: DataFrame, column: str) -> DataFrame:
    """Every row that attains the largest value of the column."""
    top = df.agg(F.max(column).alias("_top"))
    return df.join(top, F.col(column) == F.col("_top"), "left_semi")
