"""Web-server logs: parse, find bad rows, clean, and report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.functions import expressions as E

FIELDS = ("host", "timestamp", "method", "endpoint", "protocol", "status", "content_size")


def parse(
    lines: DataFrame,
    value: str = "value",
    keep_line: bool = False,
    any_host: bool = False,
    any_zone: bool = False,
) -> DataFrame:
    """One row per line. Text fields that do not match are blank, numbers null.

    The quoted request is matched once and then split, because its three
    fields hold no white space.
    """
    line = F.col(value)
    request = F.regexp_extract(line, E.REQUEST_PATTERN, 0)
    cut = lines.select(
        *([line.alias("value")] if keep_line else []),
        F.regexp_extract(line, E.ANY_HOST_PATTERN if any_host else E.HOST_PATTERN, 1).alias("host"),
        F.regexp_extract(line, E.ANY_ZONE_TIME_PATTERN if any_zone else E.TIME_PATTERN, 1).alias("timestamp"),
        F.split(request.substr(F.lit(2), F.greatest(F.length(request) - 2, F.lit(0))), r"\s+").alias("_words"),
        F.regexp_extract(line, E.STATUS_PATTERN, 1).try_cast("int").alias("status"),
        F.regexp_extract(line, E.SIZE_PATTERN, 1).try_cast("bigint").alias("content_size"),
    )

    def word(i: int, name: str) -> Column:
        return F.coalesce(F.get("_words", F.lit(i)), F.lit("")).alias(name)

    return cut.select(
        *(["value"] if keep_line else []),
        "host",
        "timestamp",
        word(0, "method"),
        word(1, "endpoint"),
        word(2, "protocol"),
        "status",
        "content_size",
    )


def unparsed(lines: DataFrame, pattern: str, value: str = "value") -> DataFrame:
    """Lines that fail one parse rule, beside what the other rules found."""
    return parse(lines.where(~F.col(value).rlike(pattern)), value, keep_line=True)


def any_null(columns) -> Column:
    """True where at least one of the columns is null."""
    found = F.lit(False)
    for name in columns:
        found = found | F.col(name).isNull()
    return found


def clean(parsed: DataFrame, use_zone: bool = False) -> DataFrame:
    """Drop rows without a status, set missing sizes to 0, turn the time text into a timestamp."""
    filled = parsed.where(F.col("status").isNotNull()).na.fill({"content_size": 0})
    return filled.withColumn("time", E.clf_time("timestamp", use_zone)).drop("timestamp")


def counts_by(logs: DataFrame, *keys) -> DataFrame:
    return logs.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def top_counts(logs: DataFrame, key: str, n: int) -> DataFrame:
    """The n most frequent values; ties are broken by the value itself."""
    return counts_by(logs, key).orderBy(F.desc("count"), F.asc(key)).limit(n)


def status_frequencies(logs: DataFrame) -> DataFrame:
    """Rows per status with the natural log of the count."""
    return counts_by(logs, "status").withColumn("log_count", F.log("count")).orderBy("status")


def error_endpoints(logs: DataFrame, n: int = 10) -> DataFrame:
    return top_counts(logs.where(F.col("status") != 200), "endpoint", n)


def not_found(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("status") == 404)


def daily_unique_hosts(logs: DataFrame, approximate: bool = False, by_date: bool = False) -> DataFrame:
    """Distinct hosts per day of month, or per calendar date when months are mixed."""
    day = F.to_date("time").alias("day") if by_date else F.dayofmonth("time").alias("day")
    hosts = F.approx_count_distinct("host") if approximate else F.countDistinct("host")
    return logs.groupBy(day).agg(hosts.alias("hosts")).orderBy("day")


def counts_by_day(logs: DataFrame) -> DataFrame:
    return counts_by(logs, F.dayofmonth("time").alias("day")).orderBy("day")


def counts_by_hour(logs: DataFrame) -> DataFrame:
    return counts_by(logs, F.hour("time").alias("hour")).orderBy("hour")
