"""Web-log questions: parsing, bad rows, cleaning, frequencies, errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions import expressions as E
from tabulon.operators import logs, profile
from tabulon.plans import standins as S
from tabulon.plans.registry import query, r4

_PARSED = S.with_sql(S.LINES_SQL, S.PARSED_SQL)
_LOGS = S.with_sql(S.LINES_SQL, S.PARSED_SQL, S.LOGS_SQL)


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.parse(S.log_lines(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.clean(parsed(spark, sf_dir))


@query("b01_projection", _LOGS + """
SELECT host, upper(endpoint) AS page, status, content_size / 1024.0::DOUBLE AS kilobytes FROM logs""")
def projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clean(spark, sf_dir).withColumn("page", F.upper("endpoint"))
    return out.withColumn("kilobytes", F.col("content_size") / 1024.0).drop(
        "method", "endpoint", "protocol", "time", "content_size"
    )


@query("b02_comparison_filters", _LOGS + """
SELECT host, endpoint, status, content_size FROM logs
WHERE status <> 200 AND status < 400 AND content_size > 100 AND "method" = 'GET'""")
def comparison_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = (F.col("status") != 200) & (F.col("status") < 400) & (F.col("content_size") > 100) & (F.col("method") == "GET")
    return clean(spark, sf_dir).where(kept).select("host", "endpoint", "status", "content_size")


@query("b03_any_null_rows", _PARSED + """
SELECT host, endpoint, status, content_size FROM parsed WHERE status IS NULL OR content_size IS NULL""")
def any_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).where(logs.any_null(logs.FIELDS)).select("host", "endpoint", "status", "content_size")


@query("b07_unparsed_status", _PARSED + """
SELECT value FROM lines WHERE NOT regexp_matches(value, '\\s(\\d{3})\\s')""")
def unparsed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.log_lines(spark, sf_dir).where(~F.col("value").rlike(E.STATUS_PATTERN))


@query("b09_casts", _PARSED + """
SELECT status, content_size, try_strptime(substr("timestamp", 1, 20), '%d/%b/%Y:%H:%M:%S') AS "time" FROM parsed""")
def casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).select(
        "status", "content_size", E.clf_time("timestamp").cast("timestamp_ntz").alias("time")
    )


@query("b10_null_split", _PARSED + """
SELECT status IS NULL AS missing, count(*) AS n FROM parsed GROUP BY 1""")
def null_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parsed(spark, sf_dir)
    bad = rows.where(F.col("status").isNull()).agg(F.count(F.lit(1)).alias("n")).select(F.lit(True).alias("missing"), "n")
    good = rows.where(F.col("status").isNotNull()).agg(F.count(F.lit(1)).alias("n")).select(F.lit(False).alias("missing"), "n")
    return bad.unionByName(good)


@query("b11_fill_nulls", _PARSED + """
SELECT host, coalesce(status, -1) AS status, coalesce(content_size, 0) AS content_size FROM parsed""")
def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).na.fill({"content_size": 0, "status": -1}).select("host", "status", "content_size")


@query("b12_drop_null_rows", _PARSED + """
SELECT host, endpoint, status, content_size FROM parsed WHERE status IS NOT NULL AND content_size IS NOT NULL""")
def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).na.drop().select("host", "endpoint", "status", "content_size")


@query("b12_has_null", _PARSED + """
SELECT bool_or(status IS NULL OR content_size IS NULL) AS any_null FROM parsed""")
def has_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.has_null(parsed(spark, sf_dir))


@query("b13_bad_row_report", _PARSED + """
SELECT * FROM parsed WHERE NOT regexp_matches(value, '\\s(\\d{3})\\s')""")
def bad_row_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.unparsed(S.log_lines(spark, sf_dir), E.STATUS_PATTERN)


@query("b13_bad_size_report", _PARSED + """
SELECT * FROM parsed WHERE NOT regexp_matches(value, '\\s\\d+$')""")
def bad_size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.unparsed(S.log_lines(spark, sf_dir), E.SIZE_PATTERN)


@query("b14_integrity", _LOGS + """
SELECT count(*) AS "rows", 0::BIGINT AS nulls, 7 AS n_columns, true AS columns_match FROM logs""")
def integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = ["host", "method", "endpoint", "protocol", "status", "content_size", "time"]
    return profile.integrity(clean(spark, sf_dir), expected)


@query("d01_status_counts", _LOGS + "SELECT status, count(*) AS count FROM logs GROUP BY 1 ORDER BY 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.counts_by(clean(spark, sf_dir), "status").orderBy("status")


@query("d02_filtered_count", _LOGS + "SELECT count(endpoint) AS n FROM logs WHERE status = 404")
def filtered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.not_found(clean(spark, sf_dir)).agg(F.count("endpoint").alias("n"))


@query("d03_size_stats", _LOGS + f"""
SELECT min(content_size) AS min_content_size, max(content_size) AS max_content_size,
  {r4('avg(content_size)')} AS mean_content_size, {r4('stddev_samp(content_size)')} AS std_content_size,
  count(content_size) AS count_content_size FROM logs""")
def size_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profile.global_stats(clean(spark, sf_dir), "content_size")
    return stats.withColumn("mean_content_size", E.tidy(F.col("mean_content_size"))).withColumn(
        "std_content_size", E.tidy(F.col("std_content_size"))
    )


@query("d11_distinct_pairs", _LOGS + "SELECT DISTINCT host, CAST(day(\"time\") AS INTEGER) AS day FROM logs")
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir).select("host", F.dayofmonth("time").alias("day")).dropDuplicates()


@query("d12_daily_unique_hosts", _LOGS + """
SELECT CAST(day("time") AS INTEGER) AS day, count(DISTINCT host) AS hosts FROM logs GROUP BY 1 ORDER BY 1""")
def daily_unique_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.daily_unique_hosts(clean(spark, sf_dir))


@query("d12_unique_hosts_by_date", _LOGS + """
SELECT CAST("time" AS DATE) AS day, count(DISTINCT host) AS hosts FROM logs GROUP BY 1 ORDER BY 1""")
def unique_hosts_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.daily_unique_hosts(clean(spark, sf_dir), by_date=True)


@query("d12_daily_unique_hosts_approx")
def daily_unique_hosts_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.daily_unique_hosts(clean(spark, sf_dir), approximate=True)


@query("d13_errors_by_day", _LOGS + """
SELECT CAST(day("time") AS INTEGER) AS day, count(*) AS count FROM logs WHERE status = 404 GROUP BY 1 ORDER BY 1""")
def errors_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.counts_by_day(logs.not_found(clean(spark, sf_dir)))


@query("d13_errors_by_hour", _LOGS + """
SELECT CAST(hour("time") AS INTEGER) AS hour, count(*) AS count FROM logs WHERE status = 404 GROUP BY 1 ORDER BY 1""")
def errors_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.counts_by_hour(logs.not_found(clean(spark, sf_dir)))


_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS nulls, "
    + (f"count(*) FILTER (WHERE trim(\"{c}\") = '')" if text else "0::BIGINT")
    + ' AS blanks, count(*) AS "rows" FROM parsed'
    for c, text in [("host", 1), ("timestamp", 1), ("method", 1), ("endpoint", 1), ("protocol", 1), ("status", 0), ("content_size", 0)]
)


@query("d14_null_profile", _PARSED + _NULLS)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_profile(parsed(spark, sf_dir))


@query("d15_distinct_statuses", _LOGS + "SELECT count(DISTINCT status) AS n FROM logs")
def distinct_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir).agg(F.countDistinct("status").alias("n"))


def _top(key: str, n: int, where: str = "") -> str:
    return _LOGS + f'SELECT {key}, count(*) AS count FROM logs {where} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {n}'


@query("f03_top_hosts", _top("host", 10))
def top_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.top_counts(clean(spark, sf_dir), "host", 10)


@query("f03_top_endpoints", _top("endpoint", 20))
def top_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.top_counts(clean(spark, sf_dir), "endpoint", 20)


@query("f03_top_error_endpoints", _top("endpoint", 10, "WHERE status <> 200"))
def top_error_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.error_endpoints(clean(spark, sf_dir), 10)


@query("f03_top_missing_endpoints", _top("endpoint", 20, "WHERE status = 404"))
def top_missing_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.top_counts(logs.not_found(clean(spark, sf_dir)), "endpoint", 20)


@query("h01_parse_fields", _PARSED + 'SELECT * EXCLUDE (value) FROM parsed')
def parse_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir)


@query("h01_parse_any_host", _PARSED + r"""
SELECT regexp_extract(value, '^(\S+)\s', 1) AS host, count(*) AS n FROM lines GROUP BY 1""")
def parse_any_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = logs.parse(S.log_lines(spark, sf_dir), any_host=True).select("host")
    return hosts.groupBy("host").agg(F.count(F.lit(1)).alias("n"))


@query("h02_log_time", _LOGS + 'SELECT host, "time" FROM logs')
def log_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir).select("host", F.col("time").cast("timestamp_ntz").alias("time"))


@query("h02_log_time_with_zone", _PARSED + """
SELECT try_strptime(substr("timestamp", 1, 20), '%d/%b/%Y:%H:%M:%S') + INTERVAL 4 HOUR AS "time"
FROM parsed WHERE status IS NOT NULL""")
def log_time_with_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logs.clean(logs.parse(S.log_lines(spark, sf_dir), any_zone=True), use_zone=True)
    return rows.select(F.to_utc_timestamp("time", F.current_timezone()).cast("timestamp_ntz").alias("time"))


@query("h04_day_and_hour", _LOGS + """
SELECT CAST(day("time") AS INTEGER) AS day, CAST(hour("time") AS INTEGER) AS hour, status FROM logs""")
def day_and_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir).select(F.dayofmonth("time").alias("day"), F.hour("time").alias("hour"), "status")


@query("h08_log_count", _LOGS + f"""
SELECT status, count(*) AS count, {r4('ln(count(*))')} AS log_count FROM logs GROUP BY 1""")
def log_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.status_frequencies(clean(spark, sf_dir)).withColumn("log_count", E.tidy(F.col("log_count")))


@query("i01_time_without_udf", _LOGS + """
SELECT CAST("time" AS DATE) AS day, count(*) AS n, min("time") AS first_time, max("time") AS last_time
FROM logs GROUP BY 1""")
def time_without_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time parse as a built-in expression, aggregated without leaving the JVM."""
    return (
        clean(spark, sf_dir)
        .groupBy(F.to_date("time").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("time").cast("timestamp_ntz").alias("first_time"),
            F.max("time").cast("timestamp_ntz").alias("last_time"),
        )
    )
