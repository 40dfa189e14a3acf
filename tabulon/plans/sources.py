"""Reading, writing and naming tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators import logs, profile
from tabulon.plans import standins as S
from tabulon.plans.registry import query
from tabulon.session import scratch_path
from tabulon.sources import catalog, files

FACILITY_COLUMNS = "facid BIGINT, name STRING, membercost DOUBLE, guestcost DOUBLE, monthlymaintenance DOUBLE"
FACILITY_SQL = S.with_sql(S.FACILITIES_SQL) + "SELECT * FROM facilities"


@query("a01_text_scan", S.with_sql(S.LINES_SQL) + "SELECT value FROM lines")
def text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.write_lines(S.log_lines(spark, sf_dir), scratch_path(spark, "lines"))
    return files.read_lines(spark, f"{path}/*.txt")


@query("a02_csv_scan", FACILITY_SQL)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.write_csv(S.facilities(spark, sf_dir), scratch_path(spark, "facilities"))
    return files.read_csv(spark, path, FACILITY_COLUMNS)


@query("a02_csv_scan_inferred", FACILITY_SQL)
def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.write_csv(S.facilities(spark, sf_dir), scratch_path(spark, "facilities"))
    read = files.read_csv(spark, path, None)
    return read.withColumn("facid", F.col("facid").cast("bigint"))


@query("a03_csv_declared_table", S.with_sql(S.CENSUS_SQL) + "SELECT education, count(*) AS n FROM census GROUP BY 1")
def csv_declared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.write_csv(
        S.census(spark, sf_dir).select("age", "education", "hours_per_week"), scratch_path(spark, "census")
    )
    name = f"census_{uuid.uuid4().hex[:8]}"
    table = catalog.csv_table(spark, name, "age DOUBLE, education STRING, hours_per_week DOUBLE", path)
    return table.groupBy("education").agg(F.count(F.lit(1)).alias("n"))


@query("a04_first_lines")
def first_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = logs.clean(logs.parse(S.log_lines(spark, sf_dir)))
    return files.first_lines(spark, files.write_csv(clean, scratch_path(spark, "logs")), 5)


@query("a04_lowest_lines", """
SELECT value FROM (SELECT CAST(s_suppkey AS VARCHAR) || ',' || s_name || ',' || CAST(s_nationkey AS VARCHAR) AS value FROM supplier
UNION ALL SELECT 's_suppkey,s_name,s_nationkey') ORDER BY value LIMIT 5""")
def lowest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest lines of a CSV file with a header, as text."""
    rows = S.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return files.lowest_lines(spark, files.write_csv(rows, scratch_path(spark, "suppliers")), 5)


_CLEAN_SQL = S.with_sql(S.LINES_SQL, S.PARSED_SQL, S.LOGS_SQL) + 'SELECT * FROM logs'
_CLEAN_SCHEMA = (
    "host STRING, method STRING, endpoint STRING, protocol STRING, status INT, content_size BIGINT, time TIMESTAMP_NTZ"
)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = logs.clean(logs.parse(S.log_lines(spark, sf_dir)))
    return clean.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("a05_csv_sink", _CLEAN_SQL)
def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.write_csv(_clean(spark, sf_dir), scratch_path(spark, "logs"))
    return files.read_csv(spark, path, _CLEAN_SCHEMA).na.fill("")


@query("a06_json_sink", _CLEAN_SQL)
def json_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.write_json(_clean(spark, sf_dir), scratch_path(spark, "logs"))
    return files.read_json(spark, path, _CLEAN_SCHEMA)


def _club_database(spark: SparkSession, sf_dir: str) -> str:
    name = f"club_{uuid.uuid4().hex[:8]}"
    catalog.recreate_database(spark, name, scratch_path(spark, name))
    catalog.save_table(S.facilities(spark, sf_dir), f"{name}.facilities")
    catalog.save_table(S.members(spark, sf_dir), f"{name}.members")
    return name


@query("a07_table_sink", FACILITY_SQL)
def table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_club_database(spark, sf_dir)}.facilities")


@query("a07_bucketed_table_join", S.with_sql(S.BOOKINGS_SQL) + """
SELECT memid, count(*) AS n, round(sum(slots), 2) AS slots FROM bookings GROUP BY memid""")
def bucketed_table_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines bucketed on the order key join without a shuffle."""
    name = f"sales_{uuid.uuid4().hex[:8]}"
    catalog.recreate_database(spark, name, scratch_path(spark, name))
    orders = catalog.save_table(
        S.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("memid")),
        f"{name}.orders", "o_orderkey", 8,
    )
    items = catalog.save_table(
        S.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity"),
        f"{name}.lineitem", "o_orderkey", 8,
    )
    return items.join(orders, "o_orderkey").groupBy("memid").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("slots")
    )


@query("a08_databases")
def databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _club_database(spark, sf_dir)
    return catalog.list_databases(spark).where(F.col("namespace") == name).select(F.lit(True).alias("created"))


@query("a09_tables", """SELECT 'facilities' AS name, count(*) AS "rows" FROM part UNION ALL SELECT 'members', count(*) FROM customer""")
def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Use the database, refresh and list its tables, and count each one by its short name."""
    before, name = spark.catalog.currentDatabase(), _club_database(spark, sf_dir)
    catalog.use_database(spark, name)
    try:
        parts = None
        for row in catalog.list_tables(spark, name).collect():
            catalog.refresh(spark, row["tableName"])
            part = spark.table(row["tableName"]).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(row["tableName"]).alias("name"), "rows")
            parts = part if parts is None else parts.unionByName(part)
        return parts
    finally:
        catalog.use_database(spark, before)


@query("a10_named_view", S.with_sql(S.CENSUS_SQL) + """
SELECT occupation, count(*) AS n FROM census GROUP BY 1""")
def named_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = catalog.register(S.census(spark, sf_dir), f"census_view_{uuid.uuid4().hex[:8]}")
    counts = spark.sql(f"SELECT occupation, count(*) AS n FROM {name} GROUP BY 1")
    spark.catalog.dropTempView(name)
    return counts


@query("a11_price_csv", S.with_sql(S.DAILY_SQL) + "SELECT t, y FROM daily")
def price_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.write_csv(S.daily(spark, sf_dir).select("t", "y"), scratch_path(spark, "prices"))
    return files.read_csv(spark, path, "t STRING, y DOUBLE").select(F.to_date("t").alias("t"), "y")


@query("a12_small_rows", S.with_sql(S.CENSUS_SQL) + """
SELECT c.occupation, w.rank FROM (SELECT DISTINCT occupation FROM census) c
JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2)) w(name, rank) ON c.occupation = w.name""")
def small_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few driver rows as a table, joined to the data."""
    ranks = spark.createDataFrame([("1-URGENT", 1), ("2-HIGH", 2)], "occupation string, rank int")
    return S.census(spark, sf_dir).select("occupation").distinct().join(F.broadcast(ranks), "occupation")


@query("a13_bounded_to_pandas", S.with_sql(S.LINES_SQL, S.PARSED_SQL, S.LOGS_SQL) + """
SELECT status, count(*) AS count FROM logs GROUP BY 1""")
def bounded_to_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status counts go through pandas: the result is bounded by the number of status codes."""
    counts = logs.counts_by(logs.clean(logs.parse(S.log_lines(spark, sf_dir))), "status")
    return spark.createDataFrame(counts.toPandas(), "status int, count bigint")


@query("a14_shape", 'SELECT count(*) AS "rows", 6 AS "columns" FROM events')
def shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shape(S.table(spark, sf_dir, "events"))


@query("a14_schema", """
SELECT * FROM (VALUES ('event_id', 'bigint', (SELECT count(event_id) FROM events)),
  ('ts', 'timestamp_ntz', (SELECT count(ts) FROM events)), ('user_id', 'bigint', (SELECT count(user_id) FROM events)),
  ('event_type', 'string', (SELECT count(event_type) FROM events)),
  ('value', 'double', (SELECT count(value) FROM events)), ('props', 'string', (SELECT count(props) FROM events)))
  v(column_name, type, non_null)""")
def schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_schema(S.table(spark, sf_dir, "events"))


@query("a15_cached_branches", S.with_sql(S.LINES_SQL, S.PARSED_SQL, S.LOGS_SQL) + """
SELECT 'errors' AS part, count(*) AS n FROM logs WHERE status <> 200
UNION ALL SELECT 'endpoints', count(DISTINCT endpoint) FROM logs WHERE status <> 200""")
def cached_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two answers from one kept intermediate."""
    errors = logs.clean(logs.parse(S.log_lines(spark, sf_dir))).where(F.col("status") != 200).persist()
    n, endpoints = errors.count(), errors.agg(F.countDistinct("endpoint")).first()[0]
    errors.unpersist()
    return spark.createDataFrame([("errors", n), ("endpoints", endpoints)], "part string, n bigint")


@query("a16_rename_all", "SELECT user_id AS customer_name, CAST(day(ts) AS INTEGER) AS offer_id, 1 AS n FROM events")
def rename_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = S.table(spark, sf_dir, "events").select("user_id", F.dayofmonth("ts"))
    return files.rename_all(pairs, ["customer_name", "offer_id"]).withColumn("n", F.lit(1))
