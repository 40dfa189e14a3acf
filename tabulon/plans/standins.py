"""The given tables in the shapes the operators expect, in Spark and as SQL.

Each Spark function has a SQL twin (a common table expression) for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions import expressions as E


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


# ---------------------------------------------------------------- web log

def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    user = F.col("user_id")
    host = F.concat(F.lit("u"), user.cast("string"), F.when(user % 10 == 0, "").otherwise(".example.org"))
    status = F.when(F.col("event_id") % 97 == 0, "-").otherwise(
        (F.lit(200) + F.col("event_id") % 5 * 51).cast("string")
    )
    size = F.when(F.col("event_id") % 7 == 0, "-").otherwise(F.col("event_id").cast("string"))
    protocol = F.when(F.col("event_id") % 11 == 0, "").otherwise(" HTTP/1.0")
    line = F.concat(
        host, F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" -0400] \"GET /"),
        F.col("event_type"), F.lit("/"), (user % 40).cast("string"), protocol, F.lit("\" "), status, F.lit(" "), size,
    )
    broken = F.concat(F.lit("unreadable "), F.col("event_id").cast("string"), F.lit("x"))
    return e.select(F.when(F.col("event_id") % 499 == 0, broken).otherwise(line).alias("value"))


LINES_SQL = """lines AS (
  SELECT CASE WHEN event_id % 499 = 0 THEN 'unreadable ' || event_id || 'x' ELSE
    'u' || user_id || CASE WHEN user_id % 10 = 0 THEN '' ELSE '.example.org' END
    || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400] "GET /' || event_type || '/' || (user_id % 40)
    || CASE WHEN event_id % 11 = 0 THEN '' ELSE ' HTTP/1.0' END || '" '
    || CASE WHEN event_id % 97 = 0 THEN '-' ELSE CAST(200 + event_id % 5 * 51 AS VARCHAR) END || ' '
    || CASE WHEN event_id % 7 = 0 THEN '-' ELSE CAST(event_id AS VARCHAR) END END AS value
  FROM events)"""

def _field(pattern: str, group: int = 1) -> str:
    return f"regexp_extract(value, '{pattern}', {group})"


PARSED_SQL = f"""parsed AS (
  SELECT value,
    {_field(E.HOST_PATTERN)} AS host,
    {_field(E.TIME_PATTERN)} AS "timestamp",
    {_field(E.REQUEST_PATTERN, 1)} AS "method",
    {_field(E.REQUEST_PATTERN, 2)} AS endpoint,
    {_field(E.REQUEST_PATTERN, 3)} AS protocol,
    TRY_CAST({_field(E.STATUS_PATTERN)} AS INTEGER) AS status,
    TRY_CAST({_field(E.SIZE_PATTERN)} AS BIGINT) AS content_size
  FROM lines)"""

LOGS_SQL = """logs AS (
  SELECT host, "method", endpoint, protocol, status, coalesce(content_size, 0) AS content_size,
    try_strptime(substr("timestamp", 1, 20), '%d/%b/%Y:%H:%M:%S') AS "time"
  FROM parsed WHERE status IS NOT NULL)"""

# ---------------------------------------------------------------- club

def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("facid"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 5 == 0, 0.0).otherwise(price).alias("membercost"),
        (price * 1.2).alias("guestcost"),
        (F.col("p_size") * 200.0).alias("monthlymaintenance"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.split("c_name", "#")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("memid"),
        name[0].alias("firstname"),
        name[1].alias("surname"),
        F.col("c_acctbal").alias("joindate"),
    )


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("memid"))
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("facid"),
        F.col("l_quantity").alias("slots"),
        F.col("l_shipdate").alias("starttime"),
    )
    return items.join(orders, "o_orderkey").select(
        F.col("o_orderkey").alias("bookid"), "line", "facid", "memid", "slots", "starttime"
    )


FACILITIES_SQL = """facilities AS (
  SELECT p_partkey AS facid, p_name AS name,
    CASE WHEN p_size % 5 = 0 THEN 0.0::DOUBLE ELSE p_retailprice END AS membercost,
    p_retailprice * 1.2::DOUBLE AS guestcost, p_size * 200.0::DOUBLE AS monthlymaintenance FROM part)"""
MEMBERS_SQL = """members AS (
  SELECT c_custkey AS memid, split_part(c_name, '#', 1) AS firstname, split_part(c_name, '#', 2) AS surname,
    c_acctbal AS joindate FROM customer)"""
BOOKINGS_SQL = """bookings AS (
  SELECT o_orderkey AS bookid, l_linenumber AS line, l_partkey AS facid, o_custkey AS memid,
    l_quantity AS slots, l_shipdate AS starttime
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

# ---------------------------------------------------------------- census

def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    # The level names that the questions ask about.
    single = F.element_at(F.array(F.lit("Divorced"), F.lit("Separated"), F.lit("Widowed")), (key % 3 + 1).cast("int"))
    married = F.when(F.col("o_orderstatus") == "F", "Married-civ-spouse").when(
        F.col("o_orderstatus") == "O", "Never-married"
    ).otherwise(single)
    hours = F.floor(F.col("o_totalprice") / 10000) + key % 17
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        (F.lit(17) + F.col("o_custkey") % 60).cast("double").alias("age"),
        F.concat(F.lit(" grade-"), (F.col("o_custkey") % 6).cast("string")).alias("education"),
        F.concat(F.lit(" "), married).alias("marital_status"),
        F.col("o_orderpriority").alias("occupation"),
        hours.cast("double").alias("hours_per_week"),
        F.when(F.col("o_totalprice") > 300000, " >50K").otherwise(" <=50K").alias("income"),
    )


CENSUS_SQL = """census AS (
  SELECT o_orderkey AS id, CAST(17 + o_custkey % 60 AS DOUBLE) AS age, ' grade-' || (o_custkey % 6) AS education,
    ' ' || CASE WHEN o_orderstatus = 'F' THEN 'Married-civ-spouse' WHEN o_orderstatus = 'O' THEN 'Never-married'
      WHEN o_orderkey % 3 = 0 THEN 'Divorced' WHEN o_orderkey % 3 = 1 THEN 'Separated' ELSE 'Widowed' END
      AS marital_status,
    o_orderpriority AS occupation, CAST(floor(o_totalprice / 10000) + o_orderkey % 17 AS DOUBLE) AS hours_per_week,
    CASE WHEN o_totalprice > 300000 THEN ' >50K' ELSE ' <=50K' END AS income
  FROM orders)"""

# ---------------------------------------------------------------- scored rows

def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, score and prediction per order: the label follows the score with some noise."""
    from tabulon.functions.expressions import hash_percent

    score = F.round(F.col("o_totalprice") / 510000.0, 3)
    label = (hash_percent("o_orderkey") < F.lit(20) + 60 * F.col("score")).cast("int")
    return (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderkey").alias("id"), F.col("o_orderkey"), score.alias("score"))
        .select("id", label.alias("label"), "score", (F.col("score") >= 0.5).cast("int").alias("prediction"))
    )


SCORED_SQL = """scored AS (
  SELECT o_orderkey AS id,
    CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100
      < 20 + 60 * round(o_totalprice / 510000.0::DOUBLE, 3) AS INTEGER) AS label,
    round(o_totalprice / 510000.0::DOUBLE, 3) AS score,
    CAST(round(o_totalprice / 510000.0::DOUBLE, 3) >= 0.5::DOUBLE AS INTEGER) AS prediction
  FROM orders)"""

# ---------------------------------------------------------------- prices

def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series over days: the order value of each day."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("t"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("y"))
        .select(F.lit("orders").alias("series_id"), "t", "y")
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per event type: the summed value of each hour."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("series_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("t"))
        .agg(F.round(F.sum("value"), 2).alias("y"))
        .select("series_id", "t", "y")
    )


DAILY_SQL = """daily AS (
  SELECT 'orders' AS series_id, CAST(o_orderdate AS DATE) AS t, round(sum(o_totalprice), 2) AS y
  FROM orders GROUP BY 2)"""
HOURLY_SQL = """hourly AS (
  SELECT event_type AS series_id, date_trunc('hour', ts) AS t, round(sum(value), 2) AS y
  FROM events GROUP BY 1, 2)"""

# ---------------------------------------------------------------- wine offers

CAMPAIGNS = 12
OFFERS = list(range(1, 32))


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabulon.functions.expressions import month_name

    day = F.dayofmonth("ts")
    return (
        table(spark, sf_dir, "events")
        .select(day.alias("offer_id"))
        .distinct()
        .select(
            "offer_id",
            month_name(F.col("offer_id") % CAMPAIGNS + 1).alias("campaign"),
            F.concat(F.lit("grape-"), (F.col("offer_id") % 5).cast("string")).alias("varietal"),
            F.concat(F.lit("land-"), (F.col("offer_id") % 4).cast("string")).alias("origin"),
        )
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per purchase event."""
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .select(F.col("user_id").alias("customer"), F.dayofmonth("ts").alias("offer_id"), F.lit(1).alias("n"))
    )


OFFERS_SQL = f"""offers AS (
  SELECT offer_id, {list(E.MONTHS)}[offer_id % 12 + 1] AS campaign,
    'grape-' || (offer_id % 5) AS varietal, 'land-' || (offer_id % 4) AS origin
  FROM (SELECT DISTINCT CAST(day(ts) AS INTEGER) AS offer_id FROM events))"""
TRANSACTIONS_SQL = """transactions AS (
  SELECT user_id AS customer, CAST(day(ts) AS INTEGER) AS offer_id, 1 AS n FROM events
  WHERE event_type = 'purchase')"""

# ---------------------------------------------------------------- store sales

def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store table without profit: a projection of the events, with nothing to sort."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("category"),
        F.to_date("ts").alias("order_date"),
        F.col("value").alias("sales"),
        ((F.col("event_id") % 9) / F.lit(10.0)).alias("discount"),
    )


def store(spark: SparkSession, sf_dir: str, run_rows: int | None = None) -> DataFrame:
    """Sales, profit (change against the user's previous sale) and discount per event."""
    from tabulon.operators.series import previous

    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    options = {"run_rows": run_rows} if run_rows else {}
    lagged = previous(e, ["user_id"], ["ts", "event_id"], "value", "before", **options)
    return lagged.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("category"),
        F.to_date("ts").alias("order_date"),
        F.col("value").alias("sales"),
        F.coalesce(F.round(F.col("value") - F.col("before"), 2), F.lit(0.0)).alias("profit"),
        ((F.col("event_id") % 9) / F.lit(10.0)).alias("discount"),
    )


STORE_SQL = """store AS (
  SELECT event_id AS id, event_type AS category, CAST(ts AS DATE) AS order_date, value AS sales,
    coalesce(round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 2), 0.0::DOUBLE) AS profit,
    (event_id % 9) / 10.0::DOUBLE AS discount
  FROM events)"""
