"""Questions over bookings, facilities and members."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expressions import tidy
from tabulon.operators import evaluate, relational as R
from tabulon.plans import standins as S
from tabulon.plans.registry import query, r4

DAY = "1995-08-09"
_F = S.with_sql(S.FACILITIES_SQL)
_M = S.with_sql(S.MEMBERS_SQL)
_ALL = S.with_sql(S.FACILITIES_SQL, S.MEMBERS_SQL, S.BOOKINGS_SQL)
#: What each booking costs: its slots at the price for guests (member 0) or members.
_PRICED = S.with_sql(S.FACILITIES_SQL, S.MEMBERS_SQL, S.BOOKINGS_SQL, """priced AS (
  SELECT facid, name, memid, starttime, slots * if(memid = 0, guestcost, membercost) AS price
  FROM bookings JOIN facilities USING (facid))""")
_ON_DAY = f"""day_total AS (SELECT facid, name, memid, sum(price) AS spent FROM priced
  WHERE CAST(starttime AS DATE) = DATE '{DAY}' GROUP BY ALL)"""


@query("b02_charging_facilities", _F + "SELECT name FROM facilities WHERE membercost > 0")
def charging_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.charging(S.facilities(spark, sf_dir)).select("name")


@query("d02_free_facilities", _F + "SELECT count(name) AS n FROM facilities WHERE membercost = 0")
def free_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.free(S.facilities(spark, sf_dir)).agg(F.count("name").alias("n"))


@query("b04_cheap_fee", _F + """
SELECT facid, name, membercost, monthlymaintenance FROM facilities
WHERE membercost > 0 AND membercost < monthlymaintenance * 0.2::DOUBLE""")
def cheap_fee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cheap_fee(S.facilities(spark, sf_dir)).select("facid", "name", "membercost", "monthlymaintenance")


@query("b04_cheap_or_no_fee", _F + """
SELECT facid, name, membercost, monthlymaintenance FROM facilities
WHERE membercost < monthlymaintenance * 0.2::DOUBLE""")
def cheap_or_no_fee(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = R.cheap_fee(S.facilities(spark, sf_dir), must_charge=False)
    return kept.select("facid", "name", "membercost", "monthlymaintenance")


@query("b05_in_list", _F + "SELECT * FROM facilities WHERE facid IN (1, 5)")
def in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.facilities(spark, sf_dir).where(F.col("facid").isin(1, 5))


@query("b06_like", _F + "SELECT facid, name FROM facilities WHERE name LIKE '%widget%' OR name LIKE 'small%'")
def like(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = F.col("name").like("%widget%") | F.col("name").startswith("small")
    return S.facilities(spark, sf_dir).where(wanted).select("facid", "name")


@query("b08_upkeep_label", _F + """
SELECT name, CASE WHEN monthlymaintenance > 5000 THEN 'expensive' ELSE 'cheap' END AS label, monthlymaintenance
FROM facilities""")
def upkeep_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.upkeep_label(S.facilities(spark, sf_dir), 5000).select("name", "label", "monthlymaintenance")


@query("c01_three_way_join", _ALL + """
SELECT b.bookid, b.line, f.name, m.surname, b.slots FROM bookings b
JOIN facilities f ON b.facid = f.facid JOIN members m ON b.memid = m.memid""")
def three_way_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        S.bookings(spark, sf_dir)
        .join(S.facilities(spark, sf_dir), "facid")
        .join(S.members(spark, sf_dir), "memid")
        .select("bookid", "line", "name", "surname", "slots")
    )


@query("d11_users_of_widgets", _ALL + """
SELECT DISTINCT f.name, m.firstname || ' ' || m.surname AS member_fullname FROM facilities f
JOIN bookings b ON f.facid = b.facid JOIN members m ON b.memid = m.memid
WHERE f.name LIKE '%widget%' ORDER BY 2""")
def users_of_widgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.users_of(S.bookings(spark, sf_dir), S.facilities(spark, sf_dir), S.members(spark, sf_dir), "widget")


@query("c02_left_join", _ALL + """
SELECT m.memid, m.surname, count(b.bookid) AS n FROM members m LEFT JOIN bookings b ON m.memid = b.memid
GROUP BY 1, 2""")
def left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members with their bookings, counted before the join; members without any show 0."""
    counts = S.bookings(spark, sf_dir).groupBy("memid").agg(F.count(F.lit(1)).alias("n"))
    return S.members(spark, sf_dir).join(counts, "memid", "left").select("memid", "surname", F.coalesce("n", F.lit(0)).alias("n"))


@query("c03_latest_members", _M + """
SELECT firstname, surname FROM members WHERE joindate IN (SELECT max(joindate) FROM members)""")
def latest_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.latest(S.members(spark, sf_dir), "joindate").select("firstname", "surname")


@query("d06_costly_bookings", f"""{_PRICED}, {_ON_DAY}, by_name AS (
  SELECT name, firstname || ' ' || surname AS member_fullname, sum(spent) AS spent
  FROM day_total JOIN members USING (memid) GROUP BY ALL)
SELECT name, member_fullname, round(spent, 2) AS total_cost FROM by_name WHERE spent > 30000""")
def costly_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.costly_bookings(
        S.bookings(spark, sf_dir), S.facilities(spark, sf_dir), S.members(spark, sf_dir), DAY, 30000, merge_names=True
    )
    return found.withColumn("total_cost", F.round("total_cost", 2))


@query("c04_costly_bookings_by_id", f"""{_PRICED}, {_ON_DAY}
SELECT name, firstname || ' ' || surname AS member_fullname, round(spent, 2) AS total_cost
FROM day_total LEFT JOIN members USING (memid) WHERE spent > 30000""")
def costly_bookings_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.costly_bookings(S.bookings(spark, sf_dir), S.facilities(spark, sf_dir), S.members(spark, sf_dir), DAY, 30000)
    return found.withColumn("total_cost", F.round("total_cost", 2))


@query("d10_low_revenue", f"""{_PRICED}
SELECT * FROM (SELECT facid, name, round(sum(price), 2) AS total_revenue FROM priced GROUP BY ALL)
WHERE total_revenue < 300000""")
def low_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.low_revenue(S.bookings(spark, sf_dir), S.facilities(spark, sf_dir), 300000)
    return found.withColumn("total_revenue", F.round("total_revenue", 2))


@query("d10_low_revenue_by_name", f"""{_PRICED}
SELECT * FROM (SELECT name, round(sum(price), 2) AS total_revenue FROM priced GROUP BY ALL)
WHERE total_revenue < 15000000""")
def low_revenue_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.low_revenue(S.bookings(spark, sf_dir), S.facilities(spark, sf_dir), 15000000, by_name=True)
    return found.withColumn("total_revenue", F.round("total_revenue", 2))


@query("d09_group_by_ordinals", _ALL + """
SELECT f.name, month(b.starttime)::INTEGER AS month, count(*) AS n FROM bookings b JOIN facilities f ON b.facid = f.facid
GROUP BY 1, 2 ORDER BY 1, 2""")
def group_by_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT f.name, month(b.starttime) AS month, count(*) AS n
           FROM {b} b JOIN {f} f ON b.facid = f.facid GROUP BY 1, 2 ORDER BY 1, 2""",
        b=S.bookings(spark, sf_dir), f=S.facilities(spark, sf_dir),
    )


@query("f01_sort_limit", _ALL + """
SELECT * FROM bookings ORDER BY starttime, bookid, line, facid, memid, slots LIMIT 100""")
def sort_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.bookings(spark, sf_dir).orderBy("starttime", "bookid", "line", "facid", "memid", "slots").limit(100)


@query("f02_plain_limit")
def plain_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.members(spark, sf_dir).limit(3)


@query("f02_limit_count", S.with_sql(S.MEMBERS_SQL) + "SELECT count(*) AS n, count(DISTINCT memid) AS members FROM (SELECT * FROM members LIMIT 3)")
def limit_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows, all of them members, a limit leaves."""
    some = S.members(spark, sf_dir).limit(3)
    return some.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("memid").alias("members"))


@query("f04_sort_by_ordinal", _F + "SELECT name, count(*) AS n FROM facilities GROUP BY 1 ORDER BY 2 DESC, 1")
def sort_by_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("SELECT name, count(*) AS n FROM {f} GROUP BY 1 ORDER BY 2 DESC, 1", f=S.facilities(spark, sf_dir))


@query("h03_day_range", _ALL + """
SELECT bookid, line, facid, memid, slots FROM bookings WHERE date_trunc('day', starttime) = TIMESTAMP '1995-08-09'""")
def day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.bookings(spark, sf_dir).where(R.on_day("starttime", DAY)).select("bookid", "line", "facid", "memid", "slots")


@query("h05_full_name", _M + "SELECT memid, firstname || ' ' || surname AS member_fullname FROM members")
def full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.members(spark, sf_dir).select("memid", R.full_name().alias("member_fullname"))


# ------------------------------------------------------------------ census

_C = S.with_sql(S.CENSUS_SQL)
_CONDITIONS = {
    "married_rate": "ltrim(marital_status) LIKE 'Married-%'",
    "widow_rate": "lower(marital_status) LIKE '%widow%'",
    "divorce_rate": "ltrim(marital_status) = 'Divorced'",
    "separated_rate": "ltrim(marital_status) = 'Separated'",
    "bachelor_rate": "ltrim(marital_status) = 'Never-married'",
}
_RATES = ", ".join(f"round(avg(CASE WHEN {c} THEN 1 ELSE 0 END), 2) AS {n}" for n, c in _CONDITIONS.items())


def _rate_conditions():
    status = F.ltrim("marital_status")
    return {
        "married_rate": status.startswith("Married-"),
        "widow_rate": F.lower("marital_status").contains("widow"),
        "divorce_rate": status == "Divorced",
        "separated_rate": status == "Separated",
        "bachelor_rate": status == "Never-married",
    }


@query("d07_rates_by_occupation", _C + f"SELECT occupation, count(*) AS n, {_RATES} FROM census GROUP BY 1 ORDER BY n DESC")
def rates_by_occupation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.rates(S.census(spark, sf_dir), "occupation", _rate_conditions()).orderBy(F.desc("n"), "occupation")


@query("d07_rates_by_education_sql", _C + f"SELECT education, count(*) AS n, {_RATES} FROM census GROUP BY 1")
def rates_by_education_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = ", ".join(f"ROUND(AVG(IF({c}, 1, 0)), 2) AS {n}" for n, c in _CONDITIONS.items())
    return spark.sql(f"SELECT education, SUM(1) AS n, {shares} FROM {{t}} GROUP BY 1 ORDER BY n DESC", t=S.census(spark, sf_dir))


@query("d08_bachelor_rate", _C + """
SELECT education, round(avg(CASE WHEN ltrim(marital_status) = 'Never-married' THEN 1 ELSE 0 END), 2) AS bachelor_rate
FROM census GROUP BY 1 ORDER BY 2 DESC""")
def bachelor_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = S.census(spark, sf_dir).select(
        "education", F.when(F.ltrim("marital_status") == "Never-married", 1).otherwise(0).alias("is_bachelor")
    )
    return marked.groupBy("education").agg(F.round(F.avg("is_bachelor"), 2).alias("bachelor_rate")).orderBy(
        F.desc("bachelor_rate"), "education"
    )


@query("d17_positive_rate", _C + f"SELECT {r4('''avg(CASE WHEN income = ' >50K' THEN 1.0 ELSE 0.0 END)''')} AS positive_rate FROM census")
def positive_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = S.census(spark, sf_dir).select((F.col("income") == " >50K").cast("int").alias("label"))
    return evaluate.positive_rate(labeled).select(tidy(F.col("positive_rate")).alias("positive_rate"))


@query("f04_income_by_occupation", _C + f"""
SELECT occupation, {r4('''avg(CASE WHEN income = ' >50K' THEN 1 ELSE 0 END)''')} AS plus_50k FROM census GROUP BY 1
ORDER BY 2 DESC""")
def income_by_occupation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        S.census(spark, sf_dir)
        .groupBy("occupation")
        .agg(tidy(F.avg(F.expr("if(income = ' >50K', 1, 0)"))).alias("plus_50k"))
        .orderBy(F.desc("plus_50k"), "occupation")
    )


@query("h06_trim_lower", _C + "SELECT id, lower(ltrim(marital_status)) AS status FROM census")
def trim_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.census(spark, sf_dir).select("id", F.lower(F.ltrim("marital_status")).alias("status"))


@query("h07_round", _C + "SELECT occupation, round(avg(hours_per_week), 2) AS hours FROM census GROUP BY 1")
def rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.census(spark, sf_dir).groupBy("occupation").agg(F.round(F.avg("hours_per_week"), 2).alias("hours"))
