"""Summaries, reshaping and set operations on the store, offer and price tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.expressions import MONTHS, month_number, tidy
from tabulon.operators import profile
from tabulon.operators.ordered import exact_quantiles
from tabulon.plans import standins as S
from tabulon.plans.registry import query, r4

_STORE = S.with_sql(S.STORE_SQL)
_WINE = S.with_sql(S.OFFERS_SQL, S.TRANSACTIONS_SQL)
_STATS = ("mean", "std", "min", "q25", "q50", "q75", "max")


def _stats_sql(column: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    parts = {
        "mean": f"avg({column})", "std": f"stddev_samp({column})", "min": f"min({column})", "max": f"max({column})",
        "q25": f"quantile_cont({column}, 0.25)", "q50": f"quantile_cont({column}, 0.5)",
        "q75": f"quantile_cont({column}, 0.75)",
    }
    cells = ", ".join(f"{r4(e)} AS {n}" for n, e in parts.items())
    group = f" GROUP BY {by}" if by else ""
    return f"SELECT {keys}'{column}' AS column_name, count({column}) AS count, {cells} FROM store{group}"


def _tidied(df: DataFrame, columns) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, tidy(F.col(c)))
    return df


@query("d04_describe", _STORE + _stats_sql("sales") + " UNION ALL " + _stats_sql("profit"))
def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(profile.summary_stats(S.store(spark, sf_dir), ["sales", "profit"]), _STATS)


@query("d05_describe_by_group", _STORE + _stats_sql("sales", "category") + " UNION ALL " + _stats_sql("profit", "category"))
def describe_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(profile.summary_stats(S.store(spark, sf_dir), ["sales", "profit"], ["category"]), _STATS)


@query("d16_rows_at_max", "SELECT event_id, value FROM events WHERE value = (SELECT max(value) FROM events)")
def rows_at_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.rows_at_max(S.table(spark, sf_dir, "events").select("event_id", "value"), "value")


_CELLS = ", ".join(f"coalesce(avg(CASE WHEN offer_id = {o} THEN n END), 0.0::DOUBLE) AS offer_{o}" for o in S.OFFERS)


def response_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.indicator_matrix(S.transactions(spark, sf_dir), "customer", "offer_id", S.OFFERS, "n", "offer_")


@query("d18_response_matrix", _WINE + f"SELECT customer, {_CELLS} FROM transactions GROUP BY 1")
def response_matrix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return response_matrix(spark, sf_dir)


@query("c02_offers_with_transactions", _WINE + """
SELECT o.offer_id, o.campaign, o.varietal, o.origin, t.customer, t.n FROM offers o
LEFT JOIN transactions t ON o.offer_id = t.offer_id""")
def offers_with_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most one offer for each day of a month: sent to the transactions, which stay where they are.

    Offers without any transaction are added from the few offer ids that occur.
    """
    offers, bought = S.offers(spark, sf_dir), S.transactions(spark, sf_dir)
    matched = bought.join(F.broadcast(offers), "offer_id").select(*offers.columns, "customer", "n")
    without = offers.join(F.broadcast(bought.select("offer_id").distinct()), "offer_id", "left_anti")
    return matched.unionByName(without, allowMissingColumns=True)


@query("d19_value_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY 1 ORDER BY 2 DESC")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = S.table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), "event_type")


_BY_CAMPAIGN = """FROM transactions t JOIN offers o ON t.offer_id = o.offer_id"""


def _labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.transactions(spark, sf_dir).join(S.offers(spark, sf_dir), "offer_id").withColumn(
        "segment", (F.col("customer") % 5).cast("int")
    )


@query("d20_cross_tab", _WINE + f"""
SELECT CAST(t.customer % 5 AS INTEGER) AS segment, o.varietal, count(*) AS value {_BY_CAMPAIGN}
GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC""")
def cross_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.cross_tab(_labeled(spark, sf_dir), "segment", "varietal")


_MONTH_CELLS = ", ".join(f"sum(CASE WHEN o.campaign = '{m}' THEN 1 END)::BIGINT AS month_{i}" for i, m in enumerate(MONTHS, 1))


@query("d21_unstacked_campaigns", _WINE + f"SELECT CAST(t.customer % 5 AS INTEGER) AS segment, {_MONTH_CELLS} {_BY_CAMPAIGN} GROUP BY 1")
def unstacked_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = _labeled(spark, sf_dir).withColumn("month", month_number("campaign"))
    pairs = profile.cross_tab(numbered, "segment", "month")
    return profile.unstack(pairs, "segment", "month", "value", list(range(1, 13)), "month_")


@query("h11_month_number", _WINE + """
SELECT offer_id, campaign, CAST(offer_id % 12 + 1 AS INTEGER) AS month FROM offers""")
def month_number_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.offers(spark, sf_dir).select("offer_id", "campaign", month_number("campaign").alias("month"))


@query("d22_percentile_cut", _STORE + f"SELECT {r4('quantile_cont(sales, 0.99)')} AS cut FROM store")
def percentile_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(exact_quantiles(S.sales(spark, sf_dir), "sales", [0.99], names=["cut"]), ["cut"])


@query("d22_percentile_cut_approx")
def percentile_cut_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.table(spark, sf_dir, "events").agg(F.percentile_approx("value", 0.99, 10000).alias("cut"))


@query("d23_histogram", _STORE + f"""
, lim AS (SELECT min(sales) AS lo, (max(sales) - min(sales)) / 20 AS w FROM store)
SELECT bin, {r4('lo + (bin - 1) * w')} AS bin_start, {r4('lo + bin * w')} AS bin_end, count(*) AS count
FROM (SELECT CAST(least(20, floor((sales - lo) / w) + 1) AS INTEGER) AS bin, lo, w FROM store, lim) GROUP BY bin, lo, w""")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(profile.histogram(S.sales(spark, sf_dir), "sales", 20), ["bin_start", "bin_end"])


@query("d24_mean_per_date", _STORE + f"""
SELECT order_date AS x, {r4('avg(sales)')} AS mean, {r4('stddev_samp(sales)')} AS std, count(sales) AS count
FROM store GROUP BY 1""")
def mean_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidied(profile.mean_per_x(S.sales(spark, sf_dir), "order_date", "sales"), ["mean", "std"])


@query("f06_sort_two_keys", _STORE + "SELECT id, profit, discount FROM store ORDER BY profit DESC, discount DESC")
def sort_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.store(spark, sf_dir).select("id", "profit", "discount").orderBy(F.desc("profit"), F.desc("discount"))
