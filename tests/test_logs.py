from pyspark.sql import functions as F

from tabulon.functions import expressions as E
from tabulon.operators import logs, profile

# A well-known line with a size of "-", and three that miss a pattern.
LINES = [
    'unicomp6.unicomp.net - - [01/Aug/1995:00:35:41 -0400] "GET /shuttle/missions/sts-73/news HTTP/1.0" 302 -',
    'nodots - - [02/Aug/1995:00:00:07 -0400] "POST /a" 200 123',
    "junk",
    "",
]


def table(spark, lines=LINES):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def test_fields_of_each_line(spark):
    rows = {r["value"]: r for r in logs.parse(table(spark), keep_line=True).collect()}
    first, second, junk = rows[LINES[0]], rows[LINES[1]], rows["junk"]
    assert (first["host"], first["method"], first["endpoint"], first["protocol"]) == (
        "unicomp6.unicomp.net", "GET", "/shuttle/missions/sts-73/news", "HTTP/1.0",
    )
    assert (first["status"], first["content_size"]) == (302, None)
    assert (second["host"], second["endpoint"], second["protocol"]) == ("", "/a", "")
    assert (second["status"], second["content_size"]) == (200, 123)
    assert (junk["host"], junk["timestamp"], junk["method"], junk["status"]) == ("", "", "", None)
    assert rows[""]["endpoint"] == ""


def test_any_host_keeps_hosts_without_a_dot(spark):
    hosts = [r["host"] for r in logs.parse(table(spark), any_host=True).collect()]
    assert "nodots" in hosts


def test_request_with_odd_quotes_matches_the_three_group_pattern(spark):
    odd = ['h.a.b x "GET /x"', 'h.a.b x ""GET /y z" 200 1', 'h.a.b x "A  /b   c" 200 1', 'h.a.b "only"']
    df = table(spark, odd)
    parsed = logs.parse(df, keep_line=True).select("value", "method", "endpoint", "protocol")
    direct = df.select(
        "value", *[F.regexp_extract("value", E.REQUEST_PATTERN, i).alias(n) for i, n in ((1, "method"), (2, "endpoint"), (3, "protocol"))]
    )
    assert sorted(parsed.collect()) == sorted(direct.collect())


def test_clean_drops_fills_and_parses_time(spark):
    rows = logs.clean(logs.parse(table(spark))).orderBy("time").collect()
    assert [(r["status"], r["content_size"]) for r in rows] == [(302, 0), (200, 123)]
    assert str(rows[0]["time"]) == "1995-08-01 00:35:41"
    nulls = profile.null_profile(logs.clean(logs.parse(table(spark)))).agg(F.sum("nulls")).first()[0]
    assert nulls == 0


def test_good_and_bad_rows_add_up(spark):
    df = table(spark)
    bad = logs.unparsed(df, E.STATUS_PATTERN).count()
    assert bad == 2 and bad + logs.clean(logs.parse(df)).count() == df.count()


def test_time_is_null_safe_and_can_use_the_zone(spark):
    df = spark.createDataFrame([("01/Jul/1995:00:00:01 -0400",), ("",), (None,)], "t string")
    rows = df.select(E.clf_time("t").alias("a"), E.clf_time("t", True).alias("b")).collect()
    assert str(rows[0]["a"]) == "1995-07-01 00:00:01" and str(rows[0]["b"]) == "1995-07-01 04:00:01"
    assert rows[1]["a"] is None and rows[2]["a"] is None


def test_month_numbers(spark):
    df = spark.createDataFrame([("January",), (" dec ",), ("May",), ("x",), (None,)], "m string")
    assert [r[0] for r in df.select(E.month_number("m")).collect()] == [1, 12, 5, None, None]


def test_top_counts_break_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [tuple(r) for r in logs.top_counts(df, "k", 2).collect()] == [("c", 2), ("a", 1)]
