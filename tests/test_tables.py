import pytest
from pyspark.sql import functions as F

from tabulon.operators import profile, relational as R
from tabulon.sources import catalog, files
from tabulon import session


def test_fill_by_column_map(spark):
    df = spark.createDataFrame([(10, 80.5, "Alice"), (5, None, "Bob"), (None, None, "Tom"), (None, 41.0, None)],
                               "age int, height double, name string")
    filled = df.na.fill({"age": 50, "name": "unknown"}).collect()
    assert [r["age"] for r in filled] == [10, 5, 50, 50] and filled[3]["name"] == "unknown"
    assert filled[1]["height"] is None
    assert df.na.drop().count() == 1
    assert profile.has_null(df).first()[0] is True
    assert profile.has_null(df.na.drop()).first()[0] is False


def test_null_profile_counts_blanks(spark):
    df = spark.createDataFrame([("", 1), (" ", None), (None, 3)], "a string, b int")
    rows = {r["column_name"]: (r["nulls"], r["blanks"], r["rows"]) for r in profile.null_profile(df).collect()}
    assert rows == {"a": (1, 2, 3), "b": (1, 0, 3)}


def test_summary_of_a_small_table(spark):
    df = spark.createDataFrame([("x", float(v)) for v in range(1, 6)] + [("y", 4.0)], "g string, v double")
    row = profile.summary_stats(df, ["v"]).first()
    assert (row["count"], row["min"], row["q50"], row["max"]) == (6, 1.0, 3.5, 5.0)
    groups = {r["g"]: r for r in profile.summary_stats(df, ["v"], ["g"]).collect()}
    assert groups["x"]["q25"] == 2.0 and groups["x"]["std"] == pytest.approx(1.5811388)
    assert groups["y"]["std"] is None and groups["y"]["q75"] == 4.0


def test_histogram_holds_every_row_and_constant_columns(spark):
    df = spark.range(0, 101).select(F.col("id").cast("double").alias("v"))
    bins = {r["bin"]: r["count"] for r in profile.histogram(df, "v", 10).collect()}
    assert sum(bins.values()) == 101 and bins[10] == 11
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [(r["bin"], r["count"]) for r in profile.histogram(same, "v", 4).collect()] == [(1, 2)]


def test_pivot_means_and_zeroes(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 1), ("b", 2, 1)], "c string, o int, n int")
    rows = {r["c"]: (r["o1"], r["o2"]) for r in profile.indicator_matrix(df, "c", "o", [1, 2], "n", "o").collect()}
    assert rows == {"a": (1.0, 0.0), "b": (0.0, 1.0)}


@pytest.fixture(scope="module")
def club(spark):
    facilities = spark.createDataFrame(
        [(1, "Tennis Court 1", 5.0, 25.0, 200.0), (2, "Tennis Court 1", 0.0, 5.0, 15.0), (3, "Pool", 3.5, 17.5, 3000.0)],
        "facid int, name string, membercost double, guestcost double, monthlymaintenance double")
    members = spark.createDataFrame([(0, "GUEST", "GUEST", 1), (1, "Ann", "Lee", 9), (2, "Ann", "Lee", 9)],
                                    "memid int, firstname string, surname string, joindate int")
    bookings = spark.createDataFrame(
        [(1, 1, 1, 4, "2012-09-14 08:00:00"), (2, 1, 2, 3, "2012-09-14 23:59:59"), (3, 1, 0, 2, "2012-09-14 10:00:00"),
         (4, 2, 0, 1, "2012-09-14 11:00:00"), (5, 3, 1, 2, "2012-09-15 00:00:00")],
        "bookid int, facid int, memid int, slots int, starttime string").withColumn("starttime", F.col("starttime").cast("timestamp_ntz"))
    return bookings, facilities, members


def test_costs_by_id_and_by_name(club):
    by_id = R.costly_bookings(*club, "2012-09-14", 16).collect()
    assert [tuple(r) for r in by_id] == [("Tennis Court 1", "GUEST GUEST", 50.0), ("Tennis Court 1", "Ann Lee", 20.0)]
    by_name = R.costly_bookings(*club, "2012-09-14", 16, merge_names=True).collect()
    assert [tuple(r) for r in by_name] == [("Tennis Court 1", "GUEST GUEST", 55.0), ("Tennis Court 1", "Ann Lee", 35.0)]


def test_questions_on_the_club(club):
    bookings, facilities, members = club
    assert [r["facid"] for r in R.charging(facilities).orderBy("facid").collect()] == [1, 3]
    assert [r["facid"] for r in R.cheap_fee(facilities).orderBy("facid").collect()] == [1, 3]
    assert R.latest(members, "joindate").count() == 2
    users = [tuple(r) for r in R.users_of(bookings, facilities, members, "Tennis Court").collect()]
    assert users == [("Tennis Court 1", "Ann Lee"), ("Tennis Court 1", "GUEST GUEST")]
    revenue = [(r["facid"], r["total_revenue"]) for r in R.low_revenue(bookings, facilities, 80).collect()]
    assert revenue == [(2, 5.0), (3, 7.0)]


def test_day_filter_reaches_the_scan(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where(R.on_day("l_shipdate", "1995-08-09")).select("l_quantity")
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    assert "l_extendedprice" not in plan


def test_round_trips_and_catalog(spark):
    df = spark.createDataFrame([(1, " a"), (2, "b,c")], "id int, t string")
    path = files.write_csv(df, session.scratch_path(spark, "t"))
    assert sorted(files.read_csv(spark, path, "id int, t string").collect()) == sorted(df.collect())
    path = files.write_json(df, session.scratch_path(spark, "t"))
    assert sorted(files.read_json(spark, path, "id int, t string").collect()) == sorted(df.collect())
    catalog.recreate_database(spark, "shelf", session.scratch_path(spark, "shelf"))
    catalog.save_table(df, "shelf.items")
    assert spark.table("shelf.items").count() == 2
    assert [r["tableName"] for r in catalog.list_tables(spark, "shelf").collect()] == ["items"]
    catalog.recreate_database(spark, "shelf", session.scratch_path(spark, "shelf"))
    assert catalog.list_tables(spark, "shelf").count() == 0
    spark.sql("DROP DATABASE shelf CASCADE")
    assert files.rename_all(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        files.rename_all(df, ["x"])


def test_bucketed_join_has_no_shuffle(spark):
    catalog.recreate_database(spark, "buckets", session.scratch_path(spark, "buckets"))
    left = catalog.save_table(spark.range(1000).withColumnRenamed("id", "k"), "buckets.a", "k", 4)
    right = catalog.save_table(spark.range(1000).withColumnRenamed("id", "k"), "buckets.b", "k", 4)
    joined = left.hint("merge").join(right, "k")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP DATABASE buckets CASCADE")
