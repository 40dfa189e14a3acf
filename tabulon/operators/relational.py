"""Business questions over bookings, facilities and members.

Costs are linear in slots, so slots are summed before any join: the join then
sees one row per key and a facility with a third of all bookings is no hot key.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GUEST = 0


def on_day(column: str, day: str) -> Column:
    """A day as a half-open range, which reaches the file scan as a pushed filter."""
    start = date.fromisoformat(day)
    stop = start + timedelta(days=1)
    return (F.col(column) >= F.lit(start).cast("timestamp_ntz")) & (F.col(column) < F.lit(stop).cast("timestamp_ntz"))


def charging(facilities: DataFrame) -> DataFrame:
    return facilities.where(F.col("membercost") > 0)


def free(facilities: DataFrame) -> DataFrame:
    return facilities.where(F.col("membercost") == 0)


def cheap_fee(facilities: DataFrame, share: float = 0.2, must_charge: bool = True) -> DataFrame:
    """Facilities whose fee is below a share of their upkeep."""
    kept = facilities.where(F.col("membercost") < F.col("monthlymaintenance") * F.lit(share))
    return charging(kept) if must_charge else kept


def upkeep_label(facilities: DataFrame, limit: float = 100) -> DataFrame:
    label = F.when(F.col("monthlymaintenance") > limit, "expensive").otherwise("cheap")
    return facilities.withColumn("label", label)


def latest(members: DataFrame, column: str) -> DataFrame:
    """All rows at the largest value, ties included."""
    top = members.agg(F.max(column).alias("_top"))
    return members.join(top, F.col(column) == F.col("_top"), "left_semi")


def full_name(first: str = "firstname", last: str = "surname") -> Column:
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def users_of(bookings: DataFrame, facilities: DataFrame, members: DataFrame, text: str) -> DataFrame:
    """Distinct (facility name, member) pairs for facilities whose name holds the text."""
    wanted = facilities.where(F.col("name").contains(text)).select("facid", "name")
    pairs = bookings.join(wanted, "facid").select("name", "memid").distinct()
    return (
        pairs.join(members, "memid")
        .select("name", full_name().alias("member_fullname"))
        .distinct()
        .orderBy("member_fullname", "name")
    )


def booking_costs(bookings: DataFrame, facilities: DataFrame, per_member: bool) -> DataFrame:
    """Total cost per facility, and per member when asked: one aggregate, then the price lookup."""
    guest = F.col("memid") == GUEST
    keys = ["facid", "memid"] if per_member else ["facid"]
    slots = bookings.groupBy(*keys).agg(
        F.sum(F.when(guest, F.col("slots")).otherwise(0)).alias("guest_slots"),
        F.sum(F.when(~guest, F.col("slots")).otherwise(0)).alias("member_slots"),
    )
    cost = F.col("guest_slots") * F.col("guestcost") + F.col("member_slots") * F.col("membercost")
    return slots.join(facilities.select("facid", "name", "guestcost", "membercost"), "facid").withColumn("cost", cost)


def costly_bookings(
    bookings: DataFrame, facilities: DataFrame, members: DataFrame, day: str, above: float, merge_names: bool = False
) -> DataFrame:
    """Facility, member and cost for one day's bookings above a limit.

    ``merge_names`` adds up members and facilities of equal name before the
    limit is applied; otherwise each (facility, member) id stands alone.
    """
    costs = booking_costs(bookings.where(on_day("starttime", day)), facilities, per_member=True)
    if not merge_names:
        costs = costs.where(F.col("cost") > above)
    named = costs.join(members.select("memid", full_name().alias("member_fullname")), "memid", "inner" if merge_names else "left")
    if merge_names:
        named = named.groupBy("name", "member_fullname").agg(F.sum("cost").alias("cost")).where(F.col("cost") > above)
    return named.select("name", "member_fullname", F.col("cost").alias("total_cost")).orderBy(
        F.desc("total_cost"), "name", "member_fullname"
    )


def low_revenue(bookings: DataFrame, facilities: DataFrame, below: float, by_name: bool = False) -> DataFrame:
    """Facilities whose total revenue stays below a limit. Needs no members table."""
    costs = booking_costs(bookings, facilities, per_member=False)
    if by_name:
        costs = costs.groupBy("name").agg(F.sum("cost").alias("cost"))
    keys = ["name"] if by_name else ["facid", "name"]
    return (
        costs.select(*keys, F.col("cost").alias("total_revenue"))
        .where(F.col("total_revenue") < below)
        .orderBy("total_revenue", *keys)
    )


def rates(df: DataFrame, key: str, conditions: dict[str, Column], digits: int = 2) -> DataFrame:
    """Rows and the share of rows that meet each condition, per key."""
    shares = [
        F.round(F.avg(F.when(condition, 1).otherwise(0)), digits).alias(name)
        for name, condition in conditions.items()
    ]
    return df.groupBy(key).agg(F.sum(F.lit(1)).alias("n"), *shares)
