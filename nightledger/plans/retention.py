"""Audience retention per room: who of a period's viewers comes back in later windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.functions.dates import DAY, days_between, epoch_to_dt, py_shift
from nightledger.functions.filters import CohortFilter
from nightledger.functions.channel import parent_code
from nightledger.functions.numeric import hours, ratio
from nightledger.functions.text import head
from nightledger.operators.merge import assemble
from nightledger.session import cut_lineage

WEEK = (7, 13)
MONTH = (30, 59)


def cohort(online: DataFrame, prices: DataFrame, first: int, last: int, params: CohortFilter) -> DataFrame:
    """Registered users online in the period who pass the filters, each as first seen."""
    rows = online.filter(
        F.col("dt").between(first, last)
        & (F.col("uid") != codes.VISITOR_UID)
        & params.predicate(F.col("channel_id"))
    )
    users = (
        rows.groupBy("uid")
        .agg(F.min(F.struct("dateline", "channel_id", "device_type", "idfa")).alias("r"))
        .select("uid", "r.*")
    )
    if params.statis_type == 0:
        return users
    foreign = (
        prices.filter(F.col("statis_type") != params.statis_type)
        .select(head(F.col("code"), 4).alias("parent"))
        .distinct()
    )
    return users.withColumn("parent", parent_code(F.col("channel_id"))).join(foreign, "parent", "left_anti")


def dwell_of(dwell: DataFrame, users: DataFrame, first: int, last: int, keys: list[str]) -> DataFrame:
    """Seconds and first second per key for cohort users in a range of days."""
    return (
        dwell.filter(F.col("dt").between(first, last))
        .join(users.select("uid"), "uid", "left_semi")
        .groupBy(*keys)
        .agg(F.min("dateline").alias("start_dt"), F.sum("longs").alias("longs"))
    )


def dwell_per_day(dwell: DataFrame, base: DataFrame, ranges: list[tuple[int, int]]) -> DataFrame:
    """Seconds and first second per user, room and day of the base, for the days of any of the ranges.

    The log meets the base before it is grouped, so only its rows are: a small base is broadcast and filters the
    scan, a large one is joined on the keys of the grouping, which then needs no further shuffle.
    """
    wanted = reduce(lambda a, b: a | b, [F.col("dt").between(*r) for r in ranges])
    return (
        dwell.filter(wanted)
        .join(base.select("uid", "roomid"), ["uid", "roomid"], "left_semi")
        .groupBy("uid", "roomid", "dt")
        .agg(F.min("dateline").alias("later_dt"), F.sum("longs").alias("longs"))
    )


def busy_rooms(workload: DataFrame, first: int, last: int, daily_seconds: int = 3600) -> DataFrame:
    """Rooms on air for more than ``daily_seconds`` a day on average, with their hours."""
    return (
        workload.filter(F.col("dt").between(first, last))
        .groupBy("roomid")
        .agg(F.sum("total").alias("seconds"))
        .filter(F.col("seconds") > daily_seconds * days_between(first, last))
        .select("roomid", hours(F.col("seconds")).alias("total"))
    )


def recommended(normal: DataFrame, fine: DataFrame, first: int) -> DataFrame:
    """Rooms recommended on the first day: 1 normal, 2 fine; fine wins."""
    tagged = [f.withColumn("recommend_type", F.lit(n)) for n, f in ((1, normal), (2, fine))]
    return (
        tagged[0]
        .unionByName(tagged[1])
        .filter(epoch_to_dt(F.col("dateline")) == first)
        .groupBy("roomid")
        .agg(F.max("recommend_type").alias("recommend_type"))
    )


def retention(
    online: DataFrame,
    dwell: DataFrame,
    workload: DataFrame,
    prices: DataFrame,
    blacklist: DataFrame,
    levels: DataFrame,
    slots: DataFrame,
    normal: DataFrame,
    fine: DataFrame,
    hosts: DataFrame,
    first: int,
    last: int,
    params: CohortFilter = CohortFilter(),
    *,
    week: tuple[int, int] = WEEK,
    month: tuple[int, int] = MONTH,
    min_base: int = 300,
    min_return: int = 300,
    daily_seconds: int = 3600,
) -> DataFrame:
    """Per room: base viewers (dwell over ``min_base``), and those back in the week and month windows.

    The windows count days from each viewer's own first second in the room. A total row
    counts every viewer once. The filter is part of every row. Both windows are judged in one join of the base with the later
    days; the resulting pairs feed the rows and the total and are computed once.
    """
    users = cohort(online, prices, first, last, params)
    rooms = busy_rooms(workload, first, last, daily_seconds)
    base = cut_lineage(
        dwell_of(dwell, users, first, last, ["uid", "roomid"])
        .filter(F.col("longs") > min_base)
        .drop("longs")
        .join(rooms.select("roomid"), "roomid", "left_semi")
        .join(blacklist.select("roomid"), "roomid", "left_anti")
    )

    later = dwell_per_day(dwell, base, [(py_shift(first, low), py_shift(last, high)) for low, high in (week, month)])
    since = F.col("later_dt") - F.col("start_dt")

    def came_back(window: tuple[int, int], name: str) -> Column:
        low, high = window
        seconds = F.sum(F.when(since.between(low * DAY, high * DAY), F.col("longs")))
        return F.when(seconds >= min_return, 1).otherwise(0).alias(name)

    nums = ["user_num", "week_num", "month_num"]
    pairs = cut_lineage(
        base.join(later, ["uid", "roomid"], "left")
        .groupBy("uid", "roomid")
        .agg(F.lit(1).alias("user_num"), came_back(week, "week_num"), came_back(month, "month_num"))
    )
    per_room = pairs.groupBy("roomid").agg(*[F.sum(n).alias(n) for n in nums]).join(rooms, "roomid")
    people = pairs.groupBy("uid").agg(*[F.max(n).alias(n) for n in nums])
    reserved = F.lit(codes.TOTAL_ROOM).cast(per_room.schema["roomid"].dataType).alias("roomid")
    overall = assemble(
        [
            people.agg(*[F.sum(n).alias(n) for n in nums]).select(reserved, *nums),
            per_room.agg(F.sum("total").alias("total")).select(reserved, "total"),
        ],
        ["roomid"],
    )
    places = slots.filter(F.col("dt").between(first, last)).groupBy("roomid").agg(
        F.count(F.lit(1)).alias("recommend_times")
    )
    level = levels.filter(F.col("date_time") == last).groupBy("roomid").agg(F.max("level").alias("level"))
    gender = hosts.groupBy("roomid").agg(F.min("gender").alias("gender"))
    rows = per_room
    for extra in (places, level, recommended(normal, fine, first), gender):
        rows = rows.join(extra, "roomid", "left")
    rows = rows.unionByName(overall, allowMissingColumns=True)
    extras = ["recommend_times", "level", "recommend_type", "gender"]
    return rows.select(
        F.lit(first).alias("start_time"),
        F.lit(last).alias("end_time"),
        *[c.alias(n) for n, c in params.columns().items()],
        "roomid",
        "total",
        *nums,
        ratio(F.col("week_num"), F.col("user_num"), 4).alias("week_pro"),
        ratio(F.col("month_num"), F.col("user_num"), 4).alias("month_pro"),
        *[F.coalesce(F.col(e), F.lit(0)).alias(e) for e in extras],
    )
