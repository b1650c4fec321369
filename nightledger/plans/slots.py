"""Recommendation slots: audience of busy rooms and how often they held each slot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.functions.numeric import count_if
from nightledger.plans.retention import busy_rooms, dwell_of, recommended

SLOTS = range(1, 16)


def slot_report(
    users: DataFrame,
    dwell: DataFrame,
    workload: DataFrame,
    blacklist: DataFrame,
    slots: DataFrame,
    normal: DataFrame,
    fine: DataFrame,
    first: int,
    last: int,
    *,
    daily_seconds: int = 3600,
) -> DataFrame:
    """Per room with slot records: cohort viewers and the count of each slot rank.

    ``users`` is the cohort, named by the caller.
    """
    audience = (
        dwell_of(dwell, users, first, last, ["uid", "roomid"])
        .groupBy("roomid")
        .agg(F.count(F.lit(1)).alias("user_num"))
        .join(busy_rooms(workload, first, last, daily_seconds).select("roomid"), "roomid", "left_semi")
        .join(blacklist.select("roomid"), "roomid", "left_anti")
    )
    ranks = (
        slots.filter(F.col("dt").between(first, last))
        .groupBy("roomid")
        .agg(*[count_if(F.col("cal_rank") == i).alias(f"p{i}") for i in SLOTS])
    )
    return (
        audience.join(ranks, "roomid")
        .join(recommended(normal, fine, first), "roomid", "left")
        .select(
            F.lit(first).alias("start_time"),
            F.lit(last).alias("end_time"),
            "roomid",
            "user_num",
            *[f"p{i}" for i in SLOTS],
            F.coalesce("recommend_type", F.lit(0)).alias("recommend_type"),
        )
    )
