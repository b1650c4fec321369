"""Host earnings per hour on air."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.functions.dates import epoch_to_dt
from nightledger.functions.numeric import hours, ratio
from nightledger.operators.aggs import with_total_row
from nightledger.operators.merge import assemble, drop_rows

FULL_DAY_SECONDS = 7200


def host_earnings(
    diamonds: DataFrame,
    workload: DataFrame,
    roster: DataFrame,
    start: int,
    end: int,
    *,
    full_day: int = FULL_DAY_SECONDS,
) -> DataFrame:
    """Per room: diamonds earned, hours on air, days of at least ``full_day`` seconds, diamonds per hour.

    A total row carries the reserved room number. Rooms without any activity are left out.
    """
    earned = (
        diamonds.filter(
            (F.col("fuid") != 0)
            & (F.col("is_anchor") == 1)
            & F.col("category").isin(1, 2)
            & F.col("dateline").between(start, end)
        )
        .groupBy("roomid")
        .agg(F.sum(F.abs("diamond")).alias("diamonds"))
    )
    daily = (
        workload.filter((F.col("start_dt") >= start) & (F.col("end_dt") <= end))
        .groupBy("roomid", epoch_to_dt(F.col("end_dt")).alias("day"))
        .agg(F.sum("total").alias("seconds"))
    )
    on_air = daily.groupBy("roomid").agg(
        hours(F.sum("seconds")).alias("online"),
        F.sum(F.when(F.col("seconds") >= full_day, 1).otherwise(0)).alias("days"),
    )
    idle = (F.col("online") == 0) & (F.col("days") == 0) & (F.col("diamonds") == 0)
    names = roster.groupBy("roomid").agg(F.min("nickname").alias("nickname"), F.min("level").alias("anchor_level"))
    rooms = (
        drop_rows(assemble([earned, on_air], ["roomid"]), idle)
        .join(names, "roomid", "left")
        .withColumns(
            {
                "nickname": F.coalesce("nickname", F.lit("")),
                "anchor_level": F.coalesce("anchor_level", F.lit(0)),
                "start_time": epoch_to_dt(F.lit(start)),
                "end_time": epoch_to_dt(F.lit(end)),
            }
        )
    )
    rows = with_total_row(
        rooms,
        ["start_time", "end_time"],
        {
            "roomid": F.lit(codes.TOTAL_ROOM).cast(rooms.schema["roomid"].dataType),
            "nickname": F.lit(codes.TOTAL_NAME),
            "anchor_level": F.lit(0),
        },
        ["diamonds", "online", "days"],
    )
    return rows.withColumn("diamonds_pro", ratio(F.col("diamonds"), F.col("online")))
