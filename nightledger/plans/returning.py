"""Metrics on users who return: online today on a device that was not new today."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.functions.channel import junk_channel
from nightledger.functions.numeric import count_if, sum_if
from nightledger.operators.merge import assemble

KEYS = ["dt", "channel_id", "device_type"]
METRICS = [
    "non_added_user_sum",
    "md5_pass_num",
    "md5_fail_num",
    "non_added_pure_visitor_sum",
    "non_added_register_sum",
    "non_added_pure_visitor_register_sum",
    "non_added_pure_visitor_qq_sum",
    "non_added_visitor_sum",
    "non_added_visitor_register_sum",
    "non_added_visitor_qq_sum",
    "non_added_recharge_user_sum",
    "old_pay_money",
    "non_added_chat_user_sum",
    "non_added_user_chat_sum",
    "non_added_flower_user_sum",
    "non_added_user_flower_sum",
]


def _one_per(online: DataFrame, key: str) -> DataFrame:
    first = F.struct("dateline", "channel_id", "device_type", "idfa")
    return online.groupBy("dt", key).agg(F.min(first).alias("r"))


def _flag(df: DataFrame, other: DataFrame, on: list[str], name: str) -> DataFrame:
    keys = other.select(*on).distinct().withColumn(name, F.lit(True))
    return df.join(keys, on, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def _distinct_registrations(rows: DataFrame, register: DataFrame, total: str, social: str) -> DataFrame:
    """Distinct users registered today on these devices, and those who used a social login."""
    uids = (
        rows.select(*KEYS, "idfa")
        .join(register.select("dt", "idfa", "uid", "qqstatus"), ["dt", "idfa"])
        .groupBy(*KEYS, "uid")
        .agg(F.max(F.when(F.col("qqstatus") == 1, 1).otherwise(0)).alias("social"))
    )
    return uids.groupBy(*KEYS).agg(F.count(F.lit(1)).alias(total), F.sum("social").alias(social))


def returning_metrics(
    online: DataFrame,
    first_visit: DataFrame,
    register: DataFrame,
    recharge: DataFrame,
    checksum: DataFrame,
    chat: DataFrame,
    flower: DataFrame,
    pure_visitor: DataFrame,
    pure_visitor_result: DataFrame,
) -> DataFrame:
    """Sixteen metrics per day, channel and device type.

    Visitors are one row per device and users one per uid; each side is flagged once and
    aggregated once instead of being scanned again for every metric.
    """
    c = F.col
    visitors = _one_per(online.filter(c("uid") == codes.VISITOR_UID), "idfa").select(
        "dt", "idfa", "r.channel_id", "r.device_type"
    )
    users = _one_per(online.filter(c("uid") != codes.VISITOR_UID), "uid").select(
        "dt", "uid", "r.idfa", "r.channel_id", "r.device_type"
    )
    md5 = checksum.groupBy("dt", "idfa").agg(F.min("md5").alias("md5"))

    visitors = _flag(visitors, first_visit, ["dt", "idfa"], "is_new")
    old_visitors = visitors.filter(~c("is_new"))
    flagged = _flag(old_visitors, register, ["dt", "idfa"], "registered").join(md5, ["dt", "idfa"], "left")
    back = ~c("registered")
    by_visitor = flagged.groupBy(*KEYS).agg(
        count_if(back).alias("v_back"),
        count_if(back & (c("md5") == 1)).alias("v_pass"),
        count_if(back & (c("md5") == 0)).alias("v_fail"),
        F.count(F.lit(1)).alias("non_added_visitor_sum"),
    )

    paid = (
        recharge.filter((c("rechange_status") == codes.PAY_SUCCESS) & (c("rechange_channel") < codes.COIN_FROM))
        .groupBy("dt", "uid")
        .agg(F.sum("money").alias("paid"))
    )
    said = chat.groupBy("dt", "uid").agg(F.sum("chat_num").alias("said"))
    gave = flower.groupBy("dt", "uid").agg(F.sum("flower_num").alias("gave"))
    users = _flag(users, register, ["dt", "uid"], "registered")
    for frame in (paid, said, gave):
        users = users.join(frame, ["dt", "uid"], "left")
    users = _flag(users, first_visit, ["dt", "idfa"], "is_new").join(md5, ["dt", "idfa"], "left")
    old = ~c("is_new")
    back = old | ~c("registered")
    by_user = users.groupBy(*KEYS).agg(
        count_if(back).alias("u_back"),
        count_if(back & (c("md5") == 1)).alias("u_pass"),
        count_if(back & (c("md5") == 0)).alias("u_fail"),
        count_if(~c("registered")).alias("non_added_register_sum"),
        count_if(old & c("paid").isNotNull()).alias("non_added_recharge_user_sum"),
        sum_if(old & c("paid").isNotNull(), c("paid")).alias("old_pay_money"),
        count_if(old & c("said").isNotNull()).alias("non_added_chat_user_sum"),
        sum_if(old & c("said").isNotNull(), c("said")).alias("non_added_user_chat_sum"),
        count_if(old & c("gave").isNotNull()).alias("non_added_flower_user_sum"),
        sum_if(old & c("gave").isNotNull(), c("gave")).alias("non_added_user_flower_sum"),
    )

    pure = pure_visitor_result.select(*KEYS, c("non_added_pure_visitor").alias("non_added_pure_visitor_sum"))
    wide = assemble(
        [
            by_visitor,
            by_user,
            pure,
            _distinct_registrations(
                pure_visitor, register, "non_added_pure_visitor_register_sum", "non_added_pure_visitor_qq_sum"
            ),
            _distinct_registrations(
                old_visitors, register, "non_added_visitor_register_sum", "non_added_visitor_qq_sum"
            ),
        ],
        KEYS,
    )
    wide = wide.withColumns(
        {
            "non_added_user_sum": c("v_back") + c("u_back"),
            "md5_pass_num": c("v_pass") + c("u_pass"),
            "md5_fail_num": c("v_fail") + c("u_fail"),
        }
    ).select(*KEYS, *METRICS)
    any_metric = F.greatest(*[c(m) != 0 for m in METRICS if m != "old_pay_money"])
    return wide.filter(any_metric & ~junk_channel(c("channel_id")))
