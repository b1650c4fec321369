"""First-payment report: per channel and day, with nine subtotal levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.functions.channel import excluded_code, normalise_channel, parse_channel, platform_name
from nightledger.functions.dates import dt_to_epoch
from nightledger.functions.numeric import percent, ratio
from nightledger.functions.text import byte_length
from nightledger.operators.aggs import distinct_if
from nightledger.operators.merge import assemble
from nightledger.session import cut_lineage

KEYS = ["dt", "channel_id"]
COUNTS = ["online_non_pay", "first_pay", "first_official", "first_official_11"]
AMOUNTS = [
    "first_pay_money",
    "first_pay_official_money",
    "first_official_11_money",
    "first_pay_all_money",
    "first_official_all_money",
    "first_official_11_all_money",
]
MEASURES = COUNTS + AMOUNTS


def ratios() -> dict[str, Column]:
    """Rates in percent and revenue per payer, from the sums of the row they stand in."""
    c = F.col
    return {
        "first_pay_ratio": percent(c("first_pay"), c("online_non_pay")),
        "first_official_ratio": percent(c("first_official"), c("online_non_pay")),
        "first_official_11_ratio": percent(c("first_official_11"), c("online_non_pay")),
        "first_pay_arpu": ratio(c("first_pay_money"), c("first_pay")),
        "first_official_arpu": ratio(c("first_pay_official_money"), c("first_official")),
        "first_official_11_arpu": ratio(c("first_official_11_money"), c("first_official_11")),
    }


def online_non_payers(online: DataFrame, first_recharge: DataFrame) -> DataFrame:
    """Per day and channel, online users whose first payment is not before that day."""
    first = first_recharge.groupBy("uid").agg(F.min("dateline").alias("first_paid"))
    rows = (
        online.filter((byte_length(F.col("channel_id")) >= 8) & ~excluded_code(F.col("channel_id")))
        .join(first, "uid", "left")
        .filter(F.col("first_paid").isNull() | (F.col("first_paid") >= dt_to_epoch(F.col("dt"))))
        .withColumn("channel_id", normalise_channel(F.col("channel_id")))
    )
    users = rows.groupBy(*KEYS, "uid").agg(F.min(F.struct("dateline", "device_type")).alias("r"))
    return users.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("online_non_pay"), F.min("r").getField("device_type").alias("device_type")
    )


def first_pay_rows(
    online: DataFrame, first_recharge: DataFrame, register: DataFrame, income: DataFrame
) -> DataFrame:
    """First payments with their channel (online that day, else at registration) and the day's income."""
    where = F.struct("channel_id", "device_type")
    on_day = online.groupBy("dt", "uid").agg(F.min_by(where, F.struct("dateline", "channel_id")).alias("s1"))
    payers = first_recharge.select("uid").distinct()
    at_signup = register.join(payers, "uid", "left_semi").groupBy("uid").agg(F.min_by(where, F.struct("channel_id", "device_type")).alias("s2"))
    daily = (
        income.filter((F.col("special") == 0) & (F.col("money") > 0) & (F.col("success") == 1))
        .groupBy("dt", "uid")
        .agg(F.max("money").alias("money_total"))
    )
    known = F.when(F.col("s1.channel_id") != "0", F.col("s1"))
    return (
        first_recharge.join(on_day, ["dt", "uid"], "left")
        .join(daily, ["dt", "uid"], "left")
        .join(at_signup, "uid", "left")
        .withColumn("s", F.coalesce(known, F.col("s2"), F.col("s1")))
        .select(
            "dt",
            "uid",
            "money",
            "type",
            "first_second",
            F.coalesce("money_total", F.lit(0)).alias("money_total"),
            normalise_channel(F.coalesce("s.channel_id", F.lit("0"))).alias("channel_id"),
        )
    )


def first_pay_leaves(
    online: DataFrame,
    first_recharge: DataFrame,
    register: DataFrame,
    income: DataFrame,
    payers: DataFrame | None = None,
) -> DataFrame:
    """Measures per day and channel; ``payers`` are all first payments known, if those given are of a period."""
    pays = first_pay_rows(online, first_recharge, register, income)
    official = F.col("type") == 1
    official_11 = official & (F.col("money") >= 11)
    users = distinct_if(
        pays,
        KEYS,
        "uid",
        {"first_pay": F.lit(True), "first_official": official, "first_official_11": official_11},
    )
    sums = {
        "first_pay_money": (F.col("first_second") == 1, "money"),
        "first_pay_official_money": (official, "money"),
        "first_official_11_money": (official_11, "money"),
        "first_pay_all_money": (F.lit(True), "money_total"),
        "first_official_all_money": (official, "money_total"),
        "first_official_11_all_money": (official_11, "money_total"),
    }
    money = pays.groupBy(*KEYS).agg(
        *[F.sum(F.when(cond, F.col(v)).otherwise(0)).alias(n) for n, (cond, v) in sums.items()]
    )
    return assemble([online_non_payers(online, first_recharge if payers is None else payers), users, money], KEYS)


def with_channel_columns(leaves: DataFrame, config: DataFrame) -> DataFrame:
    """Parsed channel, partner type and name, ratios."""
    names = config.groupBy(F.col("chancode").cast("int").alias("channel_code")).agg(
        F.min_by(F.struct("statis_type", F.col("channame").alias("channel_name")), "channame").alias("_c")
    )
    return (
        leaves.withColumn("_p", parse_channel(F.col("channel_id")))
        .select("*", "_p.*")
        .drop("_p")
        .join(names, "channel_code", "left")
        .withColumns(
            {
                "statis_type": F.coalesce("_c.statis_type", F.lit(0)),
                "channel_name": F.coalesce("_c.channel_name", F.lit("")),
                "display": F.lit(codes.LEVEL_LEAF),
            }
        )
        .drop("_c")
        .withColumns(ratios())
    )


def subtotals(leaves: DataFrame) -> DataFrame:
    """Levels 1 to 9, each from the leaves alone.

    Every leaf is tagged with the levels it belongs to and one aggregation serves them all;
    leaves are one row per channel and day, so the repetition is small.
    """
    c = F.col
    kind, partner, code, sub = c("channel_type"), c("statis_type"), c("channel_code"), c("channel_subcode")
    none = F.lit(0)
    tags = [
        (F.lit(True), 1, none, none),
        (F.lit(True), 2, kind, code),
        ((kind == 1) & (code == 1000) & (sub == 0), 3, kind, code),
        ((kind == 2) & (partner == 1), 4, kind, none),
        ((kind == 2) & (partner == 4), 5, kind, none),
        ((kind == 2) & (partner == 3), 6, kind, none),
        ((kind == 3) & (code == 1001) & (sub == 0), 7, kind, code),
        (kind == 4, 8, kind, none),
        (kind.isin(3, 4) & (partner == 1), 9, none, none),
    ]
    tagged = leaves.withColumn(
        "_tag",
        F.explode(
            F.array_compact(
                F.array(
                    *[
                        F.when(
                            cond,
                            F.struct(F.lit(n).alias("display"), k.alias("level_type"), p.alias("level_code")),
                        )
                        for cond, n, k, p in tags
                    ]
                )
            )
        ),
    )
    rep = F.struct("channel_id", "channel_name", "device_type", "statis_type", "channel_type", "channel_code")
    rows = tagged.groupBy("dt", "_tag").agg(
        F.count(F.lit(1)).alias("channel_num"),
        F.min(rep).alias("_rep"),
        *[F.sum(m).alias(m) for m in MEASURES],
    )
    level = c("_tag.display")
    whole_day = level == codes.LEVEL_DAY
    fixed = reduce(
        lambda expr, item: F.when(level == item[0], item[1]).otherwise(expr),
        codes.LEVEL_NAMES.items(),
        c("_rep.channel_name"),
    )
    parent = F.concat(c("_rep.channel_name"), F.lit(" "), platform_name(c("_rep.channel_type")))
    label = F.when(whole_day, codes.LABEL_DAY_COUNT).otherwise(codes.LABEL_SUB_COUNT)
    code_shown = level.isin(codes.LEVEL_PARENT, 3, 7, 8)
    return rows.select(
        "dt",
        F.concat(label, c("channel_num").cast("string")).alias("channel_id"),
        F.when(level == codes.LEVEL_PARENT, parent).otherwise(fixed).alias("channel_name"),
        F.when(whole_day, 0).otherwise(c("_rep.device_type")).alias("device_type"),
        F.when(whole_day, 0).otherwise(c("_rep.statis_type")).alias("statis_type"),
        F.when(whole_day, 0).otherwise(c("_rep.channel_type")).alias("channel_type"),
        F.when(code_shown, c("_rep.channel_code")).otherwise(0).alias("channel_code"),
        "channel_num",
        *MEASURES,
        level.alias("display"),
    ).withColumns(ratios())


def first_pay_report(
    online: DataFrame,
    first_recharge: DataFrame,
    register: DataFrame,
    income: DataFrame,
    config: DataFrame,
    payers: DataFrame | None = None,
) -> DataFrame:
    """Leaves and subtotals in one frame, told apart by ``display``.

    ``first_recharge`` has the first payments of the period of the report. ``payers``, if given, has those
    of all time, which decide who has not paid yet.
    """
    leaves = with_channel_columns(first_pay_leaves(online, first_recharge, register, income, payers), config)
    leaves = cut_lineage(leaves.withColumn("channel_num", F.lit(1).cast("bigint")))
    return leaves.unionByName(subtotals(leaves), allowMissingColumns=True)
