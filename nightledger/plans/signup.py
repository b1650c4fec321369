"""Sign-up fraud filter and partner settlement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.functions.channel import is_android, is_ios
from nightledger.functions.dates import DAY, epoch_to_dt
from nightledger.functions.numeric import count_if
from nightledger.functions.text import from_end
from nightledger.operators.joins import best_pattern, match_patterns
from nightledger.operators.merge import assemble
from nightledger.operators.windows import beyond_first_k, keep_first
from nightledger.session import cut_lineage


def seen_before(
    users: DataFrame, status: DataFrame, start: int, end: int, col: str, lookback: int = 10, min_uid: int = codes.SIGNUP_MIN_UID
) -> DataFrame:
    """Addresses or devices of sign-ups in the days before the run."""
    earlier = users.filter(
        (F.col("uid") > min_uid)
        & (F.col("cr_dt") > start - lookback * DAY)
        & (F.col("cr_dt") < end - DAY)
    ).select("uid")
    return earlier.join(status.select("uid", col), "uid").select(col).distinct()


def candidates(
    users: DataFrame,
    status: DataFrame,
    profile: DataFrame,
    start: int,
    end: int,
    min_uid: int = codes.SIGNUP_MIN_UID,
) -> DataFrame:
    """Sign-ups of the run with address, device and last activity.

    The nickname test is an OR of two NOT LIKEs: it only drops users without a nickname and
    names holding both fragments.
    """
    a, b = (f"%{f}%" for f in codes.NICKNAME_FRAGMENTS)
    named = profile.filter(~F.col("nickname").like(a) | ~F.col("nickname").like(b)).select("uid")
    return (
        users.filter((F.col("uid") > min_uid) & (F.col("cr_dt") > start) & (F.col("cr_dt") < end))
        .join(status, "uid")
        .join(named, "uid")
        .select(
            "uid",
            "cr_dt",
            F.col("lastactivitytime").alias("lastactivity_time"),
            F.col("lastip").alias("regip"),
            F.col("macaddr").alias("device"),
            "channelid",
            "showid",
            "qqstatus",
            "renrenstatus",
        )
    )


def removed_by_history(rows: DataFrame, seen_ips: DataFrame, seen_devices: DataFrame) -> DataFrame:
    """Per channel, how many sign-ups use an address or a device seen before."""
    ip = rows.join(seen_ips.withColumnRenamed("lastip", "regip"), "regip", "left_semi")
    device = rows.join(seen_devices.withColumnRenamed("macaddr", "device"), "device", "left_semi")
    counts = [
        f.groupBy("channelid").agg(F.count(F.lit(1)).alias(n)) for f, n in ((ip, "ip_num"), (device, "device_num"))
    ]
    return assemble(counts, ["channelid"])


def signup_steps(
    users: DataFrame,
    status: DataFrame,
    profile: DataFrame,
    partners: DataFrame,
    start: int,
    end: int,
    *,
    per_ip: int,
    min_seconds: int,
    ios_seconds: int = 180,
    min_uid: int = codes.SIGNUP_MIN_UID,
) -> DataFrame:
    """Partner sign-ups flagged in the order 3, 2, 1, each only where no earlier flag is set.

    3: beyond the first ``per_ip`` of an address; 2: later sign-ups of a device; 1: last seen
    too soon after signing up. The settlement reads the result several times, so it is
    computed once.
    """
    rows = (
        candidates(users, status, profile, start, end, min_uid)
        .join(
            seen_before(users, status, start, end, "lastip", min_uid=min_uid).withColumnRenamed("lastip", "regip"),
            "regip",
            "left_anti",
        )
        .join(
            seen_before(users, status, start, end, "macaddr", min_uid=min_uid).withColumnRenamed("macaddr", "device"),
            "device",
            "left_anti",
        )
    )
    active = partners.filter((F.col("type") == 3) & (F.col("status") == 1)).select(
        "partner_id", F.col("channelid").alias("pattern")
    )
    today = users.filter((F.col("cr_dt") > start) & (F.col("cr_dt") < end))
    # A partner may have several patterns and rows: a sign-up belongs to it once.
    owners = match_patterns(today, active, "channelid", "pattern").select("channelid", "partner_id").distinct()
    rows = rows.join(owners, "channelid")
    rows = cut_lineage(rows.withColumn("row_id", F.struct("uid", "partner_id")))
    rows = beyond_first_k(rows, ["regip"], "row_id", per_ip, "step3")
    first_on_device = (
        rows.filter(F.col("step3") == 0)
        .groupBy("device")
        .agg(F.min("uid").alias("uid"))
        .select("uid", F.lit(1).alias("first_on_device"))
        .distinct()
    )
    rows = rows.join(first_on_device, "uid", "left").withColumn(
        "step2",
        F.when((F.col("step3") == 0) & F.col("first_on_device").isNull() & F.col("device").isNotNull(), 1).otherwise(0),
    )
    stayed = F.col("lastactivity_time") - F.col("cr_dt")
    short = F.when(is_ios(F.col("channelid")), stayed < ios_seconds).otherwise(stayed < min_seconds)
    steps = rows.withColumn(
        "step1", F.when((F.col("step3") == 0) & (F.col("step2") == 0) & short, 1).otherwise(0)
    )
    return cut_lineage(steps.drop("row_id", "first_on_device"))



def is_valid() -> Column:
    return (F.col("step1") + F.col("step2") + F.col("step3")) == 0


def signup_summary(steps: DataFrame, start: int) -> DataFrame:
    """One row for the run: sign-ups, valid ones and each step."""
    return steps.agg(
        F.count(F.lit(1)).alias("reg_total"),
        F.coalesce(count_if(is_valid()), F.lit(0)).alias("user_num"),
        *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in ("step1", "step2", "step3")],
    ).select(epoch_to_dt(F.lit(start)).alias("dt"), "*")


def valid_signups(steps: DataFrame) -> DataFrame:
    return steps.filter(is_valid())


def invalid_signups(steps: DataFrame) -> DataFrame:
    return steps.filter(~is_valid())


def partner_funnel(steps: DataFrame) -> DataFrame:
    """Per partner, all sign-ups, those stopped by each step and those left."""
    return steps.groupBy("partner_id").agg(
        F.count(F.lit(1)).alias("step0"),
        *[F.sum(s).alias(s) for s in ("step1", "step2", "step3")],
        count_if(is_valid()).alias("valid_num"),
    )


def one_per_partner(partners: DataFrame) -> DataFrame:
    """Terms of each partner; of several rows the one of the lowest price, then cut rate and type."""
    terms = keep_first(partners.select("partner_id", "price", "cut_rate", "type"), ["partner_id"], ["price", "cut_rate", "type"])
    return terms.select("partner_id", "price", "type", "cut_rate")


def partner_summary(steps: DataFrame, partners: DataFrame) -> DataFrame:
    """Per partner with valid sign-ups: units after the cut, price and the counts of each step."""
    keep = F.lit(1) - F.col("cut_rate").cast("decimal(10,2)") / 100
    return (
        partner_funnel(steps)
        .filter(F.col("valid_num") > 0)
        .join(one_per_partner(partners), "partner_id")
        .select(
            "partner_id",
            F.floor(F.col("valid_num") * keep).cast("bigint").alias("user_num"),
            "price",
            "type",
            "step0",
            "step1",
            "step2",
            "step3",
        )
    )


def scaled_units(unit: Column, rate: Column, discount: Column, channel: Column) -> Column:
    """Units after the login-rate rules, in the closed form of three updates run in order.

    iOS, the unlimited android code and discounts under one half are exempt. Otherwise more
    than 10 units at a rate under 5 (for newer android at most 5) are worth nothing, and more
    than 15 units at a low rate are scaled by it.
    """
    android = is_android(channel)
    newer = android & (from_end(channel, 9, 3) >= str(codes.MIN_QUALITY_VERSION))
    exempt = is_ios(channel) | (android & (from_end(channel, 6, 4) == codes.UNLIMITED_CODE)) | (discount < 0.5)
    high = F.when(newer, 40).otherwise(50)
    scaled = F.ceil(unit * (rate * 2 - 10) / 100).cast("bigint")
    return (
        F.when(exempt, unit)
        .when((unit > 10) & (rate < 5), F.lit(0))
        .when((unit > 10) & newer & (rate == 5), F.lit(0))
        .when((unit > 15) & rate.between(F.lit(5), high), scaled)
        .otherwise(unit)
    )


def subchannel_settlement(
    steps: DataFrame,
    partners: DataFrame,
    discounts: DataFrame,
    chats: DataFrame,
    start: int,
    end: int,
) -> DataFrame:
    """Per sub-channel of the run: units after discount and quality rules, price and total."""
    valid = (
        valid_signups(steps)
        .groupBy("channelid")
        .agg(F.count(F.lit(1)).alias("tol"), F.min("partner_id").alias("partner_id"))
    )
    best = best_pattern(
        valid,
        discounts.select("id", F.col("channelid").alias("pattern"), "grade", "discount"),
        "channelid",
        "pattern",
        ["discount"],
        F.col("grade"),
        "id",
    )
    talkers = (
        chats.filter((F.col("dateline") > start) & (F.col("dateline") < end))
        .select(F.col("from_uid").alias("uid"))
        .distinct()
        .withColumn("talks", F.lit(1))
    )
    linked = (F.col("qqstatus") == 1) | (F.col("renrenstatus") == 1)
    extras = (
        steps.join(talkers, "uid", "left")
        .groupBy("partner_id", "channelid")
        .agg(
            F.coalesce(F.sum("talks"), F.lit(0)).alias("talk_num"),
            count_if(F.coalesce(linked, F.lit(False))).alias("qq_num"),
        )
    )
    unit = F.ceil(F.col("tol") * F.col("discount")).cast("bigint")
    share = F.try_divide(F.col("qq_num").cast("decimal(18,4)"), F.col("unit"))
    # The quotient of two counts is kept to four places before it becomes a percentage.
    rate = F.when(F.col("qq_num") > 0, F.round(share, 4).cast("decimal(18,4)") * 100)
    rows = (
        valid.join(best, "channelid")
        .join(one_per_partner(partners).select("partner_id", "price"), "partner_id")
        .join(extras, ["partner_id", "channelid"], "left")
        .withColumn("unit", unit)
        .withColumn("qq_rate", F.when(F.col("unit") == 0, None).otherwise(F.coalesce(rate, F.lit(0))))
    )
    final = scaled_units(F.col("unit"), F.col("qq_rate"), F.col("discount"), F.col("channelid"))
    return rows.withColumn("unit", final).select(
        "partner_id",
        "channelid",
        epoch_to_dt(F.lit(start)).alias("dt"),
        "unit",
        F.col("price").alias("unit_price"),
        (F.col("unit") * F.col("price")).alias("total"),
        F.col("discount").alias("ext1"),
        F.col("tol").alias("ext2"),
        F.coalesce("talk_num", F.lit(0)).alias("talk_num"),
        F.coalesce("qq_num", F.lit(0)).alias("qq_num"),
        "qq_rate",
    )
