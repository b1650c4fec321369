"""Channel quality: activity of new devices, deductions, and what each channel is paid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.functions.channel import (
    below_settled_version,
    device_mismatch,
    is_android,
    is_ios,
    parent_code,
    price_platform,
    product_class,
    standard_class,
    valid_channel,
    version_gate,
)
from nightledger.functions.dates import HALF_DAY, day_number, dt_to_epoch, next_day, shift_dt
from nightledger.functions.numeric import count_if, percent
from nightledger.functions.text import byte_length, head
from nightledger.operators.aggs import time_bucket_count
from nightledger.operators.joins import best_pattern, count_containing, interval_join, match_patterns
from nightledger.operators.windows import keep_first, rolling_count
from nightledger.session import cut_lineage

DEVICE = ["dt", "idfa"]
CHANNEL = ["dt", "channel_id"]
IOS_SECONDS = 180
LOGIN_SECONDS = 90


def new_devices(first_visit: DataFrame) -> DataFrame:
    """One row per day and new device, old android versions left out."""
    rows = first_visit.filter(version_gate(F.col("channel_id")))
    return keep_first(
        rows.select("dt", "idfa", "ipaddr", "channel_id", "device_type", "dateline"), DEVICE, ["dateline", "channel_id"]
    )


def request_facts(requests: DataFrame) -> DataFrame:
    """Per day and device: login flags, number of requests, iOS session span, checksum row."""
    c = F.col
    known = (
        c("macaddr").isNotNull()
        & ~c("macaddr").isin("", "0")
        & F.coalesce(version_gate(c("channelid")), F.lit(True))
    )
    ios = is_ios(c("channelid"))
    t = c("dateline")
    facts = requests.groupBy("dt", F.col("macaddr").alias("idfa")).agg(
        F.max(F.when(known & (c("action") == codes.ACTION_LOGIN_QQ), 1).otherwise(0)).alias("login_qq"),
        F.max(F.when(known & (c("action") == codes.ACTION_LOGIN_WEIXIN), 1).otherwise(0)).alias("login_weixin"),
        F.count(F.when(known, c("action"))).alias("_n"),
        (F.max(F.when(known, t)) - F.min(F.when(known, t))).alias("_span"),
        (F.max(F.when(ios, t)) - F.min(F.when(ios, t))).alias("ios_span"),
        F.min(F.when(known, F.struct("dateline", "id", "channelid", "terminal", "idfv"))).alias("row"),
    )
    return facts.withColumn("login_num", F.when(c("_span") >= LOGIN_SECONDS, c("_n")).otherwise(0)).drop("_n", "_span")


def devices_per_ip(devices: DataFrame, days: int = 31) -> DataFrame:
    """Per day and address, new devices of that day and the ``days`` before."""
    dated = devices.withColumn("_day", day_number(F.col("dt")))
    counts = rolling_count(dated, "ipaddr", "_day", days, "device_per_ip")
    return counts.withColumn("dt", F.date_format(F.date_from_unix_date("_day"), "yyyyMMdd").cast("int")).drop("_day")


def active_devices(register: DataFrame, log: DataFrame, name: str) -> DataFrame:
    """Devices of users registered that day who appear in a log of that day."""
    uids = log.filter(F.col("uid") != codes.VISITOR_UID).select("dt", "uid").distinct()
    return register.join(uids, ["dt", "uid"], "left_semi").select(*DEVICE).distinct().withColumn(name, F.lit(1))


def device_beats(devices: DataFrame, heartbeats: DataFrame) -> DataFrame:
    """Beats of new devices for each day they count on: own ones, and those after noon of the day before.

    A new device asks for the beats of its day and of the day before, so beats are not repeated and only those of new
    devices go on.
    """
    c = F.col
    own = devices.select(*DEVICE, c("dateline").alias("visit"))
    same = F.struct(c("dt").alias("log_dt"), F.lit(True).alias("own"))
    before = F.struct(shift_dt(c("dt"), -1).alias("log_dt"), F.lit(False).alias("own"))
    asked = own.select("*", F.explode(F.array(same, before)).alias("_log")).select(*own.columns, "_log.*")
    log = heartbeats.select("idfa", "roomid", c("dateline").alias("beat"), c("dt").alias("log_dt"))
    after_noon = c("beat") > dt_to_epoch(c("log_dt")) + HALF_DAY
    return (
        log.join(asked, ["idfa", "log_dt"])
        .filter(c("own") | after_noon)
        .select(*DEVICE, "visit", "roomid", "beat", "own")
    )


def beat_counts(beats: DataFrame) -> DataFrame:
    """Distinct ten-second buckets with a beat on the day, per new device, from :func:`device_beats`."""
    today = beats.filter(F.col("own") & (F.col("beat") > dt_to_epoch(F.col("dt"))) & (byte_length(F.col("idfa")) > 1))
    return time_bucket_count(today, DEVICE, "beat", 10, "heartbeat")


def on_air_facts(beats: DataFrame, workload: DataFrame, hours: int = 12) -> DataFrame:
    """Beats on air within ``hours`` of the first visit, and rooms on air visited that day.

    ``beats`` comes from :func:`device_beats`. Intervals are clipped to the days they are asked for before they
    are looked at, so an interval that was never closed costs no more than the run is long. The bounds of the run are
    read first and reach the scan of ``workload``; without beats nothing is read from it. Only the number of intervals
    around a beat matters and whether one was reported after its day began, so beats and intervals are not paired.
    """
    c = F.col
    first, last = F.min("dt"), F.max("dt")
    lo, hi = beats.agg(dt_to_epoch(first) - HALF_DAY, dt_to_epoch(shift_dt(last, 1)) - 1).first()  # two numbers
    spans = workload.filter((c("start_dt") < hi) & (c("end_dt") > lo)).select(
        "roomid",
        F.greatest("start_dt", F.lit(lo)).alias("start_dt"),
        F.least("end_dt", F.lit(hi)).alias("end_dt"),
        c("dateline").alias("reported"),
    )
    dated = beats.withColumn("day_start", dt_to_epoch(c("dt"))).withColumn("day_end", next_day(c("day_start")) - 1)
    usual = (c("beat") > c("day_start") - HALF_DAY) & (c("beat") < c("day_end"))
    # A report comes after the start of a beat's day if the beat is no later than the day of the second before the report.
    last_report = F.greatest(F.least("reported", F.lit(hi) + 1), F.lit(lo)) - 1
    report_day_end = next_day(last_report) - 1
    counts = {
        "on_air": (c("start_dt"), c("end_dt")),
        "reported_later": (c("start_dt"), F.when(c("reported").isNotNull(), F.least("end_dt", report_day_end))),
    }
    found = count_containing(dated.filter(usual), spans, ["roomid"], "beat", counts).filter(c("on_air") > 0)
    counted = dated.filter(usual).join(found, ["roomid", "beat"])
    # Beats of another day than their log's, and those of a day's last second, are held against each interval.
    paired = interval_join(dated.filter(~usual), spans, ["roomid"], "beat", "start_dt", "end_dt").filter(
        (c("start_dt") < c("day_end")) & (c("end_dt") > c("day_start") - HALF_DAY)
    )
    later = F.when(c("reported") > c("day_start"), 1).otherwise(0).cast("bigint")
    paired = paired.withColumns({"on_air": F.lit(1).cast("bigint"), "reported_later": later}).select(*counted.columns)
    today = (c("beat") > c("day_start")) & (c("reported_later") > 0) & (c("visit") > c("day_start"))
    rooms = counted.unionByName(paired).groupBy(*DEVICE, "roomid").agg(
        F.sum(F.when(c("beat") <= c("visit") + hours * 3600, c("on_air")).otherwise(0)).alias("beats"),
        F.max(F.when(today, 1).otherwise(0)).alias("room"),
    )
    return rooms.groupBy(*DEVICE).agg(
        F.sum("beats").alias("heartbeat_active"), F.sum("room").cast("bigint").alias("room_num")
    )


def device_facts(
    devices: DataFrame,
    requested: DataFrame,
    heartbeats: DataFrame,
    workload: DataFrame,
    register: DataFrame,
    recharge: DataFrame,
    spend: DataFrame,
    history: DataFrame | None = None,
) -> DataFrame:
    """One row per day and new device with everything the channel rules look at.

    ``devices`` comes from :func:`new_devices`, ``requested`` from :func:`request_facts`.
    ``history`` holds new devices of earlier days, which only count towards their address.
    """
    c = F.col
    seen = devices.select("dt", "ipaddr")
    if history is not None:
        seen = seen.unionByName(history.select("dt", "ipaddr"))
    registered = register.filter(version_gate(c("channel_id"))).select("dt", "uid", "idfa")
    paid = recharge.filter(
        (c("rechange_status") == codes.PAY_SUCCESS) & (c("rechange_channel") < codes.COIN_FROM)
    )
    beats = cut_lineage(device_beats(devices, heartbeats))
    facts = (
        devices.join(requested.drop("row"), DEVICE, "left")
        .join(beat_counts(beats), DEVICE, "left")
        .join(on_air_facts(beats, workload), DEVICE, "left")
        .join(active_devices(registered, paid, "recharge"), DEVICE, "left")
        .join(active_devices(registered, spend.filter(c("consume_coin") > 0), "consume"), DEVICE, "left")
        .join(devices_per_ip(seen), ["dt", "ipaddr"], "left")
        .fillna(
            0,
            [
                "login_qq",
                "login_weixin",
                "login_num",
                "heartbeat",
                "heartbeat_active",
                "room_num",
                "recharge",
                "consume",
                "device_per_ip",
            ],
        )
    )
    return facts.withColumn("heartbeat_active", F.when(c("heartbeat") < 2, c("heartbeat_active")).otherwise(0))


def _login_rate() -> Column:
    return F.sum(F.col("login_qq") + F.col("login_weixin")).cast("double") / F.count(F.lit(1))


def login_baselines(devices: DataFrame, requested: DataFrame, register: DataFrame) -> DataFrame:
    """Login rate of the standard channels per day and class; a fixed rate where it is 0 or nobody registered."""
    c = F.col
    rates = (
        devices.join(requested.select(*DEVICE, "login_qq", "login_weixin"), DEVICE, "left")
        .fillna(0, ["login_qq", "login_weixin"])
        .withColumn("class", standard_class(c("channel_id")))
        .filter(c("class") < 4)
        .groupBy("dt", "class")
        .agg(_login_rate().alias("rate"))
    )
    added = (
        register.filter(version_gate(c("channel_id")))
        .select("dt", "idfa", standard_class(c("channel_id")).alias("class"))
        .join(
            devices.filter(c("dateline") > dt_to_epoch(c("dt"))).select(*DEVICE), DEVICE, "left_semi"
        )
        .groupBy("dt", "class")
        .agg(F.count(F.lit(1)).alias("added"))
    )
    fixed = F.lit(None).cast("double")
    for number, value in codes.LOGIN_BASELINES.items():
        fixed = F.when(c("class") == number, float(value)).otherwise(fixed)
    use_fixed = (c("rate") == 0) | (F.coalesce("added", F.lit(0)) == 0)
    return rates.join(added, ["dt", "class"], "left").select(
        "dt", "class", F.when(use_fixed, fixed).otherwise(c("rate")).alias("baseline")
    )


def failed_checksums(requested: DataFrame) -> DataFrame:
    """Android devices per day and channel whose checksum did not pass."""
    rows = requested.select("dt", "row.*").filter(
        (F.col("terminal") == codes.DEVICE_ANDROID) & (F.col("channelid") != codes.PLACEHOLDER_CHANNEL)
    )
    failed = ~F.coalesce(F.col("idfv") == 1, F.lit(False))
    return (
        rows.filter(failed)
        .groupBy("dt", F.col("channelid").alias("channel_id"))
        .agg(F.count(F.lit(1)).alias("md5_fail_num"))
    )


def channel_counts(facts: DataFrame, baselines: DataFrame, failed: DataFrame, shared: int = 5) -> DataFrame:
    """Per day and channel: active and counted devices, deductions, additions, login factor, counted total.

    The statistic takes devices on addresses with fewer than ``shared`` devices, the
    deductions those with at most ``shared``.
    """
    c = F.col
    ch, device = c("channel_id"), c("device_type")
    android, ios = is_android(ch), is_ios(ch)
    few = c("device_per_ip") <= shared
    iphone = ch.startswith(codes.IPHONE)
    ipad = ch.startswith(codes.IPAD)
    idle = c("heartbeat") < 3
    own_android = android & (device == codes.DEVICE_ANDROID)
    own_iphone = iphone & (device == codes.DEVICE_IPHONE)
    own_ipad = ipad & (device == codes.DEVICE_IPAD)
    woke = idle & (c("heartbeat_active") > 3)
    nothing = (c("room_num") < 1) & (c("recharge") == 0) & (c("consume") == 0) & (c("login_num") < 2)
    short_ios = (
        ios & device.isin(codes.DEVICE_IPHONE, codes.DEVICE_IPAD) & F.coalesce(c("ios_span") < IOS_SECONDS, F.lit(False))
    )
    counts = (
        facts.filter(valid_channel(ch))
        .groupBy(*CHANNEL)
        .agg(
            F.count(F.lit(1)).alias("active_num"),
            count_if(c("device_per_ip") < shared).alias("stat_num"),
            count_if(few & device_mismatch(ch, device)).alias("del_1_num"),
            count_if(few & (own_android | own_iphone) & idle).alias("_idle"),
            count_if(few & short_ios).alias("_short"),
            count_if(few & ~ios & own_android & woke).alias("add_1_num"),
            count_if(few & ~ios & (own_android | own_iphone | own_ipad) & woke & nothing).alias("del_3_num"),
            _login_rate().alias("login_ratio"),
        )
        .withColumn("del_2_num", F.when(c("_short") > 0, c("_short")).otherwise(c("_idle")))
        .withColumn("class", product_class(ch))
        .join(baselines, ["dt", "class"], "left")
        .join(failed, CHANNEL, "left")
    )
    factor = F.lit(1.0) - (F.lit(1.0) - F.try_divide(c("login_ratio"), c("baseline"))) / 2
    factor = F.when(ios, F.lit(1.0)).otherwise(F.coalesce(F.least(factor, F.lit(1.0)), F.lit(0.0)))
    left_over = c("stat_num") - c("del_1_num") - c("del_2_num") + c("add_1_num") - c("del_3_num")
    return counts.withColumn("dis_4_num", F.when(ios | c("baseline").isNotNull(), factor).otherwise(F.lit(0.0))).select(
        *CHANNEL,
        "active_num",
        "stat_num",
        "del_1_num",
        "del_2_num",
        "add_1_num",
        "del_3_num",
        "dis_4_num",
        F.when(android, F.coalesce("md5_fail_num", F.lit(0))).otherwise(0).alias("md5_fail_num"),
        F.greatest(F.round(left_over * c("dis_4_num") + F.lit(0.1)), F.lit(0.0)).cast("bigint").alias("cal_num"),
    )


def final_units(cal: Column, remain: Column, discount: Column) -> Column:
    """Units paid: full inside the remaining quota, discounted beyond it."""
    return (
        F.when(remain == 0, cal * discount)
        .when(remain > cal, cal.cast("decimal(20,4)"))
        .otherwise(remain + (cal - remain) * discount)
    )


def settle(
    counts: DataFrame,
    prices: DataFrame,
    discounts: DataFrame,
    partners: DataFrame,
    quota: DataFrame,
    previous: DataFrame | None = None,
    default_discount: str = "1",
) -> DataFrame:
    """Price, discount, units paid, change on the day before, amount and partner per day and channel.

    ``quota`` holds the remaining quota per channel before the first day. Each day uses it up
    by its counted total, so what is left on a day is the quota less the running total of
    the days before, never below 0. ``previous`` supplies paid units of earlier days.
    """
    c = F.col
    ch = c("channel_id")
    channels = counts.select("channel_id").distinct()
    best = best_pattern(
        channels,
        discounts.filter(c("id") > 1).select("id", c("channelid").alias("pattern"), "grade", "discount"),
        "channel_id",
        "pattern",
        ["discount"],
        F.when(c("grade").isin(2, 3), c("grade")).otherwise(1),
        "id",
    )
    owner = (
        match_patterns(
            channels,
            partners.select("partner_id", "partner_name", c("channelid").alias("pattern")),
            "channel_id",
            "pattern",
        )
        .groupBy("channel_id")
        .agg(F.min(F.struct("partner_id", "partner_name")).alias("p"))
        .select("channel_id", "p.*")
    )
    price = prices.groupBy(head(c("code"), 4).alias("_parent"), c("channel_platform").alias("_platform")).agg(
        F.min_by("start_price", "code").alias("price")
    )
    left = quota.groupBy("channel_id").agg(F.max("remain").alias("quota"))
    days = Window.partitionBy("channel_id").orderBy("dt")
    used = F.coalesce(F.sum("cal_num").over(days.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = (
        counts.withColumns({"_parent": parent_code(ch), "_platform": price_platform(ch)})
        .join(price, ["_parent", "_platform"], "left")
        .join(best, "channel_id", "left")
        .join(owner, "channel_id", "left")
        .join(left, "channel_id", "left")
        .withColumn("remain", F.greatest(F.coalesce("quota", F.lit(0)) - used, F.lit(0)))
        .withColumn("discount_ratio", F.coalesce("discount", F.lit(default_discount).cast("decimal(10,4)")))
    )
    rows = rows.withColumn(
        "paid_num", final_units(c("cal_num"), c("remain"), c("discount_ratio")).cast("decimal(20,4)")
    )
    gated = below_settled_version(ch)
    rows = rows.withColumn("final_num", F.when(gated, F.lit(0)).otherwise(c("paid_num")).cast("decimal(20,4)"))
    before = rows.select("channel_id", shift_dt(c("dt"), 1).alias("dt"), c("final_num").alias("_before"))
    if previous is not None:
        before = before.unionByName(
            previous.select("channel_id", shift_dt(c("dt"), 1).alias("dt"), c("final_num").alias("_before"))
        )
    amount = F.coalesce(c("final_num") * c("price"), F.lit(0))
    return rows.join(before, CHANNEL, "left").select(
        *counts.columns,
        "price",
        "discount_ratio",
        "remain",
        "final_num",
        percent(c("paid_num"), c("_before")).alias("final_num_ratio"),
        amount.alias("total_price"),
        "partner_id",
        "partner_name",
    )


def channel_quality(
    first_visit: DataFrame,
    requests: DataFrame,
    heartbeats: DataFrame,
    workload: DataFrame,
    register: DataFrame,
    recharge: DataFrame,
    spend: DataFrame,
    prices: DataFrame,
    discounts: DataFrame,
    partners: DataFrame,
    quota: DataFrame,
    previous: DataFrame | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Quality and settlement per day and channel.

    ``quota`` and ``previous`` are described at :func:`settle`, ``history`` at
    :func:`device_facts`. New devices, request facts and channel counts are read several
    times and computed once, as are the beats of new devices.
    """
    devices = cut_lineage(new_devices(first_visit))
    requested = cut_lineage(request_facts(requests))
    facts = device_facts(devices, requested, heartbeats, workload, register, recharge, spend, history)
    baselines = login_baselines(devices, requested, register)
    counts = cut_lineage(channel_counts(facts, baselines, failed_checksums(requested)))
    return settle(counts, prices, discounts, partners, quota, previous)


def channel_totals(settled: DataFrame, old: DataFrame) -> DataFrame:
    """Quota table after the days in ``settled``: total counted so far and quota left."""
    used = settled.groupBy("channel_id").agg(F.sum("cal_num").alias("_used"))
    zero = F.lit(0)
    return (
        old.join(used, "channel_id", "full")
        .withColumn("_used", F.coalesce("_used", zero))
        .select(
            "channel_id",
            (F.coalesce("total", zero) + F.col("_used")).alias("total"),
            F.greatest(F.coalesce("remain", zero) - F.col("_used"), zero).alias("remain"),
        )
    )
