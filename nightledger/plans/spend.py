"""Unified spend fact, monitor totals, first and second spend per user."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.functions.dates import day_of, hour_of, month_of, year_of
from nightledger.functions.numeric import signed
from nightledger.operators.merge import merge_add
from nightledger.operators.windows import dense_ids, first_k


def _half(c: Column) -> Column:
    return F.floor(c / 2).cast("bigint")


def _fact(
    rows: DataFrame,
    kind: int | Column,
    *,
    coin: Column,
    son: Column | None = None,
    item: Column | None = None,
    num: Column | None = None,
    hot: Column | None = None,
    diamond: Column | None = None,
    host: Column | None = None,
    room: Column | None = None,
) -> DataFrame:
    """Project one source to the fact columns; what a source lacks is 0."""
    zero = F.lit(0)
    t = F.col("dateline")
    whole = {
        "uid": F.col("uid"),
        "roomid": room,
        "year": year_of(t),
        "month": month_of(t),
        "day": day_of(t),
        "hour": hour_of(t),
        "dateline": t,
        "consume_coin": coin,
        "consume_type": kind if isinstance(kind, Column) else F.lit(kind),
        "consume_type_son": son,
        "consume_id": item,
        "consume_num": F.lit(1) if num is None else num,
        "dj_hot": hot,
        "dj_diamond": diamond,
        "anchor_uid": host,
    }
    return rows.select("dt", *[(zero if c is None else c).cast("bigint").alias(n) for n, c in whole.items()])


def _grouped_props(props: DataFrame, prices: DataFrame) -> DataFrame:
    """Prop purchases per day, category, buyer and target, with the price of the first prop bought.

    Show props are categories 5 and 6. Of category 4 only props bought for oneself count, as
    other props. A group has one category, so both kinds come from one pass.
    """
    c = F.col
    show = c("category").isin(5, 6)
    own = (c("category") == 4) & (c("fuid") == c("uid"))
    groups = (
        props.filter(show | ~c("category").isin(4, 5, 6) | own)
        .groupBy("dt", "category", "uid", "fuid")
        .agg(
            F.sum("total").alias("total"),
            F.sum("spend").alias("spend"),
            F.min(F.struct("dateline", "admin_prop_id")).alias("first"),
        )
        .select(
            "dt",
            "category",
            "uid",
            "fuid",
            "total",
            "spend",
            "first.*",
            F.when(show, codes.SPEND_SHOW_PROP).otherwise(codes.SPEND_PROP).alias("kind"),
        )
    )
    return groups.join(prices.select("admin_prop_id", "price"), "admin_prop_id")


def spend_fact(
    props: DataFrame,
    prop_prices: DataFrame,
    games: DataFrame,
    show_gifts: DataFrame,
    gifts: DataFrame,
    gift_costs: DataFrame,
    memberships: DataFrame,
    songs: DataFrame,
    crowns: DataFrame,
    red_packets: DataFrame,
) -> DataFrame:
    """Nine spending logs as one fact."""
    c = F.col
    counted = (
        gifts.filter((c("admin_gift_id") != 9999) & (c("sender") != codes.SYSTEM_UID))
        .groupBy("dt", "admin_gift_id", "sender", c("uid").alias("receiver"))
        .agg(F.count(F.lit(1)).alias("num"), F.min("dateline").alias("dateline"))
        .join(gift_costs.select(c("giftid").alias("admin_gift_id"), "cost"), "admin_gift_id")
        .withColumnRenamed("sender", "uid")
    )
    value = c("num") * c("cost")

    parts: Sequence[DataFrame] = (
        _fact(
            _grouped_props(props, prop_prices),
            c("kind"),
            coin=c("spend"),
            son=c("category"),
            item=c("admin_prop_id"),
            num=c("total"),
            hot=_half(c("price")),
            diamond=_half(c("price")),
            host=c("fuid"),
        ),
        _fact(
            games.filter(c("gameid").isin(1, 3, 5)),
            codes.SPEND_GAME,
            coin=c("spend_money"),
            son=c("gameid"),
            item=c("admin_gift_id"),
            num=c("gift_num"),
            room=c("roomid"),
        ),
        _fact(
            show_gifts.filter(c("note") != "bag").withColumns({"host": c("uid"), "uid": c("sender")}),
            codes.SPEND_SHOW_GIFT,
            coin=c("spendmoney"),
            son=c("cust_gift_id"),
            item=c("admin_gift_id"),
            num=c("realnum"),
            hot=_half(c("spendmoney")),
            diamond=_half(c("spendmoney")),
            host=c("host"),
            room=c("roomid"),
        ),
        _fact(
            counted,
            codes.SPEND_GIFT,
            coin=value,
            item=c("admin_gift_id"),
            num=c("num"),
            diamond=_half(value),
            host=c("receiver"),
        ),
        _fact(memberships, codes.SPEND_MEMBERSHIP, coin=c("money"), son=c("vip")),
        _fact(
            songs.filter(c("status") == 2),
            codes.SPEND_SONG,
            coin=c("coin"),
            hot=_half(c("coin")),
            diamond=_half(c("coin")),
            room=c("roomid"),
        ),
        _fact(
            crowns.filter(c("status") == 1), codes.SPEND_CROWN, coin=c("cost"), son=c("ref_giftid"), host=c("fuid")
        ),
        _fact(
            red_packets.filter(c("type").isin(1, 3)).withColumn("uid", c("send_uid")),
            codes.SPEND_RED_PACKET,
            coin=signed(c("type") == 1, c("amount")),
            son=c("type"),
            room=c("roomid"),
        ),
    )
    return reduce(DataFrame.unionByName, parts)


def monitor_totals(fact: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """Running spend per user in hundreds of coins, positive rows only."""
    new = (
        fact.filter((F.col("uid") != codes.VISITOR_UID) & (F.col("consume_coin") > 0))
        .groupBy("uid")
        .agg((F.sum("consume_coin").cast("decimal(20,2)") / 100).cast("decimal(20,2)").alias("money"))
    )
    return new if old is None else merge_add(old, new, ["uid"], ["money"])


ID_ORDER = ["dateline", "dt", "uid", "consume_type", "consume_type_son", "consume_id", "roomid", "anchor_uid", "consume_coin"]


def with_ids(fact: DataFrame, dt: int = 0) -> DataFrame:
    """The fact with ``id``, dense in the order of time. Ids of a day follow its number, so a rerun moves no other day's."""
    return dense_ids(fact, ID_ORDER, "id", dt << 32)


SPEND_COLS = ["dateline", "consume_coin", "consume_type", "consume_type_son"]


def first_spends(fact: DataFrame, n: int, skip_uid: int = codes.SYSTEM_UID) -> DataFrame:
    """uid, its first ``n`` spends by time and id as a sorted array, and how many spends there are.

    A state that merges, see :func:`merge_first_spends`: no more than ``n`` rows of a user leave a task.
    """
    spends = fact.filter((F.col("consume_coin") != 0) & (F.col("uid") != skip_uid))
    counts = spends.groupBy("uid").agg(F.count(F.lit(1)).alias("times"))
    spend = F.struct("dateline", "id", *SPEND_COLS[1:])
    early = (
        first_k(spends.select("uid", "id", *SPEND_COLS), ["uid"], ["dateline", "id"], n)
        .groupBy("uid")
        .agg(F.array_sort(F.collect_list(spend)).alias("firsts"))
    )
    return early.join(counts, "uid").select("uid", "firsts", "times")


def merge_first_spends(rows: DataFrame, n: int) -> DataFrame:
    """One row per user from states of any days, in any order: late spends take their place."""
    merged = rows.groupBy("uid").agg(F.flatten(F.collect_list("firsts")).alias("all"), F.sum("times").alias("times"))
    return merged.select("uid", F.slice(F.array_sort("all"), 1, n).alias("firsts"), "times")


def nth_of(state: DataFrame, n: int) -> DataFrame:
    """Each user's ``n``-th spend, the last one so far if fewer, and how many there were."""
    spend = F.get("firsts", F.least(F.lit(n), F.size("firsts")) - 1)
    return state.select("uid", *[spend[c].alias(c) for c in SPEND_COLS], "times")


def nth_spend(fact: DataFrame, n: int, old: DataFrame | None = None, skip_uid: int = codes.SYSTEM_UID) -> DataFrame:
    """Each user's ``n``-th spend (the last one so far if fewer) and how many there were.

    ``old`` is the table so far, for ``n`` of 1 or 2; its row stands for the spends already counted, so new spends
    continue the numbering. A table of one row per user cannot do so beyond the second spend:
    :func:`first_spends` is a state for any ``n``.
    """
    if old is None:
        return nth_of(first_spends(fact, n, skip_uid), n)
    if n not in (1, 2):
        raise ValueError("the table so far cannot continue a numbering beyond the second spend")
    spends = fact.filter((F.col("consume_coin") != 0) & (F.col("uid") != skip_uid))
    counts = spends.groupBy("uid").agg(F.count(F.lit(1)).alias("times"))
    row = F.struct(*SPEND_COLS)
    early = (
        first_k(spends.select("uid", "id", *SPEND_COLS), ["uid"], ["dateline", "id"], n)
        .groupBy("uid")
        .agg(F.min_by(row, "rank").alias("first"), F.max_by(row, "rank").alias("nth"))
    )
    new = counts.join(early, "uid")
    state = old.select("uid", F.col("times").alias("had"), F.struct(*SPEND_COLS).alias("was"))
    had = F.coalesce("had", F.lit(0))
    pick = (
        F.when((had >= n) | F.col("nth").isNull(), F.col("was"))
        .when(had == 0, F.col("nth"))
        .otherwise(F.col("first"))
    )
    return (
        state.join(new, "uid", "full")
        .withColumn("pick", pick)
        .select("uid", "pick.*", (had + F.coalesce("times", F.lit(0))).alias("times"))
    )
