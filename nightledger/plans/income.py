"""Payment detail, first payments, daily and cumulative income."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.functions.numeric import count_if
from nightledger.operators.aggs import pivot_counts, pivot_sums
from nightledger.operators.joins import Lookup, label_by_precedence, nearest_lookup, with_memberships
from nightledger.operators.merge import merge_add
from nightledger.operators.windows import drop_later_duplicates, first_row
from nightledger.session import cut_lineage

DEVICE_COLS = ["idfa", "actid", "ipaddr", "channelid", "chantype", "chanver", "chancode", "terminal", "appver"]
TEXT_COLS = {"idfa", "channelid"}
RECHARGE_COLS = ["id", "uid", "dateline", "rechange_channel", "money", "rechange_status", "product_id", "orderid"]


def payments(recharge: DataFrame) -> DataFrame:
    """Payments split into money and coin, one row per successful official order."""
    kind = F.col("rechange_channel")
    rows = recharge.select(
        "id",
        "dt",
        "uid",
        "dateline",
        kind.alias("type"),
        F.when(kind < codes.COIN_FROM, F.col("money")).otherwise(0).alias("money"),
        F.lit(0).cast(recharge.schema["money"].dataType).alias("refund"),
        F.when(kind >= codes.COIN_FROM, F.col("money")).otherwise(0).alias("coin"),
        (F.col("rechange_status") == codes.PAY_SUCCESS).cast("int").alias("success"),
        F.col("product_id").alias("productid"),
        "orderid",
    )
    counted = (F.col("type") < codes.OFFICIAL_BELOW) & (F.col("success") == 1) & (F.col("money") > 0)
    return drop_later_duplicates(rows, ["dt", "orderid"], "id", counted)


def charges_with_refunds(ledger: DataFrame, within: int = 3600, internal_agents=codes.INTERNAL_AGENTS) -> DataFrame:
    """Agent charges, with ``refunded`` where a refund of the same user, product and amount follows within ``within`` seconds.

    One pass over the ledger: charges and refunds are told apart by a flag and paired by a window over time. The window
    runs in slots of ``within`` seconds, and a refund is shown to its own slot and to the one before, so a busy
    key is spread over its slots.
    """
    c = F.col
    known = ledger.filter(c("productid").isin(codes.AGENT_PRODUCT, codes.AGENT_OTHER_PRODUCT) & (c("money") != 0))
    slot = F.floor(c("dateline") / within)
    is_refund = c("money") < 0
    rows = known.select(
        "id",
        "dt",
        "uid",
        "dateline",
        F.floor(F.abs("money") / 100).alias("amount"),
        F.when(c("productid") == codes.AGENT_PRODUCT, codes.AGENT_TYPE).otherwise(codes.AGENT_OTHER_TYPE).alias("type"),
        "productid",
        F.when(c("salesperson").isin(*internal_agents), codes.LABEL_INTERNAL).otherwise(0).alias("special"),
        is_refund.alias("_refund"),
        F.explode(F.when(is_refund, F.array(slot, slot - 1)).otherwise(F.array(slot))).alias("_slot"),
    )
    ahead = Window.partitionBy("uid", "productid", "amount", "_slot").orderBy("dateline").rangeBetween(1, within)
    refunded = F.coalesce(F.max("_refund").over(ahead), F.lit(False)) & c("uid").isNotNull()
    return rows.withColumn("refunded", refunded).filter(~c("_refund")).drop("_refund", "_slot")


def refunded_charges(ledger: DataFrame, within: int = 3600, internal_agents=codes.INTERNAL_AGENTS) -> DataFrame:
    """Agent charges followed within ``within`` seconds by a refund of the same user, product and amount."""
    return charges_with_refunds(ledger, within, internal_agents).filter("refunded").drop("refunded")


def _placed(name: str) -> Column:
    """Device column of the pay request if that gave a channel type, else of the online record, else 0."""
    zero = F.lit("0") if name in TEXT_COLS else F.lit(0)
    requested = F.when(F.col("req.chantype") > 0, F.coalesce(F.col(f"req.{name}"), zero))
    return F.coalesce(requested, F.col(f"seen.{name}"), zero)


def attribute(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Add the device columns found for each row's user and second; refunds have no pay request."""
    paid_only = found.withColumnRenamed("req", "_req")
    joined = rows.join(paid_only, ["dt", "uid", "dateline"], "left").withColumn(
        "req", F.when(F.col("is_refund") == 0, F.col("_req"))
    )
    return joined.select(
        *rows.columns,
        *[_placed(c).alias(c) for c in DEVICE_COLS],
        (F.col("req.chancode") == int(codes.EXCLUDED_CODE)).alias("in_channel"),
    )


def income_detail(
    recharge: DataFrame,
    pay_req: DataFrame,
    online: DataFrame,
    ledger: DataFrame,
    register: DataFrame,
    internal: DataFrame,
    farmers: DataFrame,
    hosts: DataFrame,
    activation: DataFrame,
    *,
    tolerance: int = 5,
    refund_within: int = 3600,
    internal_agents: Sequence[str] = codes.INTERNAL_AGENTS,
    mark_agents: bool = True,
) -> DataFrame:
    """One row per payment or refunded agent charge, with device, channel and income label.

    The device comes from the user's nearest pay request of the day with a channel, at most ``tolerance``
    seconds away: a nearer request without one does not hide it. Else it comes from the last online record of the day at or before the payment. Both
    are looked up in one pass over the seconds in which a user paid. Every log is read once: payments and charges are
    stored, the other logs have one scan in the plan.

    Labels are applied in a fixed order and the last one wins. Refund rows join after the
    first four rules and only see the agent and host rules.
    """
    charges = cut_lineage(charges_with_refunds(ledger, refund_within, internal_agents))
    recharge = cut_lineage(recharge.select("dt", *RECHARGE_COLS))
    seconds = [f.select("dt", "uid", "dateline") for f in (recharge, charges)]
    typed = F.col("chantype") > 0
    found = nearest_lookup(
        seconds[0].unionByName(seconds[1]),
        ["dt", "uid"],
        "dateline",
        [
            Lookup("placed", pay_req, "dateline", DEVICE_COLS, ["id"], "nearest", tolerance, where=typed),
            Lookup("any", pay_req, "dateline", DEVICE_COLS, ["id"], "nearest", tolerance),
            Lookup("seen", online, "dateline", DEVICE_COLS, ["actid"]),
        ],
        slot=None,
    )
    found = found.withColumn("req", F.coalesce("placed", "any")).drop("placed", "any")
    none = F.lit(0).cast(recharge.schema["money"].dataType)
    pays = payments(recharge).withColumns({"is_refund": F.lit(0), "ledger_special": F.lit(0)})
    refunds = charges.filter("refunded").select(
        "id",
        "dt",
        "uid",
        "dateline",
        "type",
        none.alias("money"),
        F.col("amount").alias("refund"),
        none.alias("coin"),
        F.lit(1).alias("success"),
        "productid",
        F.lit("0").alias("orderid"),
        F.lit(1).alias("is_refund"),
        F.col("special").alias("ledger_special"),
    )
    rows = with_memberships(
        attribute(pays.unionByName(refunds), found),
        "uid",
        {
            "in_special": register.filter(F.col("special") == 1),
            "in_internal": internal,
            "in_farmers": farmers,
            "in_hosts": hosts,
        },
    )
    by_agent = (
        charges.filter(F.col("special") == codes.LABEL_INTERNAL)
        .select("dt", "uid", F.lit(True).alias("by_agent"))
        .distinct()
    )
    known = activation.groupBy("idfa").agg(F.min("id").alias("act"))
    rows = rows.join(by_agent, ["dt", "uid"], "left").join(known, "idfa", "left")
    pay = F.col("is_refund") == 0
    agent_type = F.col("type") == codes.AGENT_TYPE
    special = label_by_precedence(
        [
            (pay & (F.coalesce("in_channel", F.lit(False)) | F.col("in_special")), codes.LABEL_SPECIAL_CHANNEL),
            (pay & F.col("in_internal") & agent_type, codes.LABEL_INTERNAL),
            (pay & F.col("in_farmers"), codes.LABEL_FARMER),
            (F.lit(mark_agents) & F.col("by_agent").isNotNull() & agent_type, codes.LABEL_INTERNAL),
            (F.col("in_hosts"), codes.LABEL_HOST),
        ],
        default=F.col("ledger_special"),
    )
    actid = F.when(F.col("actid") == 0, F.coalesce("act", F.lit(0))).otherwise(F.col("actid"))
    return rows.select(
        *[c for c in pays.columns if c != "ledger_special"],
        special.alias("special"),
        *[c if c != "actid" else actid.alias("actid") for c in DEVICE_COLS],
    )


def internal_totals(old: DataFrame, pays: DataFrame, internal: DataFrame) -> DataFrame:
    """Running agent payments per internal user: ``old`` (uid, money) plus the payments given."""
    new = (
        pays.filter(F.col("type") == codes.AGENT_TYPE)
        .join(internal.select("uid").distinct(), "uid", "left_semi")
        .groupBy("uid")
        .agg(F.sum("money").alias("money"))
    )
    return merge_add(old, new, ["uid"], ["money"])


def first_payments(detail: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """First payment per user, and the first payment of the other class on a day that has both.

    Classes are official and agent. A user's first row is never replaced; the second part is
    filled once, by the earliest day on which both classes appear. ``old`` is the table so far.
    """
    official = F.col("type") < codes.OFFICIAL_BELOW
    paid = detail.filter(
        (F.col("success") == 1)
        & (F.col("type") < codes.COIN_FROM)
        & (F.col("money") > 0)
        & (F.col("uid") > codes.VISITOR_UID)
    )
    moments = paid.groupBy("dt", "uid", "dateline").agg(
        F.sum("money").alias("money_sum"),
        first_row(["money", "special"], ["id"]).alias("first_row"),
        F.max(F.when(official, 1).otherwise(0)).alias("has_1"),
        F.max(F.when(~official, 1).otherwise(0)).alias("has_2"),
    )
    at = F.struct("dateline", "money_sum", "first_row")
    days = moments.groupBy("dt", "uid").agg(
        F.min(F.when(F.col("has_1") == 1, at)).alias("c1"),
        F.min(F.when(F.col("has_2") == 1, at)).alias("c2"),
    )
    one_first = F.col("c2").isNull() | (F.col("c1.dateline") <= F.col("c2.dateline"))
    both = F.col("c1").isNotNull() & F.col("c2").isNotNull()
    days = days.select(
        "uid",
        "dt",
        F.when(one_first & F.col("c1").isNotNull(), 1).otherwise(2).alias("type"),
        F.when(one_first & F.col("c1").isNotNull(), F.col("c1")).otherwise(F.col("c2")).alias("one"),
        F.when(both, F.when(one_first, 2).otherwise(1)).alias("type2"),
        F.when(both, F.when(one_first, F.col("c2")).otherwise(F.col("c1"))).alias("two"),
    )
    first = F.struct("type", "one.dateline", "one.first_row.money", "one.first_row.special")
    second = F.struct("type2", F.col("two.dateline").alias("dateline2"), F.col("two.money_sum").alias("money2"))
    new = days.groupBy("uid").agg(
        F.min("dt").alias("dt"),
        F.min_by(first, "dt").alias("a"),
        F.min(F.when(F.col("two").isNotNull(), F.col("dt"))).alias("dt2"),
        F.min_by(second, F.when(F.col("two").isNotNull(), F.col("dt"))).alias("b"),
    )
    new = new.select(
        "uid",
        "dt",
        "a.type",
        "a.dateline",
        "a.money",
        "a.special",
        F.coalesce("dt2", F.lit(0)).alias("dt2"),
        F.coalesce("b.type2", F.lit(0)).alias("type2"),
        F.coalesce("b.dateline2", F.lit(0)).alias("dateline2"),
        F.coalesce("b.money2", F.lit(0)).alias("money2"),
    )
    if old is None:
        return new
    ones, twos = ["dt", "type", "dateline", "money", "special"], ["dt2", "type2", "dateline2", "money2"]
    had = F.col("o.dt").isNotNull()
    had_two = F.coalesce(F.col("o.dt2") != 0, F.lit(False))
    return (
        old.alias("o")
        .join(new.alias("n"), "uid", "full")
        .select(
            "uid",
            *[F.when(had, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in ones],
            *[
                F.when(had_two, F.col(f"o.{c}")).otherwise(F.coalesce(f"n.{c}", f"o.{c}")).alias(c)
                for c in twos
            ],
        )
    )


def merge_first_payments(rows: DataFrame) -> DataFrame:
    """One row per user from first payments of any days: the earliest first row and the earliest second part."""
    ones, twos = ["dt", "type", "dateline", "money", "special"], ["dt2", "type2", "dateline2", "money2"]
    some = F.col("dt2") != 0
    merged = rows.groupBy("uid").agg(
        F.min(F.struct(*ones)).alias("one"), F.min(F.when(some, F.struct(*twos))).alias("two")
    )
    return merged.select("uid", "one.*", *[F.coalesce(f"two.{c}", F.lit(0)).cast(rows.schema[c].dataType).alias(c) for c in twos])


def daily_income(detail: DataFrame) -> DataFrame:
    """Per day, user and success flag: sums, counts and their split by payment type."""
    failed = F.col("success") == 0
    out = detail.groupBy("dt", "uid", "success").agg(
        first_row([*DEVICE_COLS, "special"], ["dateline", "is_refund", "id"]).alias("_first"),
        F.sum("money").alias("money"),
        F.sum("refund").alias("refund"),
        F.sum("coin").alias("coin"),
        *pivot_sums("type", "money", codes.INCOME_TYPES, "money"),
        count_if(F.col("money") > 0).alias("times"),
        count_if(F.col("refund") > 0).alias("times_refund"),
        count_if(F.col("coin") > 0).alias("times_coin"),
        *pivot_counts("type", "money", codes.INCOME_TYPES, "times"),
    )
    only_success = {
        c: F.when(failed, F.lit(0)).otherwise(F.col(c)) for c in ("refund", "coin", "times_refund", "times_coin")
    }
    picked = [F.col(f"_first.{c}").alias(c) for c in (*DEVICE_COLS, "special")]
    return out.withColumns(only_success).select("*", *picked).drop("_first")


def income_totals(daily: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """Running totals per user, failed payments in their own columns; the label of the first row stays."""
    good = F.col("success") == 1
    carried = [
        c
        for c in daily.columns
        if (c.startswith(("money", "times")) or c in ("refund", "coin")) and c not in ("money", "times")
    ]
    sums = {"money": "money", "times": "times"} | {c: c for c in carried}
    columns = [F.sum(F.when(good, F.col(src)).otherwise(0)).alias(name) for name, src in sums.items()]
    columns += [F.sum(F.when(~good, F.col(c)).otherwise(0)).alias(f"{c}_fail") for c in ("money", "times")]
    new = daily.groupBy("uid").agg(
        *columns, F.min_by("special", F.struct("dt", -F.col("success"))).alias("special")
    )
    if old is None:
        return new
    return merge_add(old, new, ["uid"], [c for c in new.columns if c not in ("uid", "special")], ["special"])
