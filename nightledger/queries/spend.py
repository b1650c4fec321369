"""Unified spend fact, monitor totals and n-th spend per user."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightledger.plans import spend as plan
from nightledger.queries.registry import out, query
from nightledger.queries.standins import EV, LN, OD, ctes, events, lines, named, orders, split_columns, table

# Source tables of the fact: (log, filter, projection), the same text in both engines.
LOGS = {
    "props": (
        "ln",
        "TRUE",
        """3000006 + orderkey % 500 AS uid, CASE WHEN line = 4 AND partkey % 2 = 0 THEN 3000006 + orderkey % 500
        ELSE suppkey END AS fuid, line AS category, partkey AS admin_prop_id, quantity AS total, amount AS spend,
        dateline, dt - dt % 100 + 1 AS dt""",
    ),
    "games": (
        "ev",
        "event_type = 'click'",
        "uid, roomid, id % 6 AS gameid, amount AS spend_money, id % 200 AS admin_gift_id, 1 + id % 3 AS gift_num, dateline, dt",
    ),
    "show_gifts": (
        "od",
        "TRUE",
        """uid AS sender, id % 100 AS uid, id % 20 AS roomid, CASE WHEN status = 'P' THEN 'bag' ELSE 'room' END AS note,
        CAST(floor(money) AS BIGINT) AS spendmoney, id AS cust_gift_id, id % 200 AS admin_gift_id, priority AS realnum,
        dateline, dt""",
    ),
    "gifts": (
        "ev",
        "event_type = 'view'",
        """CASE WHEN id % 50 = 0 THEN 9999 ELSE id % 40 END AS admin_gift_id, uid AS sender, roomid AS uid, dateline,
        dt - dt % 100 + 1 AS dt""",
    ),
    "memberships": ("od", "priority = 1", "uid, CAST(floor(money) AS BIGINT) AS money, 1 + id % 3 AS vip, dateline, dt"),
    "songs": ("ev", "event_type = 'signup'", "uid, roomid, amount AS coin, id % 3 AS status, dateline, dt"),
    "crowns": (
        "ev",
        "event_type = 'error'",
        "uid, amount AS cost, id % 30 AS ref_giftid, roomid AS fuid, id % 2 AS status, dateline, dt",
    ),
    "red_packets": ("ev", "event_type = 'purchase'", "uid AS send_uid, roomid, id % 4 AS type, amount, dateline, dt"),
}
ROWS = {"ev": events, "od": orders, "ln": lines}


def _source(spark, sf_dir, name):
    log, cond, cols = LOGS[name]
    return ROWS[log](spark, sf_dir).filter(cond).selectExpr(*split_columns(cols))


def _sources(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    prices = part.select(F.col("p_partkey").alias("admin_prop_id"), F.floor("p_retailprice").alias("price"))
    costs = part.select(F.col("p_partkey").alias("giftid"), F.col("p_size").alias("cost"))
    s = {n: _source(spark, sf_dir, n) for n in LOGS}
    return (
        s["props"],
        prices,
        s["games"],
        s["show_gifts"],
        s["gifts"],
        costs,
        s["memberships"],
        s["songs"],
        s["crowns"],
        s["red_packets"],
    )


def _rows(source, kind, uid, coin, son="0", item="0", num="1", hot="0", diamond="0", host="0", room="0"):
    return f"""SELECT dt, {uid} AS uid, {room} AS roomid, dateline, {coin} AS consume_coin, {kind} AS consume_type,
        {son} AS consume_type_son, {item} AS consume_id, {num} AS consume_num, {hot} AS dj_hot,
        {diamond} AS dj_diamond, {host} AS anchor_uid FROM {source}"""


def _props(name, cond):
    return f"""{name} AS (SELECT g.*, CAST(floor(p_retailprice) AS BIGINT) // 2 AS half FROM (
        SELECT dt, category, uid, fuid, sum(total) AS total, sum(spend) AS spend, min(dateline) AS dateline,
            arg_min(admin_prop_id, dateline * 10000000 + admin_prop_id) AS admin_prop_id
        FROM props WHERE {cond} GROUP BY dt, category, uid, fuid) g JOIN part ON p_partkey = g.admin_prop_id)"""


FACT = (
    [EV, OD, LN]
    + [f"{n} AS (SELECT {cols} FROM {log} WHERE {cond})" for n, (log, cond, cols) in LOGS.items()]
    + [
        _props("show_props", "category IN (5, 6)"),
        _props("other_props", "category NOT IN (4, 5, 6) OR (category = 4 AND fuid = uid)"),
        """counted AS (SELECT g.*, num * p_size AS worth FROM (SELECT dt, admin_gift_id, sender, uid, count(*) AS num,
            min(dateline) AS dateline FROM gifts WHERE admin_gift_id <> 9999 AND sender <> 3000096
            GROUP BY dt, admin_gift_id, sender, uid) g JOIN part ON p_partkey = g.admin_gift_id)""",
        "fact0 AS ("
        + " UNION ALL ".join(
            [
                _rows("show_props", 10, "uid", "spend", "category", "admin_prop_id", "total", "half", "half", "fuid"),
                _rows("other_props", 20, "uid", "spend", "category", "admin_prop_id", "total", "half", "half", "fuid"),
                _rows(
                    "games WHERE gameid IN (1, 3, 5)",
                    11,
                    "uid",
                    "spend_money",
                    "gameid",
                    "admin_gift_id",
                    "gift_num",
                    room="roomid",
                ),
                _rows(
                    "show_gifts WHERE note <> 'bag'",
                    12,
                    "sender",
                    "spendmoney",
                    "cust_gift_id",
                    "admin_gift_id",
                    "realnum",
                    "spendmoney // 2",
                    "spendmoney // 2",
                    "uid",
                    "roomid",
                ),
                _rows("counted", 21, "sender", "worth", "0", "admin_gift_id", "num", "0", "worth // 2", "uid"),
                _rows("memberships", 22, "uid", "money", "vip"),
                _rows(
                    "songs WHERE status = 2", 13, "uid", "coin", hot="coin // 2", diamond="coin // 2", room="roomid"
                ),
                _rows("crowns WHERE status = 1", 23, "uid", "cost", "ref_giftid", host="fuid"),
                _rows(
                    "red_packets WHERE type IN (1, 3)",
                    14,
                    "send_uid",
                    "CASE WHEN type = 1 THEN amount ELSE -amount END",
                    "type",
                    room="roomid",
                ),
            ]
        )
        + ")",
        "fact AS (SELECT *, make_timestamp(dateline * 1000000) AS moment FROM fact0)",
    ]
)
FACT_BIG = (
    "dt uid roomid year month day hour dateline consume_coin consume_type consume_type_son consume_id consume_num "
    "dj_hot dj_diamond anchor_uid"
)


@query(
    "spend_fact",
    out(
        FACT,
        "FROM (SELECT *, year(moment) AS year, month(moment) AS month, day(moment) AS day, hour(moment) AS hour FROM fact)",
        FACT_BIG,
    ),
)
def spend_fact(spark, sf_dir):
    return plan.spend_fact(*_sources(spark, sf_dir))


MONITOR = out(
    FACT,
    """FROM (SELECT uid, sum(consume_coin) / 100 AS money FROM fact WHERE uid <> 3000006 AND consume_coin > 0
        GROUP BY uid)""",
    "uid",
    "money",
)


@query("spend_monitor_total", MONITOR)
def spend_monitor_total(spark, sf_dir):
    return plan.monitor_totals(spend_fact(spark, sf_dir))


@query("spend_monitor_running_total", MONITOR)
def spend_monitor_running_total(spark, sf_dir):
    """Spends before and after a day, the second added to the first."""
    fact = spend_fact(spark, sf_dir)
    old = plan.monitor_totals(fact.filter(F.col("dt") < 19990101))
    return plan.monitor_totals(fact.filter(F.col("dt") >= 19990101), old)


def _nth_sql(n: int) -> str:
    return out(
        ctes("spend_log")
        + [
            """s AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY dateline, id) AS rn,
                count(*) OVER (PARTITION BY uid) AS times FROM spend_log
                WHERE consume_coin <> 0 AND uid <> 3000096)"""
        ],
        f"FROM s WHERE rn = least({n}, times)",
        "uid dateline consume_coin consume_type consume_type_son times",
    )


def _nth(spark, sf_dir, n):
    return plan.nth_spend(named(spark, sf_dir, "spend_log"), n)


def _nth_carried(spark, sf_dir, n):
    log = named(spark, sf_dir, "spend_log")
    table_so_far = None
    dt = F.col("dt")
    for part in (dt < 20240103, dt.between(20240103, 20240105), dt > 20240105):
        table_so_far = plan.nth_spend(log.filter(part), n, table_so_far)
    return table_so_far


@query("first_spend", _nth_sql(1))
def first_spend(spark, sf_dir):
    return _nth(spark, sf_dir, 1)


@query("second_spend", _nth_sql(2))
def second_spend(spark, sf_dir):
    return _nth(spark, sf_dir, 2)


@query("first_spend_carry_over", _nth_sql(1))
def first_spend_carry_over(spark, sf_dir):
    return _nth_carried(spark, sf_dir, 1)


@query("second_spend_carry_over", _nth_sql(2))
def second_spend_carry_over(spark, sf_dir):
    return _nth_carried(spark, sf_dir, 2)


def _end_to_end_sql() -> str:
    order = "dateline, dt, uid, consume_type, consume_type_son, consume_id, roomid, anchor_uid, consume_coin"
    return out(
        FACT
        + [
            f"""s AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY {order}) AS rn,
                count(*) OVER (PARTITION BY uid) AS times FROM fact WHERE consume_coin <> 0 AND uid <> 3000096)""",
            "n AS (SELECT 1 AS nth UNION ALL SELECT 2)",
        ],
        "FROM s JOIN n ON rn = least(nth, times)",
        "nth uid dateline consume_coin consume_type consume_type_son times",
    )


@query("spend_first_and_second", _end_to_end_sql())
def spend_first_and_second(spark, sf_dir):
    """From the nine logs to numbered spends to the first and second spend of each user."""
    fact = plan.with_ids(spend_fact(spark, sf_dir))
    firsts = plan.first_spends(fact, 2)
    both = [plan.nth_of(firsts, n).withColumn("nth", F.lit(n)) for n in (1, 2)]
    return both[0].unionByName(both[1])


@query(
    "spend_ids",
    out(
        FACT,
        "FROM (SELECT row_number() OVER (ORDER BY dateline, dt, uid, consume_type) AS id, dateline FROM fact)",
        "id dateline",
    ),
)
def spend_ids(spark, sf_dir):
    """Ids without gaps in the order of time."""
    return plan.with_ids(spend_fact(spark, sf_dir)).select("id", "dateline")
