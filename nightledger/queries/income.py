"""Payments, first payments and income totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.operators.joins import label_by_precedence, with_memberships
from nightledger.operators.merge import merge_add
from nightledger.operators.windows import keep_first
from nightledger.plans import income as plan
from nightledger.queries.registry import out, query
from nightledger.queries.standins import ctes, named, orders, table

TOLERANCE = 7200
REFUND_WITHIN = 86400
SOURCES = (
    "recharge",
    "pay_req",
    "online_log",
    "ledger",
    "register_list",
    "internal_list",
    "farmer_list",
    "host_list",
    "activation",
)
DEVICE = ("idfa", "actid", "ipaddr", "channelid", "chantype", "chanver", "chancode", "terminal", "appver")
ONLINE = [f"coalesce(CASE WHEN n.chantype > 0 THEN n.{c} ELSE o.{c} END, {chr(39) + '0' + chr(39) if c in ('idfa', 'channelid') else 0}) AS {c}" for c in DEVICE]

PAYS = [
    """pays0 AS (SELECT id, dt, uid, dateline, rechange_channel AS type,
        CASE WHEN rechange_channel < 20 THEN money ELSE 0 END AS money, 0 AS refund,
        CASE WHEN rechange_channel >= 20 THEN money ELSE 0 END AS coin,
        CASE WHEN rechange_status = 30 THEN 1 ELSE 0 END AS success, product_id AS productid, orderid FROM recharge)""",
    """dup AS (SELECT dt, orderid, min(id) AS first FROM pays0 WHERE type < 10 AND success = 1 AND money > 0
        GROUP BY dt, orderid HAVING count(*) > 1)""",
    """pays AS (SELECT p.* FROM pays0 p LEFT JOIN dup d ON d.dt = p.dt AND d.orderid = p.orderid
        WHERE d.first IS NULL OR p.id <= d.first)""",
]
CHARGES = [
    """charges AS (SELECT id, dt, uid, dateline, CAST(floor(money / 100) AS BIGINT) AS amount,
        CASE WHEN productid = 147 THEN 10 ELSE 11 END AS type, productid,
        CASE WHEN salesperson IN ('dl_dzlf', 'jzljs', 'dl_tianli_7328', 'ywdl', 'czdl_g2_xs') THEN 3 ELSE 0 END
        AS special FROM ledger WHERE productid IN (147, 149) AND money > 0)""",
    f"""refunded AS (SELECT c.* FROM charges c WHERE EXISTS (SELECT 1 FROM ledger r WHERE r.money < 0
        AND r.uid = c.uid AND r.productid = c.productid AND CAST(floor(abs(r.money) / 100) AS BIGINT) = c.amount
        AND r.dateline > c.dateline AND r.dateline <= c.dateline + {REFUND_WITHIN}))""",
]
DETAIL = (
    ctes(*SOURCES)
    + PAYS
    + CHARGES
    + [
        f"""req AS (SELECT * FROM (SELECT p.id AS pid, d.*, row_number() OVER (PARTITION BY p.id
            ORDER BY CASE WHEN d.chantype > 0 THEN 0 ELSE 1 END, abs(d.dateline - p.dateline), d.dateline, d.id) AS rn FROM pays p JOIN pay_req d
            ON d.uid = p.uid AND d.dt = p.dt AND abs(d.dateline - p.dateline) <= {TOLERANCE}) WHERE rn = 1)""",
        f"""rows0 AS (
            SELECT p.id, p.dt, p.uid, p.dateline, p.type, p.money, p.refund, p.coin, p.success, p.productid, p.orderid,
                0 AS is_refund, 0 AS ledger_special, {', '.join('r.' + c for c in DEVICE)}
            FROM pays p LEFT JOIN req r ON r.pid = p.id
            UNION ALL
            SELECT id, dt, uid, dateline, type, 0, amount, 0, 1, productid, '0', 1, special,
                NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM refunded)""",
        """marked AS (SELECT *, CASE
            WHEN uid IN (SELECT uid FROM host_list) THEN 2
            WHEN type = 10 AND (dt, uid) IN (SELECT (dt, uid) FROM charges WHERE special = 3) THEN 3
            WHEN is_refund = 1 THEN ledger_special
            WHEN uid IN (SELECT uid FROM farmer_list) THEN 4
            WHEN type = 10 AND uid IN (SELECT uid FROM internal_list) THEN 3
            WHEN uid IN (SELECT uid FROM register_list WHERE special = 1) THEN 1
            WHEN chancode = 2138 THEN 1
            ELSE 0 END AS special FROM rows0)""",
        """seen AS (SELECT * FROM (SELECT n.id AS pid, n.is_refund AS pref, o.*, row_number() OVER (
            PARTITION BY n.id, n.is_refund ORDER BY o.dateline DESC, o.actid) AS rn
            FROM marked n JOIN online_log o ON o.uid = n.uid AND o.dt = n.dt AND o.dateline <= n.dateline)
            WHERE rn = 1)""",
        f"""placed AS (SELECT n.id, n.dt, n.uid, n.dateline, n.type, n.money, n.refund, n.coin, n.success, n.productid,
            n.orderid, n.is_refund, n.special, {', '.join(ONLINE)}
            FROM marked n LEFT JOIN seen o ON o.pid = n.id AND o.pref = n.is_refund)""",
        """detail AS (SELECT p.* REPLACE (CASE WHEN p.actid = 0 THEN coalesce(a.id, 0) ELSE p.actid END AS actid)
            FROM placed p LEFT JOIN (SELECT idfa, min(id) AS id FROM activation GROUP BY idfa) a
            ON a.idfa = p.idfa)""",
    ]
)
DETAIL_BIG = (
    "id dt uid dateline type money refund coin success productid is_refund special actid ipaddr chantype chanver "
    "chancode terminal appver"
)


@query("payments_deduped", out(ctes("recharge") + PAYS, "FROM pays", "id dt uid dateline type money coin success", "", "orderid"))
def payments_deduped(spark, sf_dir):
    rows = plan.payments(named(spark, sf_dir, "recharge"))
    return rows.select("id", "dt", "uid", "dateline", "type", "money", "coin", "success", "orderid")


@query("refund_match", out(ctes("ledger") + CHARGES, "FROM refunded", "id dt uid dateline amount type special"))
def refund_match(spark, sf_dir):
    rows = plan.refunded_charges(named(spark, sf_dir, "ledger"), REFUND_WITHIN)
    return rows.select("id", "dt", "uid", "dateline", "amount", "type", "special")


@query("income_detail", out(DETAIL, "FROM detail", DETAIL_BIG, "", "orderid idfa channelid"))
def income_detail(spark, sf_dir):
    return plan.income_detail(
        *[named(spark, sf_dir, s) for s in SOURCES], tolerance=TOLERANCE, refund_within=REFUND_WITHIN
    )


def _first_sql(detail: str) -> list[str]:
    return [
        f"""paid AS (SELECT *, CASE WHEN type < 10 THEN 1 ELSE 2 END AS class FROM {detail}
            WHERE success = 1 AND type < 20 AND money > 0 AND uid > 3000006)""",
        "starts AS (SELECT dt, uid, class, min(dateline) AS t FROM paid GROUP BY dt, uid, class)",
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY dt, uid ORDER BY t, class) AS n FROM starts)",
        """ones AS (SELECT r.dt, r.uid, r.class AS type, r.t AS dateline, p.money, p.special,
            row_number() OVER (PARTITION BY r.uid ORDER BY r.dt, p.id) AS pos
            FROM ranked r JOIN paid p ON p.dt = r.dt AND p.uid = r.uid AND p.dateline = r.t WHERE r.n = 1)""",
        """twos AS (SELECT r.dt, r.uid, r.class AS type, r.t AS dateline, sum(p.money) AS money,
            row_number() OVER (PARTITION BY r.uid ORDER BY r.dt) AS pos
            FROM ranked r JOIN paid p ON p.dt = r.dt AND p.uid = r.uid AND p.dateline = r.t WHERE r.n = 2
            GROUP BY r.dt, r.uid, r.class, r.t)""",
        """firsts AS (SELECT a.uid, a.dt, a.type, a.dateline, a.money, a.special, coalesce(b.dt, 0) AS dt2,
            coalesce(b.type, 0) AS type2, coalesce(b.dateline, 0) AS dateline2, coalesce(b.money, 0) AS money2
            FROM ones a LEFT JOIN twos b ON b.uid = a.uid AND b.pos = 1 WHERE a.pos = 1)""",
    ]


@query(
    "first_payments",
    out(DETAIL + _first_sql("detail"), "FROM firsts", "uid dt type dateline money special dt2 type2 dateline2 money2"),
)
def first_payments(spark, sf_dir):
    return plan.first_payments(income_detail(spark, sf_dir))


# Orders as payment rows: classes from the priority digit, a day per order.
ORDER_DETAIL = [
    """odd AS (SELECT id, dt, uid, dateline + (id % 5) * 3600 AS dateline, priority * 3 AS type, money,
        CASE WHEN status = 'F' THEN 0 ELSE 1 END AS success, CAST(0 AS DECIMAL(18,2)) AS refund,
        CAST(0 AS DECIMAL(18,2)) AS coin, 0 AS is_refund, 0 AS special FROM od)"""
]


def _order_detail(spark, sf_dir):
    zero = F.lit(0).cast("decimal(18,2)")
    return orders(spark, sf_dir).select(
        "id",
        F.floor(F.col("dt") / 100).cast("int").alias("dt"),
        "uid",
        (F.col("dateline") + F.col("id") % 5 * 3600).alias("dateline"),
        (F.col("priority") * 3).alias("type"),
        "money",
        F.when(F.col("status") == "F", 0).otherwise(1).alias("success"),
        zero.alias("refund"),
        zero.alias("coin"),
        F.lit(0).alias("is_refund"),
        F.lit(0).alias("special"),
        *[F.lit(0).alias(c) for c in plan.DEVICE_COLS],
    )


ORDER_MONTH = ["odm AS (SELECT * REPLACE (dt // 100 AS dt) FROM odd)"]
ORDERS_SQL = ctes("od") + ORDER_DETAIL + ORDER_MONTH


@query(
    "first_pay_per_class",
    out(
        ORDERS_SQL + _first_sql("odm"),
        "FROM firsts",
        "uid dt type dateline special dt2 type2 dateline2",
        "money money2",
    ),
)
def first_pay_per_class(spark, sf_dir):
    return plan.first_payments(_order_detail(spark, sf_dir))


@query(
    "first_pay_carry_over",
    out(
        ORDERS_SQL + _first_sql("odm"),
        "FROM firsts",
        "uid dt type dateline special dt2 type2 dateline2",
        "money money2",
    ),
)
def first_pay_carry_over(spark, sf_dir):
    """The first years as the table so far, then the rest: the same rows as in one go."""
    rows = _order_detail(spark, sf_dir)
    old = plan.first_payments(rows.filter(F.col("dt") < 199801))
    return plan.first_payments(rows.filter(F.col("dt") >= 199801), old)


TYPES = codes.INCOME_TYPES
DAILY = [
    f"""daily AS (SELECT dt, uid, success, sum(money) AS money,
        CASE WHEN success = 1 THEN sum(refund) ELSE 0 END AS refund,
        CASE WHEN success = 1 THEN sum(coin) ELSE 0 END AS coin,
        {', '.join(f'sum(CASE WHEN type = {t} THEN money ELSE 0 END) AS money_{t}' for t in TYPES)},
        count(CASE WHEN money > 0 THEN 1 END) AS times,
        CASE WHEN success = 1 THEN count(CASE WHEN refund > 0 THEN 1 END) ELSE 0 END AS times_refund,
        CASE WHEN success = 1 THEN count(CASE WHEN coin > 0 THEN 1 END) ELSE 0 END AS times_coin,
        {', '.join(f'count(CASE WHEN type = {t} AND money > 0 THEN 1 END) AS times_{t}' for t in TYPES)},
        {', '.join(f'arg_min({c}, ord) AS {c}' for c in (*DEVICE, 'special'))}
        FROM (SELECT *, row_number() OVER (ORDER BY dateline, is_refund, id) AS ord FROM detail)
        GROUP BY dt, uid, success)"""
]
SPLIT = [f"money_{t}" for t in TYPES] + [f"times_{t}" for t in TYPES]


@query(
    "daily_income",
    out(
        DETAIL + DAILY,
        "FROM daily",
        "dt uid success money refund coin times times_refund times_coin special actid ipaddr chantype chanver "
        "chancode terminal appver " + " ".join(SPLIT),
        "",
        "idfa channelid",
    ),
)
def daily_income(spark, sf_dir):
    return plan.daily_income(income_detail(spark, sf_dir))


CARRIED = ["refund", "coin", "times_refund", "times_coin", *SPLIT]
TOTALS = [
    f"""totals AS (SELECT uid, sum(CASE WHEN success = 1 THEN money ELSE 0 END) AS money,
        sum(CASE WHEN success = 0 THEN money ELSE 0 END) AS money_fail,
        sum(CASE WHEN success = 1 THEN times ELSE 0 END) AS times,
        sum(CASE WHEN success = 0 THEN times ELSE 0 END) AS times_fail,
        {', '.join(f'sum(CASE WHEN success = 1 THEN {c} ELSE 0 END) AS {c}' for c in CARRIED)},
        arg_min(special, dt * 2 + 1 - success) AS special FROM daily GROUP BY uid)"""
]
TOTALS_BIG = "uid money money_fail times times_fail special " + " ".join(CARRIED)


@query("income_totals", out(DETAIL + DAILY + TOTALS, "FROM totals", TOTALS_BIG))
def income_totals(spark, sf_dir):
    return plan.income_totals(daily_income(spark, sf_dir))


@query("income_totals_by_halves", out(DETAIL + DAILY + TOTALS, "FROM totals", TOTALS_BIG))
def income_totals_by_halves(spark, sf_dir):
    """Half the month as the table so far, then the rest: the same totals as in one go."""
    daily = daily_income(spark, sf_dir)
    old = plan.income_totals(daily.filter(F.col("dt") < 20240115))
    return plan.income_totals(daily.filter(F.col("dt") >= 20240115), old)


@query(
    "income_pivot",
    out(
        ORDERS_SQL,
        f"""FROM (SELECT dt, uid, success, sum(money) AS money,
            {', '.join(f'sum(CASE WHEN type = {t} THEN money ELSE 0 END) AS money_{t}' for t in TYPES)},
            count(CASE WHEN money > 0 THEN 1 END) AS times,
            {', '.join(f'count(CASE WHEN type = {t} AND money > 0 THEN 1 END) AS times_{t}' for t in TYPES)}
            FROM odm GROUP BY dt, uid, success)""",
        "dt uid success times " + " ".join(f"times_{t}" for t in TYPES),
        "money " + " ".join(f"money_{t}" for t in TYPES),
    ),
)
def income_pivot(spark, sf_dir):
    rows = plan.daily_income(_order_detail(spark, sf_dir))
    return rows.select("dt", "uid", "success", "money", "times", *SPLIT)


@query(
    "internal_user_totals",
    out(
        ctes("recharge", "internal_list") + PAYS,
        """FROM (SELECT uid, sum(money) AS money FROM pays WHERE type = 10
            AND uid IN (SELECT uid FROM internal_list) GROUP BY uid)""",
        "uid money",
    ),
)
def internal_user_totals(spark, sf_dir):
    """Two halves of the month added up."""
    pays = plan.payments(named(spark, sf_dir, "recharge"))
    internal = named(spark, sf_dir, "internal_list")
    nobody = pays.select("uid", "money").filter(F.lit(False))
    old = plan.internal_totals(nobody, pays.filter(F.col("dt") < 20240115), internal)
    return plan.internal_totals(old, pays.filter(F.col("dt") >= 20240115), internal)


@query(
    "label_precedence",
    out(
        ctes("od", "register_list", "internal_list", "farmer_list", "host_list"),
        """FROM (SELECT id, uid, CASE WHEN uid IN (SELECT uid FROM host_list) THEN 2
            WHEN uid IN (SELECT uid FROM farmer_list) THEN 4
            WHEN priority = 1 AND uid IN (SELECT uid FROM internal_list) THEN 3
            WHEN uid IN (SELECT uid FROM register_list WHERE special = 1) THEN 1 ELSE 0 END AS special FROM od)""",
        "id uid special",
    ),
)
def label_precedence(spark, sf_dir):
    lists = {
        "in_special": named(spark, sf_dir, "register_list").filter(F.col("special") == 1),
        "in_internal": named(spark, sf_dir, "internal_list"),
        "in_farmers": named(spark, sf_dir, "farmer_list"),
        "in_hosts": named(spark, sf_dir, "host_list"),
    }
    rows = with_memberships(orders(spark, sf_dir).select("id", "uid", "priority"), "uid", lists)
    special = label_by_precedence(
        [
            (F.col("in_special"), codes.LABEL_SPECIAL_CHANNEL),
            (F.col("in_internal") & (F.col("priority") == 1), codes.LABEL_INTERNAL),
            (F.col("in_farmers"), codes.LABEL_FARMER),
            (F.col("in_hosts"), codes.LABEL_HOST),
        ]
    )
    return rows.select("id", "uid", special.alias("special"))


LINE_ORDER = (
    "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()


@query(
    "dedupe_keep_first",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem)
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity,
            l_extendedprice, l_returnflag FROM r WHERE rn = 1""",
)
def dedupe_keep_first(spark, sf_dir):
    rows = keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )


@query(
    "income_running_total",
    out(
        ctes("od"),
        "FROM (SELECT uid, count(*) AS times, sum(money) AS money FROM od GROUP BY uid)",
        "uid times",
        "money",
    ),
)
def income_running_total(spark, sf_dir):
    """The payments from a day on added to the running total of those before."""
    rows, border = orders(spark, sf_dir), F.col("dt") < 19980401

    def totals(part):
        return part.groupBy("uid").agg(F.count(F.lit(1)).alias("times"), F.sum("money").alias("money"))

    return merge_add(totals(rows.filter(border)), totals(rows.filter(~border)), ["uid"], ["times", "money"])
