"""Sign-up fraud filter and partner settlement on customers as sign-ups of one day."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightledger.operators.windows import beyond_first_k
from nightledger.plans import signup as plan
from nightledger.queries.registry import out, query
from nightledger.queries.standins import ctes, customers, table

START, END = 1704067200, 1704067200 + 86399
MIN_UID = 79600000
PER_IP, SECONDS = 3, 120

# Sign-ups: most today, every sixtieth within the days before; addresses of six and devices of three.
USER_COLS = [
    f"{MIN_UID} + 1 + c_custkey AS uid",
    f"""CASE WHEN c_custkey % 60 = 0 THEN {START} - (c_custkey % 8 + 1) * 86400 + c_custkey % 1000
        ELSE {START} + 1 + (c_custkey * 37) % 86000 END AS cr_dt""",
    f"""CASE c_custkey % 4 WHEN 0 THEN 's10202' || CASE WHEN c_nationkey % 2 = 0 THEN '752' ELSE '760' END
            || CASE WHEN c_nationkey % 6 = 5 THEN '2163' ELSE CAST(1000 + c_nationkey % 6 AS STRING) END || '01'
        WHEN 1 THEN '10102760' || CAST(1000 + c_nationkey % 6 AS STRING) || '01'
        WHEN 2 THEN '10301760' || CAST(1000 + c_nationkey % 6 AS STRING) || '02'
        ELSE '2' || lpad(CAST(c_nationkey % 6 AS STRING), 3, '0') || '0101' END AS channelid""",
    "c_custkey AS showid",
    "CASE WHEN c_nationkey % 6 <= 1 THEN 0 WHEN c_custkey % (2 + c_nationkey % 6) = 0 THEN 1 ELSE 0 END AS qqstatus",
    "CASE WHEN c_custkey % 25 = 0 THEN 1 ELSE 0 END AS renrenstatus",
    "CAST(c_custkey - c_custkey % 6 AS STRING) AS lastip",
    "'m' || CAST(c_custkey - c_custkey % 30 + c_custkey % 10 AS STRING) AS macaddr",
    """CASE WHEN c_custkey % 23 = 0 THEN CAST(NULL AS STRING) WHEN c_custkey % 19 = 0 THEN '机房-共用出口'
        WHEN c_custkey % 17 = 0 THEN '机房1' ELSE 'n' END AS nickname""",
    "(c_custkey % 50) * 10 AS stayed",
]
PARTNER_COLS = [
    # 400003 has three rows; two of its patterns overlap
    "CASE WHEN n_nationkey IN (15, 23) THEN 400003 ELSE 400000 + n_nationkey END AS partner_id",
    "'p' || CAST(n_nationkey AS STRING) AS partner_name",
    """CASE WHEN n_nationkey = 24 THEN '10301760100002' WHEN n_nationkey = 23 THEN '2%0101'
        WHEN n_nationkey = 15 THEN '%03__' WHEN n_nationkey = 22 THEN '%2163__' ELSE '%' || CAST(1000 + n_nationkey AS STRING) || '__' END AS channelid""",
    "CASE WHEN n_nationkey = 4 THEN 2 ELSE 3 END AS type",
    "CASE WHEN n_nationkey % 7 = 6 THEN 0 ELSE 1 END AS status",
    "n_nationkey * 5 % 30 AS cut_rate",
    "CAST(2 + n_nationkey % 3 AS DECIMAL(10,2)) AS price",
]
DISCOUNT_COLS = [
    "n_nationkey + 1 AS id",
    """CASE n_nationkey % 3 WHEN 0 THEN '%' || CAST(1000 + n_nationkey % 6 AS STRING) || '__'
        WHEN 1 THEN 's10202%' ELSE '%0%' END AS channelid""",
    "1 + n_nationkey % 3 AS grade",
    "CAST(0.30 + n_nationkey * 0.03 AS DECIMAL(10,2)) AS discount",
]
BASE = [
    f"su AS (SELECT {', '.join(USER_COLS)} FROM customer)",
    f"partners AS (SELECT {', '.join(PARTNER_COLS)} FROM nation)",
    f"discounts AS (SELECT {', '.join(DISCOUNT_COLS)} FROM nation)",
    f"""earlier AS (SELECT * FROM su WHERE uid > {MIN_UID} AND cr_dt > {START} - 864000 AND cr_dt < {END} - 86400)""",
    f"""cand AS (SELECT *, cr_dt + stayed AS lastactivity_time FROM su WHERE uid > {MIN_UID} AND cr_dt > {START}
        AND cr_dt < {END} AND (nickname NOT LIKE '%共用出口%' OR nickname NOT LIKE '%机房%'))""",
    """terms AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY partner_id ORDER BY price, cut_rate, type) AS pos
        FROM partners) WHERE pos = 1)""",
    """fresh AS (SELECT DISTINCT c.*, p.partner_id FROM cand c JOIN partners p ON c.channelid LIKE p.channelid
        WHERE p.type = 3 AND p.status = 1 AND c.lastip NOT IN (SELECT lastip FROM earlier)
        AND c.macaddr NOT IN (SELECT macaddr FROM earlier))""",
    f"""s3 AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY lastip ORDER BY uid, partner_id) > {PER_IP} THEN 1 ELSE 0 END
        AS step3 FROM fresh)""",
    """s2 AS (SELECT *, CASE WHEN step3 = 0 AND uid NOT IN (SELECT min(uid) FROM s3 WHERE step3 = 0 GROUP BY macaddr)
        THEN 1 ELSE 0 END AS step2 FROM s3)""",
    f"""steps AS (SELECT *, CASE WHEN step3 = 0 AND step2 = 0 AND lastactivity_time - cr_dt
        < CASE WHEN left(channelid, 5) IN ('10102', '10135') THEN 180 ELSE {SECONDS} END THEN 1 ELSE 0 END AS step1 FROM s2)""",
    "valid AS (SELECT * FROM steps WHERE step1 + step2 + step3 = 0)",
]


def _users(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(*USER_COLS)


def _tables(spark, sf_dir):
    rows = _users(spark, sf_dir)
    users = rows.select("uid", "cr_dt", "channelid", "showid", "qqstatus", "renrenstatus")
    status = rows.select("uid", (F.col("cr_dt") + F.col("stayed")).alias("lastactivitytime"), "lastip", "macaddr")
    partners = table(spark, sf_dir, "nation").selectExpr(*PARTNER_COLS)
    return users, status, rows.select("uid", "nickname"), partners


def _steps(spark, sf_dir):
    return plan.signup_steps(*_tables(spark, sf_dir), START, END, per_ip=PER_IP, min_seconds=SECONDS)


@query(
    "signup_steps",
    out(BASE, "FROM steps", "uid cr_dt lastactivity_time showid partner_id step1 step2 step3", "", "lastip macaddr channelid"),
)
def signup_steps(spark, sf_dir):
    rows = _steps(spark, sf_dir).select(
        "uid",
        "cr_dt",
        "lastactivity_time",
        "showid",
        "partner_id",
        "step1",
        "step2",
        "step3",
        F.col("regip").alias("lastip"),
        F.col("device").alias("macaddr"),
        "channelid",
    )
    return rows


@query(
    "signup_history_counts",
    out(
        BASE,
        """FROM (SELECT channelid, count(CASE WHEN lastip IN (SELECT lastip FROM earlier) THEN 1 END) AS ip_num,
            count(CASE WHEN macaddr IN (SELECT macaddr FROM earlier) THEN 1 END) AS device_num FROM cand GROUP BY channelid)
            WHERE ip_num + device_num > 0""",
        "ip_num device_num",
        "",
        "channelid",
    ),
)
def signup_history_counts(spark, sf_dir):
    users, status, profile, _ = _tables(spark, sf_dir)
    rows = plan.candidates(users, status, profile, START, END)
    seen = [plan.seen_before(users, status, START, END, c) for c in ("lastip", "macaddr")]
    return plan.removed_by_history(rows, *seen)


@query(
    "signup_summary",
    out(
        BASE,
        """FROM (SELECT 20240101 AS dt, count(*) AS reg_total,
            count(CASE WHEN step1 + step2 + step3 = 0 THEN 1 END) AS user_num, sum(step1) AS step1, sum(step2) AS step2,
            sum(step3) AS step3 FROM steps)""",
        "dt reg_total user_num step1 step2 step3",
    ),
)
def signup_summary(spark, sf_dir):
    return plan.signup_summary(_steps(spark, sf_dir), START)


@query(
    "signup_invalid",
    out(BASE, "FROM steps WHERE step1 + step2 + step3 > 0", "uid partner_id step1 step2 step3", "", "channelid"),
)
def signup_invalid(spark, sf_dir):
    rows = plan.invalid_signups(_steps(spark, sf_dir))
    return rows.select("uid", "partner_id", "step1", "step2", "step3", "channelid")


@query("signup_valid", out(BASE, "FROM valid", "uid partner_id showid cr_dt", "", "channelid"))
def signup_valid(spark, sf_dir):
    return plan.valid_signups(_steps(spark, sf_dir)).select("uid", "partner_id", "showid", "cr_dt", "channelid")


@query(
    "signup_funnel",
    out(
        BASE,
        """FROM (SELECT partner_id, count(*) AS step0, sum(step1) AS step1, sum(step2) AS step2, sum(step3) AS step3,
            count(CASE WHEN step1 + step2 + step3 = 0 THEN 1 END) AS valid_num FROM steps GROUP BY partner_id)""",
        "partner_id step0 step1 step2 step3 valid_num",
    ),
)
def signup_funnel(spark, sf_dir):
    return plan.partner_funnel(_steps(spark, sf_dir))


@query(
    "signup_ip_cap",
    out(
        ctes("cu"),
        """FROM (SELECT k, ip, CASE WHEN row_number() OVER (PARTITION BY ip ORDER BY k) > 5 THEN 1 ELSE 0 END AS beyond
            FROM cu)""",
        "k ip beyond",
    ),
)
def signup_ip_cap(spark, sf_dir):
    return beyond_first_k(customers(spark, sf_dir).select("k", "ip"), ["ip"], "k", 5, "beyond")


@query(
    "partner_summary",
    out(
        BASE,
        """FROM (SELECT s.partner_id, CAST(valid_num * (100 - p.cut_rate) AS BIGINT) // 100 AS user_num, p.price, p.type,
            step0, step1, step2, step3 FROM (SELECT partner_id, count(*) AS step0, sum(step1) AS step1, sum(step2) AS step2,
            sum(step3) AS step3, count(CASE WHEN step1 + step2 + step3 = 0 THEN 1 END) AS valid_num FROM steps
            GROUP BY partner_id) s JOIN terms p ON p.partner_id = s.partner_id WHERE valid_num > 0)""",
        "partner_id user_num type step0 step1 step2 step3",
        "price",
    ),
)
def partner_summary(spark, sf_dir):
    return plan.partner_summary(_steps(spark, sf_dir), _tables(spark, sf_dir)[3])


def _scaled(unit: str, r: str, discount: str, c: str) -> str:
    """Rules on ``r``, the login rate times 100 as a whole number."""
    newer = f"({c} LIKE 's%' AND length({c}) >= 9 AND substr({c}, length({c}) - 8, 3) >= '753')"
    code = f"({c} LIKE 's%' AND length({c}) >= 6 AND left(right({c}, 6), 4) = '2163')"
    return f"""CASE WHEN {discount} < 0.5 OR left({c}, 5) IN ('10102', '10135') OR {code} THEN {unit}
        WHEN {r} < 500 AND {unit} > 10 THEN 0 WHEN {newer} AND {r} = 500 AND {unit} > 10 THEN 0
        WHEN {unit} > 15 AND {r} >= 500 AND {r} <= CASE WHEN {newer} THEN 4000 ELSE 5000 END
            THEN ({unit} * (2 * {r} - 1000) + 9999) // 10000 ELSE {unit} END"""


SETTLED = BASE + [
    "sub AS (SELECT channelid, count(*) AS tol, min(partner_id) AS partner_id FROM valid GROUP BY channelid)",
    """best AS (SELECT * FROM (SELECT sub.*, d.discount, row_number() OVER (PARTITION BY sub.channelid
        ORDER BY d.grade DESC, length(d.channelid) DESC, d.id) AS rn FROM sub JOIN discounts d
        ON sub.channelid LIKE d.channelid) WHERE rn = 1)""",
    f"""extras AS (SELECT partner_id, channelid, count(CASE WHEN showid % 2 = 0 THEN 1 END) AS talk_num,
        count(CASE WHEN qqstatus = 1 OR renrenstatus = 1 THEN 1 END) AS qq_num FROM steps GROUP BY partner_id, channelid)""",
    """units AS (SELECT b.partner_id, b.channelid, CAST(ceil(b.tol * b.discount) AS BIGINT) AS unit0, b.discount, b.tol,
        p.price, e.talk_num, e.qq_num FROM best b JOIN terms p ON p.partner_id = b.partner_id
        JOIN extras e ON e.partner_id = b.partner_id AND e.channelid = b.channelid)""",
    "rated AS (SELECT *, CASE WHEN unit0 > 0 THEN (2 * qq_num * 10000 + unit0) // (2 * unit0) ELSE 0 END AS r FROM units)",
    f"settled AS (SELECT *, {_scaled('unit0', 'r', 'discount', 'channelid')} AS unit FROM rated)",
]


@query(
    "partner_settlement",
    out(
        SETTLED,
        """FROM (SELECT partner_id, channelid, 20240101 AS dt, unit, price AS unit_price, unit * price AS total,
            discount AS ext1, tol AS ext2, talk_num, qq_num, CAST(r AS DOUBLE) / 100 AS qq_rate FROM settled)""",
        "partner_id dt unit ext2 talk_num qq_num",
        "unit_price total ext1 qq_rate",
        "channelid",
    ),
)
def partner_settlement(spark, sf_dir):
    chats = _users(spark, sf_dir).filter(F.col("showid") % 2 == 0)
    chats = chats.select(F.col("uid").alias("from_uid"), (F.lit(START) + 100 + F.col("showid") % 80000).alias("dateline"))
    partners = _tables(spark, sf_dir)[3]
    discounts = table(spark, sf_dir, "nation").selectExpr(*DISCOUNT_COLS)
    return plan.subchannel_settlement(_steps(spark, sf_dir), partners, discounts, chats, START, END)


@query(
    "quality_scaling",
    out(
        ctes("cu")
        + [
            """w AS (SELECT k, channelid, 1 + k % 40 AS unit0, (k * 7 % 600) * 10 AS r,
                CAST(0.3 + (k % 8) * 0.1 AS DECIMAL(10,2)) AS discount FROM cu)"""
        ],
        f"FROM (SELECT k, channelid, {_scaled('unit0', 'r', 'discount', 'channelid')} AS unit FROM w)",
        "k unit",
        "",
        "channelid",
    ),
)
def quality_scaling(spark, sf_dir):
    k = F.col("k")
    rate = ((k * 7) % 600).cast("decimal(18,4)") / 10
    discount = (F.lit(3) + k % 8).cast("decimal(10,2)") / 10
    units = plan.scaled_units(F.lit(1) + k % 40, rate, discount, F.col("channelid"))
    return customers(spark, sf_dir).select("k", "channelid", units.alias("unit"))
