"""First-pay report, returning users, host earnings, retention and recommendation slots."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.functions.filters import EXCLUDE, CohortFilter
from nightledger.operators.windows import first_k
from nightledger.plans import first_pay_report as first_pay
from nightledger.plans import returning, slots
from nightledger.plans.host_earnings import host_earnings
from nightledger.plans.retention import busy_rooms, cohort, retention
from nightledger.queries.channels import NORMAL, PARSED, PRICES, prices
from nightledger.queries.registry import out, query
from nightledger.queries.standins import FIRST_DAY, LAST_DAY, ctes, events, lines, named, table

# First-pay report -----------------------------------------------------------------------

FIRST_RECHARGE = """first_recharge AS (SELECT * FROM (SELECT dt, uid, dateline, amount % 40 AS money, 1 + id % 2 AS type,
    row_number() OVER (PARTITION BY uid ORDER BY dateline, id) AS first_second FROM ev
    WHERE event_type = 'purchase' AND uid <> 3000006) WHERE first_second <= 2)"""
INCOME = """income AS (SELECT dt, uid, sum(amount) AS money, CASE WHEN uid % 13 = 0 THEN 1 ELSE 0 END AS special,
    1 AS success FROM ev WHERE event_type = 'purchase' GROUP BY dt, uid)"""
CONFIG_COLS = ["1000 + n_nationkey AS chancode", "n_name AS channame", "1 + n_nationkey % 4 AS statis_type"]
CONFIG = f"config AS (SELECT {', '.join(CONFIG_COLS)} FROM nation)"


def first_recharge(spark, sf_dir):
    paid = events(spark, sf_dir, "purchase").filter(F.col("uid") != codes.VISITOR_UID)
    return first_k(paid, ["uid"], ["dateline", "id"], 2, "first_second").select(
        "dt",
        "uid",
        "dateline",
        (F.col("amount") % 40).alias("money"),
        (F.lit(1) + F.col("id") % 2).alias("type"),
        "first_second",
    )


def income(spark, sf_dir):
    return (
        events(spark, sf_dir, "purchase")
        .groupBy("dt", "uid")
        .agg(F.sum("amount").alias("money"))
        .withColumns({"special": F.when(F.col("uid") % 13 == 0, 1).otherwise(0), "success": F.lit(1)})
    )


NORMAL_ID = NORMAL.replace("(c, ", "(channel_id, ")
MEASURES = " ".join(first_pay.MEASURES)
RATIOS = (
    "first_pay_ratio first_official_ratio first_official_11_ratio first_pay_arpu first_official_arpu "
    "first_official_11_arpu"
)


def _percent(num: str, den: str) -> str:
    return f"CASE WHEN {den} = 0 THEN 0 ELSE CAST((2 * {num} * 10000 + {den}) // (2 * {den}) AS DOUBLE) / 100 END"


def _arpu(num: str, den: str) -> str:
    return f"CASE WHEN {den} = 0 THEN 0 ELSE CAST((2 * {num} * 100 + {den}) // (2 * {den}) AS DOUBLE) / 100 END"


RATIO_SQL = f"""{_percent('first_pay', 'online_non_pay')} AS first_pay_ratio,
    {_percent('first_official', 'online_non_pay')} AS first_official_ratio,
    {_percent('first_official_11', 'online_non_pay')} AS first_official_11_ratio,
    {_arpu('first_pay_money', 'first_pay')} AS first_pay_arpu,
    {_arpu('first_pay_official_money', 'first_official')} AS first_official_arpu,
    {_arpu('first_official_11_money', 'first_official_11')} AS first_official_11_arpu"""

LEAVES = ctes("online", "signup_log") + [
    FIRST_RECHARGE,
    INCOME,
    CONFIG,
    "norm AS (SELECT *, " + NORMAL_ID + " AS channel FROM online)",
    """non_payers AS (SELECT dt, channel, count(DISTINCT uid) AS online_non_pay,
        arg_min(device_type, (dateline, device_type)) AS device_type FROM norm o
        WHERE length(channel_id) >= 8 AND left(right(channel_id, 6), 4) <> '2138'
        AND NOT EXISTS (SELECT 1 FROM first_recharge f WHERE f.uid = o.uid AND f.dateline < epoch(strptime(CAST(o.dt AS STRING), '%Y%m%d')))
        GROUP BY dt, channel)""",
    """on_day AS (SELECT dt, uid, arg_min(channel_id, (dateline, channel_id)) AS channel_id FROM online GROUP BY dt, uid)""",
    "at_signup AS (SELECT uid, min(channel_id) AS channel_id FROM signup_log GROUP BY uid)",
    """payers AS (SELECT f.*, coalesce(i.money, 0) AS money_total,
        coalesce(CASE WHEN d.channel_id <> '0' THEN d.channel_id END, s.channel_id, d.channel_id, '0') AS channel_id
        FROM first_recharge f LEFT JOIN on_day d ON d.dt = f.dt AND d.uid = f.uid LEFT JOIN at_signup s ON s.uid = f.uid
        LEFT JOIN (SELECT * FROM income WHERE special = 0 AND money > 0 AND success = 1) i ON i.dt = f.dt AND i.uid = f.uid)""",
    f"""paid AS (SELECT dt, {NORMAL_ID} AS channel, count(DISTINCT uid) AS first_pay,
        count(DISTINCT CASE WHEN type = 1 THEN uid END) AS first_official,
        count(DISTINCT CASE WHEN type = 1 AND money >= 11 THEN uid END) AS first_official_11,
        sum(CASE WHEN first_second = 1 THEN money ELSE 0 END) AS first_pay_money,
        sum(CASE WHEN type = 1 THEN money ELSE 0 END) AS first_pay_official_money,
        sum(CASE WHEN type = 1 AND money >= 11 THEN money ELSE 0 END) AS first_official_11_money,
        sum(money_total) AS first_pay_all_money,
        sum(CASE WHEN type = 1 THEN money_total ELSE 0 END) AS first_official_all_money,
        sum(CASE WHEN type = 1 AND money >= 11 THEN money_total ELSE 0 END) AS first_official_11_all_money
        FROM payers GROUP BY dt, {NORMAL_ID})""",
    f"""wide AS (SELECT coalesce(n.dt, p.dt) AS dt, coalesce(n.channel, p.channel) AS channelid,
        coalesce(device_type, 0) AS device_type,
        {', '.join(f'CAST(coalesce({m}, 0) AS BIGINT) AS {m}' for m in first_pay.MEASURES)}
        FROM non_payers n FULL JOIN paid p ON p.dt = n.dt AND p.channel = n.channel)""",
    PARSED[0].replace("FROM cu)", "FROM wide)"),
    """leaves AS (SELECT p.*, coalesce(c.statis_type, 0) AS statis_type, coalesce(c.channame, '') AS channel_name
        FROM parsed p LEFT JOIN config c ON c.chancode = p.channel_code)""",
]
SUMS = ", ".join(f"sum({m}) AS {m}" for m in first_pay.MEASURES)


def _level(n: int, cond: str, keys: str = "") -> str:
    return f"""SELECT {n} AS display, dt, count(*) AS channel_num, {SUMS}, min(channelid) AS pick FROM leaves
        WHERE {cond} GROUP BY dt{', ' + keys if keys else ''}"""


LEVELS = LEAVES + [
    "levels AS ("
    + " UNION ALL ".join(
        [
            _level(1, "TRUE"),
            _level(2, "TRUE", "channel_code, channel_type"),
            _level(3, "channel_type = 1 AND channel_code = 1000 AND channel_subcode = 0"),
            _level(4, "channel_type = 2 AND statis_type = 1"),
            _level(5, "channel_type = 2 AND statis_type = 4"),
            _level(6, "channel_type = 2 AND statis_type = 3"),
            _level(7, "channel_type = 3 AND channel_code = 1001 AND channel_subcode = 0"),
            _level(8, "channel_type = 4"),
            _level(9, "channel_type IN (3, 4) AND statis_type = 1"),
        ]
    )
    + ")",
    f"""labelled AS (SELECT v.dt, CASE WHEN v.display = 1 THEN '渠道总数: ' ELSE '子渠道总数: ' END || v.channel_num AS channel_id,
        CASE v.display WHEN 1 THEN '每天总计' WHEN 4 THEN '安卓CPA' WHEN 5 THEN '安卓CPC' WHEN 6 THEN '安卓电子市场'
            WHEN 7 THEN 'iOS官网' WHEN 8 THEN 'iPad' WHEN 9 THEN 'iOS CPA' WHEN 3 THEN f.channel_name
            ELSE f.channel_name || ' ' || CASE f.channel_type WHEN 1 THEN 'Web' WHEN 2 THEN '安卓' WHEN 3 THEN 'iPhone'
                WHEN 4 THEN 'iPad' ELSE '' END END AS channel_name,
        CASE WHEN v.display = 1 THEN 0 ELSE f.device_type END AS device_type,
        CASE WHEN v.display = 1 THEN 0 ELSE f.statis_type END AS statis_type,
        CASE WHEN v.display = 1 THEN 0 ELSE f.channel_type END AS channel_type,
        CASE WHEN v.display IN (2, 3, 7, 8) THEN f.channel_code ELSE 0 END AS channel_code,
        v.channel_num, {', '.join('v.' + m for m in first_pay.MEASURES)}, v.display
        FROM levels v JOIN leaves f ON f.dt = v.dt AND f.channelid = v.pick)""",
    f"""report AS (SELECT dt, channelid AS channel_id, channel_name, device_type, statis_type, channel_type, channel_code,
        channel_version, channel_subcode, 1 AS channel_num, {MEASURES.replace(' ', ', ')}, 0 AS display FROM leaves
        UNION ALL SELECT dt, channel_id, channel_name, device_type, statis_type, channel_type, channel_code, 0, 0,
        channel_num, {MEASURES.replace(' ', ', ')}, display FROM labelled)""",
]


@query(
    "non_payer_online",
    out(LEAVES, "FROM (SELECT dt, channel AS channel_id, online_non_pay, device_type FROM non_payers)", "dt online_non_pay device_type", "", "channel_id"),
)
def non_payer_online(spark, sf_dir):
    return first_pay.online_non_payers(named(spark, sf_dir, "online"), first_recharge(spark, sf_dir))


@query(
    "first_pay_subtotals",
    out(
        LEVELS,
        f"FROM (SELECT *, {RATIO_SQL} FROM report)",
        "dt device_type statis_type channel_type channel_code channel_version channel_subcode channel_num display "
        + MEASURES,
        RATIOS,
        "channel_id channel_name",
    ),
)
def first_pay_subtotals(spark, sf_dir):
    config = table(spark, sf_dir, "nation").selectExpr(*CONFIG_COLS)
    rows = first_pay.first_pay_report(
        named(spark, sf_dir, "online"),
        first_recharge(spark, sf_dir),
        named(spark, sf_dir, "signup_log"),
        income(spark, sf_dir),
        config,
    )
    return rows.fillna(0, ["channel_version", "channel_subcode"])


# Returning users ------------------------------------------------------------------------

RETURN = ctes("online", "signup_log", "recharge") + [
    "first_visit AS (SELECT idfa, min(dt) AS dt FROM signup_log WHERE id % 3 = 0 GROUP BY idfa)",
    "checksum AS (SELECT dt, idfa, min(id % 2) AS md5 FROM ev WHERE event_type = 'click' GROUP BY dt, idfa)",
    "chat AS (SELECT dt, uid, count(*) AS chat_num FROM ev WHERE event_type = 'click' GROUP BY dt, uid)",
    "flower AS (SELECT dt, uid, sum(amount % 5) AS flower_num FROM ev WHERE event_type = 'error' GROUP BY dt, uid)",
    """pure AS (SELECT DISTINCT dt, idfa, channelid AS channel_id, terminal AS device_type FROM ev
        WHERE event_type = 'view' AND uid = 3000006 AND id % 3 = 0)""",
    "pure_result AS (SELECT dt, channel_id, device_type, count(*) AS n FROM pure GROUP BY dt, channel_id, device_type)",
    """visitors AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dt, idfa ORDER BY dateline, channel_id, device_type)
        AS rn FROM online WHERE uid = 3000006) WHERE rn = 1)""",
    """users AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dt, uid ORDER BY dateline, channel_id, device_type, idfa)
        AS rn FROM online WHERE uid <> 3000006) WHERE rn = 1)""",
    "old_visitors AS (SELECT * FROM visitors WHERE (dt, idfa) NOT IN (SELECT (dt, idfa) FROM first_visit))",
    "old_users AS (SELECT * FROM users WHERE (dt, idfa) NOT IN (SELECT (dt, idfa) FROM first_visit))",
    """back AS (SELECT dt, idfa, channel_id, device_type FROM old_visitors
            WHERE (dt, idfa) NOT IN (SELECT (dt, idfa) FROM signup_log)
        UNION ALL SELECT dt, idfa, channel_id, device_type FROM old_users
        UNION ALL SELECT dt, idfa, channel_id, device_type FROM users WHERE (dt, idfa) IN (SELECT (dt, idfa) FROM first_visit)
            AND (dt, uid) NOT IN (SELECT (dt, uid) FROM signup_log))""",
    """paid AS (SELECT dt, uid, sum(money) AS money FROM recharge WHERE rechange_status = 30 AND rechange_channel < 20
        GROUP BY dt, uid)""",
]
KEY = "dt, channel_id, device_type"


def _part(i: int, cols: str, source: str) -> str:
    return f"m{i} AS (SELECT {KEY}, {cols} FROM {source} GROUP BY {KEY})"


RETURN += [
    _part(1, "count(*) AS non_added_user_sum", "back"),
    _part(
        2,
        "sum(CASE WHEN md5 = 1 THEN 1 ELSE 0 END) AS md5_pass_num, sum(CASE WHEN md5 = 0 THEN 1 ELSE 0 END) AS md5_fail_num",
        "(SELECT b.*, c.md5 FROM back b JOIN checksum c ON c.dt = b.dt AND c.idfa = b.idfa)",
    ),
    _part(3, "sum(n) AS non_added_pure_visitor_sum", "pure_result"),
    _part(
        4,
        "count(*) AS non_added_register_sum",
        "(SELECT * FROM users WHERE (dt, uid) NOT IN (SELECT (dt, uid) FROM signup_log))",
    ),
    _part(
        5,
        """count(DISTINCT uid) AS non_added_pure_visitor_register_sum,
        count(DISTINCT CASE WHEN qqstatus = 1 THEN uid END) AS non_added_pure_visitor_qq_sum""",
        """(SELECT v.dt, v.channel_id, v.device_type, r.uid, r.qqstatus FROM pure v JOIN signup_log r
            ON r.dt = v.dt AND r.idfa = v.idfa)""",
    ),
    _part(6, "count(*) AS non_added_visitor_sum", "old_visitors"),
    _part(
        7,
        """count(DISTINCT uid) AS non_added_visitor_register_sum,
        count(DISTINCT CASE WHEN qqstatus = 1 THEN uid END) AS non_added_visitor_qq_sum""",
        """(SELECT v.dt, v.channel_id, v.device_type, r.uid, r.qqstatus FROM old_visitors v JOIN signup_log r
            ON r.dt = v.dt AND r.idfa = v.idfa)""",
    ),
    _part(
        8,
        "count(*) AS non_added_recharge_user_sum, sum(money) AS old_pay_money",
        "(SELECT o.*, p.money FROM old_users o JOIN paid p ON p.dt = o.dt AND p.uid = o.uid)",
    ),
    _part(
        9,
        "count(*) AS non_added_chat_user_sum, sum(chat_num) AS non_added_user_chat_sum",
        "(SELECT o.*, c.chat_num FROM old_users o JOIN chat c ON c.dt = o.dt AND c.uid = o.uid)",
    ),
    _part(
        10,
        "count(*) AS non_added_flower_user_sum, sum(flower_num) AS non_added_user_flower_sum",
        "(SELECT o.*, f.flower_num FROM old_users o JOIN flower f ON f.dt = o.dt AND f.uid = o.uid)",
    ),
    "spine AS (" + " UNION ".join(f"SELECT {KEY} FROM m{i}" for i in range(1, 11)) + ")",
]
RETURN_BODY = (
    f"FROM (SELECT {KEY}, "
    + ", ".join(f"coalesce({m}, 0) AS {m}" for m in returning.METRICS)
    + " FROM spine "
    + " ".join(f"LEFT JOIN m{i} USING ({KEY})" for i in range(1, 11))
    + ") WHERE ("
    + " OR ".join(f"{m} <> 0" for m in returning.METRICS if m != "old_pay_money")
    + ") AND channel_id NOT IN ('0', '', 'yibao', 'EN_APP_KEY_PLACEHOLDER') AND right(channel_id, 6) NOT LIKE '2138%'"
)


@query(
    "returning_metrics",
    out(RETURN, RETURN_BODY, "dt device_type " + " ".join(returning.METRICS), "", "channel_id"),
)
def returning_metrics(spark, sf_dir):
    ev = events(spark, sf_dir)
    signup = named(spark, sf_dir, "signup_log")
    click = ev.filter(F.col("event_type") == "click")
    pure = (
        ev.filter((F.col("event_type") == "view") & (F.col("uid") == codes.VISITOR_UID) & (F.col("id") % 3 == 0))
        .select("dt", "idfa", F.col("channelid").alias("channel_id"), F.col("terminal").alias("device_type"))
        .distinct()
    )
    return returning.returning_metrics(
        named(spark, sf_dir, "online"),
        signup.filter(F.col("id") % 3 == 0).groupBy("idfa").agg(F.min("dt").alias("dt")),
        signup,
        named(spark, sf_dir, "recharge"),
        click.groupBy("dt", "idfa").agg(F.min(F.col("id") % 2).alias("md5")),
        click.groupBy("dt", "uid").agg(F.count(F.lit(1)).alias("chat_num")),
        ev.filter(F.col("event_type") == "error")
        .groupBy("dt", "uid")
        .agg(F.sum(F.col("amount") % 5).alias("flower_num")),
        pure,
        pure.groupBy("dt", "channel_id", "device_type").agg(F.count(F.lit(1)).alias("non_added_pure_visitor")),
    )


# Host earnings --------------------------------------------------------------------------

PERIOD = (788918400, 1735689599)
DIAMONDS = """diamonds AS (SELECT suppkey AS roomid, orderkey % 5 AS fuid,
    CASE WHEN partkey % 2 = 0 THEN -quantity ELSE quantity END AS diamond, partkey % 3 % 2 AS is_anchor, line AS category,
    dateline FROM ln)"""
WORKLOAD = """workload AS (SELECT roomid, dateline AS start_dt, dateline + 1800 + (id % 5) * 1800 AS end_dt,
    1800 + (id % 5) * 1800 AS total FROM ev WHERE event_type IN ('signup', 'view'))"""


@query(
    "host_earnings_hour",
    out(
        ctes("ev", "ln")
        + [
            DIAMONDS,
            WORKLOAD,
            f"""earned AS (SELECT roomid, sum(abs(diamond)) AS diamonds FROM diamonds WHERE fuid <> 0 AND is_anchor = 1
                AND category IN (1, 2) AND dateline BETWEEN {PERIOD[0]} AND {PERIOD[1]} GROUP BY roomid)""",
            f"""daily AS (SELECT roomid, strftime(make_timestamp(end_dt * 1000000), '%Y%m%d') AS day, sum(total) AS seconds
                FROM workload WHERE start_dt >= {PERIOD[0]} AND end_dt <= {PERIOD[1]} GROUP BY ALL)""",
            """aired AS (SELECT roomid, (sum(seconds) * 200 + 3600) // 7200 AS cents,
                count(CASE WHEN seconds >= 7200 THEN 1 END) AS days FROM daily GROUP BY roomid)""",
            """rooms AS (SELECT roomid, coalesce(s_name, '') AS nickname, coalesce(s_nationkey % 10, 0) AS anchor_level,
                coalesce(diamonds, 0) AS diamonds, coalesce(cents, 0) AS cents, coalesce(days, 0) AS days
                FROM earned FULL JOIN aired USING (roomid) LEFT JOIN supplier ON s_suppkey = roomid)""",
            """listed AS (SELECT * FROM rooms WHERE cents <> 0 OR days <> 0 OR diamonds <> 0 UNION ALL
                SELECT 100, '总计', 0, sum(diamonds), sum(cents), sum(days) FROM rooms)""",
        ],
        """FROM (SELECT roomid, nickname, anchor_level, diamonds, days, CAST(cents AS DOUBLE) / 100 AS online,
            19950101 AS start_time, 20241231 AS end_time, CASE WHEN cents = 0 THEN 0 ELSE
            CAST((2 * diamonds * 10000 + cents) // (2 * cents) AS DOUBLE) / 100 END AS diamonds_pro FROM listed)""",
        "roomid anchor_level diamonds days start_time end_time",
        "online diamonds_pro",
        "nickname",
    ),
)
def host_earnings_hour(spark, sf_dir):
    q = F.col("quantity")
    diamonds = lines(spark, sf_dir).select(
        F.col("suppkey").alias("roomid"),
        (F.col("orderkey") % 5).alias("fuid"),
        F.when(F.col("partkey") % 2 == 0, -q).otherwise(q).alias("diamond"),
        (F.col("partkey") % 3 % 2).alias("is_anchor"),
        F.col("line").alias("category"),
        "dateline",
    )
    total = F.lit(1800) + F.col("id") % 5 * 1800
    workload = events(spark, sf_dir, "signup", "view").select(
        "roomid", F.col("dateline").alias("start_dt"), (F.col("dateline") + total).alias("end_dt"), total.alias("total")
    )
    roster = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("roomid"), F.col("s_name").alias("nickname"), (F.col("s_nationkey") % 10).alias("level")
    )
    return host_earnings(diamonds, workload, roster, *PERIOD)


# Retention and slots --------------------------------------------------------------------

DAILY_SECONDS = 72000
WEEK, LATER = (7, 13), (14, 27)
ROOM_TABLES = [
    PRICES,
    "blacklist AS (SELECT s_suppkey AS roomid FROM supplier WHERE s_suppkey % 9 = 4)",
    f"levels AS (SELECT s_suppkey AS roomid, {LAST_DAY} AS date_time, s_nationkey % 10 AS level FROM supplier)",
    "hosts AS (SELECT s_suppkey AS roomid, s_nationkey % 2 AS gender FROM supplier)",
    f"""busy AS (SELECT roomid, sum(total) AS seconds FROM on_air WHERE dt BETWEEN {FIRST_DAY} AND {LAST_DAY}
        GROUP BY roomid HAVING sum(total) > {DAILY_SECONDS} * 30)""",
    f"""rec AS (SELECT roomid, max(kind) AS recommend_type FROM (SELECT roomid, dateline, 1 AS kind FROM normal_log
        UNION ALL SELECT roomid, dateline, 2 FROM fine_log)
        WHERE strftime(make_timestamp(dateline * 1000000), '%Y%m%d') = '{FIRST_DAY}' GROUP BY roomid)""",
]
NAMES = ("online", "dwell_log", "on_air", "slot_log", "normal_log", "fine_log")


def _retention_sql(cohort_sql: str, filtered: str) -> str:
    def back(name: str, low: int, high: int) -> str:
        return f"""{name} AS (SELECT b.roomid, b.uid FROM base b JOIN (SELECT uid, roomid, dt, min(dateline) AS later,
            sum(longs) AS longs FROM dwell_log GROUP BY uid, roomid, dt) d ON d.uid = b.uid AND d.roomid = b.roomid
            AND d.later BETWEEN b.start_dt + {low} * 86400 AND b.start_dt + {high} * 86400
            GROUP BY b.roomid, b.uid HAVING sum(d.longs) >= 300)"""

    def rows(by: str) -> str:
        key = "roomid" if by else "100 AS roomid"
        return f"""SELECT {key}, count(DISTINCT u) AS user_num, count(DISTINCT w) AS week_num,
            count(DISTINCT m) AS month_num FROM (SELECT roomid, uid AS u, NULL AS w, NULL AS m FROM base
            UNION ALL SELECT roomid, NULL, uid, NULL FROM back1 UNION ALL SELECT roomid, NULL, NULL, uid FROM back2) {by}"""

    return out(
        ctes(*NAMES)
        + ROOM_TABLES
        + [
            f"cohort AS ({cohort_sql})",
            f"""base AS (SELECT uid, roomid, min(dateline) AS start_dt FROM dwell_log
                WHERE dt BETWEEN {FIRST_DAY} AND {LAST_DAY} AND uid IN (SELECT uid FROM cohort)
                AND roomid IN (SELECT roomid FROM busy) AND roomid NOT IN (SELECT roomid FROM blacklist)
                GROUP BY uid, roomid HAVING sum(longs) > 300)""",
            back("back1", *WEEK),
            back("back2", *LATER),
            f"""per_room AS (SELECT r.*, (seconds * 200 + 3600) // 7200 AS cents FROM ({rows('GROUP BY roomid')}) r
                JOIN busy USING (roomid))""",
            f"""everything AS (SELECT * FROM per_room UNION ALL
                SELECT t.*, (SELECT coalesce(sum(cents), 0) FROM per_room) FROM ({rows('')}) t)""",
        ],
        f"""FROM (SELECT {FIRST_DAY} AS start_time, {LAST_DAY} AS end_time, e.roomid, CAST(cents AS DOUBLE) / 100 AS total,
            user_num, week_num, month_num,
            CASE WHEN user_num = 0 THEN 0 ELSE CAST((2 * week_num * 10000 + user_num) // (2 * user_num) AS DOUBLE) / 10000 END AS week_pro,
            CASE WHEN user_num = 0 THEN 0 ELSE CAST((2 * month_num * 10000 + user_num) // (2 * user_num) AS DOUBLE) / 10000 END AS month_pro,
            coalesce(s.n, 0) AS recommend_times, coalesce(l.level, 0) AS level, coalesce(c.recommend_type, 0) AS recommend_type,
            coalesce(h.gender, 0) AS gender, {filtered}
            FROM everything e
            LEFT JOIN (SELECT roomid, count(*) AS n FROM slot_log GROUP BY roomid) s ON s.roomid = e.roomid AND e.roomid < 100
            LEFT JOIN levels l ON l.roomid = e.roomid AND e.roomid < 100
            LEFT JOIN rec c ON c.roomid = e.roomid AND e.roomid < 100
            LEFT JOIN hosts h ON h.roomid = e.roomid AND e.roomid < 100)""",
        "start_time end_time roomid user_num week_num month_num recommend_times level recommend_type gender "
        "statis_type device_type f_type p_type",
        "total week_pro month_pro",
        "f_cids p_cids",
    )


def _room_frames(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    room = F.col("s_suppkey").alias("roomid")
    return {
        "blacklist": supplier.filter(F.col("s_suppkey") % 9 == 4).select(room),
        "levels": supplier.select(room, F.lit(LAST_DAY).alias("date_time"), (F.col("s_nationkey") % 10).alias("level")),
        "hosts": supplier.select(room, (F.col("s_nationkey") % 2).alias("gender")),
    }


def _retention(spark, sf_dir, params):
    rooms = _room_frames(spark, sf_dir)
    logs = {n: named(spark, sf_dir, n) for n in NAMES}
    return retention(
        logs["online"],
        logs["dwell_log"],
        logs["on_air"],
        prices(spark, sf_dir),
        rooms["blacklist"],
        rooms["levels"],
        logs["slot_log"],
        logs["normal_log"],
        logs["fine_log"],
        rooms["hosts"],
        FIRST_DAY,
        LAST_DAY,
        params,
        week=WEEK,
        month=LATER,
        daily_seconds=DAILY_SECONDS,
    )


EVERYONE = "SELECT DISTINCT uid FROM online WHERE uid <> 3000006 AND right(channel_id, 6) NOT LIKE '2138%'"
PARENT = "CASE WHEN length(channel_id) = 8 THEN left(channel_id, 4) ELSE left(right(channel_id, 6), 4) END"
NARROW = f"""SELECT uid FROM (SELECT uid, arg_min(channel_id, (dateline, channel_id)) AS channel_id FROM online
    WHERE uid <> 3000006 AND right(channel_id, 6) NOT LIKE '2138%' AND channel_id NOT LIKE 's%'
    AND left(channel_id, 5) NOT IN ('10102', '10135') AND {PARENT} NOT IN ('1003') GROUP BY uid)
    WHERE {PARENT} NOT IN (SELECT left(code, 4) FROM prices WHERE statis_type <> 4)"""


@query("retention_week_month", _retention_sql(EVERYONE, "0 AS statis_type, 0 AS device_type, 1 AS f_type, 1 AS p_type, '' AS f_cids, '' AS p_cids"))
def retention_week_month(spark, sf_dir):
    return _retention(spark, sf_dir, CohortFilter())


@query("retention_filtered", _retention_sql(NARROW, "4 AS statis_type, 1 AS device_type, 2 AS f_type, 1 AS p_type, '1003' AS f_cids, '' AS p_cids"))
def retention_filtered(spark, sf_dir):
    return _retention(
        spark, sf_dir, CohortFilter(device=1, statis_type=4, parents=("1003",), parent_mode=EXCLUDE)
    )


@query(
    "busy_rooms",
    out(
        ctes(*NAMES) + ROOM_TABLES,
        "FROM (SELECT roomid, CAST((seconds * 200 + 3600) // 7200 AS DOUBLE) / 100 AS total FROM busy)",
        "roomid",
        "total",
    ),
)
def busy(spark, sf_dir):
    return busy_rooms(named(spark, sf_dir, "on_air"), FIRST_DAY, LAST_DAY, DAILY_SECONDS)


@query(
    "slot_pivot",
    out(
        ctes(*NAMES)
        + ROOM_TABLES
        + [
            f"cohort AS ({EVERYONE})",
            """aud AS (SELECT roomid, count(DISTINCT uid) AS user_num FROM dwell_log WHERE uid IN (SELECT uid FROM cohort)
                AND roomid IN (SELECT roomid FROM busy) AND roomid NOT IN (SELECT roomid FROM blacklist) GROUP BY roomid)""",
            "ranks AS (SELECT roomid, "
            + ", ".join(f"sum(CASE WHEN cal_rank = {i} THEN 1 ELSE 0 END) AS p{i}" for i in range(1, 16))
            + " FROM slot_log GROUP BY roomid)",
        ],
        f"""FROM (SELECT {FIRST_DAY} AS start_time, {LAST_DAY} AS end_time, *, coalesce(rec.recommend_type, 0) AS kind
            FROM aud JOIN ranks USING (roomid) LEFT JOIN rec USING (roomid))""",
        "start_time end_time roomid user_num " + " ".join(f"p{i}" for i in range(1, 16)),
    ).replace("CAST(p15", "CAST(kind AS BIGINT) AS recommend_type, CAST(p15"),
)
def slot_pivot(spark, sf_dir):
    logs = {n: named(spark, sf_dir, n) for n in NAMES}
    users = cohort(logs["online"], prices(spark, sf_dir), FIRST_DAY, LAST_DAY, CohortFilter())
    return slots.slot_report(
        users,
        logs["dwell_log"],
        logs["on_air"],
        _room_frames(spark, sf_dir)["blacklist"],
        logs["slot_log"],
        logs["normal_log"],
        logs["fine_log"],
        FIRST_DAY,
        LAST_DAY,
        daily_seconds=DAILY_SECONDS,
    )
