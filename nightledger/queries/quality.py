"""Channel quality and settlement over all days of the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightledger.plans import channel_quality as plan
from nightledger.queries.channels import PATTERN_COLS, PRICES, prices
from nightledger.queries.registry import out, query
from nightledger.queries.standins import EVENT_CHANNEL, ctes, customers, named, table
from nightledger.session import cut_lineage

SOURCES = ("signup_log", "request_log", "heartbeat", "on_air", "recharge", "spend_log")


def _gate(c: str) -> str:
    return f"""(CASE WHEN {c} LIKE 's%' THEN length({c}) >= 9
        AND coalesce(TRY_CAST(substr({c}, length({c}) - 8, 3) AS INT) >= 753, FALSE) ELSE TRUE END)"""


def _standard(c: str) -> str:
    return f"""CASE WHEN {c} LIKE 's%' AND right({c}, 6) = '102000' THEN 1 WHEN {c} LIKE '10102%' AND right({c}, 6) = '100100'
        THEN 2 WHEN {c} LIKE '10135%' AND right({c}, 6) = '100100' THEN 3 ELSE 4 END"""


START = "CAST(epoch(strptime(CAST({} AS STRING), '%Y%m%d')) AS BIGINT)"
KNOWN = f"(macaddr NOT IN ('', '0') AND {_gate('channelid')})"
IOS = "(left(channelid, 5) IN ('10102', '10135'))"

FACTS = ctes(*SOURCES) + [
    f"""dev AS (SELECT *, {START.format('dt')} AS day_start FROM (SELECT *, row_number() OVER (PARTITION BY dt, idfa
        ORDER BY dateline, channel_id) AS rn FROM signup_log WHERE {_gate('channel_id')}) WHERE rn = 1)""",
    f"""req AS (SELECT dt, macaddr AS idfa,
        max(CASE WHEN {KNOWN} AND action = 'serv_loginqq' THEN 1 ELSE 0 END) AS login_qq,
        max(CASE WHEN {KNOWN} AND action = 'serv_loginweixin' THEN 1 ELSE 0 END) AS login_weixin,
        CASE WHEN max(CASE WHEN {KNOWN} THEN dateline END) - min(CASE WHEN {KNOWN} THEN dateline END) >= 90
            THEN count(CASE WHEN {KNOWN} THEN action END) ELSE 0 END AS login_num,
        max(CASE WHEN {IOS} THEN dateline END) - min(CASE WHEN {IOS} THEN dateline END) AS ios_span
        FROM request_log GROUP BY dt, macaddr)""",
    f"""hb AS (SELECT dt, idfa, count(DISTINCT dateline // 10) AS heartbeat FROM heartbeat
        WHERE dateline > {START.format('dt')} AND length(idfa) > 1 GROUP BY dt, idfa)""",
    """air AS (SELECT d.dt, d.idfa, count(CASE WHEN h.dateline <= d.dateline + 43200 THEN 1 END) AS heartbeat_active,
        count(DISTINCT CASE WHEN h.dateline > d.day_start AND a.dateline > d.day_start AND d.dateline > d.day_start
            THEN h.roomid END) AS room_num
        FROM dev d JOIN heartbeat h ON h.idfa = d.idfa AND h.dateline > d.day_start - 43200
            AND h.dateline <= d.day_start + 86399
        JOIN on_air a ON a.roomid = h.roomid AND h.dateline BETWEEN a.start_dt AND a.end_dt
            AND a.start_dt < d.day_start + 86399 AND a.end_dt > d.day_start - 43200
        GROUP BY d.dt, d.idfa)""",
    f"reg AS (SELECT dt, uid, idfa, {_standard('channel_id')} AS class FROM signup_log WHERE {_gate('channel_id')})",
    """payer AS (SELECT DISTINCT r.dt, r.idfa FROM reg r WHERE (r.dt, r.uid) IN (SELECT (dt, uid) FROM recharge
        WHERE uid <> 3000006 AND rechange_status = 30 AND rechange_channel < 20))""",
    """spender AS (SELECT DISTINCT r.dt, r.idfa FROM reg r WHERE (r.dt, r.uid) IN (SELECT (dt, uid) FROM spend_log
        WHERE uid <> 3000006 AND consume_coin > 0))""",
    """ips AS (SELECT x.dt, x.ipaddr, count(*) AS device_per_ip FROM (SELECT DISTINCT dt, ipaddr, day_start FROM dev) x
        JOIN dev y ON y.ipaddr = x.ipaddr AND y.day_start BETWEEN x.day_start - 31 * 86400 AND x.day_start
        GROUP BY x.dt, x.ipaddr)""",
    """facts AS (SELECT d.dt, d.idfa, d.ipaddr, d.channel_id, d.device_type, d.dateline, d.day_start,
        coalesce(login_qq, 0) AS login_qq, coalesce(login_weixin, 0) AS login_weixin, coalesce(login_num, 0) AS login_num,
        ios_span, coalesce(heartbeat, 0) AS heartbeat,
        CASE WHEN coalesce(heartbeat, 0) < 2 THEN coalesce(heartbeat_active, 0) ELSE 0 END AS heartbeat_active,
        coalesce(room_num, 0) AS room_num, CASE WHEN p.idfa IS NULL THEN 0 ELSE 1 END AS recharge,
        CASE WHEN s.idfa IS NULL THEN 0 ELSE 1 END AS consume, coalesce(device_per_ip, 0) AS device_per_ip
        FROM dev d LEFT JOIN req USING (dt, idfa) LEFT JOIN hb USING (dt, idfa) LEFT JOIN air USING (dt, idfa)
        LEFT JOIN payer p USING (dt, idfa) LEFT JOIN spender s USING (dt, idfa) LEFT JOIN ips USING (dt, ipaddr))""",
]
COUNTS = FACTS + [
    f"""base AS (SELECT b.dt, b.class, CASE WHEN rate = 0 OR coalesce(added, 0) = 0 THEN
        CASE b.class WHEN 1 THEN 0.5 WHEN 2 THEN 0.48 ELSE 0.6 END ELSE rate END AS baseline
        FROM (SELECT dt, {_standard('channel_id')} AS class, CAST(sum(login_qq + login_weixin) AS DOUBLE) / count(*) AS rate
            FROM facts GROUP BY ALL HAVING class < 4) b
        LEFT JOIN (SELECT dt, class, count(*) AS added FROM reg WHERE (dt, idfa) IN (SELECT (dt, idfa) FROM facts
            WHERE dateline > day_start) GROUP BY dt, class) a ON a.dt = b.dt AND a.class = b.class)""",
    f"""fails AS (SELECT dt, channelid AS channel_id, count(*) AS md5_fail_num FROM (SELECT *, row_number() OVER (
        PARTITION BY dt, macaddr ORDER BY dateline, id) AS rn FROM request_log WHERE {KNOWN}) WHERE rn = 1
        AND terminal = 2 AND channelid <> 'EN_APP_KEY_PLACEHOLDER' AND idfv <> 1 GROUP BY dt, channelid)""",
    """marked AS (SELECT *, device_per_ip <= 5 AS few, heartbeat < 3 AS idle, channel_id LIKE 's%' AS android,
        channel_id LIKE '10102%' AS iphone, channel_id LIKE '10135%' AS ipad FROM facts
        WHERE channel_id NOT IN ('0', 'EN_APP_KEY_PLACEHOLDER') AND length(channel_id) BETWEEN 8 AND 17)""",
    """tally AS (SELECT dt, channel_id, android, iphone OR ipad AS ios, CASE WHEN android THEN 1 WHEN iphone THEN 2
            WHEN ipad THEN 3 ELSE 4 END AS class, count(*) AS active_num,
        count(CASE WHEN device_per_ip < 5 THEN 1 END) AS stat_num,
        count(CASE WHEN few AND (android <> (device_type = 2) OR iphone <> (device_type = 3)) THEN 1 END) AS del_1_num,
        count(CASE WHEN few AND idle AND ((android AND device_type = 2) OR (iphone AND device_type = 3)) THEN 1 END) AS idle_num,
        count(CASE WHEN few AND (iphone OR ipad) AND device_type IN (3, 4) AND ios_span < 180 THEN 1 END) AS short_num,
        count(CASE WHEN few AND android AND device_type = 2 AND idle AND heartbeat_active > 3 THEN 1 END) AS add_1_num,
        count(CASE WHEN few AND android AND device_type = 2 AND idle AND heartbeat_active > 3
            AND room_num < 1 AND recharge = 0 AND consume = 0 AND login_num < 2 THEN 1 END) AS del_3_num,
        CAST(sum(login_qq + login_weixin) AS DOUBLE) / count(*) AS login_ratio
        FROM marked GROUP BY ALL)""",
    """factored AS (SELECT t.*, CASE WHEN short_num > 0 THEN short_num ELSE idle_num END AS del_2_num,
        CASE WHEN ios THEN 1.0 WHEN b.baseline IS NULL THEN 0.0
            ELSE least(CAST(1 AS DOUBLE) - (CAST(1 AS DOUBLE) - login_ratio / b.baseline) / 2, 1.0) END AS dis_4_num,
        CASE WHEN android THEN coalesce(f.md5_fail_num, 0) ELSE 0 END AS md5_fail_num
        FROM tally t LEFT JOIN base b ON b.dt = t.dt AND b.class = t.class
        LEFT JOIN fails f ON f.dt = t.dt AND f.channel_id = t.channel_id)""",
    """counts AS (SELECT *, CAST(greatest(round(CAST(stat_num - del_1_num - del_2_num + add_1_num - del_3_num AS DOUBLE)
        * dis_4_num + CAST(0.1 AS DOUBLE)), 0) AS BIGINT) AS cal_num FROM factored)""",
]
COUNT_BIG = "dt active_num stat_num del_1_num del_2_num add_1_num del_3_num md5_fail_num cal_num"

QUOTA_SQL = "quota AS (SELECT channelid AS channel_id, max(k) % 4 * 2 AS remain, 0 AS total FROM ev GROUP BY channelid)"
SETTLED = COUNTS + [
    PRICES,
    QUOTA_SQL,
    f"disc AS (SELECT {', '.join(PATTERN_COLS)} FROM nation)",
    """priced AS (SELECT c.*, p.start_price AS price,
        greatest(coalesce(q.remain, 0) - coalesce(sum(c.cal_num) OVER (PARTITION BY c.channel_id ORDER BY c.dt
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS remain,
        coalesce((SELECT arg_max(d.discount, (CASE WHEN d.grade IN (2, 3) THEN d.grade ELSE 1 END, length(d.pattern), -d.id))
            FROM disc d WHERE d.id > 1 AND c.channel_id LIKE d.pattern), 1) AS discount_ratio,
        (SELECT min(d.id) FROM disc d WHERE c.channel_id LIKE d.pattern) AS partner_id,
        (SELECT arg_min(d.pattern, d.id) FROM disc d WHERE c.channel_id LIKE d.pattern) AS partner_name
        FROM counts c LEFT JOIN quota q ON q.channel_id = c.channel_id
        LEFT JOIN prices p ON left(p.code, 4) = CASE WHEN length(c.channel_id) = 8 THEN left(c.channel_id, 4)
            ELSE left(right(c.channel_id, 6), 4) END
            AND p.channel_platform = CASE WHEN c.channel_id LIKE '10301%' THEN 1 WHEN android THEN 2
                WHEN c.channel_id LIKE '10102%' THEN 3 ELSE 4 END)""",
    """paid AS (SELECT *, CAST(100 * CASE WHEN remain = 0 THEN cal_num * discount_ratio WHEN remain > cal_num THEN cal_num
        ELSE remain + (cal_num - remain) * discount_ratio END AS BIGINT) AS paid100 FROM priced)""",
    """gated AS (SELECT *, CASE WHEN android AND coalesce(TRY_CAST(substr(channel_id, 7, 3) AS INT) < 763, FALSE) THEN 0
        ELSE paid100 END AS final100 FROM paid)""",
    f"""settled AS (SELECT g.*, CAST(final100 AS DOUBLE) / 100 AS final_num,
        CASE WHEN coalesce(before.f, 0) = 0 THEN 0 ELSE
            CAST((2 * paid100 * 10000 + before.f) // (2 * before.f) AS DOUBLE) / 100 END AS final_num_ratio,
        CAST(coalesce(final100 * price, 0) AS DOUBLE) / 100 AS total_price
        FROM gated g LEFT JOIN (SELECT channel_id AS ch, {START.format('dt')} AS d, final100 AS f FROM gated) before
        ON before.ch = g.channel_id AND before.d = {START.format('g.dt')} - 86400)""",
]


def _devices(spark, sf_dir):
    return plan.new_devices(named(spark, sf_dir, "signup_log"))


def _facts(spark, sf_dir):
    return plan.device_facts(
        _devices(spark, sf_dir),
        plan.request_facts(named(spark, sf_dir, "request_log")),
        *[named(spark, sf_dir, n) for n in ("heartbeat", "on_air", "signup_log", "recharge", "spend_log")],
    )


@query(
    "channel_device_facts",
    out(
        FACTS,
        "FROM facts",
        "dt ipaddr device_type dateline login_qq login_weixin login_num heartbeat heartbeat_active room_num recharge "
        "consume device_per_ip",
        "",
        "idfa channel_id",
    ),
)
def channel_device_facts(spark, sf_dir):
    return _facts(spark, sf_dir).drop("ios_span")


@query(
    "interval_three_way",
    out(FACTS, "FROM air", "dt heartbeat_active room_num", "", "idfa"),
)
def interval_three_way(spark, sf_dir):
    beats = cut_lineage(plan.device_beats(_devices(spark, sf_dir), named(spark, sf_dir, "heartbeat")))
    return plan.on_air_facts(beats, named(spark, sf_dir, "on_air"))


@query("login_baselines", out(COUNTS, "FROM base", "dt class", "baseline"))
def login_baselines(spark, sf_dir):
    requested = plan.request_facts(named(spark, sf_dir, "request_log"))
    return plan.login_baselines(_devices(spark, sf_dir), requested, named(spark, sf_dir, "signup_log"))


@query("channel_counts", out(COUNTS, "FROM counts", COUNT_BIG, "dis_4_num", "channel_id"))
def channel_counts(spark, sf_dir):
    requested = plan.request_facts(named(spark, sf_dir, "request_log"))
    baselines = plan.login_baselines(_devices(spark, sf_dir), requested, named(spark, sf_dir, "signup_log"))
    return plan.channel_counts(_facts(spark, sf_dir), baselines, plan.failed_checksums(requested))


def _quota(spark, sf_dir):
    users = table(spark, sf_dir, "events").select("user_id").distinct()  # a channel is worked out once a user, not once an event
    return (
        users.selectExpr("user_id AS k", f"{EVENT_CHANNEL} AS channel_id")
        .groupBy("channel_id")
        .agg((F.max("k") % 4 * 2).alias("remain"), F.lit(0).cast("bigint").alias("total"))
    )


def _quality(spark, sf_dir):
    rules = table(spark, sf_dir, "nation").selectExpr(*PATTERN_COLS)
    return plan.channel_quality(
        *[
            named(spark, sf_dir, n)
            for n in ("signup_log", "request_log", "heartbeat", "on_air", "signup_log", "recharge", "spend_log")
        ],
        prices(spark, sf_dir),
        rules.withColumnRenamed("pattern", "channelid"),
        rules.select(
            F.col("id").alias("partner_id"), F.col("pattern").alias("partner_name"), F.col("pattern").alias("channelid")
        ),
        _quota(spark, sf_dir),
    )


@query(
    "channel_quality",
    out(
        SETTLED,
        """FROM (SELECT * REPLACE (coalesce(price, 0) AS price, coalesce(partner_id, 0) AS partner_id,
            coalesce(partner_name, '') AS partner_name) FROM settled)""",
        COUNT_BIG + " remain partner_id",
        "dis_4_num price discount_ratio final_num final_num_ratio total_price",
        "channel_id partner_name",
    ),
)
def channel_quality(spark, sf_dir):
    return _quality(spark, sf_dir).fillna(0, ["price", "partner_id"]).fillna("", ["partner_name"])


@query(
    "channel_totals",
    out(
        SETTLED,
        """FROM (SELECT coalesce(q.channel_id, s.channel_id) AS channel_id, coalesce(used, 0) AS total,
            greatest(coalesce(q.remain, 0) - coalesce(used, 0), 0) AS remain FROM quota q FULL JOIN
            (SELECT channel_id, sum(cal_num) AS used FROM settled GROUP BY channel_id) s ON s.channel_id = q.channel_id)""",
        "total remain",
        "",
        "channel_id",
    ),
)
def channel_totals(spark, sf_dir):
    return plan.channel_totals(_quality(spark, sf_dir), _quota(spark, sf_dir))


@query(
    "quota_settlement",
    out(
        ctes("cu")
        + [
            """w AS (SELECT k, k % 50 AS cal, k % 7 * 5 AS remain, CAST(0.5 + (k % 5) * 0.1 AS DECIMAL(10,2)) AS disc FROM cu)"""
        ],
        """FROM (SELECT k, CASE WHEN remain = 0 THEN cal * disc WHEN remain > cal THEN cal
            ELSE remain + (cal - remain) * disc END AS final_num FROM w)""",
        "k",
        "final_num",
    ),
)
def quota_settlement(spark, sf_dir):
    k = F.col("k")
    discount = (F.lit(5) + k % 5).cast("decimal(10,2)") / 10
    return customers(spark, sf_dir).select(
        "k", plan.final_units(k % 50, k % 7 * 5, discount.cast("decimal(10,2)")).alias("final_num")
    )
