"""Dwell time, lobby stays and other order-dependent logic on the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightledger.functions.dates import day_number
from nightledger.operators.aggs import span, time_bucket_count
from nightledger.operators.joins import Lookup, interval_join, nearest_join, nearest_lookup, within_window_after
from nightledger.operators.windows import consecutive_gaps, first_k, mark_last, over_frequent, rolling_count
from nightledger.plans import dwell as plan
from nightledger.plans import lobby
from nightledger.queries.registry import out, query
from nightledger.queries.standins import ctes, events, named
from nightledger.sources.scan import in_range, month_days

CAP = 259200
ON_AIR_CAP = 21600

ACT = "act AS (SELECT idfa, min(id) AS actid FROM activation GROUP BY idfa)"


def _dwell_sql(source: str, keys: str, cap: int) -> list[str]:
    """Row-by-row gaps over each person and room, as plain window functions."""
    part = f"dt, uid, dev, {keys}"
    return [
        f"""beats AS (SELECT *, CASE WHEN uid = 3000006 THEN idfa ELSE '' END AS dev FROM {source}
            WHERE uid >= 3000006)""",
        f"""gaps AS (SELECT *, dateline - lag(dateline) OVER w AS gap, row_number() OVER w AS rn
            FROM beats WINDOW w AS (PARTITION BY {part} ORDER BY dateline, id))""",
        f"""dwell AS (SELECT {part}, min(CASE WHEN rn = 1 THEN idfa END) AS idfa,
            min(CASE WHEN rn = 1 THEN terminal END) AS terminal,
            min(CASE WHEN rn = 1 THEN channelid END) AS channelid,
            min(CASE WHEN rn = 1 THEN ipaddr END) AS ipaddr,
            min(dateline) AS first_dateline, max(dateline) AS dateline,
            sum(CASE WHEN gap <= {cap} THEN gap ELSE 0 END) AS room_time
            FROM gaps GROUP BY {part})""",
        ACT,
        """rooms AS (SELECT dwell.*, coalesce(actid, 0) AS actid FROM dwell LEFT JOIN act USING (idfa))""",
    ]


SOFT = ctes("heartbeat_month", "activation") + _dwell_sql("heartbeat_month", "roomid", CAP)
ON_AIR = (
    ctes("heartbeat_month", "on_air", "activation")
    + [
        """aired AS (SELECT h.*, a.start_dt, a.end_dt FROM heartbeat_month h
        JOIN (SELECT DISTINCT roomid, start_dt, end_dt FROM on_air) a
        ON a.roomid = h.roomid AND h.dateline BETWEEN a.start_dt AND a.end_dt)"""
    ]
    + _dwell_sql("aired", "roomid, start_dt, end_dt", ON_AIR_CAP)
)


@query(
    "room_dwell_soft",
    out(SOFT, "FROM rooms", "dt uid roomid terminal ipaddr first_dateline dateline room_time actid", "", "idfa channelid"),
)
def room_dwell_soft(spark, sf_dir):
    return plan.room_dwell(named(spark, sf_dir, "heartbeat_month"), named(spark, sf_dir, "activation"), CAP)


@query(
    "room_dwell_on_air",
    out(
        ON_AIR,
        "FROM rooms",
        "dt uid roomid start_dt end_dt terminal ipaddr first_dateline dateline room_time actid",
        "",
        "idfa channelid",
    ),
)
def room_dwell_on_air(spark, sf_dir):
    return plan.room_dwell_on_air(
        named(spark, sf_dir, "heartbeat_month"),
        named(spark, sf_dir, "on_air"),
        named(spark, sf_dir, "activation"),
        ON_AIR_CAP,
    )


@query(
    "dwell_by_device_day",
    out(
        SOFT,
        """FROM (SELECT dt, actid, count(DISTINCT roomid) AS room_num, sum(room_time) AS room_time,
            arg_min(idfa, ord) AS idfa, arg_min(terminal, ord) AS terminal, arg_min(channelid, ord) AS channelid,
            arg_min(ipaddr, ord) AS ipaddr
            FROM (SELECT *, row_number() OVER (ORDER BY first_dateline, uid, roomid) AS ord FROM rooms)
            GROUP BY dt, actid, CASE WHEN actid = 0 THEN idfa ELSE '' END)""",
        "dt actid room_num room_time terminal ipaddr",
        "",
        "idfa channelid",
    ),
)
def dwell_by_device(spark, sf_dir):
    return plan.dwell_by_device(room_dwell_soft(spark, sf_dir))


@query(
    "dwell_by_user",
    out(
        SOFT,
        "FROM (SELECT dt, uid, count(DISTINCT roomid) AS room_num, sum(room_time) AS room_time FROM rooms GROUP BY dt, uid)",
        "dt uid room_num room_time",
    ),
)
def dwell_by_user(spark, sf_dir):
    rows = room_dwell_soft(spark, sf_dir)
    return rows.groupBy("dt", "uid").agg(
        F.countDistinct("roomid").alias("room_num"), F.sum("room_time").alias("room_time")
    )


LOBBY = ctes("request_month", "host_list") + [
    """asked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dt, macaddr, dateline ORDER BY id) AS rn
        FROM request_month WHERE action = 'serv_getnotif' AND terminal IN (3, 4)) WHERE rn = 1)""",
    """paced AS (SELECT *, lead(dateline) OVER w - dateline AS gap, lead(dateline, 2) OVER w - lead(dateline) OVER w AS next_gap,
        lead(idfa) OVER w AS idfa1, lead(idfa, 2) OVER w AS idfa2 FROM asked
        WINDOW w AS (PARTITION BY dt ORDER BY macaddr NULLS FIRST, dateline))""",
    """steady AS (SELECT * FROM paced WHERE gap BETWEEN 3600 AND 86400 AND next_gap BETWEEN 3600 AND 86400
        AND idfa = idfa1 AND idfa = idfa2)""",
]


@query("lobby_steady_requests", out(LOBBY, "FROM steady", "dt id uid dateline gap next_gap", "", "macaddr"))
def lobby_steady_requests(spark, sf_dir):
    asked = lobby.notice_requests(named(spark, sf_dir, "request_month"))
    return lobby.steady_requests(asked, 3600, 86400).select(
        "dt", "id", "uid", "dateline", "gap", "next_gap", "macaddr"
    )


@query(
    "lobby_stay",
    out(
        LOBBY,
        """FROM (SELECT s.dt, s.idfa, s.uid, s.channelid, s.terminal,
            CASE WHEN s.uid IN (SELECT uid FROM host_list) THEN 2 ELSE 0 END AS special
            FROM (SELECT *, row_number() OVER (PARTITION BY dt, idfa ORDER BY dateline, id) AS pos FROM steady) s
            WHERE pos = 1)""",
        "dt uid terminal special",
        "",
        "idfa channelid",
    ),
)
def lobby_stay(spark, sf_dir):
    return lobby.lobby_stay(
        named(spark, sf_dir, "request_month"), named(spark, sf_dir, "host_list"), 3600, 86400
    )


@query(
    "lobby_gap_marks",
    out(
        ctes("ev"),
        """FROM (SELECT k, dateline, lead(dateline) OVER w - dateline AS gap,
            CASE WHEN lead(dateline) OVER w IS NULL THEN 1 ELSE 0 END AS is_last
            FROM (SELECT DISTINCT k, dateline FROM ev) WINDOW w AS (PARTITION BY k ORDER BY dateline))
            WHERE gap IS NOT NULL OR is_last = 1""",
        "k dateline is_last",
        "",
        "",
    ).replace("SELECT CAST(k", "SELECT CAST(coalesce(gap, 0) AS BIGINT) AS gap, CAST(k"),
)
def lobby_gap_marks(spark, sf_dir):
    rows = events(spark, sf_dir).select("k", "dateline").distinct()
    gaps = mark_last(consecutive_gaps(rows, ["k"], "dateline"), ["k"], "dateline")
    return gaps.select("k", "dateline", "is_last", F.coalesce("gap", F.lit(0)).alias("gap"))


@query(
    "time_bucket_count",
    out(
        ctes("ev"),
        "FROM (SELECT dt, idfa, count(DISTINCT left(CAST(dateline AS STRING), 9)) AS heartbeat FROM ev GROUP BY dt, idfa)",
        "dt heartbeat",
        "",
        "idfa",
    ),
)
def heartbeat_buckets(spark, sf_dir):
    return time_bucket_count(events(spark, sf_dir), ["dt", "idfa"], "dateline", 10, "heartbeat")


@query(
    "session_span",
    out(
        ctes("ev"),
        """FROM (SELECT dt, idfa, max(dateline) - min(dateline) AS seconds FROM ev GROUP BY dt, idfa
            HAVING max(dateline) - min(dateline) >= 90)""",
        "dt seconds",
        "",
        "idfa",
    ),
)
def session_span(spark, sf_dir):
    return span(events(spark, sf_dir), ["dt", "idfa"], "dateline", "seconds").filter(F.col("seconds") >= 90)


@query(
    "devices_per_key",
    out(
        ctes("ev")
        + ["d AS (SELECT *, date_diff('day', DATE '1970-01-01', strptime(CAST(dt AS STRING), '%Y%m%d')) AS dn FROM ev)"],
        """FROM (SELECT x.ipaddr, x.dn, count(*) AS devices FROM (SELECT DISTINCT ipaddr, dn FROM d) x
            JOIN d ON d.ipaddr = x.ipaddr AND d.dn BETWEEN x.dn - 6 AND x.dn GROUP BY x.ipaddr, x.dn)""",
        "ipaddr dn devices",
    ),
)
def devices_per_key(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("dn", day_number(F.col("dt")))
    return rolling_count(rows, "ipaddr", "dn", 6, "devices")


@query(
    "over_frequent_devices",
    out(
        ctes("ev"),
        "FROM (SELECT idfa, event_type, count(*) AS n FROM ev GROUP BY idfa, event_type HAVING count(*) > 20)",
        "n",
        "",
        "idfa event_type",
    ),
)
def over_frequent_devices(spark, sf_dir):
    return over_frequent(events(spark, sf_dir), ["idfa", "event_type"], 20)


@query(
    "point_in_interval",
    out(
        ctes("heartbeat", "on_air"),
        """FROM (SELECT h.id, h.uid, h.roomid, h.dateline, a.start_dt FROM heartbeat h JOIN on_air a
            ON a.roomid = h.roomid AND h.dateline BETWEEN a.start_dt AND a.end_dt)""",
        "id uid roomid dateline start_dt",
    ),
)
def point_in_interval(spark, sf_dir):
    spans = named(spark, sf_dir, "on_air").select("roomid", "start_dt", "end_dt")
    beats = named(spark, sf_dir, "heartbeat").select("id", "uid", "roomid", "dateline")
    return interval_join(beats, spans, ["roomid"], "dateline", "start_dt", "end_dt").drop("end_dt")


@query(
    "asof_attribution",
    out(
        ctes("ev")
        + [
            "l AS (SELECT id, uid, dateline FROM ev WHERE event_type = 'purchase')",
            """r AS (SELECT uid, dateline, arg_min(roomid, id) AS roomid, min(id) AS seen FROM ev
                WHERE event_type = 'view' GROUP BY uid, dateline)""",
        ],
        """FROM (SELECT l.id, l.uid, coalesce(r.dateline, 0) AS matched_time, coalesce(r.roomid, 0) AS roomid,
            coalesce(r.seen, 0) AS seen FROM l ASOF LEFT JOIN r ON l.uid = r.uid AND l.dateline >= r.dateline)""",
        "id uid matched_time roomid seen",
    ),
)
def asof_attribution(spark, sf_dir):
    paid = events(spark, sf_dir, "purchase").select("id", "uid", "dateline")
    views = events(spark, sf_dir, "view").select("uid", "dateline", "roomid", F.col("id").alias("seen"))
    return nearest_join(
        paid, views, ["uid"], "dateline", "dateline", ["roomid", "seen"], ["seen"]
    ).select("id", "uid", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("matched_time", "roomid", "seen")])


@query(
    "tolerance_match",
    out(
        ctes("ev"),
        """FROM (SELECT p.id, v.dateline AS matched_time, v.id AS seen, row_number() OVER (PARTITION BY p.id
                ORDER BY abs(v.dateline - p.dateline), v.dateline, v.id) AS rn
            FROM ev p JOIN ev v ON v.uid = p.uid AND v.dt = p.dt AND abs(v.dateline - p.dateline) <= 7200
            WHERE p.event_type = 'purchase' AND v.event_type = 'view') WHERE rn = 1""",
        "id matched_time seen",
    ),
)
def tolerance_match(spark, sf_dir):
    paid = events(spark, sf_dir, "purchase").select("id", "uid", "dt", "dateline")
    views = events(spark, sf_dir, "view").select("uid", "dt", "dateline", F.col("id").alias("seen"))
    near = nearest_join(
        paid, views, ["uid", "dt"], "dateline", "dateline", ["seen"], ["seen"], "nearest", 7200, slot=None
    )
    return near.filter(F.col("seen").isNotNull()).select("id", "matched_time", "seen")


@query(
    "forward_match",
    out(
        ctes("ev"),
        """FROM (SELECT p.id, p.uid FROM ev p WHERE p.event_type = 'purchase' AND EXISTS (SELECT 1 FROM ev e
            WHERE e.event_type = 'error' AND e.uid = p.uid AND e.dateline > p.dateline
            AND e.dateline <= p.dateline + 86400))""",
        "id uid",
    ),
)
def forward_match(spark, sf_dir):
    paid = events(spark, sf_dir, "purchase").select("id", "uid", "dateline")
    errors = events(spark, sf_dir, "error").select("uid", "dateline", F.col("id").alias("seen"))
    ahead = nearest_join(
        paid, errors, ["uid"], "dateline", "dateline", ["seen"], ["seen"], "forward", 86400, strict=True
    )
    return ahead.filter(F.col("seen").isNotNull()).select("id", "uid")


@query(
    "relative_window_match",
    out(
        ctes("ev") + ["f AS (SELECT k, roomid, min(dateline) AS first FROM ev GROUP BY k, roomid)"],
        """FROM (SELECT f.k, f.roomid, f.first, count(*) AS visits, min(e.dateline) AS back FROM f
            JOIN ev e ON e.k = f.k AND e.roomid = f.roomid
            AND e.dateline BETWEEN f.first + 604800 AND f.first + 1123200 GROUP BY f.k, f.roomid, f.first)""",
        "k roomid first visits back",
    ),
)
def relative_window_match(spark, sf_dir):
    rows = events(spark, sf_dir).select("k", "roomid", "dateline")
    first = rows.groupBy("k", "roomid").agg(F.min("dateline").alias("first"))
    later = rows.withColumnRenamed("dateline", "later")
    hits = within_window_after(first, later, ["k", "roomid"], "first", "later", 7 * 86400, 13 * 86400)
    return hits.groupBy("k", "roomid", "first").agg(
        F.count(F.lit(1)).alias("visits"), F.min("later").alias("back")
    )


@query(
    "attribution_fallback",
    out(
        ctes("ev"),
        """FROM (SELECT p.id, p.uid, coalesce(near.id, last.id, 0) AS seen,
            CASE WHEN near.id IS NOT NULL THEN 1 WHEN last.id IS NOT NULL THEN 2 ELSE 0 END AS source
            FROM ev p
            LEFT JOIN (SELECT p.id AS pid, c.id, row_number() OVER (PARTITION BY p.id
                ORDER BY abs(c.dateline - p.dateline), c.dateline, c.id) AS rn FROM ev p JOIN ev c ON c.uid = p.uid
                AND c.dt = p.dt AND c.event_type = 'click' AND abs(c.dateline - p.dateline) <= 3600
                WHERE p.event_type = 'purchase') near ON near.pid = p.id AND near.rn = 1
            LEFT JOIN (SELECT p.id AS pid, v.id, row_number() OVER (PARTITION BY p.id
                ORDER BY v.dateline DESC, v.id) AS rn FROM ev p JOIN ev v ON v.uid = p.uid
                AND v.dt = p.dt AND v.event_type = 'view' AND v.dateline <= p.dateline
                WHERE p.event_type = 'purchase') last ON last.pid = p.id AND last.rn = 1
            WHERE p.event_type = 'purchase')""",
        "id uid seen source",
    ),
)
def attribution_fallback(spark, sf_dir):
    """Nearest click within the hour, else the last view of the day, both looked up in one pass."""
    keys = ["uid", "dt"]
    paid = events(spark, sf_dir, "purchase").select("id", *keys, "dateline")
    clicks, views = (
        events(spark, sf_dir, kind).select(*keys, "dateline", F.col("id").alias("seen")) for kind in ("click", "view")
    )
    found = nearest_lookup(
        paid,
        keys,
        "dateline",
        [
            Lookup("near", clicks, "dateline", ["seen"], ["seen"], "nearest", 3600),
            Lookup("last", views, "dateline", ["seen"], ["seen"]),
        ],
        slot=None,
    )
    return paid.join(found, [*keys, "dateline"], "left").select(
        "id",
        "uid",
        F.coalesce("near.seen", "last.seen", F.lit(0)).alias("seen"),
        F.when(F.col("near").isNotNull(), 1).when(F.col("last").isNotNull(), 2).otherwise(0).alias("source"),
    )


@query(
    "nth_event_per_user",
    out(
        ctes("ev")
        + [
            """n AS (SELECT k, id, dateline, row_number() OVER (PARTITION BY k ORDER BY dateline, id) AS nth FROM ev
                WHERE event_type = 'purchase')"""
        ],
        "FROM n WHERE nth <= 3",
        "k id dateline nth",
    ),
)
def nth_event_per_user(spark, sf_dir):
    paid = events(spark, sf_dir, "purchase").select("k", "id", "dateline")
    return first_k(paid, ["k"], ["dateline", "id"], 3, "nth")


def _range_sql(predicate):
    return out(ctes("ev"), f"FROM ev WHERE {predicate}", "id dt uid dateline")


def _range(spark, sf_dir, **bounds):
    return in_range(events(spark, sf_dir), **bounds).select("id", "dt", "uid", "dateline")


@query("scan_range", _range_sql("dateline BETWEEN 1704153600 AND 1704499200"))
def scan_range(spark, sf_dir):
    return _range(spark, sf_dir, seconds=(1704153600, 1704499200))


@query("scan_month", _range_sql("dt BETWEEN 20240101 AND 20240131"))
def scan_month(spark, sf_dir):
    return _range(spark, sf_dir, days=month_days(202401))


@query("scan_days", _range_sql("dt BETWEEN 20240105 AND 20240111"))
def scan_days(spark, sf_dir):
    return _range(spark, sf_dir, days=(20240105, 20240111))


@query("scan_empty_range", _range_sql("dt BETWEEN 19990101 AND 19991231"))
def scan_empty_range(spark, sf_dir):
    return _range(spark, sf_dir, days=(19990101, 19991231))
