"""The jobs' source tables, derived from the given tables.

Each stand-in is one projection written as SQL text that Spark and the checking engine
read alike; only the epoch of a timestamp differs between the two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.functions.dates import epoch, epoch_to_dt

FIRST_DAY, LAST_DAY = 20240101, 20240130
BASE = 3000006


def _text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def channel_text(k: str, n: str, s: str) -> str:
    """Channel id from a user number, a channel number and a sub-channel number.

    Every fifth user goes to android, iPhone, iPad, web and a short id; a few carry the
    excluded and the unlimited code, the long layouts, the placeholder and a blank.
    """
    ver = _text(f"750 + {k} % 20")
    code = _text(f"CASE WHEN {k} % 29 = 0 THEN 2138 WHEN {k} % 31 = 0 THEN 2163 ELSE 1000 + {n} END")
    sub = f"lpad({_text(s)}, 2, '0')"
    return f"""CASE
        WHEN {k} % 43 = 42 THEN 'EN_APP_KEY_PLACEHOLDER'
        WHEN {k} % 47 = 46 THEN '0'
        WHEN {k} % 37 = 36 THEN 's10202' || {ver} || '02130123'
        WHEN {k} % 41 = 40 THEN '10102' || {ver} || '21310045'
        WHEN {k} % 5 = 0 THEN 's10202' || {ver} || {code} || {sub}
        WHEN {k} % 5 = 1 THEN '10102' || {ver} || {code} || {sub}
        WHEN {k} % 5 = 2 THEN '10135' || {ver} || {code} || {sub}
        WHEN {k} % 5 = 3 THEN '10301' || {ver} || {code} || {sub}
        ELSE '2' || lpad({_text(n)}, 3, '0') || lpad({_text(f"{k} % 100")}, 4, '0')
    END"""


EVENT_CHANNEL = channel_text(
    "user_id",
    "(CASE WHEN user_id % 4 = 0 THEN (CASE WHEN user_id % 5 = 0 THEN 20 ELSE 1 END) ELSE user_id % 25 END)",
    "(CASE WHEN user_id % 4 = 0 THEN 0 ELSE user_id % 10 END)",
)
CUSTOMER_CHANNEL = channel_text("c_custkey", "c_nationkey", "(c_custkey % 10)")

# One row per event with the columns every log shares.
EVENT_COLS = [
    "event_id AS id",
    "user_id AS k",
    "event_type",
    "CAST(floor(value) AS BIGINT) AS amount",
    f"CASE WHEN user_id % 7 = 0 THEN {BASE} ELSE {BASE} + user_id END AS uid",
    "'d' || CAST(user_id - user_id % 2 AS STRING) AS idfa",
    "event_id % 20 AS roomid",
    """CASE WHEN user_id % 11 = 0 THEN 2 WHEN user_id % 5 = 0 THEN 2 WHEN user_id % 5 = 1 THEN 3
        WHEN user_id % 5 = 2 THEN 4 ELSE 1 END AS terminal""",
    f"{EVENT_CHANNEL} AS channelid",
    "user_id % 97 AS ipaddr",
]
ORDER_COLS = [
    "o_orderkey AS id",
    "o_custkey AS k",
    f"{BASE} + o_custkey AS uid",
    "CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority",
    "CAST(o_totalprice AS DECIMAL(18,2)) AS money",
    "o_orderstatus AS status",
]
LINE_COLS = [
    "l_orderkey AS orderkey",
    "l_partkey AS partkey",
    "l_suppkey AS suppkey",
    "l_linenumber AS line",
    "CAST(l_quantity AS BIGINT) AS quantity",
    "CAST(floor(l_extendedprice) AS BIGINT) AS amount",
    "CAST(l_extendedprice AS DECIMAL(18,2)) AS money",
]
CUSTOMER_COLS = [
    "c_custkey AS k",
    f"{BASE} + c_custkey AS uid",
    "c_nationkey AS nation",
    f"{CUSTOMER_CHANNEL} AS channelid",
    "c_custkey % 97 AS ip",
    "c_custkey % 1201 AS device",
]


def _log_sql(name: str, table: str, ts: str, cols: list[str]) -> str:
    return (
        f"{name} AS (SELECT {', '.join(cols)}, CAST(floor(epoch({ts})) AS BIGINT) AS dateline, "
        f"CAST(strftime({ts}, '%Y%m%d') AS INTEGER) AS dt FROM {table})"
    )


EV = _log_sql("ev", "events", "ts", EVENT_COLS)
OD = _log_sql("od", "orders", "o_orderdate", ORDER_COLS)
LN = _log_sql("ln", "lineitem", "l_shipdate", LINE_COLS)
CU = f"cu AS (SELECT {', '.join(CUSTOMER_COLS)} FROM customer)"


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
        props string""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _log(spark: SparkSession, sf_dir: str, name: str, ts: str, cols: list[str]) -> DataFrame:
    rows = table(spark, sf_dir, name).withColumn("dateline", epoch(F.col(ts)))
    return rows.selectExpr(*cols, "dateline").withColumn("dt", epoch_to_dt(F.col("dateline")))


def events(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    rows = _log(spark, sf_dir, "events", "ts", EVENT_COLS)
    return rows.filter(F.col("event_type").isin(*kinds)) if kinds else rows


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir, "orders", "o_orderdate", ORDER_COLS)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir, "lineitem", "l_shipdate", LINE_COLS)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*CUSTOMER_COLS)


# Named stand-ins: (source log, filter, projection). Both engines read the same text.
NAMED = {
    "heartbeat": ("ev", "TRUE", "id, uid, idfa, roomid, terminal, dateline, channelid, ipaddr, dt"),
    # The same beats reported by month, so that a person has several beats per room and period.
    "heartbeat_month": (
        "ev",
        "TRUE",
        "id, uid, idfa, roomid, terminal, dateline, channelid, ipaddr, dt - dt % 100 + 1 AS dt",
    ),
    "on_air": (
        "ev",
        "event_type = 'signup'",
        "roomid, dateline AS start_dt, dateline + 21600 AS end_dt, 21600 AS total, dateline + 21600 AS dateline, dt",
    ),
    "recharge": (
        "ev",
        "event_type = 'purchase'",
        """id, dt, uid, dateline, amount AS money, CASE WHEN id % 7 = 0 THEN 10 ELSE 30 END AS rechange_status,
        CASE id % 12 WHEN 0 THEN 3 WHEN 1 THEN 4 WHEN 2 THEN 5 WHEN 3 THEN 6 WHEN 4 THEN 8 WHEN 5 THEN 9
            WHEN 6 THEN 10 WHEN 7 THEN 11 WHEN 8 THEN 21 WHEN 9 THEN 22 WHEN 10 THEN 23 ELSE 24 END
            AS rechange_channel,
        id % 5 AS product_id, 'o' || CAST(id - id % 5 AS STRING) AS orderid""",
    ),
    "pay_req": (
        "ev",
        "event_type = 'click' OR (event_type = 'purchase' AND id % 3 = 0)",
        """id, dt, uid, dateline, idfa, CASE WHEN k % 3 = 0 THEN 0 ELSE k + 1 END AS actid, ipaddr, channelid,
        CASE WHEN id % 2 = 0 THEN 0 ELSE terminal END AS chantype, 750 + k % 20 AS chanver,
        CASE WHEN k % 29 = 0 THEN 2138 ELSE 1000 + k % 25 END AS chancode, terminal, 750 + k % 20 AS appver""",
    ),
    "online_log": (
        "ev",
        "event_type = 'view'",
        """id, dt, uid, dateline, idfa, CASE WHEN k % 4 = 0 THEN 0 ELSE k + 1 END AS actid, ipaddr, channelid,
        terminal AS chantype, 750 + k % 20 AS chanver, 1000 + k % 25 AS chancode, terminal, 750 + k % 20 AS appver""",
    ),
    "ledger": (
        "ev",
        "(event_type = 'purchase' AND id % 2 = 0) OR event_type = 'error'",
        """id, dt, uid, dateline,
        CASE WHEN event_type = 'error' THEN -1 ELSE 1 END * (id % 3 + 1) * 1050 AS money,
        CASE WHEN k % 5 = 4 THEN 100 WHEN k % 2 = 0 THEN 147 ELSE 149 END AS productid,
        CASE WHEN k % 6 = 0 THEN 'ywdl' ELSE 'x' END AS salesperson""",
    ),
    "register_list": ("cu", "k % 11 = 0", "uid, CASE WHEN k % 22 = 0 THEN 1 ELSE 0 END AS special"),
    "internal_list": ("cu", "k % 13 = 0", "uid"),
    "farmer_list": ("cu", "k % 17 = 0", "uid"),
    "host_list": ("cu", "k % 19 = 0", "uid"),
    "activation": ("cu", "k % 2 = 0 AND k % 3 <> 0", "k + 1 AS id, 'd' || CAST(k AS STRING) AS idfa"),
    "spend_log": (
        "ev",
        "event_type IN ('purchase', 'click')",
        """id, dt, uid, dateline, CASE WHEN id % 9 = 0 THEN 0 ELSE amount END AS consume_coin,
        10 + id % 5 AS consume_type, id % 3 AS consume_type_son""",
    ),
    "request_log": (
        "ev",
        "TRUE",
        """id, dt, uid, dateline, CASE WHEN k % 53 = 0 THEN '' ELSE idfa END AS macaddr, idfa, channelid, terminal,
        CASE event_type WHEN 'signup' THEN 'serv_loginqq' WHEN 'purchase' THEN 'serv_loginweixin'
            WHEN 'error' THEN 'serv_other' ELSE 'serv_getnotif' END AS action, id % 3 AS idfv""",
    ),
    "request_month": (
        "ev",
        "TRUE",
        """id, dt - dt % 100 + 1 AS dt, uid, dateline,
        CASE WHEN k % 3 = 0 THEN concat(idfa, '-', CAST(id % 2 AS STRING))
            WHEN k % 7 = 1 THEN concat('shared-', CAST(k % 9 AS STRING)) ELSE idfa END AS macaddr,
        CASE WHEN k % 11 = 2 THEN NULL ELSE idfa END AS idfa, channelid, terminal,
        CASE event_type WHEN 'signup' THEN 'serv_loginqq' WHEN 'purchase' THEN 'serv_loginweixin'
            WHEN 'error' THEN 'serv_other' ELSE 'serv_getnotif' END AS action""",
    ),
    "online": (
        "ev",
        "event_type IN ('view', 'click', 'error')",
        "id, dt, uid, dateline, idfa, channelid AS channel_id, terminal AS device_type",
    ),
    "signup_log": (
        "ev",
        "event_type = 'signup'",
        """id, dt, uid, dateline, idfa, ipaddr, channelid AS channel_id, terminal AS device_type,
        id % 2 AS qqstatus""",
    ),
    "dwell_log": ("ev", "TRUE", "uid, roomid, dateline, amount * 4 AS longs, dt"),
    "slot_log": ("ev", "event_type = 'error'", "roomid, 1 + (id - id % 20) % 15 AS cal_rank, dt"),
    "normal_log": ("ev", "event_type = 'view'", "(id - id % 20) % 11 AS roomid, dateline"),
    "fine_log": ("ev", "event_type = 'click'", "(id - id % 20) % 7 AS roomid, dateline"),
}

_LOGS = {"ev": (events, EV), "od": (orders, OD), "ln": (lines, LN), "cu": (customers, CU)}


def named(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the stand-ins in :data:`NAMED`."""
    log, cond, cols = NAMED[name]
    rows = _LOGS[log][0](spark, sf_dir)
    view = rows.filter(cond) if cond != "TRUE" else rows
    return view.selectExpr(*split_columns(cols))


def split_columns(cols: str) -> list[str]:
    """Split a projection at commas outside parentheses."""
    parts, depth, current = [], 0, ""
    for ch in cols:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += ch
    return [p.strip() for p in [*parts, current]]


def ctes(*names: str) -> list[str]:
    """Named parts of a checking statement: the logs needed, then the stand-ins."""
    logs = dict.fromkeys(NAMED[n][0] for n in names if n in NAMED)
    parts = [_LOGS[n][1] for n in names if n in _LOGS]
    parts += [_LOGS[n][1] for n in logs if n not in names]
    return parts + [
        f"{n} AS (SELECT {NAMED[n][2]} FROM {NAMED[n][0]} WHERE {NAMED[n][1]})" for n in names if n in NAMED
    ]
