"""Channel ids: parsing, cleaning, classes, patterns and caller-supplied filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightledger.functions import channel as ch
from nightledger.functions.filters import EXCLUDE, CohortFilter
from nightledger.functions.text import ip_number
from nightledger.operators.joins import best_pattern, pattern_join
from nightledger.plans.retention import cohort
from nightledger.queries.registry import out, query
from nightledger.queries.standins import ctes, customers, named, table

# Fixed stand-in rows per nation: LIKE patterns with grade and discount.
PATTERN_COLS = [
    "n_nationkey + 1 AS id",
    """CASE n_nationkey % 4 WHEN 0 THEN 's10202' || CAST(750 + n_nationkey % 20 AS STRING) || '%'
        WHEN 1 THEN '%' || CAST(1000 + n_nationkey AS STRING) || '__'
        WHEN 2 THEN '10102%' ELSE '%' || CAST(1000 + n_nationkey AS STRING) || '%' END AS pattern""",
    "1 + n_nationkey % 3 AS grade",
    "CAST(0.40 + n_nationkey * 0.02 AS DECIMAL(10,2)) AS discount",
]
PAT = f"pat AS (SELECT {', '.join(PATTERN_COLS)} FROM nation)"


def patterns(spark, sf_dir):
    return table(spark, sf_dir, "nation").selectExpr(*PATTERN_COLS)


def _layouts(parts: list[str]) -> str:
    tests = [
        "left(c, 1) IN ('2', '6') AND length(c) = 8",
        "c LIKE '10301%' AND length(c) = 14",
        "c LIKE 's10202%' AND length(c) = 17 AND substr(c, 11, 4) = '2130'",
        "c LIKE 's10202%' AND length(c) = 15",
        "c LIKE '10102%' AND length(c) = 14",
        "c LIKE '10102%' AND length(c) = 16 AND substr(c, 9, 4) = '2131'",
        "c LIKE '10135%' AND length(c) = 14",
    ]
    return "CASE " + " ".join(f"WHEN {t} THEN CAST({p} AS INTEGER)" for t, p in zip(tests, parts)) + " ELSE 0 END"


PARSED = [
    f"""parsed AS (SELECT *, {_layouts(['1', '1', '2', '2', '3', '3', '4'])} AS channel_type,
        {_layouts(['0', 'substr(c, 6, 3)', 'substr(c, 7, 3)', 'substr(c, 7, 3)', 'substr(c, 6, 3)', 'substr(c, 6, 3)', 'substr(c, 6, 3)'])} AS channel_version,
        {_layouts(['left(c, 4)', 'substr(c, 9, 4)', '2130', 'substr(c, 10, 4)', 'substr(c, 9, 4)', '2131', 'substr(c, 9, 4)'])} AS channel_code,
        {_layouts(['right(c, 4)', 'right(c, 2)', 'right(c, 4)', 'right(c, 2)', 'right(c, 2)', 'right(c, 4)', 'right(c, 2)'])} AS channel_subcode
        FROM (SELECT *, channelid AS c FROM cu))"""
]


@query(
    "channel_parse",
    out(
        ctes("cu") + PARSED,
        "FROM parsed",
        "k channel_type channel_version channel_code channel_subcode",
        "",
        "channelid",
    ),
)
def channel_parse(spark, sf_dir):
    return customers(spark, sf_dir).select("k", "channelid", ch.parse_channel(F.col("channelid")).alias("p")).select(
        "k", "channelid", "p.*"
    )


NORMAL = """CASE WHEN left(c, 1) = 's' AND substr(c, 11, 4) = '2130' THEN left(c, 17) WHEN left(c, 1) = 's' THEN left(c, 15)
    WHEN left(c, 1) IN ('2', '6') THEN left(c, 8) WHEN left(c, 5) IN ('10102', '10135', '10301') THEN left(c, 14)
    ELSE '0' END"""


@query(
    "channel_normalise",
    out(
        ctes("cu") + ["w AS (SELECT *, channelid || '_x' AS c FROM cu)"],
        f"FROM (SELECT k, channelid, {NORMAL} AS channel_id FROM w)",
        "k",
        "",
        "channelid channel_id",
    ),
)
def channel_normalise(spark, sf_dir):
    long = F.concat("channelid", F.lit("_x"))
    return customers(spark, sf_dir).select("k", "channelid", ch.normalise_channel(long).alias("channel_id"))


@query(
    "channel_classes",
    out(
        ctes("cu") + ["w AS (SELECT *, channelid AS c, 1 + k % 4 AS dev FROM cu)"],
        """FROM (SELECT k,
            CASE WHEN c NOT IN ('0', 'EN_APP_KEY_PLACEHOLDER') AND length(c) BETWEEN 8 AND 17 AND c NOT LIKE '%.%'
                AND c NOT LIKE '%!_%' ESCAPE '!' AND c NOT LIKE '%!%%' ESCAPE '!' THEN 1 ELSE 0 END AS valid,
            CASE WHEN c IN ('0', '', 'yibao', 'EN_APP_KEY_PLACEHOLDER') OR right(c, 6) LIKE '2138%' THEN 1 ELSE 0 END AS junk,
            CASE WHEN c LIKE 's%' AND right(c, 6) = '102000' THEN 1 WHEN c LIKE '10102%' AND right(c, 6) = '100100' THEN 2
                WHEN c LIKE '10135%' AND right(c, 6) = '100100' THEN 3 ELSE 4 END AS standard,
            CASE WHEN c LIKE 's%' THEN 1 WHEN c LIKE '10102%' THEN 2 WHEN c LIKE '10135%' THEN 3 ELSE 4 END AS product,
            CASE WHEN c LIKE '10301%' THEN 1 WHEN c LIKE 's%' THEN 2 WHEN c LIKE '10102%' THEN 3 ELSE 4 END AS platform,
            CASE WHEN (c LIKE 's%') <> (dev = 2) OR (c LIKE '10102%') <> (dev = 3) THEN 1 ELSE 0 END AS mismatch,
            CASE WHEN length(c) = 8 THEN left(c, 4) ELSE left(right(c, 6), 4) END AS parent,
            CASE WHEN length(c) = 8 THEN c ELSE right(c, 6) END AS child,
            CASE WHEN c LIKE 's%' THEN CASE WHEN length(c) >= 9 AND coalesce(TRY_CAST(substr(c, length(c) - 8, 3) AS INT) >= 753, FALSE)
                THEN 1 ELSE 0 END ELSE 1 END AS current_version,
            CASE WHEN c LIKE 's%' AND coalesce(TRY_CAST(substr(c, 7, 3) AS INT) < 763, FALSE) THEN 1 ELSE 0 END AS unpaid_version
            FROM w)""",
        "k valid junk standard product platform mismatch current_version unpaid_version",
        "",
        "parent child",
    ),
)
def channel_classes(spark, sf_dir):
    c = F.col("channelid")
    return customers(spark, sf_dir).select(
        "k",
        ch.valid_channel(c).alias("valid"),
        ch.junk_channel(c).alias("junk"),
        ch.standard_class(c).alias("standard"),
        ch.product_class(c).alias("product"),
        ch.price_platform(c).alias("platform"),
        ch.device_mismatch(c, F.lit(1) + F.col("k") % 4).alias("mismatch"),
        ch.version_gate(c).alias("current_version"),
        ch.below_settled_version(c).alias("unpaid_version"),
        ch.parent_code(c).alias("parent"),
        ch.sub_code(c).alias("child"),
    )


@query(
    "channel_valid",
    out(
        ctes("cu"),
        """FROM (SELECT channelid, count(*) AS users FROM cu WHERE channelid NOT IN ('0', 'EN_APP_KEY_PLACEHOLDER')
            AND length(channelid) BETWEEN 8 AND 17 AND NOT contains(channelid, '.') AND NOT contains(channelid, '_')
            AND NOT contains(channelid, '%') GROUP BY channelid)""",
        "users",
        "",
        "channelid",
    ),
)
def channel_valid(spark, sf_dir):
    rows = customers(spark, sf_dir).filter(ch.valid_channel(F.col("channelid")))
    return rows.groupBy("channelid").agg(F.count(F.lit(1)).alias("users"))


@query(
    "ip_numbers",
    out(
        ctes("cu"),
        """FROM (SELECT k, CASE WHEN k % 11 = 0 THEN 0 ELSE (10 * 256 + k % 250) * 65536 + (k % 7) * 256 + k % 97 END AS ip
            FROM cu)""",
        "k ip",
    ),
)
def ip_numbers(spark, sf_dir):
    k = F.col("k")
    dots = F.concat_ws(".", F.lit("10"), (k % 250).cast("string"), (k % 7).cast("string"), (k % 97).cast("string"))
    text = F.when(k % 11 == 0, "10.1").when(k % 3 == 0, F.concat(F.lit("1.2.3.4, "), dots)).otherwise(dots)
    return customers(spark, sf_dir).select("k", F.coalesce(ip_number(text), F.lit(0)).alias("ip"))


@query(
    "pattern_join",
    out(
        ctes("cu") + [PAT],
        "FROM (SELECT cu.k, pat.id, pat.grade, cu.channelid, pat.pattern FROM cu JOIN pat ON cu.channelid LIKE pat.pattern)",
        "k id grade",
        "",
        "channelid pattern",
    ),
)
def pattern_pairs(spark, sf_dir):
    pairs = pattern_join(customers(spark, sf_dir), patterns(spark, sf_dir), "channelid", "pattern")
    return pairs.select("k", "id", "grade", "channelid", "pattern")


@query(
    "pattern_best_discount",
    out(
        ctes("cu") + [PAT],
        """FROM (SELECT cu.channelid, pat.id, pat.discount, row_number() OVER (PARTITION BY cu.channelid
            ORDER BY pat.grade DESC, length(pat.pattern) DESC, pat.id) AS rn
            FROM (SELECT DISTINCT channelid FROM cu) cu JOIN pat ON cu.channelid LIKE pat.pattern) WHERE rn = 1""",
        "id",
        "discount",
        "channelid",
    ),
)
def pattern_best_discount(spark, sf_dir):
    return best_pattern(
        customers(spark, sf_dir),
        patterns(spark, sf_dir),
        "channelid",
        "pattern",
        ["id", "discount"],
        F.col("grade"),
        "id",
    )


PRICE_COLS = [
    "CAST(1000 + n_nationkey AS STRING) || '00' AS code",
    "1 + n_nationkey % 4 AS channel_platform",
    "CAST(2 + n_nationkey % 3 AS DECIMAL(10,2)) AS start_price",
    "1 + n_nationkey % 4 AS statis_type",
]
PRICES = f"prices AS (SELECT {', '.join(PRICE_COLS)} FROM nation)"


def prices(spark, sf_dir):
    return table(spark, sf_dir, "nation").selectExpr(*PRICE_COLS)


FILTER = CohortFilter(
    device=2, statis_type=1, parents=("1003", "1005"), parent_mode=EXCLUDE, children=("100101",), child_mode=EXCLUDE
)


@query(
    "dynamic_filters",
    out(
        ctes("online")
        + [
            PRICES,
            """w AS (SELECT *, CASE WHEN length(channel_id) = 8 THEN left(channel_id, 4) ELSE left(right(channel_id, 6), 4) END
                AS parent, CASE WHEN length(channel_id) = 8 THEN channel_id ELSE right(channel_id, 6) END AS child FROM online)""",
            """kept AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY dateline, channel_id, device_type, idfa) AS rn
                FROM w WHERE uid <> 3000006 AND channel_id LIKE 's%' AND right(channel_id, 6) NOT LIKE '2138%'
                AND parent NOT IN ('1003', '1005') AND child NOT IN ('100101'))""",
        ],
        "FROM kept WHERE rn = 1 AND parent NOT IN (SELECT left(code, 4) FROM prices WHERE statis_type <> 1)",
        "uid dateline device_type",
        "",
        "idfa channel_id",
    ),
)
def dynamic_filters(spark, sf_dir):
    users = cohort(named(spark, sf_dir, "online"), prices(spark, sf_dir), 20240101, 20240131, FILTER)
    return users.select("uid", "dateline", "device_type", "idfa", "channel_id")
