"""Write modes and set operations as old frame in, new frame out."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightledger.functions.dates import dt_to_epoch, epoch_to_dt, shift_dt
from nightledger.functions.numeric import percent, ratio
from nightledger.operators.aggs import distinct_if, with_total_row
from nightledger.operators.joins import enrich
from nightledger.operators.merge import assemble, drop_rows, merge_ignore, merge_replace, roll, undo_day
from nightledger.queries.registry import out, query
from nightledger.queries.standins import ctes, customers, events, lines, orders, table

OLD = "old AS (SELECT uid, count(*) AS n, sum(money) AS money, min(dt) AS first FROM od WHERE dt < 19980101 GROUP BY uid)"
NEW = "new AS (SELECT uid, count(*) AS n, sum(money) AS money, min(dt) AS first FROM od WHERE dt >= 19980101 GROUP BY uid)"


def _old_new(spark, sf_dir):
    rows = orders(spark, sf_dir)
    parts = (rows.filter(F.col("dt") < 19980101), rows.filter(F.col("dt") >= 19980101))
    return [
        p.groupBy("uid").agg(
            F.count(F.lit(1)).alias("n"), F.sum("money").alias("money"), F.min("dt").alias("first")
        )
        for p in parts
    ]


@query(
    "merge_replace",
    out(
        ctes("od") + [OLD, NEW],
        """FROM (SELECT coalesce(n.uid, o.uid) AS uid, coalesce(n.n, o.n) AS n, coalesce(n.money, o.money) AS money,
            coalesce(o.first, n.first) AS first FROM old o FULL JOIN new n ON n.uid = o.uid)""",
        "uid n first",
        "money",
    ),
)
def replace_on_match(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return merge_replace(old, new, ["uid"], ["n", "money"])


@query(
    "merge_ignore",
    out(
        ctes("od") + [OLD, NEW],
        "FROM (SELECT * FROM old UNION ALL SELECT * FROM new WHERE uid NOT IN (SELECT uid FROM old))",
        "uid n first",
        "money",
    ),
)
def insert_if_absent(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return merge_ignore(old, new, ["uid"])


@query(
    "roll_31d",
    out(
        ctes("ev"),
        "FROM (SELECT id, uid, dateline FROM ev WHERE dateline >= 1706400000 - 20 * 86400)",
        "id uid dateline",
    ),
)
def roll_days(spark, sf_dir):
    """Keep the 20 days before 2024-01-28 and add that day and later."""
    rows = events(spark, sf_dir).select("id", "uid", "dateline")
    day = 1706400000
    return roll(rows.filter(F.col("dateline") < day), rows, day, 20)


@query(
    "undo_day",
    out(
        ctes("od"),
        """FROM (SELECT uid, CASE WHEN dt2 = 20010730 THEN 0 ELSE dt2 END AS dt2,
            CASE WHEN dt2 = 20010730 THEN 0 ELSE id2 END AS id2 FROM (SELECT uid, max(dt) AS dt2, max(id) AS id2
            FROM od GROUP BY uid))""",
        "uid dt2 id2",
    ),
)
def undo_last_day(spark, sf_dir):
    last = orders(spark, sf_dir).groupBy("uid").agg(F.max("dt").alias("dt2"), F.max("id").alias("id2"))
    return undo_day(last, 20010730, "dt2", ["id2"]).select("uid", "dt2", "id2")


@query(
    "drop_rows",
    out(
        ctes("ln"),
        """FROM (SELECT suppkey, line, sum(CASE WHEN partkey % 3 = 0 THEN quantity ELSE 0 END) AS quantity FROM ln
            GROUP BY suppkey, line HAVING sum(CASE WHEN partkey % 3 = 0 THEN quantity ELSE 0 END) <> 0)""",
        "suppkey line quantity",
    ),
)
def drop_zero_rows(spark, sf_dir):
    sums = lines(spark, sf_dir).groupBy("suppkey", "line").agg(
        F.sum(F.when(F.col("partkey") % 3 == 0, F.col("quantity")).otherwise(0)).alias("quantity")
    )
    return drop_rows(sums, F.col("quantity") == 0)


@query(
    "assemble_wide_row",
    out(
        ctes("ev"),
        """FROM (SELECT uid, count(CASE WHEN event_type = 'view' THEN 1 END) AS views,
            coalesce(sum(CASE WHEN event_type = 'purchase' THEN amount END), 0) AS paid,
            coalesce(max(CASE WHEN event_type = 'error' THEN dateline END), 0) AS last_error
            FROM ev WHERE event_type IN ('view', 'purchase', 'error') GROUP BY uid)""",
        "uid views paid last_error",
    ),
)
def assemble_wide_row(spark, sf_dir):
    def of(kind):
        return events(spark, sf_dir, kind).groupBy("uid")

    return assemble(
        [
            of("view").agg(F.count(F.lit(1)).alias("views")),
            of("purchase").agg(F.sum("amount").alias("paid")),
            of("error").agg(F.max("dateline").alias("last_error")),
        ],
        ["uid"],
    )


@query(
    "enrich_update_join",
    out(
        ctes("od", "cu"),
        """FROM (SELECT c.k, c.uid, CASE WHEN o.uid IS NULL THEN '0' ELSE 'x' END || c.channelid AS tag,
            coalesce(o.id, c.device) AS device FROM cu c LEFT JOIN (SELECT uid, arg_min(id, dateline * 10000000 + id) AS id
            FROM od WHERE priority = 1 GROUP BY uid) o ON o.uid = c.uid)""",
        "k uid device",
        "",
        "tag",
    ),
)
def enrich_update_join(spark, sf_dir):
    """First urgent order of each customer written over the device column."""
    urgent = orders(spark, sf_dir).filter(F.col("priority") == 1)
    urgent = urgent.select("uid", "dateline", "id", F.col("id").alias("device"), F.lit("x").alias("mark"))
    base = customers(spark, sf_dir).withColumn("mark", F.lit("0"))
    done = enrich(base, urgent, ["uid"], ["device", "mark"], ["dateline", "id"])
    return done.select("k", "uid", "device", F.concat("mark", "channelid").alias("tag"))


@query(
    "day_over_day",
    out(
        ctes("od") + ["d AS (SELECT dt, priority, count(*) AS n, sum(money) AS money FROM od GROUP BY dt, priority)"],
        """FROM (SELECT a.dt, a.priority, a.n, coalesce(CAST((2 * a.n * 10000 + b.n) // (2 * b.n) AS DOUBLE) / 100, 0)
            AS change FROM d a LEFT JOIN d b ON b.priority = a.priority
            AND b.dt = CAST(strftime(strptime(CAST(a.dt AS STRING), '%Y%m%d') - INTERVAL 1 DAY, '%Y%m%d') AS INTEGER))""",
        "dt priority n",
        "change",
    ),
)
def day_over_day(spark, sf_dir):
    days = orders(spark, sf_dir).groupBy("dt", "priority").agg(F.count(F.lit(1)).alias("n"))
    before = days.select(shift_dt(F.col("dt"), 1).alias("dt"), "priority", F.col("n").alias("before"))
    joined = days.join(before, ["dt", "priority"], "left")
    return joined.select("dt", "priority", "n", percent(F.col("n"), F.col("before")).alias("change"))


@query(
    "distinct_if",
    out(
        ctes("ln"),
        """FROM (SELECT suppkey, count(DISTINCT orderkey) AS orders,
            count(DISTINCT CASE WHEN quantity >= 25 THEN orderkey END) AS large,
            count(DISTINCT CASE WHEN line = 1 THEN orderkey END) AS first_lines FROM ln GROUP BY suppkey)""",
        "suppkey orders large first_lines",
    ),
)
def conditional_distinct(spark, sf_dir):
    conds = {"orders": F.lit(True), "large": F.col("quantity") >= 25, "first_lines": F.col("line") == 1}
    return distinct_if(lines(spark, sf_dir), ["suppkey"], "orderkey", conds)


@query(
    "total_row",
    out(
        ctes("od") + ["y AS (SELECT dt // 10000 AS year, priority, count(*) AS n, sum(money) AS money FROM od GROUP BY ALL)"],
        """FROM (SELECT * FROM (SELECT year, priority, n, money FROM y UNION ALL
            SELECT year, 100, sum(n), sum(money) FROM y GROUP BY year))""",
        "year priority n",
        "money",
    ),
)
def total_row(spark, sf_dir):
    years = (
        orders(spark, sf_dir)
        .groupBy(F.floor(F.col("dt") / 10000).alias("year"), "priority")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("money").alias("money"))
    )
    return with_total_row(years, ["year"], {"priority": F.lit(100)}, ["n", "money"])


@query(
    "guarded_ratio",
    out(
        ctes("ln") + ["s AS (SELECT suppkey, line, sum(money) AS money, count(CASE WHEN quantity > 40 THEN 1 END) AS n FROM ln GROUP BY ALL)"],
        """FROM (SELECT suppkey, line, CASE WHEN n = 0 THEN 0 ELSE
            CAST((2 * CAST(money * 100 AS BIGINT) + n) // (2 * n) AS DOUBLE) / 100 END AS per_order FROM s)""",
        "suppkey line",
        "per_order",
    ),
)
def guarded_ratio(spark, sf_dir):
    sums = lines(spark, sf_dir).groupBy("suppkey", "line").agg(
        F.sum("money").alias("money"), F.count(F.when(F.col("quantity") > 40, 1)).alias("n")
    )
    return sums.select("suppkey", "line", ratio(F.col("money"), F.col("n")).alias("per_order"))


@query(
    "date_parts",
    out(
        ctes("ev"),
        """FROM (SELECT id, dt, CAST(epoch(strptime(CAST(dt AS STRING), '%Y%m%d')) AS BIGINT) AS day_start,
            CAST(strftime(make_timestamp(dateline * 1000000) + INTERVAL 1 DAY, '%Y%m%d') AS INTEGER) AS next_dt FROM ev)""",
        "id dt day_start next_dt",
    ),
)
def date_parts(spark, sf_dir):
    return events(spark, sf_dir).select(
        "id",
        "dt",
        dt_to_epoch(F.col("dt")).alias("day_start"),
        epoch_to_dt(F.col("dateline") + 86400).alias("next_dt"),
    )


@query(
    "nation_totals",
    """SELECT r_name, n_name, CAST(count(*) AS BIGINT) AS users, CAST(sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END)
        AS BIGINT) AS in_credit FROM customer JOIN nation ON n_nationkey = c_nationkey
        JOIN region ON r_regionkey = n_regionkey GROUP BY r_name, n_name""",
)
def nation_totals(spark, sf_dir):
    users = (
        table(spark, sf_dir, "customer")
        .groupBy(F.col("c_nationkey").alias("n_nationkey"))
        .agg(
            F.count(F.lit(1)).alias("users"),
            F.sum(F.when(F.col("c_acctbal") > 0, 1).otherwise(0)).alias("in_credit"),
        )
    )
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return (
        users.join(nation, "n_nationkey").join(region, "n_regionkey").select("r_name", "n_name", "users", "in_credit")
    )
