"""Stored tables: pruned scans, write modes, reruns, and days one by one against days at once."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from nightledger.functions import codes
from nightledger.functions.codes import SIGNUP_MIN_UID
from nightledger.functions.filters import CohortFilter
from nightledger.plans import channel_quality, dwell, first_pay_report, income, lobby, nightly, retention, returning, signup, spend
from nightledger.queries import quality as quality_queries
from nightledger.queries import spend as spend_queries
from nightledger.queries.standins import named
from nightledger.sources import runs
from nightledger.sources import schemas as S
from nightledger.sources.scan import read_table, scan, scan_month, scan_year, snapshot_before, stored_days
from nightledger.sources.sinks import append_day, overwrite_day, overwrite_days
from nightledger.sources.state import State, sums

DAYS = (20240101, 20240102, 20240103)


def as_schema(df, schema):
    """Columns and types of a stored table, with its day."""
    wanted = df.sparkSession.createDataFrame([], f"{schema}, dt int").schema
    return df.select(*[F.col(f.name).cast(f.dataType) for f in wanted.fields])


def test_scans_prune_and_miss_nothing(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    data = [(d * 86400 + 5, dt) for d, dt in ((16801, 20160101), (16831, 20160131), (16832, 20160201), (17167, 20170101))]
    spark.createDataFrame(data, "dateline bigint, dt int").write.partitionBy("dt").parquet(path)
    schema = "dateline bigint"
    assert len(rows(scan(spark, path, schema, days=(20160131, 20160201)))) == 2
    assert len(rows(scan_month(spark, path, schema, 201601))) == 2
    assert len(rows(scan_year(spark, path, schema, 2016))) == 3
    assert len(rows(scan(spark, path, schema, days=(20160105, 20160106)))) == 0
    close = scan(spark, path, schema, seconds=(16831 * 86400 + 5, 16832 * 86400 + 4))
    assert rows(close, "dt") == [(20160131,)]
    plan = close._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "20160131" in filters and "20160201" in filters
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(dateline" in plan


def test_a_table_nobody_wrote_is_empty(spark, tmp_path):
    assert read_table(spark, str(tmp_path / "none"), "uid bigint").count() == 0
    assert snapshot_before(spark, str(tmp_path / "none"), "uid bigint", 20160101).count() == 0


def test_write_modes(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    one, two = (spark.createDataFrame([(i,)], "v int") for i in (1, 2))
    append_day(one, path, 20160101)
    append_day(two, path, 20160101)
    append_day(one, path, 20160102, created=99)
    table = lambda: rows(scan(spark, path, "v int"))
    assert table() == [(1, 20160101), (1, 20160102), (2, 20160101)]
    overwrite_day(two, path, 20160101)
    assert table() == [(1, 20160102), (2, 20160101)]
    # An empty rerun clears the day and only that day.
    overwrite_day(one.filter("v > 5"), path, 20160101)
    assert table() == [(1, 20160102)]
    both = spark.createDataFrame([(7, 20160102), (8, 20160103)], "v int, dt int")
    overwrite_days(both, path)
    assert table() == [(7, 20160102), (8, 20160103)]
    assert rows(snapshot_before(spark, path, "v int", 20160103)) == [(7,)]


def test_a_failed_run_leaves_the_day(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one, two = (spark.createDataFrame([(i,)], "v int") for i in (1, 2))
    runs.replace_day(one, path, 20160101)
    runs.replace_day(one, path, 20160102)
    day = lambda: rows(scan(spark, path, "v int"))
    # Killed while the rows are written.
    with pytest.raises(Exception, match="lost"):
        runs.replace_day(two.withColumn("v", F.raise_error(F.lit("lost")).cast("int")), path, 20160102)
    assert day() == [(1, 20160101), (1, 20160102)]
    # Killed between the rows and the commit.
    with monkeypatch.context() as patch:
        patch.setattr(runs, "commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            runs.replace_day(two, path, 20160102)
    assert day() == [(1, 20160101), (1, 20160102)]
    assert rows(snapshot_before(spark, path, "v int", 20160103)) == [(1,)]
    reader = scan(spark, path, "v int", days=(20160102, 20160102))
    runs.replace_day(two, path, 20160102)
    assert rows(reader) == [(1, 20160102)]  # a reader that has started keeps its run
    assert day() == [(1, 20160101), (2, 20160102)]
    runs.replace_day(two.filter("v > 5"), path, 20160101)
    assert day() == [(2, 20160102)] and stored_days(spark, path) == [20160101, 20160102]
    assert runs.superseded(spark, path).count() == 2
    plan = scan(spark, path, "v int", days=(20160102, 20160102))._jdf.queryExecution().executedPlan().toString()
    assert "run" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_state_days_in_any_order_equal_a_recomputation(spark, rows, tmp_path):
    rng = random.Random(11)
    days = [20160101 + d for d in range(9)]
    table = State(spark, str(tmp_path / "s"), spark.createDataFrame([], "k int, n bigint, tag string, first_dt int").schema,
                  lambda df: sums(df, ["k"], {"tag": "first_dt"}), every=3)
    assert table.at(days[-1]).count() == 0
    truth = {}
    order = [*days[:7], days[2], days[8], days[7], days[0], days[5]]
    for step, dt in enumerate(order):
        data = [(k, rng.randrange(100), f"{step}-{k}", dt) for k in rng.sample(range(6), 3)]
        truth[dt] = data
        table.write(spark.createDataFrame(data, "k int, n bigint, tag string, first_dt int"), dt)
        for asked in (dt, days[-1], days[3]):
            want = {}
            for day in sorted(d for d in truth if d <= asked):
                for k, n, tag, first in truth[day]:
                    old = want.get(k)
                    want[k] = (k, n + old[1], old[2], old[3]) if old else (k, n, tag, first)
            assert rows(table.at(asked)) == sorted(want.values(), key=repr)
    assert runs.commits(spark, table.base).count() >= 2
    bytes_of = lambda d: sum(f.stat().st_size for f in (tmp_path / "s" / "delta" / f"dt={d}").rglob("*.parquet"))
    assert bytes_of(days[8]) < 4 * bytes_of(days[7])


def test_first_spends_day_by_day_equal_all_at_once(spark, rows):
    rng = random.Random(12)
    data = [(i, rng.randrange(8), 0, rng.randrange(50), rng.randrange(3), 1, 2, 0, 0, 0, 0, 0) for i in range(200)]
    fact = spark.createDataFrame(data, S.SPEND)
    for n in (1, 2, 5):
        parts = [spend.first_spends(fact.filter(F.col("id") % 7 == d), n) for d in (3, 0, 6, 1, 5, 2, 4)]
        state = parts[0]
        for part in parts[1:]:
            state = spend.merge_first_spends(state.unionByName(part), n)
        want = []
        for uid in range(8):
            mine = sorted((t, i, c, k, s) for i, u, _, t, c, k, s, *_ in data if u == uid and c)
            t, _, c, k, s = mine[min(n, len(mine)) - 1]
            want.append((uid, t, c, k, s, len(mine)))
        assert rows(spend.nth_of(state, n)) == sorted(want, key=repr) == rows(spend.nth_spend(fact, n))


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Three days of every log as stored tables."""
    folder = str(tmp_path_factory.mktemp("store"))

    def put(name, df, schema):
        as_schema(df.filter(F.col("dt").isin(*DAYS)), schema).write.partitionBy("dt").parquet(f"{folder}/{name}")

    def put_whole(name, df):
        df.write.parquet(f"{folder}/{name}")

    put("recharge", named(spark, SMALL, "recharge"), S.RECHARGE)
    put("pay_request", named(spark, SMALL, "pay_req"), S.PAY_REQUEST)
    put("online_detail", named(spark, SMALL, "online_log"), S.ONLINE_DETAIL)
    put("ledger", named(spark, SMALL, "ledger"), S.LEDGER)
    put("heartbeat", named(spark, SMALL, "heartbeat"), S.HEARTBEAT)
    put("workload", named(spark, SMALL, "on_air"), S.WORKLOAD)
    log = named(spark, SMALL, "spend_log")
    for c in ("roomid", "consume_id", "consume_num", "dj_hot", "dj_diamond", "anchor_uid"):
        log = log.withColumn(c, F.lit(0))
    put("spend", log, S.SPEND)
    put("request_log", named(spark, SMALL, "request_log").withColumn("ipaddr", F.lit("1.1.1.1")), S.REQUEST_LOG)
    put("first_visit", named(spark, SMALL, "signup_log"), S.FIRST_VISIT)
    put("online", named(spark, SMALL, "online"), S.ONLINE)
    paid = named(spark, SMALL, "recharge").withColumns({"type": F.lit(1), "first_second": F.lit(1)})
    put("first_recharge", paid, S.FIRST_RECHARGE)
    put("register_detail", named(spark, SMALL, "signup_log"), S.REGISTER_DETAIL)
    put_whole("register", named(spark, SMALL, "register_list"))
    for name, source in (("internal_user", "internal_list"), ("farmer_user", "farmer_list"), ("host_user", "host_list")):
        put_whole(name, named(spark, SMALL, source))
    put_whole("activation", named(spark, SMALL, "activation"))
    prices = [("100100", 2, Decimal(2), 1), ("102000", 2, Decimal(3), 1)]
    put_whole("channel_price", spark.createDataFrame(prices, S.CHANNEL_PRICE))
    rules = [(2, "s%", 1, Decimal("0.5")), (3, "%00", 2, Decimal("0.8"))]
    put_whole("channel_discount", spark.createDataFrame(rules, S.CHANNEL_DISCOUNT))
    put_whole("partner", spark.createDataFrame([(1, "p", "s10202%", 3, 1, 0, Decimal(1))], S.PARTNER))
    return folder


def stored(spark, root, name, schema, days=None):
    return scan(spark, f"{root}/{name}", schema, days=days)


def test_income_days_rerun_and_all_at_once(spark, rows, root):
    for dt in DAYS:
        nightly.income_day(spark, root, dt, tolerance=7200, refund_within=86400 // 24)
    sources = {
        "recharge": S.RECHARGE,
        "pay_request": S.PAY_REQUEST,
        "online_detail": S.ONLINE_DETAIL,
        "ledger": S.LEDGER,
    }
    logs = [stored(spark, root, n, s) for n, s in sources.items()]
    lists = [
        read_table(spark, f"{root}/{n}", s)
        for n, s in (
            ("register", S.REGISTER_LIST),
            ("internal_user", S.UID_LIST),
            ("farmer_user", S.UID_LIST),
            ("host_user", S.UID_LIST),
            ("activation", S.ACTIVATION),
        )
    ]
    whole = income.income_detail(*logs, *lists, tolerance=7200, refund_within=3600)
    day_by_day = stored(spark, root, "income_detail", whole.schema)
    assert rows(whole.select(*sorted(whole.columns))) == rows(day_by_day.select(*sorted(whole.columns)))

    firsts = income.first_payments(whole)
    got = nightly.state(spark, root, "income_first").at(DAYS[-1])
    assert rows(got.withColumnRenamed("first_dt", "dt"), *firsts.columns) == rows(firsts)

    totals = income.income_totals(income.daily_income(whole))
    total = nightly.state(spark, root, "income_total")
    assert rows(total.at(DAYS[-1]), *totals.columns) == rows(totals) != []

    # Reruns in any order, with new bases in between, leave the same table.
    for dt in (DAYS[-1], DAYS[0], DAYS[1]):
        nightly.income_day(spark, root, dt, tolerance=7200, refund_within=3600, every=2)
        assert rows(total.at(DAYS[-1]), *totals.columns) == rows(totals)
        got = nightly.state(spark, root, "income_first").at(DAYS[-1])
        assert rows(got.withColumnRenamed("first_dt", "dt"), *firsts.columns) == rows(firsts)


def test_dwell_and_spend_days(spark, rows, root):
    for dt in DAYS:
        nightly.dwell_day(spark, root, dt, cap=21600)
        nightly.spend_day(spark, root, dt)
    beats = stored(spark, root, "heartbeat", S.HEARTBEAT)
    act = read_table(spark, f"{root}/activation", S.ACTIVATION)
    whole = dwell.room_dwell(beats, act, 21600)
    assert rows(stored(spark, root, "room_time_soft", whole.schema), *whole.columns) == rows(whole) != []
    devices = dwell.dwell_by_device(whole)
    assert rows(stored(spark, root, "room_time_soft_by_device", devices.schema), *devices.columns) == rows(devices)
    fact = stored(spark, root, "spend", S.SPEND)
    for n in (1, 2):
        want = spend.nth_spend(fact, n)
        got = spend.nth_of(nightly.state(spark, root, "first_spends").at(DAYS[-1]), n)
        assert rows(got, *want.columns) == rows(want) != []
    money = spend.monitor_totals(fact)
    assert rows(nightly.state(spark, root, "spend_monitor").at(DAYS[-1])) == rows(money) != []


def test_quality_days_equal_all_days_at_once(spark, rows, root):
    for dt in DAYS:
        nightly.quality_day(spark, root, dt)
    first = rows(stored(spark, root, "channel_quota", S.QUOTA, (DAYS[-1],) * 2))
    nightly.quality_day(spark, root, DAYS[-1])
    assert rows(stored(spark, root, "channel_quota", S.QUOTA, (DAYS[-1],) * 2)) == first
    whole = channel_quality.channel_quality(
        *[
            stored(spark, root, n, s)
            for n, s in (
                ("first_visit", S.FIRST_VISIT),
                ("request_log", S.REQUEST_LOG),
                ("heartbeat", S.HEARTBEAT),
                ("workload", S.WORKLOAD),
                ("register_detail", S.REGISTER_DETAIL),
                ("recharge", S.RECHARGE),
                ("spend", S.SPEND),
            )
        ],
        *[
            read_table(spark, f"{root}/{n}", s)
            for n, s in (("channel_price", S.CHANNEL_PRICE), ("channel_discount", S.CHANNEL_DISCOUNT), ("partner", S.PARTNER))
        ],
        spark.createDataFrame([], S.QUOTA),
    )
    got = stored(spark, root, "channel_result", whole.drop("dt").schema)
    assert rows(got, *whole.columns) == rows(whole) != []


def test_quality_query_reads_every_day(spark):
    days = quality_queries.channel_counts(spark, SMALL).select("dt").distinct().count()
    assert days == named(spark, SMALL, "signup_log").select("dt").distinct().count()


def test_lobby_first_pay_and_returning_days(spark, rows, root):
    hosts = read_table(spark, f"{root}/host_user", S.UID_LIST)
    online, visits, reg = (
        stored(spark, root, n, s)
        for n, s in (("online", S.ONLINE), ("first_visit", S.FIRST_VISIT), ("register_detail", S.REGISTER_DETAIL))
    )
    stays = lobby.lobby_stay(stored(spark, root, "request_log", S.REQUEST_LOG), hosts)
    none = [
        spark.createDataFrame([], f"{s}, dt int")
        for s in (S.CHECKSUM, S.CHAT, S.FLOWER, S.PURE_VISITOR, S.PURE_VISITOR_RESULT)
    ]
    metrics = returning.returning_metrics(online, visits, reg, stored(spark, root, "recharge", S.RECHARGE), *none)
    nobody = spark.createDataFrame([], f"{S.INCOME_DAILY}, dt int")
    config = spark.createDataFrame([], S.CHANNEL_CONFIG)
    first = stored(spark, root, "first_recharge", S.FIRST_RECHARGE)
    report = first_pay_report.first_pay_report(online, first, reg, nobody, config)
    for dt in DAYS:
        nightly.lobby_day(spark, root, dt)
        nightly.returning_day(spark, root, dt)
        nightly.first_pay_day(spark, root, dt)
    assert rows(stored(spark, root, "lobby_stay", stays.schema), *stays.columns) == rows(stays)
    got = stored(spark, root, "returning_metrics", metrics.schema)
    assert rows(got, *metrics.columns) == rows(metrics) != []
    count = ["dt", "display", "online_non_pay", "first_pay"]
    got = stored(spark, root, "first_pay_report", report.schema)
    assert rows(got, *count) == rows(report, *count) != []


def test_spend_fact_day_feeds_the_spend_jobs(spark, rows, tmp_path):
    """Nine logs to numbered spends to first and second spend, day by day and all at once."""
    root, days = str(tmp_path), (19970101, 19970102, 20240101, 20240102)
    sources = dict(zip(("props", "prop_price", "games", "show_gifts", "gifts", "gift_cost", "memberships", "songs", "crowns", "red_packets"),
                       spend_queries._sources(spark, SMALL), strict=True))
    schemas = {"props": S.PROPS, "games": S.GAMES, "show_gifts": S.SHOW_GIFTS, "gifts": S.GIFTS, "memberships": S.MEMBERSHIPS,
               "songs": S.SONGS, "crowns": S.CROWNS, "red_packets": S.RED_PACKETS}
    for name, schema in schemas.items():
        some = sources[name].filter(F.col("dt").isin(*days) | (F.col("dt") % 100 == 1))
        as_schema(some.withColumn("dt", F.col("dt").cast("int")), schema).write.partitionBy("dt").parquet(f"{root}/{name}")
    for name, schema in (("prop_price", S.PROP_PRICES), ("gift_cost", S.GIFT_COSTS)):
        cols = spark.createDataFrame([], schema).schema
        sources[name].select(*[F.col(f.name).cast(f.dataType) for f in cols]).write.parquet(f"{root}/{name}")
    for dt in (*days, days[1]):
        nightly.spend_fact_day(spark, root, dt)
        nightly.spend_day(spark, root, dt)
    fact = stored(spark, root, "spend", S.SPEND)
    ids = sorted(r.id for r in fact.select("id").collect())
    assert ids and ids == [(dt << 32) + i for dt in days for i in range(1, fact.filter(F.col("dt") == dt).count() + 1)]
    for n in (1, 2):
        want = spend.nth_spend(fact, n)
        assert rows(spend.nth_of(nightly.state(spark, root, "first_spends").at(days[-1]), n), *want.columns) == rows(want) != []


def test_period_results_by_filter_and_rerun(spark, rows, tmp_path):
    root = str(tmp_path)
    dt = 20240101
    t = 1704067200
    online = [(i, 100 + i % 6, t + i, f"d{i % 6}", "s10202752101001" if i % 2 else "1010275210100100", 2) for i in range(12)]
    append_day(spark.createDataFrame(online, S.ONLINE), f"{root}/online", dt)
    append_day(spark.createDataFrame([(100 + i, 7, t, 400) for i in range(6)], S.DWELL_LOG), f"{root}/dwell_log", dt)
    append_day(spark.createDataFrame([(101, 7, t + 8 * 86400, 500), (102, 7, t + 8 * 86400, 10)], S.DWELL_LOG), f"{root}/dwell_log", 20240109)
    append_day(spark.createDataFrame([(7, t, t + 7300, 7300, t), (8, t, t + 60, 60, t)], S.WORKLOAD), f"{root}/workload", dt)
    append_day(spark.createDataFrame([(7, 3), (7, 3), (7, 1)], S.SLOT_LOG), f"{root}/slot_log", dt)
    append_day(spark.createDataFrame([(7, 500, 1, 1, -20, t + 5)], "roomid bigint, fuid bigint, is_anchor int, category int, diamond bigint, dateline bigint"), f"{root}/diamonds", dt)
    narrow = CohortFilter(device=2)
    for _ in range(2):
        nightly.host_earnings_period(spark, root, dt, dt)
        for params in (CohortFilter(), narrow):
            nightly.retention_period(spark, root, dt, dt, params)
            nightly.slots_period(spark, root, dt, dt, params)
    kept = "roomid bigint, user_num bigint, week_num bigint, device_type int, f_cids string"
    everyone = nightly.period_result(spark, root, "retention", kept, dt, dt, CohortFilter().key())
    assert rows(everyone, "roomid", "user_num", "week_num", "device_type") == [(codes.TOTAL_ROOM, 6, 1, 0), (7, 6, 1, 0)]
    some = nightly.period_result(spark, root, "retention", kept, dt, dt, narrow.key())
    assert rows(some, "roomid", "user_num", "device_type") == [(codes.TOTAL_ROOM, 3, 2), (7, 3, 2)]
    assert "dt" in some._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    slots = nightly.period_result(spark, root, "slot_report", "roomid bigint, user_num bigint, p1 bigint, p3 bigint", dt, dt, narrow.key())
    assert rows(slots) == [(7, 3, 1, 2)]
    earned = nightly.period_result(spark, root, "host_earnings", "roomid bigint, diamonds bigint", dt, dt)
    assert (7, 20) in rows(earned)
    assert nightly.period_result(spark, root, "retention", kept, dt, 20240102, narrow.key()).count() == 0


def test_retention_groups_the_dwell_of_its_base_only(spark):
    dwell = spark.range(1000).selectExpr("id AS uid", "id % 5 AS roomid", "20240101 AS dt", "id AS dateline", "id AS longs")
    base = spark.createDataFrame([(1, 1), (2, 2)], "uid bigint, roomid bigint")
    grouped = retention.dwell_per_day(dwell, base, [(20240101, 20240102)])
    assert grouped.count() == 2
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert plan.index("HashAggregate") < plan.index("LeftSemi") and "Exchange" in plan


def test_signup_day(spark, rows, tmp_path):
    root, base, start = str(tmp_path), SIGNUP_MIN_UID, 1704067200
    people = [(base + i, start + i, f"s1020276010{i % 3:02d}01", i, i % 2, 0) for i in range(1, 40)]
    users = spark.createDataFrame(people, S.USER)
    status = spark.createDataFrame([(p[0], p[1] + p[3] * 10, f"ip{p[3] % 9}", f"m{p[3]}") for p in people], S.USER_STATUS)
    partners = spark.createDataFrame([(1, "p", "s10202%", 3, 1, 10, Decimal(2))], S.PARTNER)
    discounts = spark.createDataFrame([(1, "s%", 1, Decimal("0.9"))], S.CHANNEL_DISCOUNT)
    chats = spark.createDataFrame([(base + 20, start + 50)], S.CHAT_HISTORY)
    users.write.parquet(f"{root}/user")
    status.write.parquet(f"{root}/user_status")
    profile = users.select("uid", F.lit("n").alias("nickname"))
    profile.write.parquet(f"{root}/user_profile")
    partners.write.parquet(f"{root}/partner")
    discounts.write.parquet(f"{root}/channel_discount")
    append_day(chats, f"{root}/chat_history", 20240101)
    end = start + 86399
    steps = signup.signup_steps(users, status, profile, partners, start, end, per_ip=3, min_seconds=120)
    want = {
        "signup_summary": signup.signup_summary(steps, start),
        "signup_invalid": signup.invalid_signups(steps),
        "signup_detail": signup.valid_signups(steps),
        "partner_summary": signup.partner_summary(steps, partners),
        "subchannel_settlement": signup.subchannel_settlement(steps, partners, discounts, chats, start, end),
    }
    for _ in range(2):
        nightly.signup_day(spark, root, 20240101, per_ip=3, min_seconds=120)
        for name, df in want.items():
            cols = [c for c in df.columns if c != "dt"]
            assert rows(stored(spark, root, name, df.schema), *cols) == rows(df, *cols) != []
