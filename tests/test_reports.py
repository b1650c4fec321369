"""Rules of the reports on small hand-made frames: ties, carry-over, corrected defects."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.plans import channel_quality as quality
from nightledger.plans import dwell, first_pay_report, host_earnings, income, lobby, returning, retention, signup, slots, spend
from nightledger.sources import schemas as S

DAY = 1463702400  # 2016-05-20
DT = 20160520


def frame(spark, schema, data, dt=True):
    rows = [(*r, DT) for r in data] if dt else data
    return spark.createDataFrame(rows, f"{schema}, dt int" if dt else schema)


def empty(spark, schema, dt=True):
    return frame(spark, schema, [], dt)


def req(i, uid, t, idfa="d", chan="c", kind=2, code=1000):
    return (i, uid, t, idfa, 7, 1, chan, kind, 750, code, 2, 750)


def detail(spark, recharge, pay=(), online=(), ledger=(), special=(), internal=(), farmers=(), hosts=(), act=(), **kw):
    return income.income_detail(
        frame(spark, S.RECHARGE, list(recharge)),
        frame(spark, S.PAY_REQUEST, list(pay)),
        frame(spark, S.ONLINE_DETAIL, list(online)),
        frame(spark, S.LEDGER, list(ledger)),
        frame(spark, S.REGISTER_LIST, [(u, 1) for u in special], dt=False),
        frame(spark, S.UID_LIST, [(u,) for u in internal], dt=False),
        frame(spark, S.UID_LIST, [(u,) for u in farmers], dt=False),
        frame(spark, S.UID_LIST, [(u,) for u in hosts], dt=False),
        frame(spark, S.ACTIVATION, list(act), dt=False),
        **kw,
    )


U = 3000100


def test_payment_attribution_chain(spark, rows):
    got = detail(
        spark,
        [(i, U + i, DAY + 100, 3, 10, 30, 0, f"o{i}") for i in range(1, 6)],
        pay=[
            req(1, U + 1, DAY + 100, "exact"),
            req(2, U + 1, DAY + 99, "near"),
            req(3, U + 2, DAY + 103, "near"),
            req(4, U + 2, DAY + 95, "far"),
            req(5, U + 3, DAY + 106, "too far"),
            req(6, U + 4, DAY + 100, "blank", kind=0),
        ],
        online=[
            req(1, U + 3, DAY + 50, "before"),
            req(2, U + 3, DAY + 101, "after"),
            req(3, U + 4, DAY + 100, "same second"),
        ],
    )
    assert rows(got, "id", "idfa") == [(1, "exact"), (2, "near"), (3, "before"), (4, "same second"), (5, "0")]


def test_payment_labels_and_order(spark, rows):
    pays = [(1, U + 1, 3), (2, U + 2, 10), (3, U + 3, 10), (4, U + 4, 3), (5, U + 5, 3), (6, U + 6, 3)]
    got = detail(
        spark,
        [(i, u, DAY + 9, t, 10, 30, 0, f"o{i}") for i, u, t in pays],
        pay=[req(1, U + 6, DAY + 9, code=2138)],
        special=[U + 1, U + 4],
        internal=[U + 1, U + 2],
        farmers=[U + 2, U + 4],
        hosts=[U + 4],
        ledger=[(1, U + 3, DAY + 1, 500, 147, "ywdl")],
    )
    # Internal needs an agent payment; the farmer label comes after it; the host label is last.
    assert rows(got, "id", "special") == [(1, 1), (2, 4), (3, 3), (4, 2), (5, 0), (6, 1)]
    off = detail(
        spark,
        [(3, U + 3, DAY + 9, 10, 10, 30, 0, "o")],
        ledger=[(1, U + 3, DAY + 1, 500, 147, "ywdl")],
        mark_agents=False,
    )
    assert rows(off, "id", "special") == [(3, 0)]


def test_refunds_match_strictly_later_within_the_hour(spark, rows):
    ledger = [
        (1, U, DAY + 10, 1099, 147, "x"),
        (2, U, DAY + 10 + 3600, -1000, 147, "x"),
        (3, U + 1, DAY + 10, 1000, 147, "x"),
        (4, U + 1, DAY + 10 + 3601, -1000, 147, "x"),
        (5, U + 2, DAY + 10, 1000, 147, "x"),
        (6, U + 2, DAY + 10, -1000, 147, "x"),
        (7, U + 3, DAY + 10, 1000, 149, "x"),
        (8, U + 3, DAY + 20, -1000, 147, "x"),
        (9, U + 4, DAY + 10, 1000, 149, "ywdl"),
        (10, U + 4, DAY + 11, 1000, 149, "x"),
        (11, U + 4, DAY + 20, -1000, 149, "x"),
    ]
    got = detail(spark, [], ledger=ledger, hosts=[U])
    # One refund may mark several equal charges.
    assert rows(got, "id", "type", "refund", "money", "special") == [(1, 10, 10, 0, 2), (10, 11, 10, 0, 0), (9, 11, 10, 0, 3)]


def test_money_and_coin_and_success(spark, rows):
    got = income.payments(
        frame(
            spark,
            S.RECHARGE,
            [
                (1, U, DAY, 3, 10, 30, 0, "a"),
                (2, U, DAY, 3, 10, 30, 0, "a"),
                (3, U, DAY, 21, 50, 30, 0, "a"),
                (4, U, DAY, 21, 50, 30, 0, "b"),
                (5, U, DAY, 3, 10, 20, 0, "c"),
                (6, U, DAY, 3, 10, 20, 0, "c"),
            ],
        )
    )
    assert rows(got, "id", "money", "coin", "success") == [(1, 10, 0, 1), (4, 0, 50, 1), (5, 10, 0, 0), (6, 10, 0, 0)]


def paid(spark, data):
    """(id, uid, dt, second, type, money) as detail rows."""
    cols = "id bigint, uid bigint, dt int, dateline bigint, type int, money bigint"
    return spark.createDataFrame(data, cols).withColumns({"success": F.lit(1), "special": F.lit(0)})


def test_first_payments_need_both_classes_on_one_day_for_the_second(spark, rows):
    data = [
        (1, U, 1, 100, 3, 5),
        (2, U, 2, 200, 10, 7),
        (3, U, 3, 300, 10, 1),
        (4, U, 3, 310, 3, 2),
        (5, U, 3, 310, 4, 4),
        (6, U + 1, 1, 50, 11, 9),
        (7, codes.VISITOR_UID, 1, 50, 3, 9),
    ]
    got = rows(income.first_payments(paid(spark, data)))
    # The second class of day 3 is official, and both rows of its first second are summed.
    assert got == [(U, 1, 1, 100, 5, 0, 3, 1, 310, 6), (U + 1, 1, 2, 50, 9, 0, 0, 0, 0, 0)]


def test_first_payment_tie_prefers_official_then_smallest_id(spark, rows):
    got = income.first_payments(paid(spark, [(9, U, 1, 100, 10, 1), (8, U, 1, 100, 3, 2), (7, U, 1, 100, 3, 3)]))
    assert rows(got, "type", "money", "type2", "money2") == [(1, 3, 2, 6)]


def test_daily_income_failed_rows_carry_no_refund(spark, rows):
    d = detail(spark, [(1, U, DAY, 3, 10, 30, 0, "a"), (2, U, DAY, 24, 8, 30, 0, "b"), (3, U, DAY, 4, 6, 10, 0, "c")])
    daily = income.daily_income(d)
    assert rows(daily, "success", "money", "coin", "money_3", "money_4", "money_24", "times", "times_coin") == [
        (0, 6, 0, 0, 6, 0, 1, 0),
        (1, 10, 8, 10, 0, 0, 1, 1),
    ]
    totals = income.income_totals(daily)
    assert rows(totals, "money", "money_fail", "times", "times_fail", "coin") == [(10, 6, 1, 1, 8)]


def beat(i, uid, idfa, room, t):
    return (i, uid, idfa, room, 2, t, "c", 1)


def test_dwell_keys_users_by_uid_and_visitors_by_device(spark, rows):
    beats = frame(
        spark,
        S.HEARTBEAT,
        [
            beat(1, U, "d1", 5, 100),
            beat(2, U, "d2", 5, 170),
            beat(3, U, "d2", 5, 241),
            beat(4, codes.VISITOR_UID, "d1", 5, 100),
            beat(5, codes.VISITOR_UID, "d2", 5, 160),
            beat(6, 7, "d9", 5, 160),
        ],
    )
    act = frame(spark, S.ACTIVATION, [(4, "d1")], dt=False)
    got = dwell.room_dwell(beats, act)
    assert rows(got, "uid", "idfa", "room_time", "dateline", "actid") == [
        (codes.VISITOR_UID, "d1", 0, 100, 4),
        (codes.VISITOR_UID, "d2", 0, 160, 0),
        (U, "d1", 70, 241, 4),
    ]
    by_device = dwell.dwell_by_device(got)
    assert rows(by_device, "actid", "idfa", "room_num", "room_time") == [(0, "d2", 1, 0), (4, "d1", 1, 70)]


def test_devices_without_activation_are_not_merged(spark, rows):
    beats = frame(spark, S.HEARTBEAT, [beat(i, codes.VISITOR_UID, f"d{i}", i, 100) for i in (1, 2, 3)])
    got = dwell.dwell_by_device(dwell.room_dwell(beats, empty(spark, S.ACTIVATION, dt=False)))
    assert rows(got, "idfa", "room_num") == [("d1", 1), ("d2", 1), ("d3", 1)]


def test_on_air_dwell_is_kept_per_interval(spark, rows):
    beats = frame(spark, S.HEARTBEAT, [beat(i, U, "d", 5, t) for i, t in enumerate((90, 100, 160, 200, 260))])
    air = frame(spark, S.WORKLOAD, [(5, 100, 160, 60, 0), (5, 100, 160, 60, 0), (5, 200, 300, 100, 0), (6, 0, 999, 9, 0)])
    got = dwell.room_dwell_on_air(beats, air, empty(spark, S.ACTIVATION, dt=False))
    assert rows(got, "start_dt", "room_time") == [(100, 60), (200, 60)]


def brute_on_air(beats, spans, act, cap):
    """Rows of (dt, uid, device, room, start, end) by walking over the beats inside each interval."""
    out = []
    people = {(b[-1], b[1], b[2] if b[1] == codes.VISITOR_UID else "", b[3]) for b in beats if b[1] >= codes.VISITOR_UID}
    for dt, uid, device, room in people:
        own = sorted(
            (b[5], b[0], *b[2:3]) for b in beats
            if (b[-1], b[1], b[3]) == (dt, uid, room) and (uid != codes.VISITOR_UID or b[2] == device) and b[5] is not None
        )
        for start, end in {s[1:3] for s in spans if s[0] == room and None not in s}:
            inside = [b for b in own if start <= b[0] <= end]
            if inside:
                gaps = [y[0] - x[0] for x, y in zip(inside, inside[1:], strict=False)]
                first = inside[0]
                out.append((dt, uid, room, start, end, first[2], first[0], inside[-1][0], sum(g for g in gaps if g <= cap), act.get(first[2], 0)))
    return sorted(out, key=repr)


def test_on_air_dwell_equals_brute_force_and_shuffles_no_pairs(spark, rows):
    rng = random.Random(3)
    schema = "id bigint, uid bigint, idfa string, roomid bigint, terminal int, dateline bigint, channelid string, ipaddr string, dt int"
    people = [(codes.VISITOR_UID, "d1"), (codes.VISITOR_UID, "d2"), (U, "d1"), (U, "d3"), (U + 1, None), (7, "d1")]
    beats = []
    for i in range(900):
        uid, device = rng.choice(people)
        t = rng.choice([rng.randrange(0, 90_000), rng.randrange(0, 300) * 20, None if i % 50 == 0 else 7200])
        beats.append((i, uid, device, rng.randrange(4), 2, t, "c", "ip", 20240101 + i % 2))
    spans = [(rng.randrange(4), a, a + rng.choice([0, 50, 3599, 3600, 10800, 21600, 43201, 10**8])) for a in (rng.randrange(-9000, 90_000) for _ in range(60))]
    spans += [(1, 500, 400), (1, None, 400), (1, 5, None), (None, 0, 9), (2, 7200, 7200), (2, 7200, 7200)]
    log = spark.createDataFrame(beats, schema)
    air = spark.createDataFrame(spans, "roomid bigint, start_dt bigint, end_dt bigint")
    act = spark.createDataFrame([(4, "d1"), (3, "d1")], "id bigint, idfa string")
    got = dwell.room_dwell_on_air(log, air, act, 70)
    keep = ["dt", "uid", "roomid", "start_dt", "end_dt", "idfa", "first_dateline", "dateline", "room_time", "actid"]
    assert rows(got, *keep) == brute_on_air(beats, spans, {"d1": 3}, 70)
    plan = got._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and not any("uid" in line and "start_dt" in line for line in shuffles)


def joins(node):
    below = [node.children().apply(i) for i in range(node.children().size())]
    return ([node] if node.nodeName() == "Join" else []) + [j for child in below for j in joins(child)]


def test_single_beats_on_air_meet_intervals_without_lists(spark, rows):
    rng = random.Random(4)
    schema = "id bigint, uid bigint, idfa string, roomid bigint, terminal int, dateline bigint, channelid string, ipaddr string, dt int"
    beats = [(i, U + i, f"d{i}", i % 3, 2, rng.randrange(0, 90_000), None, "ip", 20240101) for i in range(80)]
    beats += [(100 + i, codes.VISITOR_UID, f"v{i // 2}", 1, 2, 7200 * (i % 2) + i, "c", "ip", 20240101) for i in range(40)]
    beats += [(200, U, "d0", 0, 2, None, "c", "ip", 20240101), (201, U + 500, "d0", 2, 2, 7200, "c", "ip", 20240101)]
    spans = [(rng.randrange(3), a, a + rng.choice([0, 3600, 21600, 10**6])) for a in (rng.randrange(-9000, 90_000) for _ in range(50))]
    spans += [(2, 7200, 7200), (2, 7201, 9000), (2, 0, 7199), (2, 0, 7200), (2, 0, 7200), (None, 0, 10**6)]
    air = spark.createDataFrame(spans, "roomid bigint, start_dt bigint, end_dt bigint")
    act = spark.createDataFrame([(4, "d1")], "id bigint, idfa string")
    got = dwell.room_dwell_on_air(spark.createDataFrame(beats, schema), air, act, 7300)
    keep = ["dt", "uid", "roomid", "start_dt", "end_dt", "idfa", "first_dateline", "dateline", "room_time", "actid"]
    assert rows(got, *keep) == brute_on_air(beats, spans, {"d1": 4}, 7300)
    sides = [j.output().toString() for j in joins(got._jdf.queryExecution().optimizedPlan())]
    assert sorted("_beats" in side for side in sides if "start_dt" in side) == [False, True]


def test_beats_on_air_equal_brute_force_and_are_not_paired(spark, rows):
    rng = random.Random(8)
    start = {DT: DAY, DT + 1: DAY + 86400, DT + 2: DAY + 2 * 86400}
    beats, spans = [], []
    for _ in range(500):
        dt = rng.choice(list(start))
        t = start[dt] + rng.choice([rng.randrange(-43200, 86400), rng.randrange(-90000, 180000), 86399, 86398, 0, 1, -43200, -43199])
        beats.append((dt, f"d{rng.randrange(6)}", rng.choice([start[dt], start[dt] + 1, start[dt] + 50_000]), rng.choice([1, 2, 3, None]), t, True))
    for _ in range(40):
        a = DAY + rng.choice([rng.randrange(-200_000, 300_000), 86399, 86400, 2 * 86400 - 1, -43200, 0])
        reported = rng.choice([a + 60, a + 10**5, DAY + 86400, DAY + 86401, DAY, DAY + 2 * 86400, None, 0, 10**11])
        spans.append((rng.choice([1, 2, 3, None]), a, a + rng.choice([-5, 0, 1, 600, 21600, 90_000, 10**9]), reported))
    spans += [(1, None, DAY + 99, DAY + 99), (1, DAY, None, DAY + 99), *spans[:5]]
    want = {}
    for dt, device, visit, room, t, _ in beats:
        for r, a, b, reported in spans:
            if room is None or r != room or None in (a, b) or not a <= t <= b or a >= start[dt] + 86399 or b <= start[dt] - 43200:
                continue
            n, rooms = want.setdefault((dt, device), [0, set()])
            want[dt, device][0] += t <= visit + 43200
            if t > start[dt] and reported is not None and reported > start[dt] and visit > start[dt]:
                rooms.add(room)
    log = spark.createDataFrame(beats, "dt int, idfa string, visit bigint, roomid bigint, beat bigint, own boolean")
    air = spark.createDataFrame(spans, "roomid bigint, start_dt bigint, end_dt bigint, dateline bigint")
    got = quality.on_air_facts(log, air)
    assert rows(got, "dt", "idfa", "heartbeat_active", "room_num") == sorted(((*k, n, len(r)) for k, (n, r) in want.items()), key=repr)
    assert rows(quality.on_air_facts(log.limit(0), air)) == []
    # 300 beats in 300 intervals: no join makes a row for each pair
    air = spark.range(300).select(F.lit(1).cast("bigint").alias("roomid"), (DAY + F.col("id")).alias("start_dt"), F.lit(DAY + 50_000).alias("end_dt"), F.lit(DAY + 60_000).alias("dateline"))
    log = spark.range(300).select(F.lit(DT).alias("dt"), F.lit("d").alias("idfa"), F.lit(DAY + 1).alias("visit"), F.lit(1).cast("bigint").alias("roomid"), (DAY + 1000 + F.col("id")).alias("beat"), F.lit(True).alias("own"))
    got = quality.on_air_facts(log, air)
    assert [tuple(r) for r in got.collect()] == [(DT, "d", 90_000, 1)]
    assert 300 <= max(joined_rows(got._jdf.queryExecution().executedPlan())) <= 600


def joined_rows(plan):
    """Rows each join of an executed plan put out."""
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    out = []
    todo = [plan]
    while todo:
        node = todo.pop()
        if "Join" in node.nodeName():
            out.append(node.metrics().apply("numOutputRows").value())
        inner = [node.plan()] if node.nodeName().endswith("QueryStage") else []
        children = node.children()
        todo += inner + [children.apply(i) for i in range(children.size())]
    return out


def ask(i, device, t, terminal=3, action=codes.ACTION_NOTICE, uid=9):
    return (i, uid, t, device, device, "c", terminal, action, "1.1.1.1", 1)


def test_lobby_needs_two_gaps_in_the_band(spark, rows):
    log = frame(
        spark,
        S.REQUEST_LOG,
        [ask(i, "two", t) for i, t in enumerate((0, 95, 190))]
        + [ask(10, "two", 95)]
        + [ask(20 + i, "one", t) for i, t in enumerate((0, 95, 300))]
        + [ask(30 + i, "android", t, 2) for i, t in enumerate((0, 95, 190))]
        + [ask(40 + i, "edge", t, uid=8) for i, t in enumerate((0, 90, 190, 291))],
    )
    hosts = frame(spark, S.UID_LIST, [(8,), (8,)], dt=False)
    assert rows(lobby.lobby_stay(log, hosts), "idfa", "special") == [("edge", 2), ("two", 0)]


def brute_lobby(log, low, high):
    """Rows of a day numbered by (address, time); neighbours of one device with two gaps in the band."""
    first = {}
    for i, _, t, mac, idfa, *_ in sorted(log, key=lambda r: r[0]):
        first.setdefault((mac is not None, mac, t), (i, idfa))
    order = sorted((has, mac or "", t, i, idfa) for (has, mac, t), (i, idfa) in first.items())
    found = set()
    for a, b, c in zip(order, order[1:], order[2:], strict=False):
        if a[4] is not None and a[4] == b[4] == c[4] and low <= b[2] - a[2] <= high and low <= c[2] - b[2] <= high:
            found.add((a[4], a[3]))
    return found


def test_lobby_addresses_that_interleave(spark, rows):
    """A device that is steady on two addresses at once is steady; NULL devices and shared addresses are not."""
    log = [ask(i, "one", t) for i, t in enumerate((0, 95, 190, 285))] + [ask(10 + i, "two", t) for i, t in enumerate((40, 135, 230, 325))]
    df = frame(spark, S.REQUEST_LOG, log).withColumn("idfa", F.lit("device"))
    hosts = frame(spark, S.UID_LIST, [], dt=False)
    assert rows(lobby.lobby_stay(df, hosts), "idfa") == [("device",)]
    shared = df.withColumn("macaddr", F.lit("m")).withColumn("idfa", F.concat(F.lit("d"), F.col("id") % 2))
    assert rows(lobby.lobby_stay(shared, hosts), "idfa") == []
    assert rows(lobby.lobby_stay(df.withColumn("idfa", F.lit(None).cast("string")), hosts), "idfa") == []


def test_lobby_equals_brute_force(spark, rows):
    rng = random.Random(9)
    log = []
    for i in range(500):
        t = 95 * rng.randrange(0, 40) + rng.choice([0, 0, 0, 0, 3, 50])
        device, mac = rng.choice(["a", "a", "b", None]), rng.choice(["m1", "m2", "m3", "m4", "m5", None])
        log.append((i, 9, t, mac, device, "c", 3, codes.ACTION_NOTICE, "1.1.1.1", 1))
    steady = lobby.steady_requests(lobby.notice_requests(frame(spark, S.REQUEST_LOG, log)))
    want = brute_lobby(log, 90, 100)
    assert rows(steady, "idfa", "id") == sorted(want, key=repr) and len(want) > 5


def coins(spark, data):
    return spark.createDataFrame(
        data, "id int, uid bigint, dateline bigint, consume_coin bigint, consume_type int, consume_type_son int"
    )


def test_second_spend_takes_every_column_of_the_second_row(spark, rows):
    fact = coins(
        spark,
        [(1, U, 10, 5, 10, 1), (2, U, 10, 6, 11, 2), (3, U, 30, 7, 12, 3), (4, U, 5, 0, 13, 4), (5, codes.SYSTEM_UID, 1, 9, 1, 1)],
    )
    assert rows(spend.nth_spend(fact, 1)) == [(U, 10, 5, 10, 1, 3)]
    assert rows(spend.nth_spend(fact, 2)) == [(U, 10, 6, 11, 2, 3)]


@pytest.mark.parametrize("n", [1, 2])
def test_nth_spend_day_by_day_equals_all_at_once(spark, rows, n):
    data = [(i, U + i % 4, 10 * i, i + 1, i % 5, i % 3) for i in range(15)]
    want = rows(spend.nth_spend(coins(spark, data), n))
    state = None
    for part in (data[:3], data[3:4], [], data[4:9], data[9:]):
        state = spend.nth_spend(coins(spark, part), n, state)
    assert rows(state) == want


def signup_frames(spark, people, partners):
    users = spark.createDataFrame(
        [(u, cr, ch, u, 0, 0) for u, cr, ch, *_ in people],
        "uid bigint, cr_dt bigint, channelid string, showid bigint, qqstatus int, renrenstatus int",
    )
    status = spark.createDataFrame(
        [(u, cr + stay, ip, mac) for u, cr, _, stay, ip, mac, _ in people],
        "uid bigint, lastactivitytime bigint, lastip string, macaddr string",
    )
    profile = spark.createDataFrame([(p[0], p[6]) for p in people], "uid bigint, nickname string")
    return users, status, profile, spark.createDataFrame(partners, S.PARTNER)


B = codes.SIGNUP_MIN_UID


def test_signup_steps_run_three_two_one(spark, rows):
    android, ios = "s10202760100001", "10102760100101"
    people = [
        (B + 1, DAY + 1, android, 500, "ip1", "m1", "n"),
        (B + 2, DAY + 2, android, 500, "ip1", "m1", "n"),  # second on its device
        (B + 3, DAY + 3, android, 10, "ip1", "m3", "n"),  # third on its address
        (B + 4, DAY + 4, android, 119, "ip4", "m4", "n"),  # gone too soon
        (B + 5, DAY + 5, ios, 150, "ip5", "m5", "n"),  # iOS must stay 180 s
        (B + 6, DAY + 6, ios, 180, "ip6", "m6", "n"),
        (B + 7, DAY - 86400, android, 500, "ip7", "m7", "n"),  # the day before
        (B + 8, DAY + 8, android, 500, "ip7", "m8", "n"),  # address seen before
        (B + 9, DAY + 9, android, 500, "ip9", "m7", "n"),  # device seen before
        (B + 10, DAY + 10, android, 500, "ip10", "m10", "机房 共用出口"),
        (B + 11, DAY + 11, android, 500, "ip11", "m11", "机房"),
        (B + 12, DAY + 12, android, 500, "ip12", "m12", None),
        (B + 13, DAY + 13, "unmatched", 500, "ip13", "m13", "n"),
    ]
    partners = [
        (1, "p", "s10202%", 3, 1, 10, Decimal(2)),
        (2, "q", "10102%", 3, 1, 0, Decimal(3)),
        (3, "off", "%", 3, 0, 0, Decimal(1)),
    ]
    frames = signup_frames(spark, people, partners)
    steps = signup.signup_steps(*frames, DAY, DAY + 86399, per_ip=2, min_seconds=120)
    assert rows(steps, F.col("uid") - B, "step3", "step2", "step1") == [
        (1, 0, 0, 0),
        (11, 0, 0, 0),
        (2, 0, 1, 0),
        (3, 1, 0, 0),
        (4, 0, 0, 1),
        (5, 0, 0, 1),
        (6, 0, 0, 0),
    ]
    assert rows(signup.signup_summary(steps, DAY)) == [(DT, 7, 3, 2, 1, 1)]
    assert rows(signup.partner_summary(steps, frames[3])) == [(1, 1, 2, 3, 5, 1, 1, 1), (2, 1, 3, 3, 2, 1, 0, 0)]


def test_scaled_units_rules(spark, rows):
    new, old, ios, free = "s10202753100001", "s10202752100001", "10102760100101", "s10202760216301"
    cases = [
        (new, 11, 4.9, 0.5, 0),
        (new, 10, 4.9, 0.5, 10),
        (new, 11, 4.9, 0.4, 11),
        (ios, 99, 0.0, 1.0, 99),
        (free, 99, 0.0, 1.0, 99),
        (new, 11, 5.0, 1.0, 0),
        (old, 11, 5.0, 1.0, 11),
        (old, 16, 5.0, 1.0, 0),
        (new, 20, 40.0, 1.0, 14),
        (new, 20, 40.1, 1.0, 20),
        (old, 20, 50.0, 1.0, 18),
        (old, 20, 50.1, 1.0, 20),
        (old, 15, 20.0, 1.0, 15),
    ]
    df = spark.createDataFrame([(*c, i) for i, c in enumerate(cases)], "c string, u bigint, r double, d double, w bigint, i int")
    df = df.withColumn("r", F.col("r").cast("decimal(18,4)"))
    got = df.select("i", signup.scaled_units(F.col("u"), F.col("r"), F.col("d"), F.col("c")).alias("g"), "w").collect()
    assert [(r.i, r.g) for r in got] == [(r.i, r.w) for r in got]


def test_first_pay_report_levels_come_from_leaves_only(spark, rows):
    web, android = "10301760100000", "s10202760102001"
    online = frame(spark, S.ONLINE, [(1, U, DAY + 1, "d", web, 1), (2, U + 1, DAY + 2, "e", android + "xx", 2), (3, U + 2, DAY + 3, "f", android, 2)])
    first = spark.createDataFrame(
        [(DT, U, DAY + 5, 20, 1, 1), (DT, U + 1, DAY + 6, 10, 1, 1), (DT - 1, U + 2, DAY - 5, 10, 1, 1)],
        "dt int, uid bigint, dateline bigint, money bigint, type int, first_second int",
    )
    money = spark.createDataFrame([(DT, U, 30, 0, 1), (DT, U + 1, 40, 1, 1)], "dt int, uid bigint, money bigint, special int, success int")
    config = spark.createDataFrame([(1000, "home", 1), (1020, "shop", 3)], "chancode int, channame string, statis_type int")
    got = first_pay_report.first_pay_report(online, first, empty(spark, S.REGISTER_DETAIL), money, config).filter(F.col("dt") == DT)
    table = {r.display: r for r in got.filter("display <> 2 AND display <> 0").collect()}
    assert sorted(table) == [1, 3, 6]
    total = table[1]
    # U + 2 paid before the day, so two users are online without having paid.
    assert (total.online_non_pay, total.first_pay, total.first_official_11, total.channel_num) == (2, 2, 1, 2)
    assert (total.first_pay_all_money, float(total.first_pay_ratio), float(total.first_pay_arpu)) == (30, 100.0, 15.0)
    assert total.channel_id == "渠道总数: 2" and table[6].channel_name == "安卓电子市场"
    leaves = got.filter("display = 0")
    assert rows(leaves, "channel_id", "online_non_pay", "first_pay") == [(web, 1, 1), (android, 1, 1)]


def test_returning_metrics_drop_empty_and_junk_rows(spark, rows):
    v = codes.VISITOR_UID
    online = frame(
        spark,
        S.ONLINE,
        [
            (1, v, DAY, "old", "10301760100000", 1),
            (2, v, DAY, "new", "10301760100000", 1),
            (3, U, DAY, "new", "10301760100000", 1),
            (4, U + 1, DAY, "new", "20000101", 1),
            (5, U + 2, DAY, "old2", "yibao", 1),
        ],
    )
    visits = spark.createDataFrame([(DT, "new")], "dt int, idfa string")
    reg = frame(spark, S.REGISTER_DETAIL, [(1, U + 1, "new", "c", 1, 1, DAY)])
    none = {
        "recharge": empty(spark, S.RECHARGE),
        "md5": spark.createDataFrame([(DT, "old", 1), (DT, "new", 0)], "dt int, idfa string, md5 int"),
        "chat": spark.createDataFrame([(DT, U, 3)], "dt int, uid bigint, chat_num int"),
        "flower": spark.createDataFrame([], "dt int, uid bigint, flower_num int"),
        "pure": spark.createDataFrame([], "dt int, idfa string, channel_id string, device_type int"),
        "result": spark.createDataFrame([], "dt int, channel_id string, device_type int, non_added_pure_visitor int"),
    }
    got = returning.returning_metrics(online, visits, reg, *none.values())
    # The old visitor and the old account on a new device come back; the new account does not.
    assert rows(got, "channel_id", "non_added_user_sum", "md5_pass_num", "md5_fail_num", "non_added_register_sum", "non_added_chat_user_sum") == [
        ("10301760100000", 2, 1, 1, 1, 0)
    ]


def test_host_earnings_total_sums_rooms_once(spark, rows):
    diamonds = spark.createDataFrame(
        [(1, 5, -30, 1, 1, DAY), (1, 5, 20, 1, 2, DAY), (2, 0, 99, 1, 1, DAY), (2, 5, 99, 0, 1, DAY), (3, 5, 7, 1, 1, DAY)],
        "roomid int, fuid int, diamond int, is_anchor int, category int, dateline bigint",
    )
    load = spark.createDataFrame(
        [(1, DAY, DAY + 3600, 3600), (1, DAY + 7200, DAY + 10800, 3600), (4, DAY, DAY + 10, 10)],
        "roomid int, start_dt bigint, end_dt bigint, total bigint",
    )
    roster = spark.createDataFrame([(1, "one", 3), (9, "idle", 4)], "roomid int, nickname string, level int")
    got = host_earnings.host_earnings(diamonds, load, roster, DAY, DAY + 86399)
    assert [(r[0], r[1], float(r[2]), r[3], float(r[4])) for r in rows(got, "roomid", "diamonds", "online", "days", "diamonds_pro")] == [
        (1, 50, 2.0, 1, 25.0),
        (100, 57, 2.0, 1, 28.5),
        (3, 7, 0.0, 0, 0.0),
    ]


def test_retention_thresholds_and_windows(spark, rows):
    week = 7 * 86400
    stays = [
        (U, 1, DAY + 5, 301),  # counts: more than 300
        (U, 1, DAY + 5 + week, 300),  # back at the start of the window with exactly 300
        (U + 1, 1, DAY + 5, 300),  # base needs more than 300
        (U + 2, 1, DAY + 5, 900),
        (U + 2, 1, DAY + 4 + week, 900),  # one second early
        (U + 2, 2, DAY + 5, 900),  # room not busy enough
        (U + 3, 3, DAY + 5, 900),  # black list
    ]
    log = spark.createDataFrame(stays, "uid bigint, roomid int, dateline bigint, longs bigint").withColumn(
        "dt", F.date_format(F.timestamp_seconds("dateline"), "yyyyMMdd").cast("int")
    )
    online = frame(spark, S.ONLINE, [(i, U + i, DAY, "d", "10301760100000", 1) for i in range(4)])
    load = spark.createDataFrame([(1, 3601, DT), (2, 3600, DT), (3, 9999, DT)], "roomid int, total bigint, dt int")

    def ids(values, cols):
        return spark.createDataFrame(values, cols)

    tables = (
        ids([], S.CHANNEL_PRICE),
        ids([(3,)], "roomid int"),
        ids([(1, DT, 5)], "roomid int, date_time int, level int"),
        ids([(1, DT, 4), (1, DT, 5)], "roomid int, dt int, cal_rank int"),
        ids([(1, DAY)], "roomid int, dateline bigint"),
        ids([], "roomid int, dateline bigint"),
        ids([(1, 1)], "roomid int, gender int"),
    )
    got = retention.retention(online, log, load, *tables, DT, DT)
    cols = ("roomid", "user_num", "week_num", "month_num", "level", "recommend_times", "recommend_type", "gender")
    assert rows(got, *cols) == [(1, 2, 1, 0, 5, 2, 1, 1), (100, 2, 1, 0, 0, 0, 0, 0)]
    assert [float(r[0]) for r in rows(got, "week_pro")] == [0.5, 0.5]
    users = online.select("uid")
    report = slots.slot_report(users, log, load, tables[1], tables[3], tables[4], tables[4], DT, DT)
    assert rows(report, "roomid", "user_num", "p4", "p5", "p6", "recommend_type") == [(1, 3, 1, 1, 0, 2)]


def facts(spark, **kw):
    base = {
        "dt": DT,
        "idfa": "d",
        "ipaddr": 1,
        "channel_id": "s10202760102001",
        "device_type": 2,
        "dateline": DAY + 9,
        "login_qq": 0,
        "login_weixin": 0,
        "login_num": 0,
        "ios_span": None,
        "heartbeat": 9,
        "heartbeat_active": 0,
        "room_num": 1,
        "recharge": 0,
        "consume": 0,
        "device_per_ip": 1,
    }
    schema = """dt int, idfa string, ipaddr int, channel_id string, device_type int, dateline bigint, login_qq int,
        login_weixin int, login_num int, ios_span int, heartbeat int, heartbeat_active int, room_num int, recharge int,
        consume int, device_per_ip int"""
    return spark.createDataFrame([tuple({**base, **row}.values()) for row in kw["rows"]], schema)


def counts(spark, *devices, rate=0.5):
    base = spark.createDataFrame([(DT, 1, rate), (DT, 2, rate)], "dt int, class int, baseline double")
    none = spark.createDataFrame([], "dt int, channel_id string, md5_fail_num int")
    cols = ("active_num", "stat_num", "del_1_num", "del_2_num", "add_1_num", "del_3_num", "dis_4_num", "cal_num")
    got = quality.channel_counts(facts(spark, rows=devices), base, none).select(*cols).collect()
    assert len(got) == 1
    return tuple(got[0])


def test_channel_counts_rules(spark):
    login = {"login_qq": 1}
    assert counts(spark, {**login, "idfa": "a"}) == (1, 1, 0, 0, 0, 0, 1.0, 1)
    # The statistic stops below five devices per address, deductions at five.
    assert counts(spark, {**login, "device_per_ip": 5, "device_type": 3}) == (1, 0, 1, 0, 0, 0, 1.0, 0)
    assert counts(spark, {**login, "device_per_ip": 6, "device_type": 3}) == (1, 0, 0, 0, 0, 0, 1.0, 0)
    # Few beats are deducted, given back when the device woke on air, and taken again when it did nothing.
    idle = {**login, "heartbeat": 2}
    assert counts(spark, idle) == (1, 1, 0, 1, 0, 0, 1.0, 0)
    woke = {**login, "heartbeat": 1, "heartbeat_active": 4}
    assert counts(spark, woke) == (1, 1, 0, 1, 1, 0, 1.0, 1)
    assert counts(spark, {**woke, "room_num": 0}) == (1, 1, 0, 1, 1, 1, 1.0, 0)
    # Half the baseline login rate costs a quarter.
    four = [{"idfa": str(i), "login_qq": int(i == 0)} for i in range(4)]
    assert counts(spark, *four, rate=0.5) == (4, 4, 0, 0, 0, 0, 0.75, 3)


def test_ios_span_replaces_the_beat_rule_only_where_it_finds_devices(spark):
    ios = {"channel_id": "10102760100107", "device_type": 3, "heartbeat": 0}
    assert counts(spark, {**ios, "ios_span": 179})[3] == 1
    assert counts(spark, {**ios, "ios_span": 180})[3] == 1
    assert counts(spark, {**ios, "ios_span": 180, "heartbeat": 3})[3] == 0
    two = [{**ios, "idfa": "a", "ios_span": 10, "heartbeat": 9}, {**ios, "idfa": "b", "ios_span": 999}]
    assert counts(spark, *two)[3] == 1
    assert counts(spark, *two)[6] == 1.0


def test_every_device_of_an_address_gets_its_count(spark, rows):
    visits = frame(spark, S.FIRST_VISIT, [(f"d{i}", 7, "10301760100000", 1, DAY + i) for i in range(3)])
    got = quality.device_facts(
        quality.new_devices(visits),
        quality.request_facts(empty(spark, S.REQUEST_LOG)),
        empty(spark, S.HEARTBEAT),
        empty(spark, S.WORKLOAD),
        empty(spark, S.REGISTER_DETAIL),
        empty(spark, S.RECHARGE),
        empty(spark, S.SPEND),
        spark.createDataFrame([(20160419, 7), (20160418, 7)], "dt int, ipaddr bigint"),
    )
    # One more from 31 days ago, none from 32 days ago.
    assert rows(got, "idfa", "device_per_ip") == [("d0", 4), ("d1", 4), ("d2", 4)]


def settled(spark, cal, quota, previous=None, channel="s10202763102001"):
    days = [(DT + i, channel, c) for i, c in enumerate(cal)]
    counted = spark.createDataFrame(days, "dt int, channel_id string, cal_num bigint")
    prices = spark.createDataFrame([("102000", 2, 3, 1)], "code string, channel_platform int, start_price int, statis_type int")
    discounts = spark.createDataFrame([(1, "%", 3, 0), (2, "s%", 1, 50), (3, "s10202%", 2, 80)], "id int, channelid string, grade int, pct int")
    discounts = discounts.withColumn("discount", (F.col("pct") / 100).cast("decimal(10,4)"))
    partners = spark.createDataFrame([(2, "b", "s%", 3, 1, 0, Decimal(1)), (1, "a", "s1%", 3, 1, 0, Decimal(1))], S.PARTNER)
    quotas = spark.createDataFrame([(channel, 0, quota)], S.QUOTA)
    return quality.settle(counted, prices, discounts, partners, quotas, previous)


def test_settlement_uses_up_the_quota_day_by_day(spark, rows):
    got = rows(settled(spark, [10, 10, 10], 15), "dt", "remain", "final_num", "final_num_ratio", "total_price", "partner_name")
    assert [tuple(map(float, r[:5])) for r in got] == [
        (DT, 15, 10, 0, 30),
        (DT + 1, 5, 9, 90, 27),
        (DT + 2, 0, 8, 88.89, 24),
    ]
    assert got[0][5] == "a"
    # The same days one by one, handing the quota on.
    quota, before, one_by_one = 15, None, []
    for i, cal in enumerate([10, 10, 10]):
        day = settled(spark, [cal], quota).withColumn("dt", F.lit(DT + i))
        one_by_one += rows(day, "remain", "final_num")
        quota = max(quota - cal, 0)
    assert [tuple(map(float, r)) for r in one_by_one] == [(15, 10), (5, 9), (0, 8)]


def test_old_android_versions_are_shown_but_not_paid(spark, rows):
    got = rows(settled(spark, [10], 0, channel="s10202762102001"), "cal_num", "final_num", "total_price")
    assert [tuple(map(float, r)) for r in got] == [(10, 0, 0)]


def test_lobby_counts_a_device_once(spark, rows):
    log = frame(
        spark,
        S.REQUEST_LOG,
        [ask(i, "one", t) for i, t in enumerate((0, 95, 190, 285))] + [ask(10 + i, "two", t) for i, t in enumerate((95, 190))],
    ).withColumn("idfa", F.lit("device"))
    hosts = frame(spark, S.UID_LIST, [], dt=False)
    stays = lobby.lobby_stay(log, hosts, 0, 100)
    assert rows(stays, "idfa", "special") == [("device", 0)]


def test_partner_with_two_patterns_and_two_rows(spark):
    users = spark.createDataFrame(
        [(79600001 + i, 1000 + i, "s1020275210010%d" % (i % 2), i, 0, 0) for i in range(4)],
        "uid long, cr_dt long, channelid string, showid long, qqstatus int, renrenstatus int",
    )
    status = spark.createDataFrame(
        [(79600001 + i, 9000, "ip", f"m{i}") for i in range(4)], "uid long, lastactivitytime long, lastip string, macaddr string"
    )
    profile = spark.createDataFrame([(79600001 + i, "n") for i in range(4)], "uid long, nickname string")
    partners = spark.createDataFrame(
        [(1, "p", "s10202%", 3, 1, 10, 2), (1, "p", "%1001__", 3, 1, 0, 3), (1, "p", "%10010_", 3, 1, 0, 3)],
        "partner_id long, partner_name string, channelid string, type int, status int, cut_rate int, price int",
    )
    for per_ip, flagged in ((10, 0), (3, 1)):
        steps = signup.signup_steps(users, status, profile, partners, 500, 5000, per_ip=per_ip, min_seconds=10)
        got = steps.select("uid", "partner_id", "step3").collect()
        assert len(got) == len({r.uid for r in got}) == 4
        assert sum(r.step3 for r in got) == flagged
    summary = signup.partner_summary(steps, partners).collect()
    assert [(r.partner_id, r.price, r.user_num) for r in summary] == [(1, 2, 2)]
