"""One day of a job from stored logs to stored results.

Every function takes the folder of the tables and the day. Results are written beside the day's old
ones and committed, so a rerun leaves the same rows and a failed run leaves the old ones.
Cumulative tables per user or device are bases and daily deltas (:data:`STATES`): read them with :func:`state`.
The quota of channels is one small snapshot per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightledger.functions.dates import HALF_DAY, dt_to_epoch, py_shift
from nightledger.operators.merge import roll
from nightledger.functions.filters import CohortFilter
from nightledger.plans import (
    channel_quality,
    dwell,
    first_pay_report,
    host_earnings,
    income,
    lobby,
    retention,
    returning,
    signup,
    slots,
    spend,
)
from nightledger.sources import schemas as S
from nightledger.sources.runs import replace_day
from nightledger.sources.scan import read_table, scan, snapshot_before
from nightledger.sources.state import State, sums


FIRST_SPENDS = 2  # spends of a user that are kept in order
ROLLING_DAYS = 31


def _merge_first_payments(rows: DataFrame) -> DataFrame:
    merged = income.merge_first_payments(rows.withColumnRenamed("first_dt", "dt"))
    return merged.withColumnRenamed("dt", "first_dt")


def _no_income(spark: SparkSession) -> DataFrame:
    """Payment detail of no payments, for its columns."""
    logs = [spark.createDataFrame([], f"{s}, dt int") for s in (S.RECHARGE, S.PAY_REQUEST, S.ONLINE_DETAIL, S.LEDGER)]
    lists = [spark.createDataFrame([], s) for s in (S.REGISTER_LIST, *[S.UID_LIST] * 3, S.ACTIVATION)]
    return income.income_detail(*logs, *lists)


def _first_payments(detail: DataFrame) -> DataFrame:
    return income.first_payments(detail).withColumnRenamed("dt", "first_dt")


def _income_totals(daily: DataFrame) -> DataFrame:
    """Totals with the first day of each user, whose label stays."""
    first = daily.groupBy("uid").agg(F.min("dt").alias("first_dt"))
    return income.income_totals(daily).join(first, "uid")


#: Rows that fix the columns of each cumulative table, and how its rows merge.
STATES = {
    "income_first": (lambda spark: _first_payments(_no_income(spark)), _merge_first_payments),
    "income_total": (
        lambda spark: _income_totals(income.daily_income(_no_income(spark))),
        lambda rows: sums(rows, ["uid"], {"special": "first_dt"}),
    ),
    "first_spends": (
        lambda spark: spend.first_spends(spark.createDataFrame([], S.SPEND), FIRST_SPENDS),
        lambda rows: spend.merge_first_spends(rows, FIRST_SPENDS),
    ),
    "spend_monitor": (
        lambda spark: spend.monitor_totals(spark.createDataFrame([], S.SPEND)),
        lambda rows: sums(rows, ["uid"]),
    ),
}


def state(spark: SparkSession, root: str, name: str, every: int = 30) -> State:
    """A cumulative table of :data:`STATES`, a new base every ``every`` days."""
    like, merge = STATES[name]
    return State(spark, f"{root}/{name}", like(spark).schema, merge, every)


def day_start(spark: SparkSession, dt: int) -> int:
    """Epoch of the first second of a day in the session time zone."""
    return spark.range(1).select(dt_to_epoch(F.lit(dt))).first()[0]


def _store(df: DataFrame, root: str, name: str, dt: int) -> DataFrame:
    """Write one day of a table and return it as stored, cut off from how it was computed."""
    replace_day(df, f"{root}/{name}", dt)
    return scan(df.sparkSession, f"{root}/{name}", df.schema, days=(dt, dt))


def income_day(
    spark: SparkSession,
    root: str,
    dt: int,
    *,
    tolerance: int = 5,
    refund_within: int = 3600,
    mark_agents: bool = True,
    every: int = 30,
) -> None:
    """Payment detail, daily income, first payments and running totals."""

    def day(name: str, schema: str) -> DataFrame:
        return scan(spark, f"{root}/{name}", schema, days=(dt, dt))

    def whole(name: str, schema: str) -> DataFrame:
        return read_table(spark, f"{root}/{name}", schema)

    start = day_start(spark, dt)
    # Refunds may follow a charge into the next day; charges found there belong to that day.
    ledger = scan(spark, f"{root}/ledger", S.LEDGER, seconds=(start, day_start(spark, py_shift(dt, 1)) - 1 + refund_within))
    detail = income.income_detail(
        day("recharge", S.RECHARGE),
        day("pay_request", S.PAY_REQUEST),
        day("online_detail", S.ONLINE_DETAIL),
        ledger,
        whole("register", S.REGISTER_LIST),
        whole("internal_user", S.UID_LIST),
        whole("farmer_user", S.UID_LIST),
        whole("host_user", S.UID_LIST),
        whole("activation", S.ACTIVATION),
        tolerance=tolerance,
        refund_within=refund_within,
        mark_agents=mark_agents,
    ).filter(F.col("dt") == dt)
    detail = _store(detail, root, "income_detail", dt)
    daily = _store(income.daily_income(detail), root, "income_daily", dt)

    state(spark, root, "income_first", every).write(_first_payments(detail), dt)
    state(spark, root, "income_total", every).write(_income_totals(daily), dt)


def dwell_day(spark: SparkSession, root: str, dt: int, *, cap: int = dwell.CAP) -> None:
    """Dwell at any time and while on air, each with its totals per device."""
    beats = scan(spark, f"{root}/heartbeat", S.HEARTBEAT, days=(dt, dt))
    on_air = scan(spark, f"{root}/workload", S.WORKLOAD, days=(dt, dt))
    activation = read_table(spark, f"{root}/activation", S.ACTIVATION)
    for name, rows in (
        ("room_time_soft", dwell.room_dwell(beats, activation, cap)),
        ("room_time", dwell.room_dwell_on_air(beats, on_air, activation, cap)),
    ):
        stored = _store(rows, root, name, dt)
        _store(dwell.dwell_by_device(stored), root, f"{name}_by_device", dt)


def spend_fact_day(spark: SparkSession, root: str, dt: int) -> None:
    """The day's spends of the nine logs as one numbered fact, which :func:`spend_day` and :func:`quality_day` read."""

    def day(name: str, schema: str) -> DataFrame:
        return scan(spark, f"{root}/{name}", schema, days=(dt, dt))

    fact = spend.spend_fact(
        day("props", S.PROPS),
        read_table(spark, f"{root}/prop_price", S.PROP_PRICES),
        day("games", S.GAMES),
        day("show_gifts", S.SHOW_GIFTS),
        day("gifts", S.GIFTS),
        read_table(spark, f"{root}/gift_cost", S.GIFT_COSTS),
        day("memberships", S.MEMBERSHIPS),
        day("songs", S.SONGS),
        day("crowns", S.CROWNS),
        day("red_packets", S.RED_PACKETS),
    )
    kinds = {f.name: f.dataType for f in spark.createDataFrame([], S.SPEND).schema}
    numbered = spend.with_ids(fact, dt)
    _store(numbered.withColumns({n: F.col(n).cast(t) for n, t in kinds.items()}), root, "spend", dt)


def spend_day(spark: SparkSession, root: str, dt: int, every: int = 30) -> None:
    """First and second spend and the monitor totals, from the spend fact of the day."""
    fact = scan(spark, f"{root}/spend", S.SPEND, days=(dt, dt))
    state(spark, root, "first_spends", every).write(spend.first_spends(fact, FIRST_SPENDS), dt)
    state(spark, root, "spend_monitor", every).write(spend.monitor_totals(fact), dt)


def quality_day(spark: SparkSession, root: str, dt: int) -> None:
    """Channel quality and settlement, the rolling table of new devices and the quota left."""
    start = day_start(spark, dt)

    def day(name: str, schema: str, back: int = 0) -> DataFrame:
        return scan(spark, f"{root}/{name}", schema, days=(py_shift(dt, -back), dt))

    def whole(name: str, schema: str) -> DataFrame:
        return read_table(spark, f"{root}/{name}", schema)

    visits = day("first_visit", S.FIRST_VISIT)
    devices = channel_quality.new_devices(visits).withColumnRenamed("dt", "visit_dt")
    month = (py_shift(dt, -ROLLING_DAYS), py_shift(dt, -1))
    rolling = scan(spark, f"{root}/first_visit_new", devices.schema, days=month).drop("dt")
    history = roll(rolling, rolling.filter(F.lit(False)), start, ROLLING_DAYS).withColumnRenamed("visit_dt", "dt")
    quota = snapshot_before(spark, f"{root}/channel_quota", S.QUOTA, dt)
    previous = scan(
        spark, f"{root}/channel_result", "channel_id string, final_num decimal(20,4)", days=(py_shift(dt, -1),) * 2
    )
    result = channel_quality.channel_quality(
        visits,
        day("request_log", S.REQUEST_LOG),
        day("heartbeat", S.HEARTBEAT, 1).filter(F.col("dateline") > start - HALF_DAY),
        day("workload", S.WORKLOAD, 1),
        day("register_detail", S.REGISTER_DETAIL),
        day("recharge", S.RECHARGE),
        day("spend", S.SPEND),
        whole("channel_price", S.CHANNEL_PRICE),
        whole("channel_discount", S.CHANNEL_DISCOUNT),
        whole("partner", S.PARTNER),
        quota,
        previous,
        history,
    )
    stored = _store(result, root, "channel_result", dt)
    _store(devices.filter(F.col("dateline") >= start), root, "first_visit_new", dt)
    _store(channel_quality.channel_totals(stored, quota), root, "channel_quota", dt)


def lobby_day(spark: SparkSession, root: str, dt: int) -> None:
    """Devices that stayed in the lobby."""
    log = scan(spark, f"{root}/request_log", S.REQUEST_LOG, days=(dt, dt))
    hosts = read_table(spark, f"{root}/host_user", S.UID_LIST)
    _store(lobby.lobby_stay(log, hosts), root, "lobby_stay", dt)


def first_pay_day(spark: SparkSession, root: str, dt: int) -> None:
    """First-payment report of the day, from the daily income already stored.

    Only the day's own first payments are reported; those of all earlier days decide who has not
    paid yet.
    """
    report = first_pay_report.first_pay_report(
        scan(spark, f"{root}/online", S.ONLINE, days=(dt, dt)),
        scan(spark, f"{root}/first_recharge", S.FIRST_RECHARGE, days=(dt, dt)),
        read_table(spark, f"{root}/register_detail", f"{S.REGISTER_DETAIL}, dt int"),
        scan(spark, f"{root}/income_daily", S.INCOME_DAILY, days=(dt, dt)),
        read_table(spark, f"{root}/channel_config", S.CHANNEL_CONFIG),
        payers=scan(spark, f"{root}/first_recharge", S.FIRST_RECHARGE).filter(F.col("dt") <= dt),
    )
    _store(report, root, "first_pay_report", dt)


def returning_day(spark: SparkSession, root: str, dt: int) -> None:
    """Returning-user metrics."""

    def day(name: str, schema: str) -> DataFrame:
        return scan(spark, f"{root}/{name}", schema, days=(dt, dt))

    metrics = returning.returning_metrics(
        day("online", S.ONLINE),
        day("first_visit", S.FIRST_VISIT),
        day("register_detail", S.REGISTER_DETAIL),
        day("recharge", S.RECHARGE),
        day("checksum", S.CHECKSUM),
        day("chat", S.CHAT),
        day("flower", S.FLOWER),
        day("pure_visitor", S.PURE_VISITOR),
        day("pure_visitor_result", S.PURE_VISITOR_RESULT),
    )
    _store(metrics, root, "returning_metrics", dt)


def signup_day(spark: SparkSession, root: str, dt: int, *, per_ip: int, min_seconds: int) -> None:
    """Flagged sign-ups of the day, their summaries, and partner and sub-channel settlement."""

    def whole(name: str, schema: str) -> DataFrame:
        return read_table(spark, f"{root}/{name}", schema)

    start = day_start(spark, dt)
    end = day_start(spark, py_shift(dt, 1)) - 1
    users, status, profile = (
        whole(n, s) for n, s in (("user", S.USER), ("user_status", S.USER_STATUS), ("user_profile", S.USER_PROFILE))
    )
    partners = whole("partner", S.PARTNER)
    seen = [signup.seen_before(users, status, start, end, c) for c in ("lastip", "macaddr")]
    removed = signup.removed_by_history(signup.candidates(users, status, profile, start, end), *seen)
    _store(removed, root, "signup_removed", dt)
    steps = signup.signup_steps(
        users, status, profile, partners, start, end, per_ip=per_ip, min_seconds=min_seconds
    )
    _store(signup.signup_summary(steps, start), root, "signup_summary", dt)
    _store(signup.invalid_signups(steps), root, "signup_invalid", dt)
    _store(signup.valid_signups(steps), root, "signup_detail", dt)
    _store(signup.partner_summary(steps, partners), root, "partner_summary", dt)
    settled = signup.subchannel_settlement(
        steps,
        partners,
        whole("channel_discount", S.CHANNEL_DISCOUNT),
        scan(spark, f"{root}/chat_history", S.CHAT_HISTORY, days=(dt, dt)),
        start,
        end,
    )
    _store(settled, root, "subchannel_settlement", dt)


def _period(df: DataFrame, root: str, name: str, first: int, last: int, *, study: str = "all") -> None:
    """Write the result of a period: a table per first day and study, in it a committed run per last day."""
    replace_day(df, f"{root}/{name}/start_time={first}/study={study}", last)


def period_result(spark: SparkSession, root: str, name: str, schema, first: int, last: int, study: str = "all") -> DataFrame:
    """The stored result of a period; no other period is listed or read."""
    return scan(spark, f"{root}/{name}/start_time={first}/study={study}", schema, days=(last, last)).drop("dt")


def host_earnings_period(spark: SparkSession, root: str, first: int, last: int) -> None:
    """Host earnings per hour from ``first`` to ``last``, both days included."""
    seconds = (day_start(spark, first), day_start(spark, py_shift(last, 1)) - 1)
    result = host_earnings.host_earnings(
        scan(spark, f"{root}/diamonds", S.DIAMONDS, seconds=seconds),
        scan(spark, f"{root}/workload", S.WORKLOAD, days=(first, last)),
        read_table(spark, f"{root}/roster", S.ROSTER),
        *seconds,
    )
    _period(result, root, "host_earnings", first, last)


def _audience(spark: SparkSession, root: str, first: int, last: int, later: int) -> dict[str, DataFrame]:
    """What retention and slots read: logs of the period, of dwell those of ``later`` days after it too."""
    to = py_shift(last, later)
    return {
        "online": scan(spark, f"{root}/online", S.ONLINE, days=(first, last)),
        "dwell": scan(spark, f"{root}/dwell_log", S.DWELL_LOG, days=(first, to)),
        "workload": scan(spark, f"{root}/workload", S.WORKLOAD, days=(first, last)),
        "prices": read_table(spark, f"{root}/channel_price", S.CHANNEL_PRICE),
        "blacklist": read_table(spark, f"{root}/room_blacklist", S.ROOM_LIST),
        "slots": scan(spark, f"{root}/slot_log", S.SLOT_LOG, days=(first, last)),
        "normal": scan(spark, f"{root}/recommend_normal", S.RECOMMENDED, days=(first, last)),
        "fine": scan(spark, f"{root}/recommend_fine", S.RECOMMENDED, days=(first, last)),
    }


def retention_period(
    spark: SparkSession, root: str, first: int, last: int, params: CohortFilter = CohortFilter(), **limits
) -> None:
    """Retention of the viewers of a period; studies under several filters are stored side by side."""
    logs = _audience(spark, root, first, last, limits.get("month", retention.MONTH)[1])
    levels = read_table(spark, f"{root}/room_level", S.ROOM_LEVELS)
    hosts = read_table(spark, f"{root}/host_gender", S.HOST_GENDER)
    result = retention.retention(
        **logs, levels=levels, hosts=hosts, first=first, last=last, params=params, **limits
    )
    _period(result, root, "retention", first, last, study=params.key())


def slots_period(
    spark: SparkSession, root: str, first: int, last: int, params: CohortFilter = CohortFilter(), **limits
) -> None:
    """Audience and slot ranks of the busy rooms of a period."""
    logs = _audience(spark, root, first, last, 0)
    users = retention.cohort(logs.pop("online"), logs.pop("prices"), first, last, params)
    result = slots.slot_report(users, **logs, first=first, last=last, **limits)
    _period(result, root, "slot_report", first, last, study=params.key())
