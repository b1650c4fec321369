"""Column expressions: the edge cases that differ between engines."""

import datetime

from pyspark.sql import functions as F

from nightledger.functions import channel as ch
from nightledger.functions import dates, numeric, text
from nightledger.functions.filters import EXCLUDE, CohortFilter


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()[0]


def test_from_end_is_empty_when_the_text_is_shorter(spark):
    assert one(spark, lambda v: text.from_end(v, 6, 4), "abc") == ""
    assert one(spark, lambda v: text.from_end(v, 6, 4), "xx213801") == "2138"


def test_text_that_is_no_number_compares_as_false(spark):
    assert one(spark, lambda v: ch.version_gate(v), "s102027a3100101") is False
    assert one(spark, lambda v: ch.version_gate(v), "s10202753100101") is True
    assert one(spark, lambda v: ch.version_gate(v), "s1") is False
    assert one(spark, lambda v: ch.version_gate(v), "10301700100101") is True


def test_length_counts_bytes(spark):
    assert one(spark, text.byte_length, "安卓") == 6


def test_ratio_guards_and_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 0), (1, 8), (None, 3), (2, 3)], "a int, b int")
    got = [float(r[0]) for r in df.select(numeric.ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.0, 0.13, 0.0, 0.67]
    assert float(one(spark, lambda v: numeric.percent(v, F.lit(3)), 1, "int")) == 33.33
    assert float(one(spark, numeric.hours, 4518, "int")) == 1.26


def test_ip_number_takes_the_last_proxy(spark):
    assert one(spark, text.ip_number, "10.0.0.1, 1.2.3.4") == 16909060
    assert one(spark, text.ip_number, "1.2.3.4") == 16909060
    assert one(spark, text.ip_number, "1.2.3") is None
    assert one(spark, text.ip_number, "a.b.c.d") is None


def test_dates(spark):
    assert one(spark, lambda v: dates.dt_to_epoch(v), 20160520, "int") == 1463702400
    assert one(spark, lambda v: dates.epoch_to_dt(v), 1463702400 + 86399, "bigint") == 20160520
    assert one(spark, lambda v: dates.shift_dt(v, 1), 20160229, "int") == 20160301
    assert one(spark, lambda v: dates.shift_dt(v, -1), 20160101, "int") == 20151231
    assert one(spark, dates.dt_to_date, 20160101, "int") == datetime.date(2016, 1, 1)
    assert dates.py_shift(20151231, 1) == 20160101 and dates.days_between(20160228, 20160301) == 3
    assert one(spark, dates.hour_of, 1463702400 + 7200, "bigint") == 2


def test_days_follow_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert one(spark, lambda v: dates.dt_to_epoch(v), 20160520, "int") == 1463702400 - 8 * 3600
        assert one(spark, dates.epoch_to_dt, 1463702400 - 1, "bigint") == 20160520
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def parse(spark, value):
    return tuple(one(spark, ch.parse_channel, value))


def test_channel_layouts(spark):
    assert parse(spark, "20000101") == (1, 0, 2000, 101)
    assert parse(spark, "10301760100002") == (1, 760, 1000, 2)
    assert parse(spark, "s10202753102000") == (2, 753, 1020, 0)
    assert parse(spark, "s1020275302130123") == (2, 753, 2130, 123)
    assert parse(spark, "10102760100100") == (3, 760, 1001, 0)
    assert parse(spark, "1010276021310045") == (3, 760, 2131, 45)
    assert parse(spark, "10135760100107") == (4, 760, 1001, 7)
    assert parse(spark, "10135") == (0, 0, 0, 0)


def test_normalise_cuts_to_the_layout(spark):
    for raw, want in {
        "s10202753102000extra": "s10202753102000",
        "s1020275302130123extra": "s1020275302130123",
        "20000101extra": "20000101",
        "10102760100100extra": "10102760100100",
        "unknown1": "0",
    }.items():
        assert one(spark, ch.normalise_channel, raw) == want


def test_channel_cleaning(spark):
    for bad in ("0", "EN_APP_KEY_PLACEHOLDER", "1234567", "123456789012345678", "1234.5678", "1234_5678", "1234%5678"):
        assert one(spark, ch.valid_channel, bad) is False
    assert one(spark, ch.valid_channel, "12345678") is True
    for bad in (None, "0", "", "yibao", "EN_APP_KEY_PLACEHOLDER", "s10202753213801"):
        assert one(spark, ch.junk_channel, bad) is True


def test_parent_and_child_keys(spark):
    assert one(spark, ch.parent_code, "20000101") == "2000"
    assert one(spark, ch.parent_code, "s10202753102007") == "1020"
    assert one(spark, ch.sub_code, "s10202753102007") == "102007"
    assert one(spark, ch.sub_code, "20000101") == "20000101"


def test_device_mismatch_and_old_versions(spark):
    assert one(spark, lambda v: ch.device_mismatch(v, F.lit(2)), "s10202753102007") is False
    assert one(spark, lambda v: ch.device_mismatch(v, F.lit(3)), "s10202753102007") is True
    assert one(spark, lambda v: ch.device_mismatch(v, F.lit(3)), "10102760100100") is False
    assert one(spark, ch.below_settled_version, "s10202762102007") is True
    assert one(spark, ch.below_settled_version, "s10202763102007") is False


def test_cohort_filter(spark, rows):
    ids = ["s10202753102007", "10102760100100", "10301760100301", "20030101", "s10202753213801"]
    df = spark.createDataFrame([(c,) for c in ids], "c string")

    def kept(**kw):
        return [r[0] for r in rows(df.filter(CohortFilter(**kw).predicate(F.col("c"))))]

    assert len(kept()) == 4  # the excluded code never counts
    assert kept(device=2) == ["s10202753102007"]
    assert kept(device=1) == ["10301760100301", "20030101"]
    assert kept(parents=("1020", "2003")) == ["20030101", "s10202753102007"]
    assert kept(device=1, children=("100301",), child_mode=EXCLUDE) == ["20030101"]
