"""Epoch seconds, yyyymmdd integers and their parts, in the session time zone."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400
HALF_DAY = 43200


def epoch(ts: Column) -> Column:
    """Epoch seconds of a timestamp, with or without zone."""
    return F.unix_timestamp(ts.cast("timestamp"))


def date_to_dt(d: Column) -> Column:
    """yyyymmdd integer of a date, by arithmetic rather than formatting."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.day(d)


def epoch_to_dt(e: Column) -> Column:
    """yyyymmdd integer of an epoch."""
    return date_to_dt(F.timestamp_seconds(e).cast("date"))


def dt_to_date(dt: Column) -> Column:
    """Calendar date of a yyyymmdd integer."""
    day = dt % 100
    month = (dt % 10000 - day) / 100
    year = (dt - dt % 10000) / 10000
    return F.make_date(year.cast("int"), month.cast("int"), day.cast("int"))


def dt_to_epoch(dt: Column) -> Column:
    """Epoch of the first second of a yyyymmdd day."""
    return F.unix_timestamp(dt_to_date(dt).cast("timestamp"))


def next_day(e: Column) -> Column:
    """Epoch of the first second of the day after that of an epoch."""
    return F.unix_timestamp(F.date_add(F.timestamp_seconds(e).cast("date"), 1).cast("timestamp"))


def shift_dt(dt: Column, days: int) -> Column:
    """yyyymmdd integer ``days`` later."""
    return date_to_dt(F.date_add(dt_to_date(dt), days))


def day_number(dt: Column) -> Column:
    """Days since 1970-01-01, for windows that range over days."""
    return F.unix_date(dt_to_date(dt))


def slot_start(t: Column, width: int) -> Column:
    """First second of the ``width``-wide slot a time falls in, in whole numbers."""
    return t - F.pmod(t, F.lit(width))


def hour_of(e: Column) -> Column:
    return F.hour(F.timestamp_seconds(e))


def year_of(e: Column) -> Column:
    return F.year(F.timestamp_seconds(e))


def month_of(e: Column) -> Column:
    return F.month(F.timestamp_seconds(e))


def day_of(e: Column) -> Column:
    return F.day(F.timestamp_seconds(e))


def py_date(dt: int) -> _dt.date:
    """Python date of a yyyymmdd parameter."""
    return _dt.datetime.strptime(str(dt), "%Y%m%d").date()


def py_shift(dt: int, days: int) -> int:
    """yyyymmdd parameter ``days`` later."""
    return int((py_date(dt) + _dt.timedelta(days=days)).strftime("%Y%m%d"))


def days_between(first: int, last: int) -> int:
    """Number of days in the closed range of two yyyymmdd parameters."""
    return (py_date(last) - py_date(first)).days + 1
