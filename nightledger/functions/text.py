"""String expressions whose edge cases differ between engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_end(s: Column, back: int, n: int) -> Column:
    """``n`` characters starting ``back`` from the end; empty where the text is shorter than ``back``."""
    return F.when(F.length(s) >= back, F.substring(s, -back, n)).otherwise(F.lit(""))


def starts(s: Column, prefix: str) -> Column:
    return s.startswith(prefix)


def head(s: Column, n: int) -> Column:
    return F.substring(s, 1, n)


def tail(s: Column, n: int) -> Column:
    """Last ``n`` characters, the whole text where it is shorter."""
    return F.right(s, F.lit(n))


def byte_length(s: Column) -> Column:
    return F.octet_length(s)


def to_number(s: Column) -> Column:
    """Text as a number; NULL, and so false in comparisons, where it is none."""
    return s.try_cast("int")


def last_proxy(ip: Column) -> Column:
    """Address after the first comma of a forwarded list ``a, b``."""
    comma = F.locate(",", ip)
    return F.when(comma > 0, F.substring(ip, comma + 2, F.length(ip))).otherwise(ip)


def ip_number(ip: Column) -> Column:
    """Dotted IPv4 address as a number; NULL where malformed."""
    part = F.split(last_proxy(ip), r"\.")
    value = F.lit(0).cast("bigint")
    for i in range(4):
        value = value * 256 + F.get(part, F.lit(i)).try_cast("bigint")
    return F.when(F.size(part) == 4, value)
