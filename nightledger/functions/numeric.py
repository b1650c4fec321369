"""Money, ratios and signs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def ratio(num: Column, den: Column, places: int = 2) -> Column:
    """Rounded quotient, 0 where the denominator is 0 or missing."""
    wide = num.cast("decimal(24,4)")
    return F.coalesce(F.round(F.try_divide(wide, den.cast("decimal(20,4)")), places), F.lit(0))


def percent(num: Column, den: Column) -> Column:
    """Quotient times 100, rounded to 2 places."""
    return ratio(num * 100, den)


def hours(seconds: Column) -> Column:
    """Seconds as hours, rounded to 2 places."""
    return F.round(seconds.cast("decimal(24,4)") / F.lit(3600).cast("decimal(10,0)"), 2)


def signed(positive: Column, amount: Column) -> Column:
    return F.when(positive, amount).otherwise(-amount)


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def zero_if_null(*names: str) -> list[Column]:
    return [F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names]


def implies(cond: Column, then: Column) -> Column:
    """True unless ``cond`` holds and ``then`` does not; a NULL ``cond`` counts as not holding."""
    return F.when(cond, then).otherwise(F.lit(True))
