"""Aggregations that recur across the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions.dates import slot_start
from nightledger.functions.numeric import count_if, sum_if


def pivot_sums(code: str, value: str, values: Sequence[int], prefix: str) -> list[Column]:
    """Sum of ``value`` per code, as one column each."""
    return [sum_if(F.col(code) == v, F.col(value)).alias(f"{prefix}_{v}") for v in values]


def pivot_counts(code: str, value: str, values: Sequence[int], prefix: str) -> list[Column]:
    """Rows with a positive ``value`` per code."""
    return [count_if((F.col(code) == v) & (F.col(value) > 0)).alias(f"{prefix}_{v}") for v in values]


def distinct_if(df: DataFrame, keys: Sequence[str], item: str, conds: dict[str, Column]) -> DataFrame:
    """Several conditional distinct counts of one item in two aggregations and no row expansion.

    Rows are reduced to (key, item) with one flag per condition, then the flags are summed;
    the first step spreads a busy key over its items.
    """
    flags = df.filter(F.col(item).isNotNull()).groupBy(*keys, item).agg(
        *[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in conds.items()]
    )
    return flags.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in conds])


def with_total_row(df: DataFrame, keys: Sequence[str], reserved: dict[str, Column], sums: Sequence[str]) -> DataFrame:
    """Append one row per ``keys`` with sums over all rows; ``reserved`` fills the other columns."""
    total = df.groupBy(*keys).agg(*[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in sums])
    for name, value in reserved.items():
        total = total.withColumn(name, value)
    return df.unionByName(total, allowMissingColumns=True)


def time_bucket_count(df: DataFrame, keys: Sequence[str], time: str, width: int, name: str) -> DataFrame:
    """Distinct time buckets in which a key was seen."""
    buckets = df.select(*keys, slot_start(F.col(time), width).alias("_b")).distinct()
    return buckets.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def span(df: DataFrame, keys: Sequence[str], time: str, name: str) -> DataFrame:
    """Seconds between the first and last row of a key."""
    return df.groupBy(*keys).agg((F.max(time) - F.min(time)).alias(name))
