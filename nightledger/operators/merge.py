"""Upserts and cumulative state as plain snapshots: old frame in, new frame out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_replace(old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """On a key match take ``cols`` from ``new``; other columns keep their old value."""
    rest = [c for c in old.columns if c not in keys]
    seen = F.col("n._seen")
    joined = old.alias("o").join(new.withColumn("_seen", F.lit(True)).alias("n"), list(keys), "full")
    out = []
    for c in rest:
        old_c = F.col(f"o.{c}")
        if c not in new.columns:
            out.append(old_c.alias(c))
        elif c in cols:
            out.append(F.when(seen, F.col(f"n.{c}")).otherwise(old_c).alias(c))
        else:
            was_there = reduce(lambda a, b: a | b, [F.col(f"o.{k}").isNotNull() for k in keys])
            out.append(F.when(was_there, old_c).otherwise(F.col(f"n.{c}")).alias(c))
    return joined.select(*keys, *out)


def merge_add(
    old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """On a key match add ``cols``; ``keep`` columns stay as first written.

    Sums keep the type of the old column, so a table keeps its schema from day to day.
    """
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    return both.groupBy(*keys).agg(
        *[F.sum(c).cast(old.schema[c].dataType).alias(c) for c in cols],
        *[F.min_by(c, "_age").alias(c) for c in keep],
    )


def merge_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows win; new keys are added."""
    return old.unionByName(new.join(old.select(*keys), list(keys), "left_anti"))


def assemble(parts: Sequence[DataFrame], keys: Sequence[str], default: int | None = 0) -> DataFrame:
    """One wide row per key from frames that each hold some of its metrics.

    A union and one aggregation replace a spine and a join per metric, so the whole
    report costs a single shuffle of already aggregated rows.
    """
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    metrics = [c for c in wide.columns if c not in keys]
    out = wide.groupBy(*keys).agg(*[F.max(c).alias(c) for c in metrics])
    return out if default is None else out.fillna(default, subset=metrics)


def undo_day(df: DataFrame, dt: int, mark: str, cols: Sequence[str]) -> DataFrame:
    """Zero ``cols`` where the marking column says the rerun day set them."""
    set_that_day = F.col(mark) == dt
    return df.withColumns({c: F.when(set_that_day, F.lit(0)).otherwise(F.col(c)) for c in {*cols, mark}})


def roll(old: DataFrame, new: DataFrame, day_start: int, days: int = 31, time: str = "dateline") -> DataFrame:
    """Table of the last ``days`` days: drop what is older, add today's rows."""
    today = F.col(time) >= day_start
    kept = old.filter((F.col(time) >= day_start - days * 86400) & ~today)
    return kept.unionByName(new.filter(today))


def drop_rows(df: DataFrame, cond: Column) -> DataFrame:
    """Delete rows for which ``cond`` is true; rows where it is NULL stay."""
    return df.filter(~F.coalesce(cond, F.lit(False)))
