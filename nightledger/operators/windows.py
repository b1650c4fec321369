"""Order-dependent logic per key, reduced before it is ordered so that no key outgrows a task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.functions.dates import slot_start
from nightledger.session import cut_lineage


def first_row(cols: Sequence[str], order: Sequence[str]) -> Column:
    """Aggregate: ``cols`` of the smallest row by ``order``, as the fields of one struct.

    The order leads the struct, so a plain minimum finds the row, and further ties are broken
    by the columns themselves.
    """
    return F.min(F.struct(*[F.col(c).alias(f"_by_{c}") for c in order], *cols))


def gap_dwell(
    df: DataFrame, keys: Sequence[str], time: str, order: str, cap: int, first_cols: Sequence[str] = ()
) -> DataFrame:
    """Dwell time per key: the sum of gaps between consecutive beats, gaps over ``cap`` left out.

    Two beats in the same ``cap``-wide slot are never more than ``cap`` apart, so inside a
    slot the capped gaps add up to last minus first. Beats are therefore reduced to one row
    per (key, slot) with a map-side aggregate, and only these rows are ordered: at most
    86400 / cap + 1 per key and day, however many beats a key sends. ``first_cols`` come
    from the earliest beat, ties broken by ``order``; ``dateline`` is the last beat.
    """
    slots = df.groupBy(*keys, slot_start(F.col(time), cap).alias("_slot")).agg(
        F.min(time).alias("_from"),
        F.max(time).alias("_to"),
        *([first_row(first_cols, [time, order]).alias("_first")] if first_cols else []),
    )
    gap = F.col("_from") - F.lag("_to").over(Window.partitionBy(*keys).orderBy("_slot"))
    joined = slots.withColumn("_gap", gap)
    dwell = F.sum(F.col("_to") - F.col("_from") + F.when(F.col("_gap") <= cap, F.col("_gap")).otherwise(0))
    out = joined.groupBy(*keys).agg(
        *([F.min("_first").alias("_first")] if first_cols else []),
        F.min("_from").alias("first_dateline"),
        F.max("_to").alias("dateline"),
        dwell.alias("room_time"),
    )
    return out.select(
        *keys, *[F.col(f"_first.{c}").alias(c) for c in first_cols], "first_dateline", "dateline", "room_time"
    )


def first_k(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, name: str = "rank") -> DataFrame:
    """First ``k`` rows per key, numbered.

    Each key is limited to ``k`` rows before the shuffle, for every ``k`` in a session of
    ``prepare``, so a busy key sends at most ``k`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def beyond_first_k(df: DataFrame, keys: Sequence[str], order: str, k: int, name: str) -> DataFrame:
    """Flag rows that are not among the first ``k`` of their key; ``order`` is unique per row.

    The kept rows are few and joined back on their unique id, so the key itself is never
    gathered. Rows without a key are never flagged.
    """
    keyed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
    kept = first_k(df.filter(keyed).select(*keys, order), keys, [order], k).select(order, F.lit(0).alias(name))
    return df.join(kept, order, "left").withColumn(
        name, F.when(keyed, F.coalesce(F.col(name), F.lit(1))).otherwise(0)
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by ``order``; partial aggregation, no window."""
    rest = [c for c in df.columns if c not in keys]
    rows = df.groupBy(*keys).agg(first_row(rest, order).alias("_row"))
    return rows.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def drop_later_duplicates(df: DataFrame, keys: Sequence[str], order: str, counted: Column) -> DataFrame:
    """Where a key has several ``counted`` rows, drop every row of that key after the first counted one."""
    firsts = (
        df.filter(counted)
        .groupBy(*keys)
        .agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .drop("_n")
    )
    return (
        df.join(firsts, list(keys), "left")
        .filter(F.col("_first").isNull() | (F.col(order) <= F.col("_first")))
        .select(*df.columns)
    )


def dealt_by_range(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows in parts of about equal size by (keys, order), numbered in that order in ``_part``.

    A part is a range of rows, so a busy key spreads over several. Which rows make a part is decided by sampling; the
    frame is computed once, so that all readers see the same parts.
    """
    ranged = df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
    return cut_lineage(ranged)


def following(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], steps: int = 2) -> DataFrame:
    """``cols`` of the next rows of the same keys in ``next_1`` to ``next_<steps>``; NULL beyond the end of a key.

    Rows must be unique per (keys, order). Windows run inside the parts of :func:`dealt_by_range`, so no key is handled
    in one piece. What a part lacks at its end are the first rows of the parts after it: as many rows as steps of
    each part go through one small window and are carried back to the part before.
    """
    dealt = dealt_by_range(df, keys, order)
    key, row = F.struct(*keys), F.struct(*cols)
    head = Window.partitionBy("_part").orderBy(*keys, *order)
    heads = dealt.select("_part", *dict.fromkeys([*keys, *order, *cols]), F.row_number().over(head).alias("_n"))
    heads = heads.filter(F.col("_n") <= steps).select("_part", "_n", F.struct(key.alias("key"), row.alias("row")).alias("_h"))
    ahead = Window.orderBy("_part", "_n")
    carried = [F.lead("_h", i).over(ahead).alias(f"_c{i}") for i in range(1, steps + 1)]
    last = F.max_by(F.struct(*[f"_c{i}" for i in range(1, steps + 1)]), "_n")
    carry = heads.select("_part", "_n", *carried).groupBy("_part").agg(last.alias("_carry"))

    inside = Window.partitionBy("_part", *keys).orderBy(*order)
    local = [F.lead(row, i).over(inside).alias(f"_l{i}") for i in range(1, steps + 1)]
    placed = dealt.repartitionByRange("_part").select("*", *local).join(carry, "_part", "left")

    def own(i: int) -> Column:
        return F.when(F.col(f"_carry._c{i}.key").eqNullSafe(key), F.col(f"_carry._c{i}.row"))

    known = F.array(*[F.col(f"_l{i}") for i in range(1, steps + 1)], *[own(i) for i in range(1, steps + 1)])
    placed = placed.withColumn("_known", F.filter(known, lambda x: x.isNotNull()))
    nexts = [F.get("_known", i - 1).alias(f"next_{i}") for i in range(1, steps + 1)]
    return placed.select(*df.columns, *nexts)


def dense_ids(df: DataFrame, order: Sequence[str], name: str = "id", after: int = 0) -> DataFrame:
    """Number the rows from ``after`` + 1 without gaps, by ``order``; rows equal in it are numbered in any order.

    Rows are numbered inside the parts of :func:`dealt_by_range`, from an offset that counts the rows of the parts before:
    no task sees more than a part, or one row per part.
    """
    dealt = dealt_by_range(df, [], order)
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    numbered = dealt.repartitionByRange("_part").withColumn("_at", inside).join(offsets, "_part")
    return numbered.select((F.col("_before") + F.col("_at") + F.lit(after)).alias(name), *df.columns)


def consecutive_gaps(df: DataFrame, keys: Sequence[str], time: str, *ties: str) -> DataFrame:
    """Gap to the next row and the gap after that, per key; NULL at the end of a key.

    Rows must be unique per (key, time, ties). A busy key is spread over tasks, see :func:`following`.
    """
    found = following(df, keys, [time, *ties], [time])
    first, second = F.col(f"next_1.{time}"), F.col(f"next_2.{time}")
    return found.select(*df.columns, (first - F.col(time)).alias("gap"), (second - first).alias("next_gap"))


def mark_last(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """1 on the last row of each key; rows unique per (key, time). A busy key is spread over tasks."""
    found = following(df, keys, [time], [time], 1)
    return found.select(*df.columns, F.col("next_1").isNull().cast("int").alias("is_last"))


def rolling_count(df: DataFrame, key: str, day: str, days: int, name: str) -> DataFrame:
    """Rows per (key, day) over that day and the ``days`` before it; ``day`` is a day number.

    Counts are formed per (key, day) first, so the window sees one row per day.
    """
    daily = df.groupBy(key, day).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(key).orderBy(day).rangeBetween(-days, 0)
    return daily.select(key, day, F.sum("_n").over(w).alias(name))


def over_frequent(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Keys with more than ``k`` rows and their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > k)
