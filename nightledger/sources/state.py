"""Cumulative tables as a base and daily deltas, in plain Parquet folders.

A day writes what it adds, one row per key it touched. The state at the end of a day is the newest base up to it,
with the deltas since, merged per key. Every so many days the state is written as the next base. So the bytes of
a day follow the keys of the day, not those of all time.

Merging must not depend on how rows are grouped or ordered: sums, smallest rows, first n. Then a day can be
run again at any time, also out of order. A base knows the last delta commit it was made from; a delta of a covered day
that is committed later makes the base invalid, and readers go back to an older one or to the deltas alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from nightledger.sources.runs import commits, newest, read_runs, replace_day

Merge = Callable[[DataFrame], DataFrame]


class State:
    """One cumulative table: ``merge`` makes one row per key from rows of any days."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, merge: Merge, every: int = 30):
        self.spark, self.merge, self.every = spark, merge, every
        self.schema = StructType([f for f in schema.fields if f.name != "dt"])
        self.base, self.delta = f"{path}/base", f"{path}/delta"

    def write(self, delta: DataFrame, dt: int) -> None:
        """Store what a day adds, instead of what an earlier run of it added, and a new base if it is due."""
        replace_day(delta.select(*self.schema.names), self.delta, dt)
        _, since = self._parts(dt)
        if len(since) >= self.every:
            self.compact(dt)

    def compact(self, dt: int) -> None:
        """Write the state at the end of a day as a base."""
        made = commits(self.spark, self.delta)
        covers = 0 if made is None else made.agg(F.max("seq")).first()[0] or 0
        replace_day(self.at(dt), self.base, dt, covers)

    def at(self, dt: int) -> DataFrame:
        """The table as it stands at the end of a day, also one on which nothing was written."""
        base, since = self._parts(dt)
        rows = read_runs(self.spark, self.delta, self.schema, since)
        if base is not None:
            rows = rows.unionByName(read_runs(self.spark, self.base, self.schema, [base]))
        return self.merge(rows.drop("dt")).select(*self.schema.names)

    def before(self, dt: int) -> DataFrame:
        return self.at(dt - 1)  # days are numbers that keep their order; there is none between

    def _parts(self, dt: int) -> tuple[str | None, list[str]]:
        """Run of the base to start from, and runs of the deltas after it, one row per day and commit."""
        deltas = commits(self.spark, self.delta)
        if deltas is None:
            return None, []
        deltas = [r for r in deltas.filter(F.col("dt") <= dt).collect()]
        made = commits(self.spark, self.base)
        bases = [] if made is None else newest(made.filter(F.col("dt") <= dt)).orderBy(F.desc("dt")).collect()
        start, run = 0, None
        for base in bases:
            if all(d.seq <= base.covers for d in deltas if d.dt <= base.dt):
                start, run = base.dt, base.run
                break
        last = {}
        for d in sorted(deltas, key=lambda d: (d.seq, d.run)):
            last[d.dt] = d.run
        return run, [last[day] for day in sorted(last) if day > start]


def sums(df: DataFrame, keys: list[str], first: dict[str, str] | None = None) -> DataFrame:
    """One row per key: ``first`` maps columns to the column that orders them, smallest first; all others are added up."""
    first = first or {}
    rest = [c for c in df.columns if c not in keys and c not in first and c not in first.values()]
    return df.groupBy(*keys).agg(
        *[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in rest],
        *[F.min_by(c, by).alias(c) for c, by in first.items()],
        *[F.min(by).alias(by) for by in dict.fromkeys(first.values())],
    )
