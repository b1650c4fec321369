"""Range scans that prune partitions and survive missing days."""

from __future__ import annotations

import calendar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from nightledger.functions.dates import epoch_to_dt
from nightledger.sources.runs import commits, newest, read_runs

Schema = StructType | str


def read_table(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """Table at ``path`` with an explicit schema; a table nobody has written yet is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def with_dt(schema: Schema) -> Schema:
    """The schema with the day partition as its last column."""
    if isinstance(schema, str):
        return f"{schema}, dt int"
    return StructType([f for f in schema.fields if f.name != "dt"]).add("dt", IntegerType())


def scan(
    spark: SparkSession,
    path: str,
    schema: Schema,
    *,
    days: tuple[int, int] | None = None,
    seconds: tuple[int, int] | None = None,
    time: str = "dateline",
) -> DataFrame:
    """Rows of the closed day range and closed epoch range.

    Either bound becomes a partition filter on ``dt``, so only the days asked for are
    listed and read; days without a partition contribute no rows. Of a table whose days are committed,
    see :mod:`nightledger.sources.runs`, the newest committed run of each day is read.
    """
    made = commits(spark, path)
    if made is None:
        rows = read_table(spark, path, with_dt(schema))
    else:
        if days is not None:
            made = made.filter(F.col("dt").between(*days))
        kind = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
        rows = read_runs(spark, path, kind, [r.run for r in newest(made).collect()])  # one row per day
    return in_range(rows, days=days, seconds=seconds, time=time)


def in_range(
    df: DataFrame,
    *,
    days: tuple[int, int] | None = None,
    seconds: tuple[int, int] | None = None,
    time: str = "dateline",
) -> DataFrame:
    """Rows of ``df`` in the closed day range and closed epoch range, a filter on ``dt`` in either case."""
    if days is not None:
        df = df.filter(F.col("dt").between(*days))
    if seconds is not None:
        first, last = seconds
        df = df.filter(
            F.col("dt").between(epoch_to_dt(F.lit(first)), epoch_to_dt(F.lit(last)))
            & F.col(time).between(first, last)
        )
    return df


def scan_month(spark: SparkSession, path: str, schema: Schema, month: int) -> DataFrame:
    """One yyyymm month."""
    return scan(spark, path, schema, days=month_days(month))


def month_days(month: int) -> tuple[int, int]:
    """First and last day of a yyyymm month."""
    return month * 100 + 1, month * 100 + calendar.monthrange(*divmod(month, 100))[1]


def scan_year(spark: SparkSession, path: str, schema: Schema, year: int) -> DataFrame:
    return scan(spark, path, schema, days=(year * 10000 + 101, year * 10000 + 1231))


def snapshot_before(spark: SparkSession, path: str, schema: Schema, dt: int) -> DataFrame:
    """Cumulative table as it stood at the end of the last day written before ``dt``.

    Running totals are written as one snapshot per day and each day starts from the one
    before, so running a day again gives the same snapshot. After such a rerun the days
    that follow have to be run again as well.
    """
    last = max((d for d in stored_days(spark, path) if d < dt), default=0)
    return scan(spark, path, schema, days=(last, last)).drop("dt")


def stored_days(spark: SparkSession, path: str) -> list[int]:
    """Days that are committed, or have a partition in a table without commits.

    The latter are read from the names of the folders, through the JVM of a classic session.
    """
    made = commits(spark, path)
    if made is not None:
        return sorted(r.dt for r in made.select("dt").distinct().collect())
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(folder) if entry.isDirectory()]
    return sorted(int(n[3:]) for n in names if n.startswith("dt=") and n[3:].isdigit())
