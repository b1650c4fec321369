"""Write modes for dated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_day(df: DataFrame, path: str, dt: int, created: int | None = None) -> None:
    """Add rows to a day, stamped with the day and, if given, the creation epoch."""
    if created is not None:
        df = df.withColumn("create_time", F.lit(created).cast("bigint"))
    df.withColumn("dt", F.lit(dt)).hint("rebalance").write.mode("append").partitionBy("dt").parquet(path)


def overwrite_day(df: DataFrame, path: str, dt: int) -> None:
    """Replace exactly one day, also when the new result is empty."""
    df.drop("dt").hint("rebalance").write.mode("overwrite").parquet(f"{path}/dt={dt}")


def overwrite_days(df: DataFrame, path: str) -> None:
    """Replace every day present in ``df`` and leave the others alone."""
    (
        df.hint("rebalance", "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a table without days: create it from a result, or empty and refill it."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)
