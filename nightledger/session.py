"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """Set the runtime options every job assumes and return the same session.

    Day boundaries are taken in the session time zone, so it is always set
    explicitly. Adaptive execution sizes the shuffles, turns joins with a small
    measured side into broadcasts and splits skewed join partitions, also where
    that costs one more exchange. Windows that keep the first k rows of a key limit
    each key before the shuffle, whatever k is.
    """
    spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(2**31 - 1))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, which the cluster names in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise ValueError("spark.checkpoint.dir names no shared folder")
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from a reliable checkpoint.

    Jobs call this on frames they read several times. The checkpoint goes to the shared folder,
    so it survives the loss of executors; without one the call is an error, on every kind of cluster.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
