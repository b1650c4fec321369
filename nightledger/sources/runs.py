"""Days replaced as a whole: written beside the old ones, then committed.

A run of a day writes its rows into a folder of its own, ``dt=<day>/run=<id>``, and then adds one row to the table of
commits, ``_commits``, as one small Parquet file. Readers take the newest committed run of each day. So a run that
fails at any point leaves the day as it was, a reader that has started is not disturbed by a rerun, and nothing is
renamed or deleted, which object stores cannot do at once. Runs that are no longer read are listed by
:func:`superseded`; removing their folders is left to the store.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

COMMITS = "dt int, run string, seq bigint, covers bigint"


def commits(spark: SparkSession, path: str) -> DataFrame | None:
    """Every commit of a table, None for a table without any."""
    try:
        return spark.read.schema(COMMITS).parquet(f"{path}/_commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def newest(made: DataFrame) -> DataFrame:
    """The commit that counts for each day: the last one, the smaller run first among equals."""
    order = F.struct(F.col("seq"), F.col("run"))
    return made.groupBy("dt").agg(F.max_by(F.struct("run", "seq", "covers"), order).alias("c")).select("dt", "c.*")


def stage(df: DataFrame, path: str, dt: int) -> str:
    """Write the rows of a day where no reader looks yet; the id of the run."""
    run = uuid.uuid4().hex
    df.drop("dt").hint("rebalance").write.parquet(f"{path}/dt={dt}/run={run}")
    return run


def commit(spark: SparkSession, path: str, dt: int, run: str, covers: int | None = None) -> int:
    """Make a staged run the one that readers take, from now on."""
    made = commits(spark, path)
    last = 0 if made is None else made.agg(F.max("seq")).first()[0] or 0
    row = spark.createDataFrame([(dt, run, last + 1, covers)], COMMITS)
    row.coalesce(1).write.mode("append").parquet(f"{path}/_commits")
    return last + 1


def replace_day(df: DataFrame, path: str, dt: int, covers: int | None = None) -> int:
    """Replace exactly one day, also when the new result is empty; the number of the commit."""
    return commit(df.sparkSession, path, dt, stage(df, path, dt), covers)


def read_runs(spark: SparkSession, path: str, schema: StructType, runs: list[str]) -> DataFrame:
    """Rows of the runs with their day, read from their folders alone."""
    full = StructType([f for f in schema.fields if f.name not in ("dt", "run")])
    full = full.add("dt", IntegerType()).add("run", StringType())
    if not runs:
        return spark.createDataFrame([], full).drop("run")
    return spark.read.schema(full).parquet(path).filter(F.col("run").isin(runs)).drop("run")


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """Day and run of the commits that a later one has replaced."""
    made = commits(spark, path)
    if made is None:
        return spark.createDataFrame([], "dt int, run string")
    return made.join(newest(made).select("dt", "run"), ["dt", "run"], "left_anti").select("dt", "run")
