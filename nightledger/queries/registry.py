"""Registry of queries: a Spark function and, where SQL can say it, the checking statement."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, IntegralType

from nightledger.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and decimals as double, so that results compare across engines."""
    out = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, (IntegralType, BooleanType)):
            col = col.cast("bigint")
        out.append(col.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_types(fn(prepare(spark), sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def out(ctes: list[str], body: str, big: str = "", dbl: str = "", txt: str = "") -> str:
    """SQL statement from named parts, its columns cast to bigint, double and text."""
    cols = [f"CAST({c} AS BIGINT) AS {c}" for c in big.split()]
    cols += [f"CAST({c} AS DOUBLE) AS {c}" for c in dbl.split()]
    cols += txt.split()
    return f"WITH {', '.join(ctes)} SELECT {', '.join(cols)} {body}"
