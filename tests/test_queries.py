"""Every registered query against its statement in DuckDB."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from conftest import SMALL
from nightledger.queries import ORACLES, QUERIES

ALL_WITH_ALL_OR_PYTHON = ("BroadcastNestedLoopJoin", "CartesianProduct", "EvalPython", "InPandas", "InArrow")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def as_rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(
        (tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False, name=None)), key=repr
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in ALL_WITH_ALL_OR_PYTHON if node in plan]
    got = df.toPandas()
    want = con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert as_rows(got) == as_rows(want)


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


def test_driver_has_every_query():
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())
