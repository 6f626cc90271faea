"""Every registered query against its SQL counterpart, run by another engine on the same files."""

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from conftest import SMALL

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}
OVER_THE_STAR = [n for n, sql in driver.oracle_sql().items() if "WITH tx AS" in sql]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    if hasattr(value, "item"):
        value = value.item()
    if value is None or value is pd.NA or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float) and value.is_integer():
        return int(value)  # pandas turns an integer column with gaps into floats
    return pd.Timestamp(value) if hasattr(value, "isoformat") else value


def table(frame, columns):
    return sorted((tuple(normal(v) for v in row) for row in frame[columns].itertuples(index=False, name=None)), key=repr)


def assert_agrees(spark, db, name):
    df = driver.queries()[name](spark, SMALL)
    result = db.execute(driver.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    columns = sorted(types)
    assert table(df.toPandas(), columns) == table(result.df(), columns)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_agrees_with_sql(spark, db, name):
    assert_agrees(spark, db, name)


@pytest.mark.parametrize("name", sorted(OVER_THE_STAR))
def test_query_agrees_with_sql_when_no_dimension_fits_a_broadcast(spark, db, setting, name):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert_agrees(spark, db, name)


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_query_without_sql_counterpart_returns_rows(spark, name):
    assert driver.queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert driver.entry(spark).columns == ["category", "total_revenue", "transaction_count", "avg_transaction_value"]
