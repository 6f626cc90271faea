"""Named queries over a data folder, each with the SQL that must give the same result where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The star tables as the views of ``plans.views``, in plain SQL.
TX = """WITH tx AS (
  SELECT concat(l_orderkey, '-', l_linenumber) AS transaction_id, o_custkey AS customer_id, l_partkey AS product_id,
         p_name AS product_name, p_type AS category, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price, CAST(l_extendedprice AS DECIMAL(12,2)) AS total_amount,
         CAST(o_orderdate AS DATE) AS transaction_date, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day,
         n_name AS city, o_orderpriority AS payment_method, round(l_discount * 300) AS discount
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON l_partkey = p_partkey)
"""
LOGS = """WITH logs AS (
  SELECT event_id, ts AS timestamp,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'CRITICAL' WHEN 'purchase' THEN 'WARN'
                         WHEN 'view' THEN 'INFO' WHEN 'click' THEN 'DEBUG' END AS level,
         concat('svc-', user_id % 12) AS service, props AS message,
         CASE WHEN event_id % 103 <> 0 THEN CAST(floor(value * 20) AS INTEGER) END AS response_time_ms,
         event_id % 103 <> 0 AS is_valid
  FROM events)
"""
SENSORS = """WITH sensors AS (
  SELECT event_id, ts AS timestamp,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'BAD'
              ELSE concat('SENS', lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0')) END AS sensor_id,
         concat('B', user_id % 5) AS building, concat('F', user_id % 7) AS floor,
         CASE WHEN event_id % 101 <> 0 THEN value - 50 END AS temperature,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) + 10 AS DOUBLE) AS humidity,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS battery_level
  FROM events)
"""


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and timestamps without zone, the types the SQL side yields."""
    casts = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            casts[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            casts[field.name] = F.col(field.name).cast("timestamp_ntz")
    return df.withColumns(casts) if casts else df


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def add(build: Query) -> Query:
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = lambda spark, sf_dir: plain(build(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def load_all() -> None:
    """Import the modules that register queries."""
    from tallyloom.plans import file_queries, layout_queries, merge_queries, record_queries, sales_queries, stream_queries  # noqa: F401
