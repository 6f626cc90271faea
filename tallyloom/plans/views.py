"""The star tables seen as transactions, application logs and sensor readings.

Dimensions are joined only when one of their columns is asked for. All joins are left joins on the dimension's unique
key, so a join that is left out never changes the number of fact rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.measures import summed
from tallyloom.operators.joins import fits_broadcast
from tallyloom.sources.readers import load

_FACT: dict[str, Column] = {}
_ORDER: dict[str, Column] = {}
_PRODUCT: dict[str, Column] = {}


def _columns() -> tuple[dict[str, Column], dict[str, Column], dict[str, Column]]:
    """Transaction columns by the table that supplies them (built on first use, once a session exists)."""
    if not _FACT:
        day = F.col("o_orderdate").cast("date")
        _FACT.update(
            transaction_id=F.concat_ws("-", "l_orderkey", "l_linenumber"),
            product_id=F.col("l_partkey"),
            quantity=F.col("l_quantity").cast("int"),
            total_amount=F.col("l_extendedprice"),
            discount=F.round(F.col("l_discount") * 300),
        )
        _ORDER.update(
            customer_id=F.col("o_custkey"),
            transaction_date=day,
            year=F.year(day),
            month=F.month(day),
            day=F.dayofmonth(day),
            payment_method=F.col("o_orderpriority"),
            city=F.col("n_name"),
        )
        _PRODUCT.update(
            product_name=F.col("p_name"),
            category=F.col("p_type"),
            unit_price=F.col("p_retailprice"),
        )
    return _FACT, _ORDER, _PRODUCT


def transaction_columns() -> list[str]:
    return [name for group in _columns() for name in group]


def _lookup(rows: DataFrame, dim: DataFrame, on: Column, base: DataFrame) -> DataFrame:
    """Left join to a dimension with one row per row of the table ``base``, broadcast if that table is small enough.

    The optimizer's own estimate for a joined dimension is the product of its inputs, so the base table is measured.
    """
    return rows.join(F.broadcast(dim) if fits_broadcast(base) else dim, on, "left")


def _orders(spark: SparkSession, sf_dir: str, wanted: Iterable[str]) -> DataFrame:
    """Orders with the wanted transaction columns; cities are joined here, before the far larger fact table."""
    wanted = list(wanted)
    orders = load(spark, sf_dir, "orders")
    if "city" in wanted:
        customers = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        nations = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        cities = _lookup(customers, nations, F.col("c_nationkey") == F.col("n_nationkey"), nations)
        orders = _lookup(orders, cities, F.col("o_custkey") == F.col("c_custkey"), customers)
    return orders.select("o_orderkey", *[_columns()[1][c].alias(c) for c in wanted])


def _base(spark: SparkSession, sf_dir: str, columns: Iterable[str]) -> DataFrame:
    """The order columns that the view takes: what a broadcast of that dimension would hold, before cities are joined to it."""
    columns = list(columns)
    city = [F.lit(" " * 25).alias("city")] * ("city" in columns)
    return _orders(spark, sf_dir, [c for c in columns if c != "city"]).select("*", *city)


def _products(spark: SparkSession, sf_dir: str, wanted: Iterable[str]) -> DataFrame:
    return load(spark, sf_dir, "part").select("p_partkey", *[_columns()[2][c].alias(c) for c in wanted])


def transactions(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per transaction with the given columns (all by default)."""
    wanted = list(columns) if columns is not None else transaction_columns()
    fact_cols, order_cols, product_cols = _columns()
    unknown = [c for c in wanted if not any(c in group for group in (fact_cols, order_cols, product_cols))]
    if unknown:
        raise ValueError(f"unknown transaction columns: {unknown}")
    from_orders = [c for c in wanted if c in order_cols]
    from_products = [c for c in wanted if c in product_cols]
    rows = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", *[fact_cols[c].alias(c) for c in wanted if c in fact_cols]
    )
    if from_orders:
        orders = _orders(spark, sf_dir, from_orders)
        rows = _lookup(rows, orders, F.col("l_orderkey") == F.col("o_orderkey"), _base(spark, sf_dir, from_orders))
    if from_products:
        products = _products(spark, sf_dir, from_products)
        rows = _lookup(rows, products, F.col("l_partkey") == F.col("p_partkey"), products)
    return rows.select(*wanted)


def transaction_totals(
    spark: SparkSession, sf_dir: str, by: Iterable[str], measures: Iterable[str] = ("total_amount",)
) -> DataFrame:
    """Transactions for aggregation by the columns ``by``, summed to the join key first where that saves work.

    If every column of ``by`` comes from one dimension that is too large to broadcast, the fact rows are summed per key
    of that dimension before the join. The join then reuses the aggregation's exchange, ships one row per key and has
    no hot key left. Otherwise plain transactions are returned; ``functions.measures`` reads both.
    """
    by, measures = list(by), list(measures)
    fact_cols, order_cols, product_cols = _columns()
    if all(c in product_cols for c in by):
        key, other_key = "l_partkey", "p_partkey"
        dimension = base = _products(spark, sf_dir, by)
    elif all(c in order_cols for c in by):
        key, other_key = "l_orderkey", "o_orderkey"
        dimension, base = _orders(spark, sf_dir, by), _base(spark, sf_dir, by)
    else:
        return transactions(spark, sf_dir, [*by, *measures])
    if any(m not in fact_cols for m in measures) or fits_broadcast(base):
        return transactions(spark, sf_dir, [*by, *measures])
    rows = load(spark, sf_dir, "lineitem").select(key, *[fact_cols[m].alias(m) for m in measures])
    return summed(rows, [key], measures).join(dimension, F.col(key) == F.col(other_key), "left").drop(key, other_key)


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as application log records; some response times are missing so that null handling shows."""
    levels = F.create_map(
        *[F.lit(x) for pair in (("error", "ERROR"), ("signup", "CRITICAL"), ("purchase", "WARN"), ("view", "INFO"), ("click", "DEBUG")) for x in pair]
    )
    response = F.when(F.col("event_id") % 103 != 0, F.floor(F.col("value") * 20).cast("int"))
    return load(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.try_element_at(levels, F.col("event_type")).alias("level"),
        F.concat(F.lit("svc-"), (F.col("user_id") % 12).cast("string")).alias("service"),
        F.col("props").alias("message"),
        response.alias("response_time_ms"),
        response.isNotNull().alias("is_valid"),
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sensor readings, with missing and malformed ids and missing temperatures."""
    k = F.get_json_object("props", "$.k").cast("int")
    event_id, user_id = F.col("event_id"), F.col("user_id")
    sensor = F.concat(F.lit("SENS"), F.lpad((user_id % 1000).cast("string"), 3, "0"))
    return load(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.when(event_id % 97 == 0, F.lit(None)).when(event_id % 89 == 0, F.lit("BAD")).otherwise(sensor).alias("sensor_id"),
        F.concat(F.lit("B"), (user_id % 5).cast("string")).alias("building"),
        F.concat(F.lit("F"), (user_id % 7).cast("string")).alias("floor"),
        F.when(event_id % 101 != 0, F.col("value") - 50).alias("temperature"),
        (k + 10).cast("double").alias("humidity"),
        k.alias("battery_level"),
    )
