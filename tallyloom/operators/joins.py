"""Joins: size-checked broadcast, lookups, hot keys, self-join results without the pairs."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.measures import UNITS, is_double, units
from tallyloom.sources.tables import largest_bucket, table_location, table_options

BROADCAST_LIMIT = 25_000_000
_SALT = "_salt"
_COUNTABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType, T.TimestampType, T.DecimalType)  # key types of the sketch


def plan_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate; None where the session gives no access to its plans."""
    if not hasattr(df, "_jdf"):
        return None
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_threshold(spark: SparkSession) -> int:
    """The session's own automatic broadcast limit in bytes, -1 where it is switched off."""
    conf = spark._jsparkSession.sessionState().conf()
    return int(conf.autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the estimated size lies below ``limit`` (the session's automatic limit by default)."""
    if limit is None:
        limit = broadcast_threshold(df.sparkSession)
    size = plan_bytes(df)
    return size is not None and size <= limit


def enrich(fact: DataFrame, dim: DataFrame, key: str | Sequence[str], how: str = "inner", limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Fact rows with the columns of a dimension; works on a stream with a static dimension too.

    The dimension is broadcast when its estimated size is within ``limit``; a larger one is shuffled by key, where
    adaptive execution splits hot partitions.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return fact.join(F.broadcast(dim) if fits_broadcast(dim, limit) else dim, keys, how)


def enrich_hot_keys(
    fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", share: float = 0.001, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """:func:`enrich` for a large dimension with one row per key, when a few keys hold much of the fact table.

    One pass finds the keys with more than ``share`` of the rows by a frequent-items sketch, of bounded size however many
    keys there are. The join is then a single shuffled one on the key and a salt: a hot key's fact rows are spread over one salt
    per ``share`` they hold, and its dimension row is repeated for each, so all repeats together are at most ``2 / share``. A salt
    follows from the row's values and its task's number, so a task that runs again gives the same ones. Null keys match nothing
    and are spread too. A key that the sketch misses or overrates is only spread worse, never joined wrongly.
    """
    if fits_broadcast(dim, limit):
        return enrich(fact, dim, key, how, limit)
    if how not in ("inner", "left"):
        raise ValueError("inner and left joins only")
    if not isinstance(fact.schema[key].dataType, _COUNTABLE):
        return fact.join(dim, key, how)
    most = math.ceil(1 / share)
    name = key.replace("`", "``")
    sketch = F.expr(f"approx_top_k(`{name}`, {most}, {min(10 * most, 1_000_000)})")
    top, rows = fact.filter(F.col(key).isNotNull()).agg(sketch, F.count(F.lit(1))).first()
    copies = {r["item"]: math.ceil(r["count"] / (share * rows)) for r in top if r["count"] > share * rows}
    if not copies:
        return fact.join(dim, key, how)
    hot = F.col(key).isin(list(copies))
    if dim.filter(hot).limit(len(copies) + 1).count() > len(copies):
        raise ValueError("the dimension must hold one row per key")
    kind = fact.schema[key].dataType
    number = F.create_map(*[F.lit(v) for pair in copies.items() for v in pair]).cast(T.MapType(kind, T.IntegerType()))
    spread = F.when(hot, F.element_at(number, F.col(key).try_cast(kind))).otherwise(1)  # the dimension's key may be wider
    drawn = F.xxhash64(F.spark_partition_id(), *[c for c in fact.columns if "map<" not in fact.schema[c].dataType.simpleString()])
    salted = fact.withColumn(_SALT, F.pmod(drawn, F.when(F.col(key).isNull(), most).otherwise(spread)))
    repeated = dim.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("long"), (spread - 1).cast("long"))))
    return salted.join(repeated, [key, _SALT], how).drop(_SALT)


def repeat_day_customers(
    tx: DataFrame,
    customer: str = "customer_id",
    day: str = "transaction_date",
    product: str = "product_id",
    amount: str = "total_amount",
) -> DataFrame:
    """What joining transactions to themselves on the customer with differing days adds up to, without the pairs.

    A row counts once for every row of its customer on another day: per customer, with N rows, n rows and sum s on one
    day, the total is the sum of s * (N - n) over the days. Products are those of customers with two days or more. Rows
    without customer or day match nothing. One pass: days and products are two grouping sets of one pre-aggregated
    exchange.
    """
    # Whole numbers of the amount's smallest unit.
    kind = tx.schema[amount].dataType
    per_one = UNITS if is_double(tx, amount) else 10 ** getattr(kind, "scale", 0)
    amounts = units(F.col(amount)) if is_double(tx, amount) else (F.col(amount) * per_one).cast("long")
    kept = tx.filter(F.col(customer).isNotNull() & F.col(day).isNotNull()).select(customer, day, product, amounts.alias("units"))
    items = kept.groupingSets([[customer, day], [customer, product]], customer, day, product).agg(
        F.grouping(day).alias("by_product"), F.count(F.lit(1)).alias("n"), F.sum("units").alias("s")
    )
    on_day = F.col("by_product") == 0
    # Products of sums and counts outgrow a long, so from here on they are whole-number decimals.
    rows, spent = F.col("n").cast("decimal(15,0)"), F.col("s").cast("decimal(20,0)")
    per_customer = items.groupBy(customer).agg(
        F.sum(F.when(on_day, F.col("n"))).cast("decimal(15,0)").alias("rows"),
        F.sum(F.when(on_day, F.col("s"))).cast("decimal(20,0)").alias("spent"),
        F.sum(F.when(on_day, rows * spent)).alias("same_day"),
        F.count(F.when(on_day, F.lit(1))).alias("days"),
        F.count(F.when(~on_day, F.col(product))).alias("unique_products"),
    )
    return per_customer.filter(F.col("days") > 1).select(
        customer, "unique_products", ((F.col("spent") * F.col("rows") - F.col("same_day")).cast("double") / per_one).alias("total_spent")
    )


def customer_product_breadth(tx: DataFrame, customer: str = "customer_id", product: str = "product_id") -> DataFrame:
    """Distinct products per customer.

    Joining the table to itself on the customer first would change nothing but drop null customers. On a table bucketed
    by customer the plan holds no exchange.
    """
    return tx.filter(F.col(customer).isNotNull()).groupBy(customer).agg(F.countDistinct(product).alias("unique_products"))


MAX_BUCKET_BYTES = 4 * 1024**3


def bucketed_scan(spark: SparkSession, table: str, max_bucket_bytes: int = MAX_BUCKET_BYTES) -> DataFrame:
    """A bucketed table, read by bucket while every bucket is of a size one task bears.

    A bucketed scan ties a whole bucket to one task. When one is larger (a hot key, or too few buckets) the table's
    files are read as plain files instead; what follows then shuffles, pre-aggregates and splits hot partitions.
    """
    if largest_bucket(spark, table) <= max_bucket_bytes:
        return spark.table(table)
    provider, path = table_location(spark, table)
    return spark.read.schema(spark.table(table).schema).format(provider).options(**table_options(spark, table)).load(path)


def bucketed_join(
    spark: SparkSession, left: str, right: str, key: str, how: str = "inner", max_bucket_bytes: int = MAX_BUCKET_BYTES
) -> DataFrame:
    """Join of two tables bucketed alike on ``key``: no exchange, unless a bucket is too large (see :func:`bucketed_scan`)."""
    if max(largest_bucket(spark, t) for t in (left, right)) > max_bucket_bytes:
        max_bucket_bytes = -1
    return bucketed_scan(spark, left, max_bucket_bytes).join(bucketed_scan(spark, right, max_bucket_bytes), key, how)
