"""Transaction analytics.

Every operator is one aggregation over one scan. Those built on ``row_count``/``mean`` take plain transactions or
transaction totals (``functions.measures``). Global sorts run on aggregated rows only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyloom.functions.columns import LOYALTY_LABELS, SPEND_BOUNDS, VALUE_LABELS, discount_band, segment
from tallyloom.functions.measures import UNITS, is_double, mean, row_count, total, units
from tallyloom.functions.parsing import currency, hour_of, safe_number


def _by(tx: DataFrame, keys: Sequence[str | Column], **aggregates: Column) -> DataFrame:
    return tx.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggregates.items()])


def overview(tx: DataFrame) -> DataFrame:
    """Rows, distinct customers and distinct products, in one job."""
    return tx.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.countDistinct("product_id").alias("unique_products"),
    )


def row_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def category_revenue(tx: DataFrame) -> DataFrame:
    """Revenue, transactions and average value per category, highest revenue first."""
    return _by(
        tx,
        ["category"],
        total_revenue=total(tx, "total_amount"),
        transaction_count=row_count(tx),
        avg_transaction_value=mean(tx, "total_amount"),
    ).orderBy(F.desc("total_revenue"), "category")


def category_performance(tx: DataFrame) -> DataFrame:
    return _by(
        tx,
        ["category"],
        unique_customers=F.countDistinct("customer_id"),
        total_revenue=total(tx, "total_amount"),
        avg_transaction_value=mean(tx, "total_amount"),
        total_items_sold=total(tx, "quantity"),
    ).orderBy(F.desc("total_revenue"), "category")


def customer_value(tx: DataFrame) -> DataFrame:
    """Lifetime value, purchases and average purchase per customer."""
    return _by(
        tx,
        ["customer_id"],
        customer_lifetime_value=total(tx, "total_amount"),
        purchase_count=row_count(tx),
        avg_purchase_value=mean(tx, "total_amount"),
    )


def customer_segments(tx: DataFrame, bounds: Sequence[float] = SPEND_BOUNDS, labels: Sequence[str] = VALUE_LABELS) -> DataFrame:
    return customer_value(tx).withColumn("segment", segment("customer_lifetime_value", bounds, labels))


def segment_summary(tx: DataFrame, bounds: Sequence[float] = SPEND_BOUNDS, labels: Sequence[str] = VALUE_LABELS) -> DataFrame:
    """Customers and average lifetime value per segment."""
    customers = customer_segments(tx, bounds, labels)
    return _by(
        customers,
        ["segment"],
        customer_count=F.count("customer_id"),
        avg_lifetime_value=mean(customers, "customer_lifetime_value"),
    ).orderBy("segment")


def loyalty_counts(tx: DataFrame, bounds: Sequence[float] = SPEND_BOUNDS) -> DataFrame:
    """Customers per loyalty label."""
    return _by(customer_segments(tx, bounds, LOYALTY_LABELS), ["segment"], count=F.count(F.lit(1)))


def monthly_trend(tx: DataFrame) -> DataFrame:
    return _by(
        tx,
        ["year", "month"],
        transaction_count=row_count(tx),
        monthly_revenue=total(tx, "total_amount"),
        avg_transaction_value=mean(tx, "total_amount"),
    ).orderBy("year", "month")


def monthly_trend_for(tx: DataFrame, year: int, date_col: str = "transaction_date") -> DataFrame:
    """Month-of-year trend of one year; the year test is a date range, which a scan can push down."""
    day = F.col(date_col)
    rows = tx.filter((day >= F.make_date(F.lit(year), F.lit(1), F.lit(1))) & (day < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1))))
    return _by(
        rows, [F.month(day).alias("month")], transactions=row_count(tx), total_sales=total(tx, "total_amount")
    ).orderBy("month")


def daily_trend(tx: DataFrame, date_col: str = "transaction_date") -> DataFrame:
    return _by(
        tx, [F.to_date(F.col(date_col)).alias("date")], daily_sales=total(tx, "total_amount"), transactions=row_count(tx)
    ).orderBy("date")


def hourly_pattern(tx: DataFrame, time_col: str = "transaction_time", amount: str = "total_amount") -> DataFrame:
    """Sales by hour of day, from a timestamp or an ``HH:mm:ss`` text."""
    return _by(
        tx,
        [hour_of(time_col).alias("hour_of_day")],
        transaction_count=row_count(tx),
        hourly_revenue=total(tx, amount),
    ).orderBy("hour_of_day")


def product_performance(tx: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` products with the highest revenue."""
    return (
        _by(
            tx,
            ["product_name", "category"],
            units_sold=total(tx, "quantity"),
            total_revenue=total(tx, "total_amount"),
            avg_discount=mean(tx, "discount"),
            transaction_count=row_count(tx),
        )
        .orderBy(F.desc("total_revenue"), "product_name", "category")
        .limit(n)
    )


def city_sales(tx: DataFrame) -> DataFrame:
    return _by(
        tx,
        ["city"],
        transaction_count=row_count(tx),
        total_revenue=total(tx, "total_amount"),
        unique_customers=F.countDistinct("customer_id"),
        avg_transaction_value=mean(tx, "total_amount"),
    ).orderBy(F.desc("total_revenue"), "city")


def payment_mix(tx: DataFrame) -> DataFrame:
    """Use, revenue and share of all transactions per payment method.

    The grand total is a window over the aggregated rows, one per method, so the data is read once.
    """
    methods = _by(
        tx,
        ["payment_method"],
        usage_count=row_count(tx),
        total_revenue=total(tx, "total_amount"),
        avg_transaction=mean(tx, "total_amount"),
    )
    return methods.withColumn("usage_percentage", share_of_total("usage_count")).orderBy(F.desc("usage_count"), "payment_method")


def share_of_total(measure: str) -> Column:
    """Percentage of the grand total; for aggregated rows, since the total is formed in one task."""
    value = F.col(measure).cast("double")
    return F.lit(100.0) * value / F.sum(measure).over(Window.partitionBy()).cast("double")


def purchase_frequency(tx: DataFrame) -> DataFrame:
    """How many customers made how many purchases."""
    customers = _by(tx, ["customer_id"], customer_count=row_count(tx))
    return _by(customers, ["customer_count"], number_of_customers=F.count(F.lit(1))).orderBy("customer_count")


def discount_impact(tx: DataFrame) -> DataFrame:
    return _by(
        tx,
        [discount_band("discount").alias("discount_range")],
        transaction_count=row_count(tx),
        total_revenue=total(tx, "total_amount"),
        avg_transaction_value=mean(tx, "total_amount"),
    ).orderBy(F.desc("transaction_count"), "discount_range")


def price_stats(tx: DataFrame, min_rows: int = 5, n: int = 10) -> DataFrame:
    """Price range, mean and sample deviation of products with more than ``min_rows`` rows; the ``n`` dearest."""
    price = F.col("unit_price")
    return (
        _by(
            tx,
            ["product_name"],
            min_price=F.min(price),
            max_price=F.max(price),
            avg_price=mean(tx, "unit_price"),
            price_stddev=F.stddev_samp(price.cast("double")),
            rows=row_count(tx),
        )
        .filter(F.col("rows") > min_rows)
        .drop("rows")
        .orderBy(F.desc("avg_price"), "product_name")
        .limit(n)
    )


def frequent_customers(tx: DataFrame, k: int = 5) -> DataFrame:
    """Customers with more than ``k`` purchases."""
    return _by(
        tx, ["customer_id"], purchase_count=row_count(tx), total_spent=total(tx, "total_amount")
    ).filter(F.col("purchase_count") > k)


def big_ticket_categories(tx: DataFrame, min_amount: float = 100, min_total: float = 1000) -> DataFrame:
    """Customers and revenue per category over large transactions, for categories above a revenue."""
    return (
        _by(
            tx.filter(F.col("total_amount") > min_amount),
            ["category"],
            unique_customers=F.countDistinct("customer_id"),
            total_revenue=total(tx, "total_amount"),
        )
        .filter(F.col("total_revenue") > min_total)
        .orderBy(F.desc("total_revenue"), "category")
    )


def _days(tx: DataFrame, year: int, months: Sequence[int] = (1, 12)) -> DataFrame:
    """Rows between the first and the last of some months, a range of dates that a scan can push down; where the table
    holds no date, all rows. The exact year and months are for the caller to ask for."""
    if "transaction_date" not in tx.columns or not months:
        return tx
    last = max(months)
    until = dt.date(year + (last == 12), last % 12 + 1, 1)
    return tx.filter((F.col("transaction_date") >= F.lit(dt.date(year, min(months), 1))) & (F.col("transaction_date") < F.lit(until)))


def category_revenue_for(tx: DataFrame, year: int, months: Sequence[int]) -> DataFrame:
    """Revenue per category in some months of a year; on a table partitioned by year and month only those are read."""
    rows = _days(tx, year, months).filter((F.col("year") == year) & F.col("month").isin(*months))
    return _by(rows, ["category"], revenue=total(tx, "total_amount"), transactions=row_count(tx))


def category_month(tx: DataFrame, year: int) -> DataFrame:
    return _by(
        _days(tx, year).filter(F.col("year") == year),
        ["category", "year", "month"],
        revenue=total(tx, "total_amount"),
        avg_transaction=mean(tx, "total_amount"),
        transaction_count=row_count(tx),
    )


def monthly_sales_summary(tx: DataFrame) -> DataFrame:
    """Revenue, transactions, average and distinct customers per month, category and city."""
    return _by(
        tx,
        ["year", "month", "category", "city"],
        total_revenue=total(tx, "total_amount"),
        transaction_count=row_count(tx),
        avg_transaction=mean(tx, "total_amount"),
        unique_customers=F.countDistinct("customer_id"),
    )


def category_sales_report(rows: DataFrame, formatted: bool = False, amount: str = "total_amount") -> DataFrame:
    """Sales per category from text amounts; rows whose amount does not parse, or without category, are skipped."""
    parsed = rows.select("category", safe_number(F.col(amount).cast("string")).alias("amount"))
    report = _by(
        parsed.filter(F.col("category").isNotNull() & F.col("amount").isNotNull()),
        ["category"],
        total_sales=F.sum(F.col("amount")),
        transaction_count=F.count(F.lit(1)),
        average_sale=F.avg("amount"),
    ).orderBy("category")
    if not formatted:
        return report
    return report.withColumns({"total_sales": currency("total_sales"), "average_sale": currency("average_sale")})


def units_by_product(tx: DataFrame) -> DataFrame:
    return _by(tx, ["product_name"], units_sold=total(tx, "quantity")).orderBy("product_name")


def top_customers(tx: DataFrame, n: int = 5) -> DataFrame:
    return (
        _by(tx, ["customer_id"], total_spent=total(tx, "total_amount"))
        .orderBy(F.desc("total_spent"), "customer_id")
        .limit(n)
    )


def category_city(tx: DataFrame) -> DataFrame:
    """Revenue per category and city, of a batch or a stream."""
    return _by(tx, ["category", "city"], revenue=total(tx, "total_amount"))


def top_products(tx: DataFrame, n: int = 10) -> DataFrame:
    return (
        _by(
            tx,
            ["product_name"],
            total_quantity=total(tx, "quantity"),
            total_revenue=total(tx, "total_amount"),
            transaction_count=row_count(tx),
        )
        .orderBy(F.desc("total_revenue"), "product_name")
        .limit(n)
    )


def top_categories(tx: DataFrame, n: int = 5) -> DataFrame:
    return (
        _by(tx, ["category"], revenue=total(tx, "total_amount")).orderBy(F.desc("revenue"), "category").limit(n)
    )


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows of an order that should be total, so that the preview repeats."""
    return df.orderBy(*order).limit(n)


def slice_metrics(tx: DataFrame, order: Sequence[str | Column], size: int = 100, stop: int = 500) -> DataFrame:
    """Running metrics over the first ``size``, ``2 * size`` … ``stop`` rows of an order.

    Only the first ``stop`` rows leave the scan (a top-k), so the numbering works on a fixed number of rows.
    """
    first = tx.orderBy(*order).limit(stop)
    numbered = first.withColumn("position", F.row_number().over(Window.orderBy(*order)))
    slices = numbered.groupBy(F.ceil(F.col("position") / size).cast("int").alias("batch")).agg(
        F.count(F.lit(1)).alias("n"), total(tx, "total_amount").alias("amount")
    )
    so_far = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = slices.withColumn("transactions", F.sum("n").over(so_far))
    if is_double(slices, "amount"):
        running = running.withColumn("revenue", F.sum(units(F.col("amount"))).over(so_far).cast("double") / UNITS)
    else:
        running = running.withColumn("revenue", F.sum("amount").over(so_far))
    return running.select(
        "batch", "transactions", "revenue", (F.col("revenue").cast("double") / F.col("transactions")).alias("avg_transaction")
    )
