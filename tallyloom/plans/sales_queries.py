"""Transaction queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.columns import DISCOUNT_LABELS
from tallyloom.operators import enrichment, joins, sales
from tallyloom.plans.registry import TX, query
from tallyloom.plans.views import transaction_totals, transactions
from tallyloom.sources.readers import load

YEAR = 1998
MONTHS = (6, 7, 8)
CUSTOMER_BOUNDS = (2_500_000, 1_500_000)
FREQUENT = 45
BIG_AMOUNT, BIG_TOTAL = 50_000, 350_000_000

REVENUE = "CAST(sum(total_amount) AS DOUBLE)"
MEAN = "CAST(sum(total_amount) AS DOUBLE) / count(total_amount)"


@query(TX + "SELECT count(*) AS transactions, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT product_id) AS unique_products FROM tx")
def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.overview(transactions(spark, sf_dir, ["customer_id", "product_id"]))


@query("SELECT count(*) AS rows FROM lineitem")
def row_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.row_total(load(spark, sf_dir, "lineitem"))


@query(TX + f"SELECT category, {REVENUE} AS total_revenue, count(*) AS transaction_count, {MEAN} AS avg_transaction_value FROM tx GROUP BY category")
def category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.category_revenue(transaction_totals(spark, sf_dir, ["category"]))


@query(
    TX
    + f"""SELECT category, count(DISTINCT customer_id) AS unique_customers, {REVENUE} AS total_revenue,
          {MEAN} AS avg_transaction_value, CAST(sum(quantity) AS BIGINT) AS total_items_sold FROM tx GROUP BY category"""
)
def category_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.category_performance(transactions(spark, sf_dir, ["category", "customer_id", "total_amount", "quantity"]))


@query(TX + f"SELECT customer_id, {REVENUE} AS customer_lifetime_value, count(*) AS purchase_count, {MEAN} AS avg_purchase_value FROM tx GROUP BY customer_id")
def customer_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.customer_value(transaction_totals(spark, sf_dir, ["customer_id"]))


_SEGMENTED = (
    TX
    + f""", c AS (SELECT customer_id, sum(total_amount) AS v FROM tx GROUP BY customer_id),
     s AS (SELECT customer_id, v, CASE WHEN v > {CUSTOMER_BOUNDS[0]} THEN 'HIGH' WHEN v > {CUSTOMER_BOUNDS[1]} THEN 'MID' ELSE 'LOW' END AS g FROM c)
    """
)


@query(
    _SEGMENTED
    + """SELECT CASE g WHEN 'HIGH' THEN 'High Value' WHEN 'MID' THEN 'Medium Value' ELSE 'Low Value' END AS segment,
         count(customer_id) AS customer_count, CAST(sum(v) AS DOUBLE) / count(v) AS avg_lifetime_value FROM s GROUP BY 1"""
)
def segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.segment_summary(transaction_totals(spark, sf_dir, ["customer_id"]), CUSTOMER_BOUNDS)


@query(_SEGMENTED + "SELECT CASE g WHEN 'HIGH' THEN 'VIP' WHEN 'MID' THEN 'Regular' ELSE 'Occasional' END AS segment, count(*) AS count FROM s GROUP BY 1")
def loyalty_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.loyalty_counts(transaction_totals(spark, sf_dir, ["customer_id"]), CUSTOMER_BOUNDS)


@query(TX + f"SELECT year, month, count(*) AS transaction_count, {REVENUE} AS monthly_revenue, {MEAN} AS avg_transaction_value FROM tx GROUP BY year, month")
def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.monthly_trend(transaction_totals(spark, sf_dir, ["year", "month"]))


@query(TX + f"SELECT month, count(*) AS transactions, {REVENUE} AS total_sales FROM tx WHERE year = {YEAR} GROUP BY month")
def monthly_trend_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.monthly_trend_for(transaction_totals(spark, sf_dir, ["transaction_date"]), YEAR)


@query(TX + f"SELECT transaction_date AS date, {REVENUE} AS daily_sales, count(*) AS transactions FROM tx GROUP BY 1")
def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.daily_trend(transaction_totals(spark, sf_dir, ["transaction_date"]))


@query(
    """SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS transaction_count,
       CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS hourly_revenue FROM events GROUP BY 1"""
)
def hourly_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.hourly_pattern(load(spark, sf_dir, "events"), "ts", "value")


@query(
    TX
    + f"""SELECT product_name, category, CAST(sum(quantity) AS BIGINT) AS units_sold, {REVENUE} AS total_revenue,
          sum(discount) / count(discount) AS avg_discount, count(*) AS transaction_count
          FROM tx GROUP BY product_name, category ORDER BY sum(total_amount) DESC, product_name, category LIMIT 15"""
)
def product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.product_performance(
        transaction_totals(spark, sf_dir, ["product_name", "category"], ["quantity", "total_amount", "discount"])
    )


@query(
    TX
    + f"""SELECT city, count(*) AS transaction_count, {REVENUE} AS total_revenue, count(DISTINCT customer_id) AS unique_customers,
          {MEAN} AS avg_transaction_value FROM tx GROUP BY city"""
)
def city_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.city_sales(transaction_totals(spark, sf_dir, ["city", "customer_id"]))


@query(
    TX
    + f"""SELECT payment_method, count(*) AS usage_count, {REVENUE} AS total_revenue, {MEAN} AS avg_transaction,
          100.0::DOUBLE * CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM tx) AS DOUBLE) AS usage_percentage
          FROM tx GROUP BY payment_method"""
)
def payment_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.payment_mix(transaction_totals(spark, sf_dir, ["payment_method"]))


@query(
    TX
    + """, c AS (SELECT customer_id, count(*) AS customer_count FROM tx GROUP BY customer_id)
    SELECT customer_count, count(*) AS number_of_customers FROM c GROUP BY customer_count"""
)
def purchase_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.purchase_frequency(transaction_totals(spark, sf_dir, ["customer_id"], []))


@query(
    TX
    + f"""SELECT CASE WHEN discount = 0 THEN '{DISCOUNT_LABELS[0]}' WHEN discount > 0 AND discount <= 10 THEN '{DISCOUNT_LABELS[1]}'
                      WHEN discount > 10 AND discount <= 20 THEN '{DISCOUNT_LABELS[2]}' ELSE '{DISCOUNT_LABELS[3]}' END AS discount_range,
          count(*) AS transaction_count, {REVENUE} AS total_revenue, {MEAN} AS avg_transaction_value FROM tx GROUP BY 1"""
)
def discount_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.discount_impact(transactions(spark, sf_dir, ["discount", "total_amount"]))


@query(
    TX
    + """SELECT product_name, CAST(min(unit_price) AS DOUBLE) AS min_price, CAST(max(unit_price) AS DOUBLE) AS max_price,
          CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS avg_price, round(stddev_samp(CAST(unit_price AS DOUBLE)), 4) AS price_stddev
          FROM tx GROUP BY product_name HAVING count(*) > 5
          ORDER BY CAST(sum(unit_price) AS DOUBLE) / count(unit_price) DESC, product_name LIMIT 10"""
)
def price_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = sales.price_stats(transactions(spark, sf_dir, ["product_name", "unit_price"]))
    return stats.withColumn("price_stddev", F.round("price_stddev", 4))


@query(TX + f"SELECT customer_id, count(*) AS purchase_count, {REVENUE} AS total_spent FROM tx GROUP BY customer_id HAVING count(*) > {FREQUENT}")
def frequent_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.frequent_customers(transaction_totals(spark, sf_dir, ["customer_id"]), FREQUENT)


@query(
    TX
    + f"""SELECT category, count(DISTINCT customer_id) AS unique_customers, {REVENUE} AS total_revenue
          FROM tx WHERE total_amount > {BIG_AMOUNT} GROUP BY category HAVING sum(total_amount) > {BIG_TOTAL}"""
)
def big_ticket_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.big_ticket_categories(transactions(spark, sf_dir, ["category", "customer_id", "total_amount"]), BIG_AMOUNT, BIG_TOTAL)


@query(TX + f"SELECT category, {REVENUE} AS revenue, count(*) AS transactions FROM tx WHERE year = {YEAR} AND month IN {MONTHS} GROUP BY category")
def category_revenue_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.category_revenue_for(transactions(spark, sf_dir, ["category", "transaction_date", "year", "month", "total_amount"]), YEAR, MONTHS)


@query(
    TX
    + f"SELECT category, year, month, {REVENUE} AS revenue, {MEAN} AS avg_transaction, count(*) AS transaction_count FROM tx WHERE year = {YEAR} GROUP BY category, year, month"
)
def category_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.category_month(transactions(spark, sf_dir, ["category", "transaction_date", "year", "month", "total_amount"]), YEAR)


SUMMARY_SQL = (
    TX
    + f"""SELECT year, month, category, city, {REVENUE} AS total_revenue, count(*) AS transaction_count, {MEAN} AS avg_transaction,
          count(DISTINCT customer_id) AS unique_customers FROM tx GROUP BY year, month, category, city"""
)
SUMMARY_COLUMNS = ["year", "month", "category", "city", "total_amount", "customer_id"]


@query(SUMMARY_SQL)
def monthly_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.monthly_sales_summary(transactions(spark, sf_dir, SUMMARY_COLUMNS))


# Amounts as text, some of which do not parse.
_TEXT_AMOUNT = "CASE WHEN l_linenumber = 3 THEN 'n/a' WHEN l_linenumber = 5 THEN '' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END"


def _text_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    text = F.when(line == 3, "n/a").when(line == 5, "").otherwise(F.col("l_quantity").cast("int").cast("string"))
    return load(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("category"), text.alias("total_amount"))


@query(
    f"""WITH t AS (SELECT l_returnflag AS category, TRY_CAST({_TEXT_AMOUNT} AS DOUBLE) AS amount FROM lineitem)
    SELECT category, sum(amount) AS total_sales, count(*) AS transaction_count, avg(amount) AS average_sale
    FROM t WHERE amount IS NOT NULL GROUP BY category"""
)
def category_sales_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.category_sales_report(_text_amounts(spark, sf_dir))


@query(
    f"""WITH t AS (SELECT l_returnflag AS category, TRY_CAST({_TEXT_AMOUNT} AS DOUBLE) AS amount FROM lineitem)
    SELECT category, printf('$%.2f', sum(amount)) AS total_sales, count(*) AS transaction_count, printf('$%.2f', avg(amount)) AS average_sale
    FROM t WHERE amount IS NOT NULL GROUP BY category"""
)
def category_sales_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.category_sales_report(_text_amounts(spark, sf_dir), formatted=True)


@query(TX + "SELECT product_name, CAST(sum(quantity) AS BIGINT) AS units_sold FROM tx GROUP BY product_name")
def units_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.units_by_product(transaction_totals(spark, sf_dir, ["product_name"], ["quantity"]))


@query(TX + f"SELECT customer_id, {REVENUE} AS total_spent FROM tx GROUP BY customer_id ORDER BY sum(total_amount) DESC, customer_id LIMIT 5")
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.top_customers(transaction_totals(spark, sf_dir, ["customer_id"]))


@query(TX + f"SELECT category, city, {REVENUE} AS revenue FROM tx GROUP BY category, city")
def category_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.category_city(transactions(spark, sf_dir, ["category", "city", "total_amount"]))


@query(
    TX
    + f"""SELECT product_name, CAST(sum(quantity) AS BIGINT) AS total_quantity, {REVENUE} AS total_revenue, count(*) AS transaction_count
          FROM tx GROUP BY product_name ORDER BY sum(total_amount) DESC, product_name LIMIT 10"""
)
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.top_products(transaction_totals(spark, sf_dir, ["product_name"], ["quantity", "total_amount"]))


@query(TX + f"SELECT category, {REVENUE} AS revenue FROM tx GROUP BY category ORDER BY sum(total_amount) DESC, category LIMIT 5")
def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.top_categories(transaction_totals(spark, sf_dir, ["category"]))


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.preview(load(spark, sf_dir, "orders"), [F.desc("o_totalprice"), "o_orderkey"])


@query(
    """WITH r AS (SELECT CAST(o_totalprice AS DECIMAL(12,2)) AS a, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS p FROM orders),
       b AS (SELECT unnest([1, 2, 3, 4, 5]) AS batch)
    SELECT CAST(batch AS INTEGER) AS batch, count(*) AS transactions, CAST(sum(a) AS DOUBLE) AS revenue, CAST(sum(a) AS DOUBLE) / count(*) AS avg_transaction
    FROM b JOIN r ON p <= batch * 100 GROUP BY batch"""
)
def slice_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").withColumnRenamed("o_totalprice", "total_amount")
    return sales.slice_metrics(orders, ["o_orderdate", "o_orderkey"])


# --- joins


@query(
    """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, l_linenumber, p_name AS product_name, p_type AS category, l_extendedprice AS total_amount
       FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_shipdate >= TIMESTAMP '1998-06-01' AND l_shipdate < TIMESTAMP '1998-07-01'"""
)
def enrich_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = F.col("l_shipdate")
    june = (shipped >= F.lit("1998-06-01").cast("timestamp_ntz")) & (shipped < F.lit("1998-07-01").cast("timestamp_ntz"))
    fact = load(spark, sf_dir, "lineitem").filter(june).withColumnRenamed("l_partkey", "p_partkey")
    dim = load(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("product_name"), F.col("p_type").alias("category"))
    return joins.enrich(fact, dim, "p_partkey").select(
        "l_orderkey", "l_linenumber", "product_name", "category", F.col("l_extendedprice").alias("total_amount")
    )


@query(
    """WITH d AS (SELECT p_type, concat('from ', CAST(min(p_size) AS VARCHAR)) AS description FROM part WHERE p_type IN ('SMALL', 'LARGE', 'PROMO') GROUP BY p_type)
       SELECT p_partkey, part.p_type AS category, description FROM part LEFT JOIN d ON part.p_type = d.p_type"""
)
def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    dim = part.filter(F.col("p_type").isin("SMALL", "LARGE", "PROMO")).groupBy(F.col("p_type").alias("category"))
    dim = dim.agg(F.concat(F.lit("from "), F.min("p_size").cast("string")).alias("description"))
    return joins.enrich(part.select("p_partkey", F.col("p_type").alias("category")), dim, "category", "left")


@query(
    """SELECT p_type AS category, count(*) AS rows, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY p_type"""
)
def enrich_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = load(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"))
    dim = load(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("category"))
    joined = joins.enrich_hot_keys(fact, dim, "p_partkey", "left", limit=-1)
    return joined.groupBy("category").agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("revenue"))


@query(
    TX
    + """SELECT t1.customer_id, count(DISTINCT t1.product_id) AS unique_products, CAST(sum(t1.total_amount) AS DOUBLE) AS total_spent
         FROM tx t1 JOIN tx t2 ON t1.customer_id = t2.customer_id WHERE t1.transaction_date <> t2.transaction_date GROUP BY t1.customer_id"""
)
def repeat_day_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.repeat_day_customers(transactions(spark, sf_dir, ["customer_id", "transaction_date", "product_id", "total_amount"]))


BREADTH_SQL = TX + """SELECT t1.customer_id, count(DISTINCT t1.product_id) AS unique_products
         FROM tx t1 JOIN tx t2 ON t1.customer_id = t2.customer_id GROUP BY t1.customer_id"""


@query(BREADTH_SQL)
def customer_product_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.customer_product_breadth(transactions(spark, sf_dir, ["customer_id", "product_id"]))


# --- projections on transactions


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 1.1 AS DECIMAL(12,2))::DOUBLE AS total_amount, 'UPDATED' AS update_flag FROM lineitem")
def apply_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").alias("total_amount"))
    return enrichment.apply_markup(rows, 10)


@query("SELECT o_orderkey, 'shop' AS data_source, 3 AS revision FROM orders WHERE o_orderstatus <> 'F' AND o_custkey IS NOT NULL AND o_orderpriority NOT IN ('5-LOW', '3-MEDIUM') AND o_totalprice BETWEEN 1000 AND 200000")
def constants_on_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").filter(
        (F.col("o_orderstatus") != "F")
        & F.col("o_custkey").isNotNull()
        & ~F.col("o_orderpriority").isin("5-LOW", "3-MEDIUM")
        & F.col("o_totalprice").between(1000, 200000)
    )
    return enrichment.with_constants(orders.select("o_orderkey"), data_source="shop", revision=3)


@query(
    """SELECT p_type AS category, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS total_revenue,
              count(*) AS transaction_count,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) / count(*) AS avg_transaction_value
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY p_type"""
)
def net_category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category revenue of discounted prices, which carry four decimals."""
    lines = load(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("total_amount"))
    parts = load(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("category"))
    return sales.category_revenue(lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left"))
