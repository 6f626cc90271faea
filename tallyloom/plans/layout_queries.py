"""Sources, sinks and table layouts: each query lays given tables out anew and reads them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import joins, layout, sales
from tallyloom.plans.registry import TX, query
from tallyloom.plans.sales_queries import BREADTH_SQL, MONTHS, REVENUE, SUMMARY_COLUMNS, SUMMARY_SQL, YEAR
from tallyloom.plans.views import transactions
from tallyloom.session import scratch_path
from tallyloom.sources import inventory, readers, writers
from tallyloom.sources.readers import load


def _table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@query(TX + f"SELECT category, {REVENUE} AS revenue, count(*) AS transactions FROM tx WHERE year = {YEAR} AND month IN {MONTHS} GROUP BY category")
def category_revenue_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "partitioned")
    writers.write_partitioned(transactions(spark, sf_dir, ["category", "total_amount", "year", "month"]), path, ["year", "month"])
    return sales.category_revenue_for(spark.read.parquet(path), YEAR, MONTHS)


@query(BREADTH_SQL)
def bucketed_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _table_name("by_customer")
    writers.write_bucketed(transactions(spark, sf_dir, ["customer_id", "product_id"]), name, 10, ["customer_id"], scratch_path(spark, name))
    return joins.customer_product_breadth(joins.bucketed_scan(spark, name))


@query("SELECT o_orderpriority, count(*) AS items, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS units FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority")
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _table_name("items"), _table_name("orders")
    items = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_quantity").cast("int").alias("quantity"))
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderpriority")
    writers.write_bucketed(items, left, 8, ["orderkey"], scratch_path(spark, left))
    writers.write_bucketed(orders, right, 8, ["orderkey"], scratch_path(spark, right))
    joined = joins.bucketed_join(spark, left, right, "orderkey")
    return joined.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("items"), F.sum("quantity").alias("units"))


@query(SUMMARY_SQL)
def refresh_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary built once, then refreshed for the months of one year."""
    path = scratch_path(spark, "summary")
    tx = transactions(spark, sf_dir, SUMMARY_COLUMNS)
    layout.refresh_summary(spark, tx, path)
    touched = tx.filter(F.col("year") == YEAR).select("year", "month")
    return layout.refresh_summary(spark, tx, path, touched).select("year", "month", "category", "city", "total_revenue", "transaction_count", "avg_transaction", "unique_customers")


@query("SELECT event_type, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type")
def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "small-files")
    load(spark, sf_dir, "events").repartition(16).write.partitionBy("event_type").parquet(path)
    layout.compact(spark, path, by=["event_type"])
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))


@query("SELECT o_custkey, count(*) AS orders, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey")
def cluster_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "clustered")
    layout.cluster_write(load(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"], path, 4)
    return spark.read.parquet(path).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )


@query("SELECT unnest(['csv', 'orc', 'parquet']) AS format, (SELECT count(*) FROM orders) AS rows, true AS has_bytes")
def format_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.format_sizes(spark, load(spark, sf_dir, "orders")).select("format", "rows", (F.col("bytes") > 0).alias("has_bytes"))


@query("SELECT o_orderstatus, count(*) AS rows, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total FROM orders GROUP BY o_orderstatus")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    writers.write(orders, path, "csv", header=True)
    rows = readers.read_csv(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice decimal(12,2)")
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_totalprice").alias("total"))


@query(
    """SELECT count(*) FILTER (event_type NOT IN ('error', 'signup')) AS good_rows, count(*) FILTER (event_type IN ('error', 'signup')) AS bad_rows,
       CAST(sum(event_id) FILTER (event_type NOT IN ('error', 'signup')) AS BIGINT) AS good_ids FROM events"""
)
def tolerant_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as CSV lines; errors have a text in place of the number, and sign-ups are cut short."""
    path = scratch_path(spark, "messy")
    kind = F.col("event_type")
    event_id, value = F.col("event_id").cast("string"), F.col("value").cast("string")
    line = F.when(kind == "error", F.concat_ws(",", event_id, F.lit("oops"), "event_type")).when(kind == "signup", event_id).otherwise(F.concat_ws(",", event_id, value, "event_type"))
    load(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    good, bad = readers.read_csv_tolerant(spark, path, "event_id bigint, value double, event_type string", readers.CsvDialect(header=False))
    counted = [
        good.agg(F.count(F.lit(1)).alias("good_rows"), F.sum("event_id").alias("good_ids")),
        bad.agg(F.count(F.lit(1)).alias("bad_rows")),
    ]
    merged = counted[0].unionByName(counted[1], allowMissingColumns=True)
    return merged.agg(F.max("good_rows").alias("good_rows"), F.max("bad_rows").alias("bad_rows"), F.max("good_ids").alias("good_ids"))


@query("SELECT event_id AS id, event_type AS level, user_id AS actor FROM events WHERE event_type <> 'click'")
def payload_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events staged as nested API payloads, flattened again."""
    path = scratch_path(spark, "payloads")
    events = load(spark, sf_dir, "events")
    events.select(F.col("event_id").alias("id"), F.struct(F.col("event_type").alias("level"), F.struct("user_id").alias("by")).alias("data")).write.json(path)
    schema = "id bigint, data struct<level: string, by: struct<user_id: bigint>>"
    flat = readers.payload_table(spark, path, schema, {"id": "id", "level": "data.level", "actor": "data.by.user_id"})
    return flat.filter(F.col("level") != "click")


@query("SELECT n_nationkey AS id, n_name AS name, 2::BIGINT AS properties FROM nation UNION ALL SELECT c_custkey, c_name, 2 FROM customer")
def xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "xml")
    prop = lambda key, value: F.struct(F.lit(key).alias("key"), value.alias("value"))
    nation = load(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    customer = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    both = nation.unionByName(customer)
    records = both.select("id", "name", F.array(prop("a", F.col("name")), prop("b", F.col("id").cast("string"))).alias("property"))
    writers.write_xml(records, path, "processor")
    rows = readers.read_xml_records(spark, path, "processor", "id bigint, name string, property array<struct<key: string, value: string>>")
    return rows.select("id", "name", F.size("property").cast("long").alias("properties"))


@query("SELECT o_orderpriority, count(*) AS rows FROM orders GROUP BY o_orderpriority")
def orc_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _table_name("orders_orc")
    writers.ctas(load(spark, sf_dir, "orders"), name, "orc", "snappy", scratch_path(spark, name))
    return spark.table(name).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("rows"))


@query()
def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.list_files(spark, sf_dir, "*.parquet").select("name", "bytes")


@query()
def dir_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.dir_usage(inventory.list_files(spark, sf_dir, "*.parquet"))


@query()
def file_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = inventory.file_checksums(spark, sf_dir, "*.parquet")
    return checked.select(F.element_at(F.split("path", "/"), -1).alias("name"), "bytes", "sha256")


@query("SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment")
def files_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = load(spark, sf_dir, "customer").schema
    rows = readers.read_files(spark, "parquet", sf_dir, schema, glob="custom*.parquet", recursive=True, max_bytes=2**50)
    return rows.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
