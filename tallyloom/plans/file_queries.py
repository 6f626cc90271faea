"""Readers, writers and table statements: given tables are written in some way and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import layout, merge, ordering, quality, snapshots
from tallyloom.plans.record_queries import ROUTES_SQL, VALID
from tallyloom.plans.registry import LOGS, SENSORS, query
from tallyloom.plans.views import logs, sensors
from tallyloom.session import scratch_path
from tallyloom.sources import kafka, readers, tables, writers
from tallyloom.sources.readers import load
from tallyloom.streaming import sinks
from tallyloom.streaming.sources import stream_table

ORDERS_BY_STATUS = "SELECT o_orderstatus, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY o_orderstatus"
ORDER_FIELDS = "o_orderkey bigint, o_orderstatus string, o_orderpriority string"


def _by_status(df: DataFrame) -> DataFrame:
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))


def _slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@query(ORDERS_BY_STATUS)
def inferred_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.write(_slim(spark, sf_dir), scratch_path(spark, "inferred"), "csv", header=True)
    return _by_status(readers.read_csv(spark, path).withColumn("o_orderkey", F.col("o_orderkey").cast("long")))


@query("SELECT page_id, length(html) AS html_length, url FROM pages")
def quoted_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with their quotes, commas and line ends, written with quotes and a backslash as escape."""
    dialect = readers.CsvDialect(comment=None, multi_line=True)
    pages = load(spark, sf_dir, "pages")
    path = writers.write(pages, scratch_path(spark, "quoted"), "csv", quoteAll=True, **dialect.options())
    rows = readers.read_csv(spark, path, "page_id bigint, url string, html string", dialect)
    return rows.select("page_id", F.length("html").cast("long").alias("html_length"), "url")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def json_array_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in pretty-printed JSON arrays of up to 500, one array per file, read as multi-line files."""
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    arrays = ordering.bundle(customers, "c_mktsegment", "c_custkey", 500)
    whole = F.transform("records", lambda r: r.withField("c_mktsegment", F.col("c_mktsegment")))
    path = scratch_path(spark, "arrays")
    arrays.select(F.to_json(whole, {"pretty": "true"}).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_json(spark, path, "c_custkey bigint, c_name string, c_mktsegment string")


@query(ORDERS_BY_STATUS)
def orc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.write(_slim(spark, sf_dir), scratch_path(spark, "orc"), "orc", compression="snappy")
    return _by_status(readers.read_orc(spark, path, ORDER_FIELDS))


@query("SELECT c_mktsegment, count(*) AS customers FROM customer WHERE c_acctbal IS NOT NULL GROUP BY c_mktsegment")
def sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    readers.register(spark, {"customer_view": load(spark, sf_dir, "customer")})
    return spark.sql("SELECT c_mktsegment, count(*) AS customers FROM customer_view WHERE c_acctbal IS NOT NULL GROUP BY c_mktsegment")


@query(ORDERS_BY_STATUS)
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.write(_slim(spark, sf_dir), scratch_path(spark, "external"), "csv", header=True)
    return _by_status(readers.external_table(spark, _name("external"), path, ORDER_FIELDS, header=True))


@query(ORDERS_BY_STATUS)
def files_by_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = writers.write(_slim(spark, sf_dir), scratch_path(spark, "wildcard"), "json")
    return _by_status(readers.read_any(spark, "json", f"{path}/part-*.json", ORDER_FIELDS))


@query("SELECT o_orderstatus, 2 * count(*) AS rows, CAST(2 * sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY o_orderstatus")
def append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _name("appended")
    for _ in range(2):
        writers.append(_slim(spark, sf_dir), name, path=scratch_path(spark, name))
    return _by_status(spark.table(name))


@query(ORDERS_BY_STATUS)
def write_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "single")
    writers.write_single(_by_status(_slim(spark, sf_dir)), path)
    return spark.read.parquet(path)


@query(ORDERS_BY_STATUS)
def convert_json_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = writers.write(_slim(spark, sf_dir), scratch_path(spark, "json"), "json"), scratch_path(spark, "converted")
    writers.convert(spark, source, "json", target, "parquet", ORDER_FIELDS)
    return _by_status(spark.read.parquet(target))


@query(ORDERS_BY_STATUS)
def parquet_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "settings")
    writers.write_parquet(_slim(spark, sf_dir), path, "zstd", 1024**2, True, 64 * 1024**2)
    return _by_status(spark.read.parquet(path))


@query("SELECT 2 * count(*) AS rows, true AS renamed FROM orders")
def rename_on_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = writers.write(_slim(spark, sf_dir), scratch_path(spark, "conflict"))
    second = writers.write(_slim(spark, sf_dir), first, on_conflict="rename")
    return spark.read.parquet(first, second).agg(F.count(F.lit(1)).alias("rows")).withColumn("renamed", F.lit(first != second))


@query("SELECT CAST(year(ts) AS INTEGER) AS yyyy, CAST(month(ts) AS INTEGER) AS \"MM\", CAST(day(ts) AS INTEGER) AS dd, count(*) AS rows FROM events GROUP BY 1, 2, 3")
def dated_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dated")
    writers.write_dated(load(spark, sf_dir, "events"), path, "ts")
    return spark.read.parquet(path).groupBy("yyyy", "MM", "dd").agg(F.count(F.lit(1)).alias("rows"))


@query(
    LOGS
    + "SELECT route, count(*) AS rows FROM ("
    + " UNION ALL ".join(f"SELECT event_id, '{name}' AS route FROM logs WHERE {p}" for name, p in ROUTES_SQL.items())
    + " UNION ALL SELECT event_id, 'unmatched' FROM logs WHERE NOT ("
    + " OR ".join(f"coalesce({p}, false)" for p in ROUTES_SQL.values())
    + ")) GROUP BY route"
)
def route_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "routes")
    writers.write_routes(quality.routed(logs(spark, sf_dir), quality.log_routes()), path)
    return spark.read.parquet(path).groupBy("route").agg(F.count(F.lit(1)).alias("rows"))


@query(SENSORS + f"SELECT {VALID} AS is_valid, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids FROM sensors GROUP BY 1")
def quarantine_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "split")
    writers.write_split(quality.flag_valid_readings(sensors(spark, sf_dir)), path)
    rows = spark.read.parquet(path).withColumn("is_valid", F.col("is_valid").cast("boolean"))
    return rows.groupBy("is_valid").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))


@query("SELECT count(*) AS rows, 'orders' AS source FROM orders")
def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "run")
    rows = load(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n")).first()["n"]
    writers.write_run_metadata(spark, path, {"rows": rows, "source": "orders"})
    return spark.read.json(path).select(F.from_json("run", "rows bigint, source string").alias("r")).select("r.*")


@query("SELECT concat('o_orderstatus=', o_orderstatus) AS partition FROM orders GROUP BY o_orderstatus")
def partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _name("by_status")
    writers.append(_slim(spark, sf_dir), name, by=["o_orderstatus"], path=scratch_path(spark, name))
    return layout.partitions(spark, name)


@query("SELECT count(*) AS rows FROM orders")
def table_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _name("measured")
    writers.ctas(_slim(spark, sf_dir), name, "parquet", path=scratch_path(spark, name))
    facts = layout.collect_stats(spark, name, ["o_orderkey"]).filter("col_name = 'Statistics'")
    return facts.select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long").alias("rows"))


@query()
def bucket_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _name("bucketed")
    writers.write_bucketed(_slim(spark, sf_dir), name, 8, ["o_orderkey"], scratch_path(spark, name))
    return tables.bucket_bytes(spark, name)


@query("SELECT count(*) AS rows, count(note) AS noted FROM (SELECT o_orderkey, NULL AS note FROM orders UNION ALL SELECT c_custkey, c_name FROM customer)")
def growing_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "growing")
    load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")).write.parquet(path)
    load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("note")).write.mode("append").parquet(path)
    return merge.read_evolved(spark, path).agg(F.count(F.lit(1)).alias("rows"), F.count("note").alias("noted"))


@query("SELECT 1::BIGINT AS version, count(*) AS rows FROM orders WHERE o_orderstatus = 'F'")
def expired_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, long_ago = scratch_path(spark, "expiring"), dt.datetime(2024, 1, 1)
    orders = load(spark, sf_dir, "orders")
    snapshots.write_snapshot(orders, path, "LOAD", now=long_ago)
    snapshots.write_snapshot(orders.filter(F.col("o_orderstatus") == "F"), path, "PRUNE", now=long_ago)
    snapshots.expire_snapshots(spark, path, 168, now=dt.datetime(2024, 6, 1))
    return snapshots.history(spark, path).select("version", "rows")


@query("SELECT CAST(event_id AS VARCHAR) AS key, concat('{\"event_type\":\"', event_type, '\",\"user_id\":', user_id, '}') AS value FROM events")
def message_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka.as_messages(load(spark, sf_dir, "events"), "event_id", ["event_type", "user_id"])


@query("SELECT false AS is_active, count(*) AS input_rows FROM events")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "progress")
    done = sinks.finish(sinks.to_table(stream_table(spark, sf_dir, "events"), f"{base}/out", f"{base}/checkpoint"))
    return sinks.progress_row(done).select("is_active", "input_rows")


@query(ORDERS_BY_STATUS)
def cached_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two results of one persisted parent, put together after they were written."""
    path = scratch_path(spark, "cached")
    with layout.cached(_slim(spark, sf_dir)) as orders:
        for status in ("F", "O", "P"):
            _by_status(orders.filter(F.col("o_orderstatus") == status)).write.mode("append").parquet(path)
    return layout.repartition(spark.read.parquet(path), 4, "o_orderstatus")
