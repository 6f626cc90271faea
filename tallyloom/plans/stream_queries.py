"""Streaming queries: the tables are read as streams, run to their end, and the sink's content is returned."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import joins
from tallyloom.operators.merge import flatten_cdc
from tallyloom.operators.sales import category_city
from tallyloom.operators.snapshots import read_as_of
from tallyloom.plans.merge_queries import CDC_SQL, ROW, order_envelopes
from tallyloom.plans.record_queries import VALIDATED_SQL
from tallyloom.plans.registry import LOGS, SENSORS, query
from tallyloom.plans.views import logs, sensors
from tallyloom.session import scratch_path
from tallyloom.sources.readers import TABLES, load
from tallyloom.streaming import jobs, merged, sinks
from tallyloom.streaming.sources import stream_files, stream_table

NOON = dt.datetime(2024, 6, 1, 12, 0, 0)
AMOUNT = "CAST(value AS DECIMAL(12,2))"


def _sales_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of sales: type as category, value as amount."""
    return stream_table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"), F.col("event_type").alias("category"), F.col("value").alias("total_amount"), "user_id"
    )


def _places(spark: SparkSession, label: str) -> tuple[str, str]:
    base = scratch_path(spark, label)
    return f"{base}/out", f"{base}/checkpoint"


@query(
    f"""WITH w AS (SELECT date_trunc('minute', ts) - to_minutes(k) AS ws, event_type, {AMOUNT} AS amount FROM events, range(0, 5) r(k))
    SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, event_type AS category, CAST(sum(amount) AS DOUBLE) AS total_revenue,
           count(*) AS transaction_count, CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_transaction FROM w GROUP BY ws, event_type"""
)
def windowed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _places(spark, "windowed")
    stream = jobs.flat_window(jobs.windowed_sales(_sales_stream(spark, sf_dir)))
    sinks.finish(sinks.to_updates(stream, out, checkpoint))
    return sinks.read_updates(spark, out, ["window_start", "window_end", "category"])


@query(
    f"""SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type AS category,
        CAST(sum({AMOUNT}) AS DOUBLE) AS total_revenue, count(*) AS transaction_count, CAST(sum({AMOUNT}) AS DOUBLE) / count(*) AS avg_transaction
        FROM events GROUP BY 1, 2, 3"""
)
def windowed_sales_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events staged as CSV transactions with date and time texts, streamed into hourly windows."""
    staged = scratch_path(spark, "transactions")
    ts = F.col("ts")
    load(spark, sf_dir, "events").select(
        F.date_format(ts, "yyyy-MM-dd").alias("transaction_date"), F.date_format(ts, "HH:mm:ss").alias("transaction_time"),
        F.col("event_type").alias("category"), F.col("value").alias("total_amount"),
    ).write.csv(staged, header=True)
    stream = stream_files(spark, staged, "csv", "transaction_date string, transaction_time string, category string, total_amount double", header=True)
    out, checkpoint = _places(spark, "windowed-csv")
    windows = jobs.flat_window(jobs.windowed_sales(jobs.timed_transactions(stream), size="1 hour", slide=None))
    sinks.finish(sinks.to_updates(windows, out, checkpoint))
    return sinks.read_updates(spark, out, ["window_start", "window_end", "category"])


@query(f"SELECT event_type AS category, CAST(sum({AMOUNT}) AS DOUBLE) AS cumulative_revenue, count(*) AS total_transactions FROM events GROUP BY 1")
def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _places(spark, "totals")
    sinks.finish(sinks.to_snapshot(jobs.running_totals(_sales_stream(spark, sf_dir)), out, checkpoint))
    return read_as_of(spark, out)


@query(f"SELECT event_type AS category, concat('city-', user_id % 5) AS city, CAST(sum({AMOUNT}) AS DOUBLE) AS revenue FROM events GROUP BY 1, 2")
def category_city_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _places(spark, "category-city")
    placed = _sales_stream(spark, sf_dir).withColumn("city", F.concat(F.lit("city-"), (F.col("user_id") % 5).cast("string")))
    sinks.finish(sinks.to_snapshot(category_city(placed), out, checkpoint))
    return read_as_of(spark, out)


def _messages(spark: SparkSession, sf_dir: str, rows: DataFrame, key: str) -> DataFrame:
    """Rows staged as files of key, value and timestamp, and read back as a stream of such records."""
    path = scratch_path(spark, "messages")
    columns = [c for c in rows.columns if c != "timestamp"]
    rows.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*columns, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"))).cast("binary").alias("value"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    ).write.parquet(path)
    return stream_files(spark, path, "parquet", "key binary, value binary, timestamp timestamp")


@query(
    LOGS
    + """SELECT event_id, level, service, response_time_ms, CAST(hour(timestamp) AS INTEGER) AS hour, CASE level WHEN 'CRITICAL' THEN 5 WHEN 'ERROR' THEN 4 WHEN 'WARN' THEN 3 WHEN 'INFO' THEN 2 ELSE 1 END AS severity,
         coalesce(level IN ('CRITICAL', 'ERROR'), false) AS alert_required FROM logs"""
)
def log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _places(spark, "logs")
    raw = _messages(spark, sf_dir, logs(spark, sf_dir), "service")
    schema = "event_id bigint, timestamp string, level string, service string, message string, response_time_ms int"
    sinks.finish(sinks.to_table(jobs.log_stream(raw, schema), out, checkpoint, by=["hour"]))
    return spark.read.parquet(out).select("event_id", "level", "service", "response_time_ms", "hour", "severity", "alert_required")


@query(
    SENSORS
    + """SELECT event_id, CAST(event_id AS VARCHAR) AS key, concat(building, '-', floor) AS sensor_location,
         CASE WHEN temperature > 30 THEN 'HIGH_TEMP' WHEN temperature < 10 THEN 'LOW_TEMP' ELSE 'NORMAL' END AS alert_status FROM sensors"""
)
def sensor_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _places(spark, "sensors")
    raw = _messages(spark, sf_dir, sensors(spark, sf_dir), "event_id")
    sinks.finish(sinks.to_table(jobs.sensor_stream(raw, now=NOON), out, checkpoint))
    return spark.read.parquet(out).select("event_id", "key", "sensor_location", "alert_status")


@query(VALIDATED_SQL)
def validated_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One streaming query that writes valid and quarantined readings to their own folders."""
    staged = scratch_path(spark, "readings")
    sensors(spark, sf_dir).write.parquet(staged)
    out, checkpoint = _places(spark, "validated")
    stream = stream_files(spark, staged, "parquet", sensors(spark, sf_dir).schema)
    sinks.finish(sinks.to_table(jobs.validated_stream(stream, NOON), out, checkpoint, by=["validation_status"]))
    return spark.read.parquet(out).select(
        "event_id", "is_valid_temperature", "is_valid_humidity", "is_valid_sensor_id", "has_required_fields",
        "validation_status", "validated_at", "validation_version",
    )


@query(CDC_SQL)
def merge_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = scratch_path(spark, "changes")
    order_envelopes(spark, sf_dir).write.parquet(staged)
    out, checkpoint = _places(spark, "merged")
    merged.load_base(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), out, ["o_orderkey"], places=8)
    changes = flatten_cdc(stream_files(spark, staged, "parquet", "value string"), ROW, ["o_orderkey"])
    sinks.finish(merged.merge_stream(changes, out, checkpoint))
    return merged.read_merged(spark, out)


@query(
    """SELECT o_orderkey, 'R' AS o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, 'U', o_totalprice * 2 FROM orders WHERE o_orderstatus NOT IN ('O', 'P')"""
)
def merge_stream_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the newer changes first, with changes that lack an operation and texts that are no JSON among them."""
    staged, (out, checkpoint) = scratch_path(spark, "changes"), _places(spark, "merged")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    merged.load_base(orders, out, ["o_orderkey"], places=8)
    image = "named_struct('o_orderkey', o_orderkey, 'o_orderstatus', '{}', 'o_totalprice', o_totalprice * {})"
    none = "cast(null as struct<o_orderkey: bigint, o_orderstatus: string, o_totalprice: double>)"

    def envelopes(status: str | None, op: str, ts: int, before: str, after: str) -> DataFrame:
        rows = orders if status is None else orders.filter(F.col("o_orderstatus") == status)
        return rows.selectExpr(f"to_json(named_struct('before', {before}, 'after', {after}, 'op', {op}, 'ts_ms', {ts})) AS value")

    update = envelopes(None, "'u'", 1_700_000_000_000, none, image.format("U", 2))
    delete = [envelopes(s, "'d'", 1_700_000_001_000, image.format(s, 1), none) for s in ("O", "P")]
    create = envelopes("P", "'c'", 1_700_000_002_000, none, image.format("R", 1))
    unknown = envelopes("F", "cast(null as string)", 1_700_000_003_000, none, "named_struct('o_orderkey', -o_orderkey, 'o_orderstatus', 'X', 'o_totalprice', 0D)")
    broken = orders.select(F.concat(F.lit("{no json "), "o_orderkey").alias("value"))
    for batch in (create.unionByName(delete[0]).unionByName(unknown), update.unionByName(delete[1]).unionByName(broken)):
        batch.write.mode("append").parquet(staged)
        changes = flatten_cdc(stream_files(spark, staged, "parquet", "value string"), ROW, ["o_orderkey"])
        sinks.finish(merged.merge_stream(changes, out, checkpoint))
    return merged.read_merged(spark, out)


MINUTE = 60_000_000
PLACES = "o_orderkey div 1000"


def _changing_orders(spark: SparkSession, sf_dir: str) -> tuple[str, Callable[..., None]]:
    """Orders as a merged table in places of a thousand keys, and a function that streams one batch of changes into it."""
    staged, (out, checkpoint) = scratch_path(spark, "changes"), _places(spark, "merged")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    merged.load_base(orders, out, ["o_orderkey"], place=PLACES)

    def change(which: str, op: str, minute: int, status: str, price: str = "o_totalprice") -> None:
        columns = ["o_orderkey", f"'{status}' AS o_orderstatus", f"{price} AS o_totalprice", f"'{op}' AS operation", f"timestamp_micros({minute * MINUTE}L) AS changed_at"]
        rows = orders.filter(which).selectExpr(*columns)
        rows.write.mode("append").parquet(staged)
        sinks.finish(merged.merge_stream(stream_files(spark, staged, "parquet", rows.schema), out, checkpoint))

    return out, change


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'B' WHEN o_orderkey % 5 = 0 THEN 'C' WHEN o_orderstatus = 'F' THEN 'A' ELSE o_orderstatus END AS o_orderstatus,
              CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 OR o_orderstatus <> 'P'"""
)
def fold_between_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches, folded after the third and the fourth; the third brings changes older than the second's."""
    out, change = _changing_orders(spark, sf_dir)
    change("o_orderstatus = 'F'", "u", 10, "A")
    change("o_orderkey % 3 = 0", "u", 30, "B", "7D")
    change("o_orderstatus = 'P' OR o_orderkey % 3 = 0", "d", 20, "X")
    merged.fold_changes(spark, out, "5 minutes")
    change("o_orderkey % 5 = 0", "c", 25, "C")
    merged.fold_changes(spark, out, "0 minutes")
    return merged.read_merged(spark, out)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 THEN 'N' ELSE o_orderstatus END AS o_orderstatus, o_totalprice + 1 AS o_totalprice
    FROM orders WHERE o_orderkey % 4 <> 2"""
)
def load_over_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second full load complete up to minute 40: changes up to then no longer count, whenever they come; later ones do."""
    out, change = _changing_orders(spark, sf_dir)
    change("o_orderkey % 2 = 0", "u", 10, "OLD", "0D")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    merged.load_base(orders, out, ["o_orderkey"], dt.datetime(1970, 1, 1, 0, 40), place=PLACES)
    change("o_orderkey % 3 = 0", "d", 39, "STALE")
    change("o_orderkey % 4 = 1", "u", 41, "N", "o_totalprice + 1")
    change("o_orderkey % 4 = 2", "d", 42, "GONE")
    merged.fold_changes(spark, out, "0 minutes")
    return merged.read_merged(spark, out)


@query(
    """WITH t AS (SELECT o_orderkey // 1000 AS place, o_orderkey FROM orders), top AS (SELECT max(place) AS place FROM t)
    SELECT count(DISTINCT place) AS places, count(DISTINCT place) FILTER (place = (SELECT place FROM top)) AS rewritten,
           count(*) FILTER (place = (SELECT place FROM top)) AS changes FROM t"""
)
def fold_touches_few_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the newest thousand keys only: what the fold reports, one place of all."""
    out, change = _changing_orders(spark, sf_dir)
    newest = load(spark, sf_dir, "orders").agg(F.expr(f"max({PLACES})")).first()[0]
    change(f"{PLACES} = {newest}", "u", 10, "A")
    change("false", "u", 20, "A")
    done = merged.fold_changes(spark, out, "0 minutes")
    return spark.createDataFrame([(done.places, done.rewritten, done.changes)], "places long, rewritten long, changes long")


def _in_parts(spark: SparkSession, sf_dir: str, run: Callable[[str], object], parts: int = 4, late: bool = False) -> None:
    """Events staged in ``parts`` steps by time, ``run`` after each; with ``late`` the first step's rows come again at the end."""
    events, folder = load(spark, sf_dir, "events"), scratch_path(spark, "parts")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = events.agg(F.min(micros), F.max(micros)).first()
    part = F.least(F.floor((micros - (lo or 0)) * parts / max(1, (hi or 0) - (lo or 0))), F.lit(parts - 1))
    for k in [*range(parts), *[0] * late]:
        events.filter(part == k).write.mode("append").parquet(folder)
        run(folder)


@query(
    f"""SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type AS category,
        CAST(sum({AMOUNT}) AS DOUBLE) AS total_revenue, count(*) AS transaction_count, CAST(sum({AMOUNT}) AS DOUBLE) / count(*) AS avg_transaction
        FROM events GROUP BY 1, 2, 3 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""
)
def late_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows over four batches and a fifth of late rows only, which change nothing."""
    out, checkpoint = _places(spark, "late")

    def run(folder: str) -> None:
        events = stream_files(spark, folder, "parquet", TABLES["events"])
        sales = events.select(F.col("ts").alias("timestamp"), F.col("event_type").alias("category"), F.col("value").alias("total_amount"))
        windows = jobs.flat_window(jobs.windowed_sales(sales, size="1 hour", slide=None, late="10 minutes"))
        sinks.finish(sinks.to_table(windows, out, checkpoint))

    _in_parts(spark, sf_dir, run, late=True)
    return spark.read.parquet(out)


@query("SELECT event_id, event_type, c_name, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey")
def enrich_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _places(spark, "enriched")
    lookup = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    stream = joins.enrich(stream_table(spark, sf_dir, "events"), lookup, "user_id", "left")
    sinks.finish(sinks.to_table(stream.select("event_id", "event_type", "c_name", "c_mktsegment"), out, checkpoint))
    return spark.read.parquet(out)


@query("SELECT 'errors in batch' AS alert, 'WARNING' AS level, CAST(count(*) FILTER (event_type = 'error') AS DOUBLE) AS value, 100.0::DOUBLE AS limit_ FROM events")
def alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _places(spark, "alerts")
    metric = F.count_if(F.col("event_type") == "error")
    sinks.finish(sinks.alert_stream(stream_table(spark, sf_dir, "events"), out, checkpoint, metric, 100, "errors in batch"))
    return sinks.read_batches(spark, out).drop("batch_id").withColumnRenamed("limit", "limit_")


@query(
    """WITH p AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, event_id,
                  (row_number() OVER (PARTITION BY time_bucket(INTERVAL 1 HOUR, ts), event_type ORDER BY event_id) - 1) // 3 + 1 AS bundle_no FROM events)
    SELECT window_start, event_type, bundle_no, string_agg(event_id, ',' ORDER BY event_id) AS ids FROM p
    WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY window_start, event_type, bundle_no"""
)
def bundle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in four batches whose bounds cut windows; windows that the watermark has passed are bundled."""
    out, checkpoint = _places(spark, "bundles")

    def run(folder: str) -> None:
        events = stream_files(spark, folder, "parquet", TABLES["events"]).select("event_id", "ts", "event_type")
        sinks.finish(sinks.bundle_stream(events, out, checkpoint, "ts", ["event_type"], ["event_id"], "1 hour", 3, None, "10 minutes", 4))

    _in_parts(spark, sf_dir, run)
    ids = F.array_join(F.transform("records", lambda r: r["event_id"].cast("string")), ",")
    return sinks.read_batches(spark, out).select("window_start", "event_type", "bundle_no", ids.alias("ids"))
