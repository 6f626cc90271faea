"""Queries over logs, sensor readings, texts and pages."""

from __future__ import annotations

import datetime as dt
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import columns, parsing
from tallyloom.operators import enrichment, monitoring, ordering, quality, text
from tallyloom.plans.registry import LOGS, SENSORS, query
from tallyloom.plans.views import logs, sensors
from tallyloom.sources.readers import load, read_incremental

NOON = dt.datetime(2024, 6, 1, 12, 0, 0)

# --- filters and validation


@query(SENSORS + "SELECT event_id, sensor_id FROM sensors WHERE regexp_matches(sensor_id, '^SENS[0-9]{3}$')")
def well_formed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensors(spark, sf_dir).filter(F.col("sensor_id").rlike(columns.SENSOR_ID_PATTERN)).select("event_id", "sensor_id")


VALID = "coalesce(temperature BETWEEN -50 AND 50 AND humidity BETWEEN 0 AND 100 AND sensor_id IS NOT NULL AND timestamp IS NOT NULL, false)"


@query(SENSORS + f"SELECT event_id, {VALID} AS is_valid FROM sensors")
def flag_valid_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.flag_valid_readings(sensors(spark, sf_dir)).select("event_id", "is_valid")


@query(SENSORS + f"SELECT event_id, sensor_id, temperature FROM sensors WHERE NOT {VALID}")
def quarantined_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, invalid = quality.split_valid(quality.flag_valid_readings(sensors(spark, sf_dir)))
    return invalid.select("event_id", "sensor_id", "temperature")


@query(SENSORS + f"SELECT count(*) FILTER ({VALID}) AS valid_count, count(*) FILTER (NOT {VALID}) AS invalid_count, count(*) AS total_processed FROM sensors")
def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ingest_summary(quality.flag_valid_readings(sensors(spark, sf_dir)))


VALIDATED_SQL = (
    SENSORS
    + """, v AS (SELECT event_id, temperature BETWEEN -50 AND 50 AS is_valid_temperature, humidity BETWEEN 0 AND 100 AS is_valid_humidity,
         regexp_matches(sensor_id, '^SENS[0-9]{3}$') AS is_valid_sensor_id,
         sensor_id IS NOT NULL AND timestamp IS NOT NULL AND temperature IS NOT NULL AS has_required_fields FROM sensors)
    SELECT *, CASE WHEN is_valid_temperature AND is_valid_humidity AND is_valid_sensor_id AND has_required_fields THEN 'VALID' ELSE 'INVALID' END AS validation_status,
           TIMESTAMP '2024-06-01 12:00:00' AS validated_at, 'v1.0' AS validation_version FROM v"""
)


@query(VALIDATED_SQL)
def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.validate(sensors(spark, sf_dir), now=NOON)
    return judged.select(
        "event_id", "is_valid_temperature", "is_valid_humidity", "is_valid_sensor_id", "has_required_fields",
        "validation_status", "validated_at", "validation_version",
    )


ROUTES_SQL = {
    "critical": "level = 'CRITICAL' OR response_time_ms > 5000",
    "errors": "level = 'ERROR' AND response_time_ms <= 5000",
    "warnings": "level = 'WARN'",
    "info": "level IN ('INFO', 'DEBUG')",
}
_ANY_ROUTE = " OR ".join(f"coalesce({p}, false)" for p in ROUTES_SQL.values())


@query(
    LOGS
    + " UNION ALL ".join(f"SELECT event_id, '{name}' AS route FROM logs WHERE {p}" for name, p in ROUTES_SQL.items())
    + f" UNION ALL SELECT event_id, 'unmatched' FROM logs WHERE NOT ({_ANY_ROUTE})"
)
def routed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.routed(logs(spark, sf_dir), quality.log_routes()).select("event_id", "route")


@query(LOGS + f"SELECT event_id, level, service FROM logs WHERE {ROUTES_SQL['critical']}")
def critical_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.route(logs(spark, sf_dir), quality.log_routes())["critical"].select("event_id", "level", "service")


@query(
    LOGS
    + """SELECT event_id, CASE WHEN level IN ('ERROR', 'CRITICAL') THEN 'errors' WHEN level = 'WARN' THEN 'warnings'
         WHEN level = 'INFO' THEN 'info' ELSE 'unmatched' END AS route FROM logs"""
)
def route_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.route_first(logs(spark, sf_dir), quality.level_routes()).select("event_id", "route")


@query(LOGS + "SELECT " + ", ".join(f"count(*) FILTER ({p}) AS {name}" for name, p in ROUTES_SQL.items()) + f", count(*) FILTER (NOT ({_ANY_ROUTE})) AS unmatched FROM logs")
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.route_counts(logs(spark, sf_dir), quality.log_routes())


GRADED = (
    SENSORS
    + """, f AS (SELECT event_id, timestamp, sensor_id IS NULL OR timestamp IS NULL AS has_nulls, temperature BETWEEN -50 AND 50 AS temp_in_range,
         humidity BETWEEN 0 AND 100 AS humidity_in_range, battery_level < 10 AS battery_critical FROM sensors),
    g AS (SELECT *, CASE WHEN NOT has_nulls AND temp_in_range AND humidity_in_range THEN 'GOOD'
          WHEN has_nulls OR NOT temp_in_range OR NOT humidity_in_range THEN 'POOR' ELSE 'FAIR' END AS data_quality_score FROM f)
    """
)


@query(GRADED + "SELECT event_id, has_nulls, temp_in_range, humidity_in_range, battery_critical FROM f")
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = quality.quality_flags(sensors(spark, sf_dir))
    return flagged.select("event_id", "has_nulls", "temp_in_range", "humidity_in_range", "battery_critical")


@query(GRADED + "SELECT event_id, data_quality_score FROM g")
def quality_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_grade(sensors(spark, sf_dir)).select("event_id", "data_quality_score")


@query(GRADED + "SELECT data_quality_score, count(*) AS count FROM g GROUP BY data_quality_score")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(quality.quality_grade(sensors(spark, sf_dir)))


EXPECTED = {"warm": "temperature > 0", "charged": "battery_level >= 10", "known": "sensor_id IS NOT NULL"}


@query(
    SENSORS
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER ({rule}) AS passed, count(*) FILTER (NOT coalesce({rule}, false)) AS failed FROM sensors"
        for name, rule in EXPECTED.items()
    )
)
def expectation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expectation_counts(sensors(spark, sf_dir), EXPECTED)


@query(
    SENSORS
    + ", q AS (SELECT event_id, concat_ws(',', "
    + ", ".join(f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END" for name, rule in EXPECTED.items())
    + ") AS failed_rules FROM sensors) SELECT * FROM q WHERE failed_rules <> ''"
)
def expectations_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = quality.expectations(sensors(spark, sf_dir), EXPECTED, "quarantine")
    return failed.select("event_id", F.array_join("failed_rules", ",").alias("failed_rules"))


@query(
    LOGS
    + """SELECT 'errors per service' AS alert, 'WARNING' AS level, service, CAST(count(*) FILTER (level = 'ERROR') AS DOUBLE) AS value, 165.0::DOUBLE AS limit_
         FROM logs GROUP BY service HAVING count(*) FILTER (level = 'ERROR') > 165"""
)
def threshold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = F.count_if(F.col("level") == "ERROR")
    return quality.threshold_alert(logs(spark, sf_dir), errors, 165, "errors per service", ("service",)).withColumnRenamed("limit", "limit_")


@query(
    SENSORS
    + f"""SELECT 'out of range' AS error_reason, concat(event_id, ',', coalesce(sensor_id, '')) AS raw_payload, TIMESTAMP '2024-06-01 12:00:00' AS failed_at
          FROM sensors WHERE NOT {VALID}"""
)
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = quality.split_valid(quality.flag_valid_readings(sensors(spark, sf_dir)))
    payload = F.concat(F.col("event_id").cast("string"), F.lit(","), F.coalesce("sensor_id", F.lit("")))
    return quality.dead_letters(bad, "out of range", payload, NOON)


# --- monitoring, as of the newest record


@query(
    LOGS
    + """, n AS (SELECT max(timestamp) AS now FROM logs)
    SELECT any_value(now) AS check_time, count(*) AS total_records, count(*) FILTER (is_valid) AS valid_records, count(*) FILTER (NOT is_valid) AS invalid_records,
           avg(response_time_ms) AS avg_response_time FROM logs, n WHERE timestamp > now - INTERVAL 1 HOUR"""
)
def ingest_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = logs(spark, sf_dir)
    return monitoring.ingest_health(records, monitoring.latest_moment(records))


_RATE = (
    LOGS
    + """, n AS (SELECT max(timestamp) AS now FROM logs), r AS (
    SELECT date_trunc('hour', timestamp) AS hour, count(*) AS total_requests, count(*) FILTER (level = 'ERROR') AS errors,
           round(100.0::DOUBLE * CAST(count(*) FILTER (level = 'ERROR') AS DOUBLE) / CAST(count(*) AS DOUBLE), 2) AS error_rate
    FROM logs, n WHERE timestamp > now - INTERVAL 24 HOUR GROUP BY 1)
    """
)


@query(_RATE + "SELECT * FROM r")
def error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = logs(spark, sf_dir)
    return monitoring.error_rate(records, monitoring.latest_moment(records))


@query(_RATE + "SELECT * FROM r WHERE error_rate > 20")
def error_rate_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = logs(spark, sf_dir)
    return monitoring.error_rate_alerts(records, monitoring.latest_moment(records), 20.0)


@query(
    GRADED
    + """, n AS (SELECT CAST(max(timestamp) AS DATE) AS today FROM g)
    SELECT CAST(timestamp AS DATE) AS processing_date, data_quality_score, count(*) AS record_count
    FROM g, n WHERE CAST(timestamp AS DATE) > today - INTERVAL 7 DAY GROUP BY 1, 2"""
)
def quality_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = quality.quality_grade(sensors(spark, sf_dir)).withColumn("processing_date", F.to_date("timestamp"))
    today = monitoring.latest_moment(load(spark, sf_dir, "events"), "ts").date()
    return monitoring.quality_trend(graded, today)


# --- derived columns


@query(
    LOGS
    + """SELECT event_id, CAST(hour(timestamp) AS INTEGER) AS hour, CASE level WHEN 'CRITICAL' THEN 5 WHEN 'ERROR' THEN 4 WHEN 'WARN' THEN 3 WHEN 'INFO' THEN 2 ELSE 1 END AS severity,
         coalesce(level IN ('CRITICAL', 'ERROR'), false) AS alert_required FROM logs"""
)
def score_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.score_logs(logs(spark, sf_dir)).select("event_id", "hour", "severity", "alert_required")


LABELLED_SQL = (
    SENSORS
    + """SELECT event_id, concat(building, '-', floor) AS sensor_location, CASE WHEN temperature > 30 THEN 'HIGH_TEMP' WHEN temperature < 10 THEN 'LOW_TEMP' ELSE 'NORMAL' END AS alert_status,
         TIMESTAMP '2024-06-01 12:00:00' AS processed_timestamp FROM sensors"""
)


@query(LABELLED_SQL)
def label_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.label_sensors(sensors(spark, sf_dir), NOON).select("event_id", "sensor_location", "alert_status", "processed_timestamp")


@query("SELECT event_id, TIMESTAMP '2024-06-01 12:00:00' AS ingestion_timestamp, 'events' AS data_source, DATE '2024-06-01' AS processing_date, 'events.parquet' AS file_name FROM events")
def ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = enrichment.with_ingest_metadata(load(spark, sf_dir, "events"), "events", NOON, file_name=True)
    name = F.element_at(F.split("file_name", "/"), -1)
    return stamped.select("event_id", "ingestion_timestamp", "data_source", "processing_date", name.alias("file_name"))


@query("SELECT event_id, user_id AS actor, event_type AS action, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = load(spark, sf_dir, "events").select(
        "event_id", F.struct(F.col("user_id"), F.struct("event_type").alias("act")).alias("who"), parsing.json_record("props", "k int").alias("data")
    )
    return enrichment.reshape(nested, {"event_id": "event_id", "actor": "who.user_id", "action": "who.act.event_type", "k": "data.k"})


@query("SELECT event_id, json_extract_string(props, '$.k') AS k_text, event_type AS kind FROM events")
def property_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = lambda key, value: F.struct(F.lit(key).alias("key"), value.alias("value"))
    events = load(spark, sf_dir, "events")
    listed = events.select("event_id", F.array(pair("k", parsing.json_value("props", "$.k")), pair("type", F.col("event_type"))).alias("properties"))
    return enrichment.with_properties(listed, "properties", {"k_text": "k", "kind": "type"}).drop("properties")


@query(
    """SELECT event_id, strftime(ts, '%Y/%m/%d') AS folder, concat(event_type, '.log_', CAST(epoch_us(ts) // 1000 AS VARCHAR)) AS file_name,
       printf('$%.2f', value) AS amount, strptime(concat(strftime(ts, '%Y-%m-%d'), ' ', strftime(ts, '%H:%M:%S')), '%Y-%m-%d %H:%M:%S') AS moment,
       TRY_CAST(CASE WHEN event_type = 'view' THEN 'n/a' ELSE concat(' ', CAST(user_id AS VARCHAR), ' ') END AS DOUBLE) AS number
       FROM events"""
)
def text_and_time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    messy = F.when(F.col("event_type") == "view", "n/a").otherwise(F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")))
    return load(spark, sf_dir, "events").select(
        "event_id",
        parsing.dated_folder(ts).alias("folder"),
        parsing.stamped_name(F.concat("event_type", F.lit(".log.txt")), ts).alias("file_name"),
        parsing.currency("value").alias("amount"),
        parsing.event_time(F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss")).alias("moment"),
        parsing.safe_number(messy).alias("number"),
    )


@query("SELECT event_id, ts, event_type FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def incremental_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return read_incremental(load(spark, sf_dir, "events"), "ts", mark).select("event_id", "ts", "event_type")


# --- text


@query(
    r"""WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS word FROM documents)
    SELECT word, count(*) AS count FROM w GROUP BY word"""
)
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.word_count(load(spark, sf_dir, "documents"), "text")


@query(r"SELECT page_id, nullif(regexp_extract(url, '^https?://([^/]+)/', 1), '') AS host, try_cast(nullif(regexp_extract(url, 'page=(\d+)', 1), '') AS INTEGER) AS page FROM pages")
def extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "pages").select(
        "page_id",
        parsing.extract("url", "^https?://([^/]+)/").alias("host"),
        parsing.extract("url", r"page=(\d+)").try_cast("int").alias("page"),
    )


@query(
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT doc_id, count(*) AS lines, max(length(line)) AS longest FROM l GROUP BY doc_id"""
)
def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = enrichment.split_lines(load(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.max(F.length("line")).cast("long").alias("longest"))


@query(
    """WITH e AS (SELECT vec_id, unnest(embedding) AS x FROM embeddings)
    SELECT vec_id, count(*) AS parts, max(x)::DOUBLE AS largest FROM e GROUP BY vec_id"""
)
def split_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = load(spark, sf_dir, "embeddings").select("vec_id", F.to_json("embedding").alias("payload"))
    parts = enrichment.split_json_array(staged, "payload", "float", "x")
    return parts.groupBy("vec_id").agg(F.count(F.lit(1)).alias("parts"), F.max("x").cast("double").alias("largest"))


@query("SELECT page_id, length(html) AS html_length, length(url) AS url_length FROM pages")
def enrich_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make_client():
        def call(batch: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"page_id": batch["page_id"], "html_length": batch["html"].str.len(), "url_length": batch["url"].str.len()})

        return call

    pages = load(spark, sf_dir, "pages").select("page_id", "html", "url")
    return enrichment.enrich_batches(pages, make_client, "page_id long, html_length long, url_length long", 100)


@query("SELECT page_id, CASE WHEN page_id % 50 <> 7 THEN length(nfc_normalize(html)) END AS composed_length, page_id % 50 = 7 AS failed FROM pages")
def enrich_or_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in Unicode's composed form by an external call that fails on some pages; those come out as dead letters."""

    def make_client():
        def call(batch: pd.DataFrame) -> pd.DataFrame:
            if (batch["page_id"] % 50 == 7).any():
                raise ValueError("a page that the service refuses")
            composed = batch["html"].map(lambda t: None if t is None else len(unicodedata.normalize("NFC", t)))
            return pd.DataFrame({"page_id": batch["page_id"], "composed_length": composed})

        return call

    pages = load(spark, sf_dir, "pages").select("page_id", "html")
    good, bad = enrichment.enrich_or_reject(pages, make_client, "page_id long, composed_length long", 100)
    lost = bad.select(F.get_json_object("raw_payload", "$.page_id").cast("long").alias("page_id"), F.lit(None).cast("long").alias("composed_length"), F.lit(True).alias("failed"))
    return good.withColumn("failed", F.lit(False)).unionByName(lost)


# --- latest rows and bundles


@query(
    """SELECT user_id, event_id, ts, event_type FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1"""
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return ordering.latest_per_key(events, "user_id", "ts", "event_id")


BUNDLE_SIZE = 3


@query(
    f"""WITH p AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // {BUNDLE_SIZE} + 1 AS bundle_no FROM conversations)
    SELECT conv_id, bundle_no, count(*) AS records, string_agg(concat(turn, ':', role, ':', length(text)), '|' ORDER BY turn) AS content FROM p GROUP BY conv_id, bundle_no"""
)
def bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundled = ordering.bundle(load(spark, sf_dir, "conversations"), "conv_id", "turn", BUNDLE_SIZE)
    entry = lambda r: F.concat_ws(":", r["turn"].cast("string"), r["role"], F.length(r["text"]).cast("string"))
    return bundled.select(
        "conv_id", "bundle_no", F.size("records").cast("long").alias("records"), F.array_join(F.transform("records", entry), "|").alias("content")
    )


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position FROM events")
def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return ordering.with_position(events, "user_id", ["ts", "event_id"]).select("event_id", "user_id", "position")
