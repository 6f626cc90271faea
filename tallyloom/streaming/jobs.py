"""Stream transformations. Each takes and returns a streaming DataFrame; most run on a batch just as well."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.measures import mean, total
from tallyloom.functions.parsing import event_time
from tallyloom.operators.enrichment import label_sensors, parse_records, score_logs
from tallyloom.operators.quality import validate
from tallyloom.sources.readers import LOG_SCHEMA

SENSOR_EVENT_SCHEMA = (
    "event_id bigint, sensor_id string, building string, floor string, temperature double, humidity double, battery_level int"
)


def windowed_sales(
    stream: DataFrame,
    ts: str = "timestamp",
    by: str = "category",
    amount: str = "total_amount",
    size: str = "5 minutes",
    slide: str | None = "1 minute",
    late: str = "10 minutes",
) -> DataFrame:
    """Revenue, transactions and average per sliding event-time window; rows later than ``late`` are dropped once the
    watermark has passed their windows."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return timed.groupBy(window, by).agg(
        total(timed, amount).alias("total_revenue"), F.count(F.lit(1)).alias("transaction_count"), mean(timed, amount).alias("avg_transaction")
    )


def timed_transactions(stream: DataFrame, date_col: str = "transaction_date", time_col: str = "transaction_time") -> DataFrame:
    """Transactions with an event time made of their date and time texts; null where these do not parse."""
    return stream.withColumn("timestamp", event_time(date_col, time_col))


def flat_window(df: DataFrame) -> DataFrame:
    """The window struct as two plain columns, for file sinks."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def running_totals(stream: DataFrame, by: str = "category", amount: str = "total_amount") -> DataFrame:
    """Totals since the start; the state holds one row per group."""
    return stream.groupBy(by).agg(total(stream, amount).alias("cumulative_revenue"), F.count(F.lit(1)).alias("total_transactions"))


def log_stream(raw: DataFrame, schema: T.StructType | str = LOG_SCHEMA) -> DataFrame:
    """Key/value/timestamp records with a JSON log record as value: parsed, with hour, severity and alert flag."""
    arrived = raw.withColumnRenamed("timestamp", "kafka_timestamp")
    return score_logs(parse_records(arrived, schema, keep=["kafka_timestamp"]))


def sensor_stream(raw: DataFrame, schema: T.StructType | str = SENSOR_EVENT_SCHEMA, now: object = None) -> DataFrame:
    """Key/value/timestamp records with a JSON sensor reading as value: parsed, located and labelled."""
    keyed = raw.withColumn("key", F.col("key").cast("string"))
    return label_sensors(parse_records(keyed, schema, keep=["key", "timestamp"]), now)


def validated_stream(stream: DataFrame, now: object = None) -> DataFrame:
    """Readings with rule flags and verdict. Written partitioned by ``validation_status``, one query feeds the valid
    folder and the quarantine."""
    return validate(stream, now=now)
