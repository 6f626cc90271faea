"""Health figures over recent records. ``now`` is given by the caller, so that results repeat."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _since(df: DataFrame, column: str, now: object, back: dt.timedelta) -> DataFrame:
    """Rows later than ``now - back``: a literal bound, which a file scan can use to skip data."""
    return df.filter(F.col(column) > F.lit(now - back))


def ingest_health(logs: DataFrame, now: dt.datetime) -> DataFrame:
    """Records, valid and invalid records and mean response time over the last hour."""
    recent = _since(logs, "timestamp", now, dt.timedelta(hours=1))
    valid = F.col("is_valid")
    return recent.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(valid).alias("valid_records"),
        F.count_if(~valid).alias("invalid_records"),
        F.avg("response_time_ms").alias("avg_response_time"),
    ).select(F.lit(now).alias("check_time"), "*")


def error_rate(logs: DataFrame, now: dt.datetime) -> DataFrame:
    """Percentage of ERROR records per hour over the last 24 hours."""
    recent = _since(logs, "timestamp", now, dt.timedelta(hours=24))
    hourly = recent.groupBy(F.date_trunc("hour", F.col("timestamp")).alias("hour")).agg(
        F.count(F.lit(1)).alias("total_requests"), F.count_if(F.col("level") == "ERROR").alias("errors")
    )
    rate = F.round(F.lit(100.0) * F.col("errors").cast("double") / F.col("total_requests").cast("double"), 2)
    return hourly.withColumn("error_rate", rate).orderBy(F.desc("hour"))


def error_rate_alerts(logs: DataFrame, now: dt.datetime, limit: float = 5.0) -> DataFrame:
    return error_rate(logs, now).filter(F.col("error_rate") > limit)


def quality_trend(graded: DataFrame, today: dt.date, date_col: str = "processing_date") -> DataFrame:
    """Readings per day and grade over the last 7 days."""
    recent = graded.filter(F.col(date_col) > F.lit(today - dt.timedelta(days=7)))
    return (
        recent.groupBy(F.col(date_col).alias("processing_date"), "data_quality_score")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy(F.desc("processing_date"), "data_quality_score")
    )


def latest_moment(df: DataFrame, column: str = "timestamp") -> dt.datetime:
    """The newest time in the data, as a stand-in for the clock."""
    return df.agg(F.max(column).alias("latest")).first()["latest"]
