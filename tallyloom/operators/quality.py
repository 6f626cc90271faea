"""Validation, splitting, routing and quality reports.

A rule is a boolean column. Unknown (null) counts as failed wherever a verdict is drawn; the raw flags keep it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import (
    BATTERY_MINIMUM,
    HUMIDITY_RANGE,
    SENSOR_ID_PATTERN,
    TEMPERATURE_RANGE,
    all_of,
    certain,
    every_match,
    first_match,
    within,
)

Rules = Mapping[str, "Column | str"]


def _expression(rule: Column | str) -> Column:
    return F.expr(rule) if isinstance(rule, str) else rule


def reading_rule(with_timestamp: bool = True) -> Column:
    """A sensor reading in range, with its id (and its time)."""
    parts = [within("temperature", TEMPERATURE_RANGE), within("humidity", HUMIDITY_RANGE), F.col("sensor_id").isNotNull()]
    return all_of(parts + ([F.col("timestamp").isNotNull()] if with_timestamp else []))


def flag_valid_readings(df: DataFrame, with_timestamp: bool = True) -> DataFrame:
    return df.withColumn("is_valid", certain(reading_rule(with_timestamp)))


def sensor_rules() -> dict[str, Column]:
    return {
        "is_valid_temperature": within("temperature", TEMPERATURE_RANGE),
        "is_valid_humidity": within("humidity", HUMIDITY_RANGE),
        "is_valid_sensor_id": F.col("sensor_id").rlike(SENSOR_ID_PATTERN),
        "has_required_fields": F.col("sensor_id").isNotNull() & F.col("timestamp").isNotNull() & F.col("temperature").isNotNull(),
    }


def validate(df: DataFrame, rules: Rules | None = None, version: str = "v1.0", now: object = None) -> DataFrame:
    """One flag per rule, VALID if all hold and INVALID otherwise, and when and by which version it was judged."""
    flags = {name: _expression(rule) for name, rule in (sensor_rules() if rules is None else rules).items()}
    moment = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    verdict = F.when(all_of([F.col(name) for name in flags]), "VALID").otherwise("INVALID")
    return df.withColumns(flags).withColumns(
        {"validation_status": verdict, "validated_at": moment, "validation_version": F.lit(version)}
    )


def split_valid(df: DataFrame, rule: Column | str = "is_valid") -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows that do not. Each branch reads the parent: persist it, or use a single partitioned write."""
    passed = certain(_expression(rule))
    return df.filter(passed), df.filter(~passed)


def ingest_summary(df: DataFrame, flag: str = "is_valid") -> DataFrame:
    """Valid, invalid and total rows in one pass."""
    passed = certain(F.col(flag))
    return df.agg(
        F.count_if(passed).alias("valid_count"),
        F.count_if(~passed).alias("invalid_count"),
        F.count(F.lit(1)).alias("total_processed"),
    )


def log_routes() -> dict[str, Column]:
    """Routes of log records; they overlap, and some records match none."""
    level, slow = F.col("level"), F.col("response_time_ms") > 5000
    return {
        "critical": (level == "CRITICAL") | slow,
        "errors": (level == "ERROR") & (F.col("response_time_ms") <= 5000),
        "warnings": level == "WARN",
        "info": level.isin("INFO", "DEBUG"),
    }


def level_routes() -> dict[str, Column]:
    level = F.col("level")
    return {"errors": level.isin("ERROR", "CRITICAL"), "warnings": level == "WARN", "info": level == "INFO"}


def route(df: DataFrame, rules: Mapping[str, Column]) -> dict[str, DataFrame]:
    """One lazily filtered DataFrame per route, and one for rows that match none."""
    routes = {name: df.filter(certain(rule)) for name, rule in rules.items()}
    routes["unmatched"] = df.filter(~F.coalesce(*[F.when(rule, F.lit(True)) for rule in rules.values()], F.lit(False)))
    return routes


def routed(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """All routes in one pass: a row appears once per route it matches, named in the column ``route``."""
    return df.withColumn("route", F.explode(every_match(rules)))


def route_first(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Each row with the first route it matches."""
    return df.withColumn("route", first_match(rules))


def route_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows per route as one row of counts."""
    nothing = ~F.coalesce(*[F.when(rule, F.lit(True)) for rule in rules.values()], F.lit(False))
    return df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()], F.count_if(nothing).alias("unmatched"))


def quality_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "has_nulls": F.col("sensor_id").isNull() | F.col("timestamp").isNull(),
            "temp_in_range": within("temperature", TEMPERATURE_RANGE),
            "humidity_in_range": within("humidity", HUMIDITY_RANGE),
            "battery_critical": F.col("battery_level") < BATTERY_MINIMUM,
        }
    )


def quality_grade(df: DataFrame) -> DataFrame:
    """GOOD if every check holds, POOR if one fails, FAIR if none fails but a range check is unknown."""
    flagged = quality_flags(df)
    checks = [~F.col("has_nulls"), F.col("temp_in_range"), F.col("humidity_in_range")]
    good = all_of(checks)
    return flagged.withColumn("data_quality_score", F.when(good, "GOOD").when(~good, "POOR").otherwise("FAIR"))


def quality_report(graded: DataFrame) -> DataFrame:
    return graded.groupBy("data_quality_score").agg(F.count(F.lit(1)).alias("count"))


def expectation_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """Passed and failed rows per rule, one output row per rule, from one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(_expression(rule)).alias(f"rule_{i}") for i, rule in enumerate(rules.values())]
    )
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col(f"rule_{i}").alias("passed"), (F.col("rows") - F.col(f"rule_{i}")).alias("failed"))
        for i, name in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*rows)))


def expectations(df: DataFrame, rules: Rules, action: str = "keep") -> DataFrame:
    """Rows against named expectations: ``keep`` all, ``drop`` failures, or ``quarantine`` (failures only, with names)."""
    failed = F.filter(
        F.array(*[F.when(~certain(_expression(rule)), F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull()
    )
    if action == "keep":
        return df.withColumn("failed_rules", failed)
    if action == "drop":
        return df.filter(all_of([certain(_expression(rule)) for rule in rules.values()]))
    if action == "quarantine":
        return df.withColumn("failed_rules", failed).filter(F.size("failed_rules") > 0)
    raise ValueError(f"unknown action: {action}")


def threshold_alert(df: DataFrame, metric: Column, limit: float, name: str, by: tuple[str, ...] = (), level: str = "WARNING") -> DataFrame:
    """Alert rows for groups whose aggregate exceeds the limit; no row if none does."""
    measured = df.groupBy(*by).agg(metric.cast("double").alias("value"))
    return measured.filter(F.col("value") > limit).select(
        F.lit(name).alias("alert"), F.lit(level).alias("level"), *by, "value", F.lit(float(limit)).alias("limit")
    )


def dead_letters(bad: DataFrame, reason: str | Column, payload: str | Column, now: object = None) -> DataFrame:
    """Rejected rows as reason, raw payload and time."""
    moment = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    text = F.col(payload) if isinstance(payload, str) else payload
    why = F.lit(reason) if isinstance(reason, str) else reason
    return bad.select(why.alias("error_reason"), text.cast("string").alias("raw_payload"), moment.alias("failed_at"))
