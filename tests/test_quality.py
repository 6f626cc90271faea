import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import enrichment, monitoring, quality

NOW = dt.datetime(2024, 1, 2, 12, 0, 0)


@pytest.fixture
def readings(spark):
    return spark.createDataFrame(
        [
            (1, "t", "SENS001", -50.0, 0.0, 10),
            (2, "t", "SENS002", 50.0, 100.0, 9),
            (3, "t", "SENS003", 50.01, 50.0, 50),
            (4, "t", "SENS004", None, 50.0, 50),
            (5, "t", "SENS005", 20.0, None, 50),
            (6, "t", None, 20.0, 50.0, None),
            (7, "t", "SENS12", 20.0, 50.0, 50),
            (8, None, "SENS008", 20.0, 50.0, 50),
            (9, "t", "SENS009", None, 101.0, 50),
        ],
        "id int, timestamp string, sensor_id string, temperature double, humidity double, battery_level int",
    )


@pytest.fixture
def records(spark):
    return spark.createDataFrame(
        [(1, "WARN", 6000), (2, "ERROR", None), (3, "ODD", 10), (4, "CRITICAL", None), (5, "ERROR", 5000), (6, "INFO", None), (7, None, 9000)],
        "id int, level string, response_time_ms int",
    )


def test_null_measures_are_invalid(readings):
    flagged = quality.flag_valid_readings(readings)
    assert [r["id"] for r in flagged.filter("is_valid").orderBy("id").collect()] == [1, 2, 7]
    assert [r["id"] for r in quality.flag_valid_readings(readings, with_timestamp=False).filter("is_valid").orderBy("id").collect()] == [1, 2, 7, 8]


def test_split_is_complete(readings):
    good, bad = quality.split_valid(readings, quality.reading_rule())
    assert (good.count(), bad.count()) == (3, 6)
    summary = quality.ingest_summary(quality.flag_valid_readings(readings)).first()
    assert tuple(summary) == (3, 6, 9)


def test_documented_validation_case(spark):
    df = spark.createDataFrame(
        [("t", "SENS001", 25.0, 45.0), ("t", "INVALID", 25.0, 45.0), ("t", "SENS002", 100.0, 45.0)],
        "timestamp string, sensor_id string, temperature double, humidity double",
    )
    judged = quality.validate(df, now=NOW)
    assert judged.filter("validation_status = 'VALID'").count() == 1
    assert judged.filter("validation_status = 'INVALID'").count() == 2


def test_custom_rules_as_sql(spark):
    judged = quality.validate(spark.range(4), {"small": "id < 3", "even": "id % 2 = 0"}, "v2", NOW)
    assert [r["validation_status"] for r in judged.orderBy("id").collect()] == ["VALID", "INVALID", "VALID", "INVALID"]


def test_grades(readings):
    got = {r["id"]: r["data_quality_score"] for r in quality.quality_grade(readings).collect()}
    assert got == {1: "GOOD", 2: "GOOD", 3: "POOR", 4: "FAIR", 5: "FAIR", 6: "POOR", 7: "GOOD", 8: "POOR", 9: "POOR"}


def test_battery_flag(readings):
    got = {r["id"]: r["battery_critical"] for r in quality.quality_flags(readings).collect()}
    assert (got[1], got[2], got[6]) == (False, True, None)


def test_routes_overlap_and_leak(records, rows):
    got = rows(quality.routed(records, quality.log_routes()), "id", "route")
    assert got == sorted(
        [(1, "critical"), (1, "warnings"), (2, "unmatched"), (3, "unmatched"), (4, "critical"), (5, "errors"), (6, "info"), (7, "critical")], key=repr
    )
    split = quality.route(records, quality.log_routes())
    assert {name: df.count() for name, df in split.items()} == {"critical": 3, "errors": 1, "warnings": 1, "info": 1, "unmatched": 2}
    assert quality.route_counts(records, quality.log_routes()).first().asDict() == {"critical": 3, "errors": 1, "warnings": 1, "info": 1, "unmatched": 2}


def test_first_route_is_exclusive(records):
    got = [r["route"] for r in quality.route_first(records, quality.level_routes()).orderBy("id").collect()]
    assert got == ["warnings", "errors", "unmatched", "errors", "errors", "info", "unmatched"]


def test_expectations(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    rules = {"positive": "v > 0", "first": F.col("id") < 3}
    assert rows(quality.expectation_counts(df, rules)) == [("first", 2, 1), ("positive", 1, 2)]
    assert rows(quality.expectations(df, rules, "drop"), "id") == [(1,)]
    assert [(r["id"], r["failed_rules"]) for r in quality.expectations(df, rules, "quarantine").orderBy("id").collect()] == [(2, ["positive"]), (3, ["positive", "first"])]
    assert quality.expectations(df, rules).count() == 3
    with pytest.raises(ValueError):
        quality.expectations(df, rules, "burn")


def test_threshold_alert_only_above_the_limit(spark):
    assert quality.threshold_alert(spark.range(5), F.count(F.lit(1)), 5, "rows").count() == 0
    alert = quality.threshold_alert(spark.range(6), F.count(F.lit(1)), 5, "rows").first()
    assert tuple(alert) == ("rows", "WARNING", 6.0, 5.0)


def test_monitoring_bounds_are_strict(spark):
    hour_ago = NOW - dt.timedelta(hours=1)
    df = spark.createDataFrame(
        [(NOW, "ERROR", 10, True), (hour_ago, "ERROR", 20, True), (hour_ago + dt.timedelta(seconds=1), "CRITICAL", None, False)],
        "timestamp timestamp, level string, response_time_ms int, is_valid boolean",
    )
    assert tuple(monitoring.ingest_health(df, NOW).first())[1:] == (2, 1, 1, 10.0)
    rates = [(r["total_requests"], r["errors"], r["error_rate"]) for r in monitoring.error_rate(df, NOW).collect()]
    assert rates == [(1, 1, 100.0), (2, 1, 50.0)]
    assert monitoring.error_rate_alerts(df, NOW, 50.0).count() == 1


def test_json_array_and_lines(spark, rows):
    df = spark.createDataFrame([(1, '[{"a":1},{"a":2}]'), (2, "broken"), (3, None)], "id int, j string")
    assert rows(enrichment.split_json_array(df, "j", "struct<a:int>").select("id", "element.a")) == [(1, 1), (1, 2)]
    lines = enrichment.split_lines(spark.createDataFrame([(1, "a|b||")], "id int, t string"), "t", "|")
    assert [(r["line_no"], r["line"]) for r in lines.collect()] == [(0, "a"), (1, "b"), (2, ""), (3, "")]


def test_batches_share_one_client_per_partition(spark, rows):
    def make_client():
        calls = []

        def call(batch):
            calls.append(len(batch))
            return batch.assign(call=len(calls), size=len(batch))

        return call

    got = enrichment.enrich_batches(spark.range(10).coalesce(1), make_client, "id long, call long, size long", 4)
    assert [(r["call"], r["size"]) for r in got.orderBy("id").collect()] == [(1, 4)] * 4 + [(2, 4)] * 4 + [(3, 2)] * 2


@pytest.mark.parametrize("bad", [set(), {3}, {0, 1, 9}, set(range(10))])
def test_a_call_that_fails_on_some_rows_loses_none(spark, bad):
    def make_client():
        tried = {}

        def call(batch):
            ids = list(batch["id"])
            tried[tuple(ids)] = tried.get(tuple(ids), 0) + 1
            if tried[tuple(ids)] == 1 and 5 in ids:
                raise TimeoutError("once")
            if bad & set(ids):
                return batch.head(0) if 9 in ids else 1 / 0
            return batch.assign(size=len(batch), calls=sum(tried.values()))

        return call

    rows = spark.range(10).selectExpr("id", "if(id = 3, null, timestamp_seconds(id)) AS t", "cast('x' AS binary) AS b").coalesce(1)
    good, dead = enrichment.enrich_or_reject(rows, make_client, "id long, size long, calls long", 4, attempts=2)
    assert sorted(r["id"] for r in good.collect()) == sorted(set(range(10)) - bad)
    letters = {json.loads(r["raw_payload"])["id"]: r["error_reason"] for r in dead.collect()}
    assert set(letters) == bad and dead.columns == ["error_reason", "raw_payload", "failed_at"]
    assert all(("0 rows answered for 1" in why) if k == 9 else ("ZeroDivisionError" in why) for k, why in letters.items())
    if not bad:
        assert {r["id"]: r["size"] for r in good.collect()}[5] == 4  # tried again as a whole, not halved
    assert [df.count() for df in enrichment.enrich_or_reject(rows.limit(0), make_client, "id long")] == [0, 0]


def test_ingest_metadata_with_file_name(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(3).write.parquet(path)
    stamped = enrichment.with_ingest_metadata(spark.read.parquet(path), "unit", NOW, file_name=True).first()
    assert stamped["data_source"] == "unit" and stamped["processing_date"] == NOW.date() and stamped["file_name"].endswith(".parquet")
