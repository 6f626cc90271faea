import datetime as dt

from pyspark.sql import functions as F

from tallyloom.functions import columns, parsing


def values(spark, kind, items, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


def test_segment_bounds_are_strict_and_null_is_lowest(spark):
    got = values(spark, "double", [1000.01, 1000.0, 500.01, 500.0, None], columns.segment("v"))
    assert got == ["High Value", "Medium Value", "Medium Value", "Low Value", "Low Value"]


def test_discount_bands(spark):
    got = values(spark, "double", [0.0, 0.5, 10.0, 10.1, 20.0, 20.01, -1.0, None], columns.discount_band("v"))
    assert got == ["No Discount", "1-10%", "1-10%", "11-20%", "11-20%", ">20%", ">20%", ">20%"]


def test_severity_and_alert(spark):
    levels = ["CRITICAL", "ERROR", "WARN", "INFO", "DEBUG", "odd", None]
    assert values(spark, "string", levels, columns.severity("v")) == [5, 4, 3, 2, 1, 1, 1]
    assert values(spark, "string", levels, columns.alert_required("v")) == [True, True, False, False, False, False, False]


def test_temperature_alert_is_normal_at_the_bounds_and_for_null(spark):
    got = values(spark, "double", [30.1, 30.0, 10.0, 9.9, None], columns.temperature_alert("v"))
    assert got == ["HIGH_TEMP", "NORMAL", "NORMAL", "LOW_TEMP", "NORMAL"]


def test_joined_text_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("a", "1"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(columns.joined_text(["x", "y"])).collect()] == ["a-1", None]


def test_words(spark):
    texts = ["Été café_1 don't", "x² 42", "", None, "éa"]
    assert values(spark, "string", texts, parsing.words("v")) == [["été", "café_1", "don", "t"], ["x²", "42"], [], None, ["e", "a"]]


def test_safe_number(spark):
    got = values(spark, "string", ["1.5", " 2 ", "x", "", "nan", None, "inf"], parsing.safe_number("v"))
    assert got == [1.5, 2.0, None, None, None, None, float("inf")]


def test_extract_gives_null_without_match(spark):
    assert values(spark, "string", ["id=7;", "none"], parsing.extract("v", r"id=(\d+)")) == ["7", None]


def test_event_time(spark):
    df = spark.createDataFrame([("2024-02-29", "10:11:12"), ("2024-02-30", "10:11:12"), ("2024-01-01", None)], "d string, t string")
    assert [r[0] for r in df.select(parsing.event_time("d", "t")).collect()] == [dt.datetime(2024, 2, 29, 10, 11, 12), None, None]


def test_hour_of_a_time_text(spark):
    assert values(spark, "string", ["23:59:01"], parsing.hour_of("v")) == [23]


def test_names_and_folders(spark):
    moment = F.lit(dt.datetime(2024, 3, 4, 5, 6, 7))
    row = spark.range(1).select(parsing.stamped_name(F.lit("a.b.csv"), moment), parsing.stamped_name(F.lit("plain"), moment), parsing.dated_folder(moment)).first()
    assert tuple(row) == ("a.b_1709528767000", "plain_1709528767000", "2024/03/04")


def test_currency(spark):
    assert values(spark, "double", [12.5, 0.005, 1234567.891], parsing.currency("v")) == ["$12.50", "$0.01", "$1234567.89"]


def test_lookup_map_keeps_the_last_value(spark):
    df = spark.sql("SELECT array(named_struct('key', 'a', 'value', '1'), named_struct('key', 'a', 'value', '2'), named_struct('key', 'b', 'value', null)) p")
    assert df.select(parsing.lookup_map("p")).first()[0] == {"a": "2", "b": None}
