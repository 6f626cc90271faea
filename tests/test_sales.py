import pytest

from tallyloom.functions.measures import summed
from tallyloom.operators import sales
from tallyloom.plans.views import transaction_columns, transaction_totals, transactions
from conftest import SMALL


@pytest.fixture
def tx(spark):
    return spark.createDataFrame(
        [
            ("c1", "p1", "A", "n1", 2, 0.1, 0.0, "10:00:00"),
            ("c1", "p2", "A", "n1", 1, 0.2, 5.0, "10:30:00"),
            ("c2", "p1", "B", "n2", 4, 100.0, 15.0, "23:00:00"),
            (None, "p1", None, "n2", 1, None, None, None),
        ],
        "customer_id string, product_id string, category string, product_name string, quantity int, total_amount double, discount double, transaction_time string",
    )


def test_category_revenue_is_exact_and_ignores_missing_amounts(tx, rows):
    got = rows(sales.category_revenue(tx))
    assert got == sorted([("A", 0.3, 2, 0.15), ("B", 100.0, 1, 100.0), (None, None, 1, None)], key=repr)


def test_decimal_amounts_are_kept_as_decimals(tx, rows):
    exact = tx.withColumn("total_amount", tx["total_amount"].cast("decimal(10,2)"))
    report = sales.category_revenue(exact)
    assert report.schema["total_revenue"].dataType.simpleString() == "decimal(20,2)"
    assert [float(r[1]) for r in rows(report) if r[0] == "A"] == [0.3]


def test_totals_give_the_same_as_rows(tx, rows):
    totals = summed(tx, ["category", "product_id"], ["total_amount"])
    assert rows(sales.category_revenue(totals)) == rows(sales.category_revenue(tx))


def test_overview(tx, rows):
    assert rows(sales.overview(tx)) == [(4, 2, 2)]


def test_hourly_pattern_from_text(tx, rows):
    assert rows(sales.hourly_pattern(tx)) == sorted([(10, 2, 0.3), (23, 1, 100.0), (None, 1, None)], key=repr)


def test_payment_share_sums_to_hundred(spark):
    methods = sales.payment_mix(transaction_totals(spark, SMALL, ["payment_method"]))
    assert abs(sum(r["usage_percentage"] for r in methods.collect()) - 100) < 1e-9


def test_single_row_group_has_no_deviation(spark):
    df = spark.createDataFrame([("p", 5.0)], "product_name string, unit_price double")
    assert [tuple(r) for r in sales.price_stats(df, min_rows=0).collect()] == [("p", 5.0, 5.0, 5.0, None)]


def test_price_stats_needs_more_rows_than_the_minimum(spark):
    df = spark.createDataFrame([("p", float(i)) for i in range(5)], "product_name string, unit_price double")
    assert sales.price_stats(df).count() == 0


def test_report_skips_what_does_not_parse(spark, rows):
    df = spark.createDataFrame([("A", "1.5"), ("A", "x"), ("A", None), (None, "3"), ("B", "nan"), ("B", "2")], "category string, total_amount string")
    assert rows(sales.category_sales_report(df)) == [("A", 1.5, 1, 1.5), ("B", 2.0, 1, 2.0)]
    assert rows(sales.category_sales_report(df, formatted=True)) == [("A", "$1.50", 1, "$1.50"), ("B", "$2.00", 1, "$2.00")]


def test_empty_input(spark, tx):
    assert sales.category_revenue(tx.limit(0)).count() == 0
    assert [tuple(r) for r in sales.overview(tx.limit(0)).collect()] == [(0, 0, 0)]


def test_slice_metrics_stop_at_the_data(spark):
    df = spark.range(250).selectExpr("id", "cast(1 as double) total_amount")
    assert [(r[0], r[1]) for r in sales.slice_metrics(df, ["id"]).collect()] == [(1, 100), (2, 200), (3, 250)]


def test_view_joins_only_what_is_asked_for(spark):
    plan = transactions(spark, SMALL, ["quantity"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    with pytest.raises(ValueError):
        transactions(spark, SMALL, ["nope"])
    assert transactions(spark, SMALL).columns == transaction_columns()


def test_totals_without_broadcast_sum_before_the_join(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    totals = transaction_totals(spark, SMALL, ["category"])
    assert "row_weight" in totals.columns
    exchanges = totals._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(l_partkey")
    assert exchanges == 1  # the join reuses the aggregation's exchange


def test_no_amount_is_rounded(spark, rows):
    tx = spark.range(1000).selectExpr("'a' AS category", "0.0004D AS total_amount")
    assert rows(sales.category_revenue(tx).select("total_revenue")) == [(0.4,)]
    with pytest.raises(Exception, match="more than 4 decimals"):
        sales.category_revenue(tx.selectExpr("category", "total_amount / 7 AS total_amount")).collect()


def test_a_month_of_a_year_reaches_the_scan_as_dates(spark):
    tx = transactions(spark, SMALL, ["category", "transaction_date", "year", "month", "total_amount"])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = sales.category_revenue_for(tx, 1998, [6, 7])._jdf.queryExecution().explainString(mode)
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
