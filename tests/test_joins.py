import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import joins, layout
from tallyloom.session import scratch_path
from tallyloom.sources import writers


def brute_force_pairs(data):
    out = {}
    for a, b in itertools.product(data, data):
        if a[0] is not None and a[0] == b[0] and a[1] is not None and b[1] is not None and a[1] != b[1]:
            products, total = out.setdefault(a[0], (set(), [0]))
            if a[2] is not None:
                products.add(a[2])
            total[0] += round(a[3] * 100)
    return sorted((c, len(p), t[0] / 100) for c, (p, t) in out.items())


def test_repeat_day_customers_equals_the_pairs(spark, rows):
    rng = random.Random(3)
    data = [
        (rng.choice(["a", "a", "a", "b", "c", None]), rng.choice(["2024-01-01", "2024-01-02", "2024-01-05", None]), rng.choice(["p", "q", None]), rng.randint(1, 999) / 100)
        for _ in range(80)
    ]
    data.append(("once", "2024-01-01", "p", 3.0))
    df = spark.createDataFrame(data, "customer_id string, d string, product_id string, total_amount double")
    df = df.withColumn("transaction_date", F.to_date("d"))
    assert rows(joins.repeat_day_customers(df)) == brute_force_pairs(data)
    decimals = df.withColumn("total_amount", F.col("total_amount").cast("decimal(10,2)"))
    assert rows(joins.repeat_day_customers(decimals)) == brute_force_pairs(data)


def test_repeat_day_customers_makes_no_pairs(spark):
    df = spark.createDataFrame([], "customer_id string, transaction_date date, product_id string, total_amount double")
    assert "Join" not in layout.plan_text(joins.repeat_day_customers(df))


def test_enrich_broadcasts_by_size(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert layout.plan_facts(joins.enrich(fact, dim, "k"))["broadcast_joins"] == 1
    assert not joins.fits_broadcast(dim, 1)
    assert joins.enrich(fact, dim, "k", "left").count() == 100


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_join_equals_plain_join(spark, rows, how):
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"), "id")
    dim = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = joins.enrich_hot_keys(fact, dim, "k", how, share=0.1, limit=-1)
    assert rows(hot, "k", "id", "v") == rows(fact.join(dim, "k", how), "k", "id", "v")
    none_hot = joins.enrich_hot_keys(fact, dim, "k", how, share=0.9, limit=-1)
    assert none_hot.count() == hot.count()


@pytest.mark.parametrize("kind", ["string", "date", "decimal(10,2)", "double"])
def test_hot_key_join_takes_keys_of_any_type_and_spreads_hot_and_null_ones(spark, setting, rows, kind):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    of = lambda c: F.date_add(F.lit("2024-01-01").cast("date"), c.cast("int")) if kind == "date" else c.cast(kind)
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 40)
    fact = spark.range(3000).select(of(key).alias("k"), "id", F.lit("x").alias("v2"))
    dim = spark.range(30).select(of(F.col("id")).alias("k"), F.col("id").alias("v"))
    hot = joins.enrich_hot_keys(fact, dim, "k", "left", share=0.05, limit=-1)
    assert layout.plan_facts(hot)["exchanges"] == 2
    assert rows(hot) == rows(fact.join(dim, "k", "left"))
    assert hot.columns == fact.join(dim, "k", "left").columns


def test_hot_key_join_scans_the_fact_twice(spark, setting, rows, tmp_path):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.shuffle.partitions", "16")
    spark.range(20_000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 900).alias("k"), "id").write.parquet(str(tmp_path / "f"))
    fact, dim = spark.read.parquet(str(tmp_path / "f")), spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = joins.enrich_hot_keys(fact, dim, "k", share=0.01, limit=-1)
    assert hot._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1  # the other one is the sketch's
    sizes = [r["n"] for r in hot.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 5_000  # two thirds are one key's


def test_hot_key_join_refuses_repeated_dimension_keys(spark):
    fact = spark.range(100).select(F.lit(1).cast("long").alias("k"), "id")
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(ValueError):
        joins.enrich_hot_keys(fact, dim, "k", limit=-1)


def test_bucketed_tables_join_without_exchange_unless_a_bucket_is_too_large(spark, setting, rows):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias("a"))
    right = spark.range(100).select(F.col("id").alias("k"), (F.col("id") + 1).alias("b"))
    for name, df in (("bucketed_l", left), ("bucketed_r", right)):
        writers.write_bucketed(df, name, 4, ["k"], scratch_path(spark, name))
    near = joins.bucketed_join(spark, "bucketed_l", "bucketed_r", "k")
    far = joins.bucketed_join(spark, "bucketed_l", "bucketed_r", "k", max_bucket_bytes=1)
    assert layout.plan_facts(near)["exchanges"] == 0
    assert layout.plan_facts(far)["exchanges"] == 2
    assert rows(near) == rows(far) == rows(left.join(right, "k"))
    breadth = joins.customer_product_breadth(spark.table("bucketed_l"), "k", "a")
    assert layout.plan_facts(breadth)["exchanges"] == 0
    assert layout.plan_facts(joins.customer_product_breadth(joins.bucketed_scan(spark, "bucketed_l", 1), "k", "a"))["exchanges"] == 2
