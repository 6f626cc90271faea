import pytest
from pyspark.sql import functions as F

from tallyloom.operators import layout, sales
from tallyloom.session import checkpointed, scratch_path, shared_dir
from tallyloom.sources import tables, writers


def test_partition_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    tx = spark.range(100).selectExpr("cast(id % 5 as string) category", "cast(id as double) total_amount", "2024 + cast(id % 2 as int) year", "cast(id % 12 as int) month")
    writers.write_partitioned(tx, path, ["year", "month"])
    facts = layout.plan_facts(sales.category_revenue_for(spark.read.parquet(path), 2024, [6, 7]))
    assert facts["scans"] == 1 and "year" in facts["partition_filters"][0] and "month" in facts["partition_filters"][0]
    assert facts["read_schemas"] == ["category:string,total_amount:double"]


def test_partitions_and_stats(spark, tmp_path):
    writers.append(spark.range(10).withColumn("p", F.col("id") % 2), "with_parts", by=["p"], path=str(tmp_path / "t"))
    assert sorted(r[0] for r in layout.partitions(spark, "with_parts").collect()) == ["p=0", "p=1"]
    described = {r["col_name"]: r["data_type"] for r in layout.collect_stats(spark, "with_parts", ["id"]).collect()}
    assert "10 rows" in described["Statistics"]


def test_bucket_facts(spark, tmp_path):
    writers.write_bucketed(spark.range(100), "bucket_facts", 4, ["id"], str(tmp_path / "b"))
    assert sorted(r["bucket"] for r in tables.bucket_bytes(spark, "bucket_facts").collect()) == [0, 1, 2, 3]
    assert tables.largest_bucket(spark, "bucket_facts") > 0


def test_format_sizes(spark):
    sizes = {r["format"]: r for r in layout.format_sizes(spark, spark.range(1000)).collect()}
    assert set(sizes) == {"csv", "orc", "parquet"}
    assert all(r["rows"] == 1000 and r["bytes"] > 0 for r in sizes.values())


def test_cached_is_released(spark):
    df = spark.range(5).withColumn("x", F.lit(1))
    with layout.cached(df) as kept:
        assert kept.count() == 5 and kept.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_refresh_of_touched_months(spark, tmp_path):
    path = str(tmp_path / "s")
    ddl = "year int, month int, category string, city string, total_amount double, customer_id int"
    old = spark.createDataFrame([(2024, 1, "A", "x", 1.0, 1), (2024, 2, "A", "x", 1.0, 1)], ddl)
    layout.refresh_summary(spark, old, path)
    new = spark.createDataFrame([(2024, 1, "A", "x", 9.0, 1), (2024, 2, "A", "x", 5.0, 1), (2024, 2, "A", "x", 5.0, 2)], ddl)
    layout.refresh_summary(spark, new, path, new.filter("month = 2"))
    got = {r["month"]: (r["total_revenue"], r["unique_customers"]) for r in layout.read_summary(spark, path).collect()}
    assert got == {1: (1.0, 1), 2: (10.0, 2)}


def test_compaction_keeps_rows(spark, setting, tmp_path):
    plain = tmp_path / "plain"
    spark.range(1000).repartition(20).write.parquet(str(plain))
    assert layout.compact(spark, str(plain)) == 1
    assert len(list(plain.glob("part-*"))) == 1 and spark.read.parquet(str(plain)).count() == 1000
    parts = tmp_path / "parts"
    data = spark.range(1000).withColumn("p", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 2))
    data.repartition(20).write.partitionBy("p").parquet(str(parts))
    layout.compact(spark, str(parts), by=["p"])
    assert len(list(parts.glob("p=*/part-*"))) == 3 and spark.read.parquet(str(parts)).count() == 1000
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or these tiny pieces share a task again
    layout.compact(spark, str(parts), target_bytes=500, by=["p"])
    assert len(list(parts.glob("p=0/part-*"))) > 1 and spark.read.parquet(str(parts)).count() == 1000


def test_clustering_narrows_files_on_both_columns(spark, tmp_path):
    path = str(tmp_path / "z")
    df = spark.range(40000).selectExpr("id % 200 as a", "cast(id / 200 as int) as b", "cast(id as string) as s", "date_add(date'2024-01-01', cast(id % 100 as int)) as d")
    layout.cluster_write(df, ["a", "b"], path, 16)
    spans = spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b")).collect()
    assert len(spans) == 16 and sum(r["a"] + r["b"] for r in spans) < 16 * 200
    layout.cluster_write(df, ["s", "d"], path, 4)
    assert spark.read.parquet(path).count() == 40000


def test_one_key_is_spread_over_files(spark, tmp_path):
    path = tmp_path / "hot"
    layout.cluster_write(spark.range(20000).selectExpr("1 as k", "id"), ["k"], str(path), 8)
    assert len(list(path.glob("part-*"))) == 8


class Stub:
    """As much of a session as the shared folder is looked up in."""

    def __init__(self, master, settings):
        self.settings, self.sparkContext, self.conf, self.master = settings, self, self, master

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(Stub("yarn", {"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    with pytest.raises(ValueError):
        shared_dir(Stub("yarn", {}))
    local = Stub("local[2]", {})
    assert shared_dir(local) == shared_dir(local)
    assert scratch_path(spark, "a").startswith(f"{shared_dir(spark)}/a-")
    assert checkpointed(spark, spark.range(3), "kept").count() == 3


def test_compaction_keeps_columns_and_folder_names(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "06"), (2, "07")], "id int, mm string").write.partitionBy("mm").parquet(path)
    spark.createDataFrame([(3, "06", "x")], "id int, mm string, note string").write.mode("append").partitionBy("mm").parquet(path)
    layout.compact(spark, path, by=["mm"])
    got = layout.read_as_written(spark, path).select("id", "mm", "note").collect()
    assert sorted(map(tuple, got)) == [(1, "06", None), (2, "07", None), (3, "06", "x")]


def test_text_keys_cluster_as_well_as_numbers(spark, tmp_path):
    df = spark.range(40000).selectExpr("(id * 7919) % 1000 as n", "format_string('CUST%06d', (id * 7919) % 1000) as t", "cast(id / 200 as int) as b")

    def files_with(key, path):
        layout.cluster_write(df, [key, "b"], path, 16)
        spans = spark.read.parquet(path).groupBy(F.col("_metadata.file_name")).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
        probes = [f"CUST{k:06d}" if key == "t" else k for k in range(0, 1000, 50)]
        return sum(r["lo"] <= p <= r["hi"] for p in probes for r in spans)

    text, number = files_with("t", str(tmp_path / "t")), files_with("n", str(tmp_path / "n"))
    assert text <= number * 1.1 and text < 20 * 8


def test_pushed_filters_are_given_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "current_timestamp() as a_column_with_a_long_name").write.parquet(path)
    kept = spark.read.parquet(path).filter("a_column_with_a_long_name >= timestamp'2024-01-01' and a_column_with_a_long_name < timestamp'2025-01-01' and id in (1, 2)")
    pushed = layout.plan_facts(kept)["pushed_filters"]
    assert len(pushed) == 1 and "GreaterThanOrEqual(a_column" in pushed[0] and "LessThan(a_column" in pushed[0] and "In(id, [1,2])" in pushed[0]
