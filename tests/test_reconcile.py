import pytest
from pyspark.sql import functions as F

from tallyloom.operators import graph, ordering, reconcile


def test_compare_within_tolerance(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 1.0), (4, None), (5, 1.0), (7, 1.0), (7, 2.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.0), (2, 1.0000001), (3, 1.1), (4, None), (6, 1.0), (7, 1.0)], "k int, v double")
    report = {r["item"]: tuple(r)[1:] for r in reconcile.compare(a, b, "k").collect()}
    assert report["rows"] == (7, 6, False)
    assert report["nulls:v"] == (1, 1, True)
    assert report["keys_only_here"] == (1, 1, False)
    assert report["duplicate_keys"] == (1, 0, False)
    assert report["different:v"] == (1, 1, False)
    assert report["schema_equal"] == (2, 2, True)


def test_compare_sees_schema_changes_and_null_against_value(spark):
    a = spark.createDataFrame([(1, None)], "k int, v double")
    b = spark.createDataFrame([(1, 5.0)], "k int, v double")
    assert {r["item"]: r["left_value"] for r in reconcile.compare(a, b, "k").collect()}["different:v"] == 1
    assert not {r["item"]: r["matches"] for r in reconcile.compare(a, b.withColumnRenamed("v", "w")).collect()}["schema_equal"]


def test_comparison_by_digests_reports_the_same(spark, rows):
    a = spark.range(5000).selectExpr("if(id = 0, null, id) AS k", "cast(id % 7 AS double) AS v", "if(id % 11 = 0, null, concat('t', id)) AS t")
    a = a.unionByName(a.filter("k % 1000 = 1"))  # five repeated keys
    changes = {
        "equal": a,
        "close": a.withColumn("v", F.when(F.col("k") == 17, F.col("v") + 1e-9).otherwise(F.col("v"))),
        "one value": a.withColumn("t", F.when(F.col("k") == 17, "x").otherwise(F.col("t"))),
        "a key gone, one new": a.filter("k IS NULL OR k <> 40").unionByName(spark.range(9000, 9001).selectExpr("id AS k", "1D AS v", "'n' AS t")),
        "null key gone": a.filter("k IS NOT NULL"),
        "one copy less": a.filter("k IS NULL OR k <> 2001").unionByName(a.filter("k = 2001").limit(1)),
        "empty": a.limit(0),
        "other type": a.withColumn("k", F.col("k").cast("int")),
        "column gone": a.drop("t"),
    }
    for name, b in changes.items():
        assert rows(reconcile.compare(a, b, "k", digests=True)) == rows(reconcile.compare(a, b, "k", digests=False)), name
    assert rows(reconcile.compare(a.limit(0), a.limit(0), "k", digests=True)) == rows(reconcile.compare(a.limit(0), a.limit(0), "k"))


def test_equal_tables_compare_without_a_join_of_rows(spark):
    a = spark.range(5000).selectExpr("id AS k", "id * 2 AS v")
    assert reconcile.differing_rows(a, a.repartition(3), ["k"]) is None
    left, right, alike = reconcile.differing_rows(a, a.withColumn("v", F.when(F.col("k") == 77, 0).otherwise(F.col("v"))), ["k"])
    assert [left.count(), right.count(), alike.count()] == [1, 1, 4999]


def test_reconcile_with_missing_and_null_groups(spark, rows):
    a = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "g string, v int")
    b = spark.createDataFrame([("x", 1), (None, 2), ("z", 3)], "g string, v int")
    got = {r["g"]: (r["left_count"], r["right_count"], r["matches"]) for r in reconcile.reconcile(a, b, "g", "v").collect()}
    assert got == {"x": (1, 1, True), None: (1, 1, True), "y": (1, 0, False), "z": (0, 1, False)}


def test_row_diff_counts_copies(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "v int")
    b = spark.createDataFrame([(1,), (3,), (3,), (None,)], "v int")
    assert rows(reconcile.row_diff(a, b), "v", "side", "copies") == [(1, "left", 1), (2, "left", 1), (3, "right", 2)]


def test_combine_fills_missing_columns(spark, rows):
    assert rows(reconcile.combine([spark.range(1), spark.createDataFrame([(5, "x")], "id long, n string")])) == [(0, None), (5, "x")]


def test_count_match(spark):
    assert tuple(reconcile.count_match(spark.range(3), spark.range(4)).first()) == (3, 4, False)


@pytest.mark.parametrize("rows", [1000, 10_000])
def test_position_ranges_stay_small_when_the_input_grows(spark, tmp_path, rows):
    df = spark.range(rows).selectExpr("'hot' AS k", "id", f"{rows} - id AS o")
    placed = ordering.with_position(df, "k", "o", scratch=str(tmp_path / "p"), range_rows=100)
    sizes = [r["n"] for r in spark.read.parquet(str(tmp_path / "p")).groupBy("range_no").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= rows // 100 * 0.9 and max(sizes) <= 200
    assert placed.filter("position <> o").count() == 0


def test_positions_and_bundles_of_a_hot_key(spark):
    df = spark.range(5000).selectExpr("case when id % 3 = 0 then null else id % 2 end as k", "id", "5000 - id as o").repartition(7)
    placed = ordering.with_position(df, "k", "o")
    expected = {}
    for k, o in sorted(((r["k"], r["o"]) for r in df.collect()), key=lambda p: (p[0] is None, p[0] or 0, p[1])):
        expected.setdefault(k, []).append(o)
    got = {(r["k"], r["o"]): r["position"] for r in placed.collect()}
    assert got == {(k, o): i + 1 for k, os in expected.items() for i, o in enumerate(os)}
    bundles = ordering.bundle(df, "k", "o", 100).collect()
    assert max(len(b["records"]) for b in bundles) == 100
    assert sum(len(b["records"]) for b in bundles) == 5000
    for k, os in expected.items():
        joined = [r["o"] for b in sorted((b for b in bundles if b["k"] == k), key=lambda b: b["bundle_no"]) for r in b["records"]]
        assert joined == os


def levels(spark, edges, nodes):
    df = spark.createDataFrame(edges, "src string, dst string")
    ids = spark.createDataFrame([(n,) for n in nodes], "id string")
    return {r["id"]: r["level"] for r in graph.dag_levels(df, ids).collect()}


def test_levels_of_chain_diamond_and_isolated_node(spark):
    got = levels(spark, [("a", "b"), ("b", "c"), ("a", "x"), ("x", "c"), ("a", "c"), ("a", "b")], ["a", "b", "c", "x", "alone"])
    assert got == {"a": 0, "b": 1, "x": 1, "c": 2, "alone": 0}


def test_levels_are_null_on_and_behind_a_cycle(spark):
    got = levels(spark, [("a", "b"), ("b", "c"), ("c", "b"), ("c", "d"), ("a", "e")], ["a"])
    assert got == {"a": 0, "b": None, "c": None, "d": None, "e": 1}


def test_levels_without_edges_or_nodes(spark):
    assert levels(spark, [], ["a", "b"]) == {"a": 0, "b": 0}
    assert levels(spark, [], []) == {}
    assert levels(spark, [("a", "a")], []) == {"a": None}
