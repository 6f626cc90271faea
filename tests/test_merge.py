import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import layout, merge, ordering, snapshots
from tallyloom.sources import key_index, writers
from tallyloom.sources.tables import in_partitions_of

T0, T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
NOW = dt.datetime(2024, 6, 1)


def test_latest_per_key_breaks_ties_and_puts_null_times_last(spark, rows):
    df = spark.createDataFrame([("a", T1, 1), ("a", T1, 2), ("a", None, 9), ("b", None, 3), (None, T0, 4)], "k string, t timestamp, v int")
    assert rows(ordering.latest_per_key(df, "k", "t", "v"), "k", "v") == sorted([("a", 2), ("b", 3), (None, 4)], key=repr)


def test_merge_update_changes_matched_rows_only(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    assert rows(merge.merge_update(target, source, ["id"], {"v": "v"})) == [(1, "a"), (2, "B")]


@pytest.fixture
def target(spark):
    data = [(1, "same", T1, T0, T0), (2, "older", T1, T0, T0), (3, "newer", T1, T0, T0), (4, "null", T1, T0, T0), (5, "alone", T1, T0, T0), (6, "no time", None, T0, T0)]
    return spark.createDataFrame(data, "id int, value string, timestamp timestamp, created_at timestamp, updated_at timestamp")


@pytest.fixture
def source(spark):
    data = [(1, "x", T1), (2, "x", T0), (3, "first", T1), (3, "x", T2), (4, "x", None), (6, "x", T2), (7, "new", T0)]
    return spark.createDataFrame(data, "id int, value string, timestamp timestamp")


EXPECTED = {1: ("same", T0), 2: ("older", T0), 3: ("x", NOW), 4: ("null", T0), 5: ("alone", T0), 6: ("no time", T0), 7: ("new", NOW)}


def test_upsert_updates_only_with_strictly_newer_rows(target, source, rows):
    merged = merge.upsert(target, source, ["id"], now=NOW)
    assert {r["id"]: (r["value"], r["updated_at"]) for r in merged.collect()} == EXPECTED
    assert {r["id"] for r in merged.filter(F.col("created_at") == NOW).collect()} == {7}
    assert rows(merge.upsert(merged, source, ["id"], now=T2)) == rows(merged)


def test_touched_partitions_prune_the_scan(spark, target, source, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(target.withColumn("p", F.when(F.col("id") > 3, F.col("id") % 2)), path, ["p"])
    table = spark.read.parquet(path)
    touched = table.filter(in_partitions_of(table, source.select(F.lit(None).cast("string").alias("p")), ["p"]))
    assert {r["id"] for r in touched.collect()} == {1, 2, 3}
    assert "StructsToJson" in layout.plan_facts(touched)["partition_filters"][0]


def test_upsert_partitions_touches_only_affected_folders(spark, target, source, tmp_path):
    path = str(tmp_path / "t")
    part = F.col("id") % 4
    writers.write_partitioned(target.withColumn("p", part), path, ["p"])
    untouched = [str(f) for f in (tmp_path / "t" / "p=1").glob("*.parquet")]
    merge.upsert_partitions(spark, path, source.filter("id not in (1, 5)").withColumn("p", part), ["id"], ["p"], now=NOW)
    assert {r["id"]: (r["value"], r["updated_at"]) for r in spark.read.parquet(path).collect()} == EXPECTED
    assert [str(f) for f in (tmp_path / "t" / "p=1").glob("*.parquet")] == untouched


ROW = "id int, name string"


def envelope(before, after, op, ts):
    return (json.dumps({"before": before, "after": after, "op": op, "ts_ms": ts}),)


@pytest.fixture
def changes(spark):
    feed = [
        envelope(None, {"id": 10, "name": "n"}, "c", 1),
        envelope({"id": 10, "name": "n"}, {"id": 10, "name": "m"}, "u", 2),
        envelope({"id": 10, "name": "m"}, None, "d", 3),
        envelope({"id": 1, "name": "a"}, {"id": 1, "name": "A"}, "u", 2),
        envelope({"id": 2, "name": "b"}, None, "d", 2),
        envelope({"id": 99, "name": "?"}, None, "d", 2),
        envelope(None, {"id": 11, "name": "k"}, "c", 5),
        envelope({"id": 12, "name": "q"}, {"id": 12, "name": "z"}, "u", 7),
        envelope({"id": 12, "name": "z"}, None, "d", 7),
    ]
    return merge.flatten_cdc(spark.createDataFrame(feed, "value string"), ROW, ["id"])


def test_changes_apply_in_order_and_twice_is_once(spark, changes, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], ROW)
    after = merge.apply_cdc(target, changes, ["id"])
    assert rows(after) == [(1, "A"), (11, "k"), (3, "c")]
    assert rows(merge.apply_cdc(after, changes, ["id"])) == rows(after)


def test_delete_keeps_its_key(changes):
    assert {r["id"] for r in changes.filter("operation = 'd'").collect()} == {10, 2, 99, 12}


def test_snapshots(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert snapshots.write_snapshot(spark.range(3), path, "A", now=T0) == 0
    assert snapshots.write_snapshot(spark.range(5), path, "B", now=T1) == 1
    assert snapshots.write_snapshot(spark.range(9), path, "B", version=1, now=T1) == 1  # a retry replaces its own try
    assert snapshots.read_as_of(spark, path, 0).count() == 3
    assert snapshots.read_as_of(spark, path).count() == 9
    assert rows(snapshots.history(spark, path), "version", "operation", "rows") == [(0, "A", 3), (1, "B", 9)]
    with pytest.raises(ValueError):
        snapshots.read_as_of(spark, path, 7)
    assert snapshots.expire_snapshots(spark, path, 168, now=T1) == []
    assert snapshots.expire_snapshots(spark, path, 1, now=NOW) == [0]
    assert snapshots.read_as_of(spark, path).count() == 9


def test_unfinished_snapshot_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshot(spark.range(3), path)
    spark.range(1).write.parquet(f"{path}/data/version=1")  # data without its history record
    assert snapshots.latest_version(spark, path) == 0
    assert snapshots.write_snapshot(spark.range(4), path) == 1
    assert snapshots.read_as_of(spark, path).count() == 4


def test_schema_evolution(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)
    merge.evolve(spark.range(2, 3), {"note": "string", "id": "int"}).write.mode("append").parquet(path)
    assert merge.read_evolved(spark, path).columns == ["id", "note"]
    assert merge.read_evolved(spark, path).count() == 3


def test_replace_table_that_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    merge.replace_table(spark, spark.read.parquet(path).filter("id < 4"), path)
    assert spark.read.parquet(path).count() == 4


def test_migrate_reports_a_match(spark, tmp_path):
    spark.range(50).selectExpr("id", "id % 3 as g", "cast(id as decimal(10,2)) as v").createOrReplaceTempView("to_migrate")
    report = snapshots.migrate(spark, "to_migrate", str(tmp_path / "m"), ["g"], "g", "v").first()
    assert report["matches"] and report["source_count"] == 50 and report["groups"] == 3


def test_changes_without_operation_or_key_are_rejected(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    changes = spark.createDataFrame(
        [(1, "x", None, 5), (3, "y", None, 5), (None, "z", "u", 5), (2, None, "d", 5), (4, "w", "c", 5), (5, "q", "?", 5)],
        "id int, v string, operation string, t int",
    ).selectExpr("id", "v", "operation", "timestamp_seconds(t) AS changed_at")
    assert rows(merge.apply_cdc(target, changes, ["id"])) == [(1, "a"), (4, "w")]
    assert rows(merge.rejected_changes(changes, ["id"]).select("v")) == [("q",), ("x",), ("y",), ("z",)]


def test_retention_below_an_hour_and_a_second_writer(spark, tmp_path):
    path, now = str(tmp_path / "t"), dt.datetime(2024, 1, 1, 12)
    for minutes in (40, 10, 0):
        snapshots.write_snapshot(spark.range(3), path, now=now - dt.timedelta(minutes=minutes))
    assert snapshots.expire_snapshots(spark, path, hours=0.5, now=now) == [0]
    assert snapshots.latest_version(spark, path) == 2


def test_a_key_must_stay_in_its_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, p string, t int").selectExpr("id", "p", "timestamp_seconds(t) AS timestamp").write.partitionBy("p").parquet(path)
    moved = spark.createDataFrame([(1, "b", 9)], "id int, p string, t int").selectExpr("id", "p", "timestamp_seconds(t) AS timestamp")
    with pytest.raises(ValueError):
        merge.upsert_partitions(spark, path, moved, ["id"], ["p"])


@pytest.fixture
def spread(spark, tmp_path):
    """400 keys over four partitions whose folder names need encoding; numbers and texts as keys."""
    path = str(tmp_path / "t")
    rows = spark.range(400).selectExpr("id", "concat('k', id) AS name", "concat('part ', id % 4, ' %') AS p", "timestamp_seconds(id) AS timestamp")
    rows.write.partitionBy("p").parquet(path)
    return path, rows


@pytest.mark.parametrize("keys", [["id"], ["name"], ["name", "id"]])
def test_key_index_finds_every_key_and_reads_only_suspected_folders(spark, spread, keys):
    path, rows = spread
    assert len(key_index.refresh(spark, path, keys, ["p"])) == 4
    assert key_index.refresh(spark, path, keys, ["p"]) == []
    for part in range(4):
        source = rows.filter(f"id % 4 = {part} AND id < 20").select(*keys)
        assert key_index.suspected(spark, path, source, keys, ["p"]) == [f"p=part%20{part}%20%2525"]
        found = key_index.rows_elsewhere(spark, path, source, keys, ["p"], F.col("p") == "another")
        assert found.count() == 5
        assert found.inputFiles() and all(f"p=part%20{part}%20" in f for f in found.inputFiles())
    unknown = spark.range(1000, 1020).selectExpr("id", "concat('k', id, 'x') AS name").select(*keys)
    assert key_index.suspected(spark, path, unknown, keys, ["p"]) == []
    assert key_index.rows_elsewhere(spark, path, unknown, keys, ["p"], F.lit(False)) is None
    assert len(key_index.suspected(spark, path, rows.select(*keys), keys, ["p"], most=10)) == 4


def test_key_index_notices_folders_written_by_others(spark, spread):
    path, rows = spread
    key_index.refresh(spark, path, ["id"], ["p"])
    late = spark.range(7000, 7001).selectExpr("id", "'n' AS name", "'part 2 %' AS p", "timestamp_seconds(id) AS timestamp")
    late.write.mode("append").partitionBy("p").parquet(path)
    moved = late.withColumn("p", F.lit("part 1 %"))
    with pytest.raises(ValueError):
        merge.upsert_partitions(spark, path, moved, ["id"], ["p"])
    merge.upsert_partitions(spark, path, moved.withColumn("id", F.lit(7002)), ["id"], ["p"])
    assert key_index.refresh(spark, path, ["id"], ["p"]) == ["p=part%201%20%2525"]
    assert spark.read.parquet(path).count() == 402


def test_of_two_writers_of_one_version_one_is_refused_and_the_other_is_intact(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    snapshots.write_snapshot(spark.range(1), path)
    real, once = snapshots.folders.create, []

    def create(spark, *args):
        if not once:  # another writer comes first, between this one's rows and its record
            once.append(True)
            snapshots.write_snapshot(spark.range(100, 107), path, "OTHER")
        return real(spark, *args)

    monkeypatch.setattr(snapshots.folders, "create", create)
    with pytest.raises(snapshots.VersionTaken):
        snapshots.write_snapshot(spark.range(5), path, "MINE")
    assert sorted(r["id"] for r in snapshots.read_as_of(spark, path).collect()) == list(range(100, 107))
    assert [r["operation"] for r in snapshots.history(spark, path).collect()] == ["OTHER", "WRITE"]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2
    with pytest.raises(snapshots.VersionTaken):
        snapshots.write_snapshot(spark.range(5), path, "MINE", version=1)


def test_many_writers_at_once_each_get_a_version_or_an_error(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "t")

    def write(n):
        try:
            return snapshots.write_snapshot(spark.range(n), path, f"w{n}"), n
        except snapshots.VersionTaken:
            return None

    with ThreadPoolExecutor(4) as pool:
        done = dict(filter(None, pool.map(write, range(1, 9))))
    assert sorted(done) == list(range(len(done))) and done
    assert {v: snapshots.read_as_of(spark, path, v).count() for v in done} == done


def test_expiry_spares_the_newest_and_what_a_reader_holds(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(5):
        snapshots.write_snapshot(spark.range(n), path, now=T0)
    with snapshots.held(spark, path, 1) as rows_held:
        assert snapshots.expire_snapshots(spark, path, 1, now=NOW, keep=2) == [0, 2]
        assert rows_held.count() == 1
    assert snapshots.expire_snapshots(spark, path, 1, now=NOW, keep=2) == [1]
    assert [r["version"] for r in snapshots.history(spark, path).collect()] == [4, 3]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2
