import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tallyloom.sources import databases, folders, inventory, kafka, readers, tables, writers

SCHEMA = "id int, name string, amount double"


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


def test_csv_with_header_and_schema(spark, tmp_path, rows):
    path = put(tmp_path, "a.csv", "id,name,amount\n1,x,2.5\n2,,\n")
    assert rows(readers.read_csv(spark, path, SCHEMA)) == [(1, "x", 2.5), (2, None, None)]
    assert dict(readers.read_csv(spark, path).dtypes) == {"id": "int", "name": "string", "amount": "double"}


def test_csv_dialect(spark, tmp_path, rows):
    path = put(tmp_path, "a.csv", 'id,name,amount\n# a comment\n1,"a, b",2\n2,"say \\"hi\\"",3\n')
    assert rows(readers.read_csv(spark, path, SCHEMA, readers.CsvDialect())) == [(1, "a, b", 2.0), (2, 'say "hi"', 3.0)]


def test_tolerant_csv_keeps_every_row_on_one_side(spark, tmp_path, rows):
    path = put(tmp_path, "a.csv", 'id,name,amount\n1,ok,2\n2,bad,abc\n3\n# note\n4,"q,uoted",5\n')
    good, bad = readers.read_csv_tolerant(spark, path, SCHEMA)
    assert rows(good) == [(1, "ok", 2.0), (4, "q,uoted", 5.0)]
    assert rows(bad, readers.REJECTED) == [("2,bad,abc",), ("3",)]
    assert (good.count(), bad.count()) == (2, 2)
    assert rows(good, "id") == [(1,), (4,)]


def test_empty_csv(spark, tmp_path):
    path = put(tmp_path, "a.csv", "")
    good, bad = readers.read_csv_tolerant(spark, path, SCHEMA)
    assert (good.count(), bad.count()) == (0, 0)


def test_pretty_printed_json_array(spark, tmp_path, rows):
    path = put(tmp_path, "a.json", json.dumps([{"level": "INFO", "filters_applied": ["a", "b"]}, {"level": "WARN", "response_time_ms": 7}], indent=2))
    df = readers.read_json(spark, path, "level string, response_time_ms int, filters_applied array<string>")
    assert [(r["level"], r["response_time_ms"], r["filters_applied"]) for r in df.collect()] == [("INFO", None, ["a", "b"]), ("WARN", 7, None)]


def test_files_by_pattern_depth_and_size(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "1,x,1\n")
    put(tmp_path / "in" / "sub", "b.csv", "2,x,1\n")
    put(tmp_path / "in", "big.csv", "3,xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx,1\n" * 9)
    put(tmp_path / "in", "c.txt", "4,x,1\n")
    base = str(tmp_path / "in")
    ids = lambda df: sorted({r["id"] for r in df.collect()})
    assert ids(readers.read_files(spark, "csv", base, SCHEMA, glob="*.csv")) == [1, 3]
    assert ids(readers.read_files(spark, "csv", base, SCHEMA, glob="*.csv", recursive=True)) == [1, 2, 3]
    assert ids(readers.read_files(spark, "csv", base, SCHEMA, glob="*.csv", recursive=True, max_bytes=50)) == [1, 2]
    assert ids(readers.read_any(spark, "csv", f"{base}/[ab].csv", SCHEMA)) == [1]


def test_inventory(spark, tmp_path):
    put(tmp_path / "x", "a.bin", "12345")
    put(tmp_path / "x" / "y", "b.bin", "123")
    files = inventory.list_files(spark, str(tmp_path / "x"))
    assert {(r["name"], r["bytes"]) for r in files.collect()} == {("a.bin", 5), ("b.bin", 3)}
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    assert sorted((r["files"], r["bytes"]) for r in inventory.dir_usage(files).collect()) == [(1, 3), (1, 5)]
    sums = {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in inventory.file_checksums(spark, str(tmp_path / "x")).collect()}
    assert sums["a.bin"] == hashlib.sha256(b"12345").hexdigest()


@pytest.mark.parametrize("content", [b"ab\n\ncd" * 900, b"\xef\xbb\xbfx\r\ny\n" * 700, bytes(range(256)) * 30, b"\n" * 5000, b"\xff" * 5000])
def test_large_files_are_hashed_in_steps(spark, tmp_path, monkeypatch, setting, content):
    monkeypatch.setattr(inventory, "WHOLE_BYTES", 4000)
    monkeypatch.setattr(inventory, "STEP_BYTES", 1024)
    monkeypatch.setattr(inventory, "PIECE_BYTES", 300)
    setting("spark.sql.files.maxPartitionBytes", "1000")
    files = {"a {1}.bin": content, "b%.bin": content[:4500] + b"z", "small.bin": b"12345"}
    for name, data in files.items():
        (tmp_path / "x").mkdir(exist_ok=True)
        (tmp_path / "x" / name).write_bytes(data)
    got = {r["path"].rsplit("/", 1)[1]: (r["bytes"], r["sha256"]) for r in inventory.file_checksums(spark, str(tmp_path / "x")).collect()}
    assert got == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in files.items()}


def test_external_table_survives_its_drop(spark, tmp_path):
    path = put(tmp_path / "ext", "a.csv", "id,name,amount\n1,x,2.5\n")
    df = readers.external_table(spark, "ext_csv", str(tmp_path / "ext"), SCHEMA, header=True)
    assert df.count() == 1
    spark.sql("DROP TABLE ext_csv")
    assert folders.exists(spark, path)


def test_register(spark):
    readers.register(spark, {"numbers": spark.range(4)})
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 4


def test_incremental_read_pushes_the_mark(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    df = spark.read.parquet(path)
    newer = readers.read_incremental(df, "id", 6)
    assert newer.count() == 3
    assert "GreaterThan(id,6)" in newer._jdf.queryExecution().executedPlan().toString()
    assert readers.next_high_water_mark(newer, "id", 6) == 9
    assert readers.next_high_water_mark(readers.read_incremental(df, "id", 9), "id", 9) == 9
    assert readers.read_incremental(df, "id", None).count() == 10


def test_xml(spark, tmp_path):
    path = put(tmp_path, "f.xml", "<flow><p><id>1</id><prop><key>a</key><value>x</value></prop><prop><key>b</key><value>y</value></prop></p><p><id>2</id></p></flow>")
    df = readers.read_xml_records(spark, path, "p", "id int, prop array<struct<key: string, value: string>>")
    assert [(r["id"], len(r["prop"] or [])) for r in df.orderBy("id").collect()] == [(1, 2), (2, 0)]


def test_xml_is_written_in_files_of_bounded_size(spark, tmp_path):
    path = tmp_path / "x"
    writers.write_xml(spark.range(25).coalesce(1), str(path), "p", records=10)
    assert all(f.read_text().count("<p>") <= 10 for f in path.glob("part-*"))
    assert sorted(r["id"] for r in readers.read_xml_records(spark, str(path), "p", "id bigint").collect()) == list(range(25))


def test_conflicts(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.write(spark.range(1), path) == path
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write(spark.range(2), path)
    writers.write(spark.range(3), path, on_conflict="ignore")
    assert spark.read.parquet(path).count() == 1
    other = writers.write(spark.range(4), path, on_conflict="rename")
    assert other != path and spark.read.parquet(other).count() == 4
    writers.write(spark.range(5), path, on_conflict="replace")
    assert spark.read.parquet(path).count() == 5
    writers.write(spark.range(5), path, on_conflict="append")
    assert spark.read.parquet(path).count() == 10


def test_write_single(spark, tmp_path):
    path = tmp_path / "one"
    writers.write_single(spark.range(100).repartition(4), str(path))
    assert len(list(path.glob("part-*"))) == 1
    with pytest.raises(ValueError):
        writers.write_single(spark.range(100).repartition(4), str(path), max_bytes=1)
    assert spark.read.parquet(str(path)).count() == 100
    assert [p.name for p in tmp_path.iterdir()] == ["one"]


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(spark.range(10).withColumn("p", F.col("id") % 3), path, ["p"])
    writers.write_partitioned(spark.range(1).selectExpr("id", "1L as p"), path, ["p"])
    assert {r["p"]: r["count"] for r in spark.read.parquet(path).groupBy("p").count().collect()} == {0: 4, 1: 1, 2: 3}
    writers.write_partitioned(spark.range(1).selectExpr("id", "1L as p"), path, ["p"], dynamic=False)
    assert spark.read.parquet(path).count() == 1


def test_append_creates_then_adds(spark, tmp_path):
    for _ in range(2):
        writers.append(spark.range(3).withColumn("p", F.col("id") % 2), "appended", by=["p"], path=str(tmp_path / "t"))
    writers.append(spark.range(1).selectExpr("id % 2 as p", "id"), "appended")
    assert spark.table("appended").count() == 7


def test_ctas_and_conversion(spark, tmp_path, rows):
    writers.ctas(spark.range(3), "orc_copy", "orc", "snappy", str(tmp_path / "orc"))
    assert readers.read_orc(spark, str(tmp_path / "orc")).count() == 3
    assert tables.table_location(spark, "orc_copy")[0] == "orc"
    src = put(tmp_path / "csv", "a.csv", "1,x,2\n")
    assert writers.convert(spark, src, "csv", str(tmp_path / "pq"), "parquet", SCHEMA)
    assert rows(spark.read.parquet(str(tmp_path / "pq"))) == [(1, "x", 2.0)]
    empty = put(tmp_path / "csv", "none.csv", "")
    assert not writers.convert(spark, empty, "csv", str(tmp_path / "none"), "parquet", SCHEMA)
    assert not (tmp_path / "none").exists()


def test_dated_folders_and_knobs(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, timestamp'2024-03-04 05:06:07' AS ts")
    writers.write_dated(df, str(tmp_path / "d"), "ts")
    assert (tmp_path / "d" / "yyyy=2024" / "MM=03" / "dd=04").is_dir()
    writers.write_parquet(df, str(tmp_path / "k"), "zstd", 65536, False, 1024**2)
    assert spark.read.parquet(str(tmp_path / "k")).count() == 1


def test_routes_and_split_are_written_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", True), (2, "b", None)], "id int, route string, is_valid boolean")
    writers.write_routes(df, str(tmp_path / "r"))
    writers.write_split(df, str(tmp_path / "s"))
    assert {p.name for p in (tmp_path / "r").glob("route=*")} == {"route=a", "route=b"}
    assert {p.name for p in (tmp_path / "s").glob("is_valid=*")} == {"is_valid=true", "is_valid=false"}


def test_run_metadata(spark, tmp_path):
    writers.write_run_metadata(spark, str(tmp_path / "m"), {"rows": 5, "by": ["year"]})
    row = spark.read.json(str(tmp_path / "m")).first()
    assert json.loads(row["run"]) == {"rows": 5, "by": ["year"]} and row["written_at"].startswith("20")


def test_database_options():
    split = databases.Partitioning("id", 0, 100, 4)
    assert databases.read_options("jdbc:x", "t", split, fetchsize=10) == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "10", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4",
    }
    assert databases.read_options("jdbc:x", "SELECT 1")["dbtable"] == "(SELECT 1) q"


def test_kafka_layout(spark):
    assert kafka.kafka_options("b:1", "t")["maxOffsetsPerTrigger"] == "10000"
    message = kafka.as_messages(spark.createDataFrame([(1, "x")], "id int, v string"), "id").first()
    assert tuple(message) == ("1", '{"id":1,"v":"x"}')


def test_append_adds_new_columns(spark):
    spark.sql("DROP TABLE IF EXISTS appended")
    writers.append(spark.createDataFrame([(1, "a")], "id int, name string"), "appended")
    writers.append(spark.createDataFrame([("x", 2)], "note string, id int"), "appended")
    assert sorted(map(tuple, spark.table("appended").collect())) == [(1, "a", None), (2, None, "x")]
    spark.sql("DROP TABLE appended")
