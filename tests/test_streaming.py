import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import joins, snapshots
from tallyloom.streaming import jobs, merged, sinks
from tallyloom.streaming.sources import stream_files

SALES = "timestamp timestamp, category string, total_amount double"


def moment(text):
    return dt.datetime.fromisoformat(f"2024-01-01 {text}")


@pytest.fixture
def feed(spark, tmp_path):
    """Stage batches of rows one after the other; returns the folder and the function that adds a file."""
    folder = tmp_path / "feed"
    folder.mkdir()

    def add(rows, schema=SALES):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))

    return str(folder), add


def test_windows_and_late_rows(spark, feed, tmp_path):
    folder, add = feed
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = stream_files(spark, folder, "parquet", SALES)
        windows = jobs.flat_window(jobs.windowed_sales(stream, slide=None))
        sinks.finish(sinks.to_table(windows, out, checkpoint))

    add([(moment("10:01:00"), "a", 0.1), (moment("10:02:00"), "a", 0.2), (moment("10:20:00"), "a", 1.0)])
    run()
    add([(moment("10:03:00"), "a", 50.0), (moment("10:40:00"), "a", 1.0)])  # the first row is past the watermark
    run()
    add([(moment("11:00:00"), "a", 1.0)])
    run()
    got = {r["window_start"]: (r["total_revenue"], r["transaction_count"]) for r in spark.read.parquet(out).collect()}
    assert got[moment("10:00:00")] == (0.3, 2)
    assert set(got) == {moment("10:00:00"), moment("10:20:00"), moment("10:40:00")}


def test_update_sink_holds_the_batch_result(spark, feed, tmp_path):
    folder, add = feed
    add([(moment("10:01:30"), "a", 1.0)])
    add([(moment("10:02:30"), "a", 2.0), (moment("10:02:40"), "b", 5.0)])
    stream = stream_files(spark, folder, "parquet", SALES, max_files=1)
    sinks.finish(sinks.to_updates(jobs.flat_window(jobs.windowed_sales(stream)), str(tmp_path / "o"), str(tmp_path / "c")))
    got = sinks.read_updates(spark, str(tmp_path / "o"), ["window_start", "window_end", "category"])
    batch = jobs.flat_window(jobs.windowed_sales(spark.read.schema(SALES).parquet(folder)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert got.count() == 6 + 5


def test_running_totals_continue_after_a_restart(spark, feed, tmp_path):
    folder, add = feed
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")

    def run():
        totals = jobs.running_totals(stream_files(spark, folder, "parquet", SALES))
        return sinks.finish(sinks.to_snapshot(totals, out, checkpoint))

    add([(moment("10:00:00"), "a", 1.0), (moment("10:00:00"), "b", 2.0)])
    run()
    add([(moment("10:00:00"), "a", 0.5)])
    query = run()
    assert sorted(map(tuple, snapshots.read_as_of(spark, out).collect())) == [("a", 1.5, 2), ("b", 2.0, 1)]
    assert sorted(map(tuple, snapshots.read_as_of(spark, out, 0).collect())) == [("a", 1.0, 1), ("b", 2.0, 1)]
    health = sinks.progress_row(query).first()
    assert health["is_active"] is False and health["input_rows"] == 1 and health["state_operators"] == ["stateStoreSave"]


def test_each_row_is_written_once_across_restarts(spark, feed, tmp_path):
    folder, add = feed
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    for i in range(3):
        add([(moment("10:00:00"), f"k{i}", 1.0)])
        sinks.finish(sinks.to_table(stream_files(spark, folder, "parquet", SALES), out, checkpoint, by=["category"]))
    assert sorted(r["category"] for r in spark.read.parquet(out).collect()) == ["k0", "k1", "k2"]


def test_rate_limit_makes_one_batch_per_file(spark, feed, tmp_path):
    folder, add = feed
    for i in range(3):
        add([(moment("10:00:00"), f"k{i}", 1.0)])
    stream = stream_files(spark, folder, "parquet", SALES, max_files=1)
    query = sinks.finish(sinks.alert_stream(stream, str(tmp_path / "o"), str(tmp_path / "c"), F.count(F.lit(1)), 0, "rows"))
    assert len(query.recentProgress) >= 3
    assert [r["value"] for r in sinks.read_batches(spark, str(tmp_path / "o")).collect()] == [1.0, 1.0, 1.0]


def test_lookup_join_on_a_stream(spark, feed, tmp_path):
    folder, add = feed
    add([(moment("10:00:00"), "a", 1.0), (moment("10:00:00"), "z", 1.0)])
    lookup = spark.createDataFrame([("a", "Books")], "category string, label string")
    stream = joins.enrich(stream_files(spark, folder, "parquet", SALES), lookup, "category", "left")
    sinks.finish(sinks.to_table(stream, str(tmp_path / "o"), str(tmp_path / "c")))
    assert sorted((r["category"], r["label"]) for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [("a", "Books"), ("z", None)]


def test_log_records_from_messages(spark, feed, tmp_path):
    folder, add = feed
    value = b'{"timestamp":"2024-01-01T07:08:09Z","level":"ERROR","service":"s","message":"m","response_time_ms":5}'
    add([(b"k", value, moment("10:00:00")), (b"k", b"not json", moment("10:00:00"))], "key binary, value binary, timestamp timestamp")
    stream = jobs.log_stream(stream_files(spark, folder, "parquet", "key binary, value binary, timestamp timestamp"))
    sinks.finish(sinks.to_memory(stream, "parsed_logs", "append"))
    got = {r["level"]: (r["hour"], r["severity"], r["alert_required"]) for r in spark.table("parsed_logs").collect()}
    assert got == {"ERROR": (7, 4, True), None: (None, 1, False)}


CHANGES = "id int, name string, operation string, changed_at timestamp"


@pytest.fixture
def merging(spark, feed, tmp_path):
    """A table of (id, name) and a function that streams changes into it, one batch a call."""
    folder, add = feed
    out = str(tmp_path / "t")
    merged.load_base(spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"), out, ["id"], place="id")

    def change(*rows):
        if rows:
            add([(i, n, op, moment(f"{t}:00") if t else None) for i, n, op, t in rows], CHANGES)
        sinks.finish(merged.merge_stream(stream_files(spark, folder, "parquet", CHANGES), out, str(tmp_path / "c")))

    return out, change


def test_merge_stream_applies_a_batch_once(spark, merging, rows):
    out, change = merging
    change((1, "A", "u", "10:00"), (2, None, "d", "10:00"), (3, "c", "c", "10:00"))
    change()
    assert rows(merged.read_merged(spark, out)) == [(1, "A"), (3, "c")]


def test_merge_stream_goes_by_change_time(spark, merging, rows):
    out, change = merging
    batches = [
        [(1, "new", "u", "12:00"), (2, None, "d", "12:00"), (5, "x", None, "12:00"), (None, "y", "c", "12:00"), (6, "z", "c", None)],
        [(1, "old", "u", "11:00"), (2, "late", "u", "11:00"), (3, "c", "c", "11:00")],
        [(3, "c2", "u", "13:00"), (2, "again", "c", "13:00")],
    ]
    want = [[(1, "new")], [(1, "new"), (3, "c")], [(1, "new"), (2, "again"), (3, "c2")]]
    for batch, after in zip(batches, want, strict=True):
        change(*batch)
        assert rows(merged.read_merged(spark, out)) == after
    assert sorted(r["name"] for r in merged.read_rejected(spark, out).collect()) == ["x", "y", "z"]
    for late in ("10 minutes", "0 minutes"):
        merged.fold_changes(spark, out, late)
        assert rows(merged.read_merged(spark, out)) == want[-1]
    assert merged.read_late(spark, out) is None


def test_fold_rewrites_only_the_places_of_its_changes(spark, merging, rows, tmp_path):
    out, change = merging
    files = lambda place: {f.name for f in (tmp_path / "t/data").glob(f"*/_place={place}/*.parquet")}
    second = files(2)
    change((1, "A", "u", "10:00"), (3, None, "d", "10:00"))
    change((1, "B", "u", "10:05"))
    change((2, "never folded: the newest batch", "u", "10:01"))
    before = rows(merged.read_merged(spark, out))
    assert merged.fold_changes(spark, out, "2 minutes") == (1, 2, 2, 2)  # id 1 lies before the mark once, id 3 is only deleted
    assert rows(merged.read_merged(spark, out)) == before == [(1, "B"), (2, "never folded: the newest batch")]
    assert files(2) == second
    assert merged.fold_changes(spark, out) == (1, 2, 0, 0)


def test_a_stale_change_beats_neither_a_fold_nor_a_later_load(spark, merging, rows):
    out, change = merging
    change((1, "A", "u", "12:00"), (2, None, "d", "12:00"))
    with pytest.raises(ValueError):
        merged.load_base(spark.createDataFrame([(1, "L")], "id int, name string"), out, ["id"], place="id")
    load = spark.createDataFrame([(1, "L"), (2, "M")], "id int, name string")
    merged.load_base(load, out, ["id"], moment("13:00:00"), place="id")
    assert rows(merged.read_merged(spark, out)) == [(1, "L"), (2, "M")]
    change((1, "stale", "u", "12:30"), (3, "gone by 13:00", "c", "12:30"), (2, "N", "u", "13:30"))
    assert rows(merged.read_merged(spark, out)) == [(1, "L"), (2, "N")]
    change((9, "i", "c", "13:40"))
    merged.fold_changes(spark, out, "0 minutes")
    assert rows(merged.read_merged(spark, out)) == [(1, "L"), (2, "N"), (9, "i")]
    change((2, "after its fold", "u", "13:20"), (2, "after its fold", "u", "13:20"))
    change((8, "h", "c", "13:50"))
    assert rows(merged.read_merged(spark, out)) == [(1, "L"), (2, "N"), (8, "h"), (9, "i")]
    merged.fold_changes(spark, out, "0 minutes")
    assert rows(merged.read_merged(spark, out)) == [(1, "L"), (2, "N"), (8, "h"), (9, "i")]
    assert {r["name"] for r in merged.read_late(spark, out).collect()} == {"A", None, "stale", "gone by 13:00", "after its fold"}


def test_old_files_leave_with_the_next_fold_and_a_second_fold_is_refused(spark, merging, rows, tmp_path, monkeypatch):
    out, change = merging
    for k in range(6):
        change((1, f"n{k}", "u", f"10:{k:02d}"))
        merged.fold_changes(spark, out, "0 minutes")
        assert rows(merged.read_merged(spark, out)) == [(1, f"n{k}"), (2, "b")]
    held = {p.name for p in (tmp_path / "t/_changes").iterdir()}
    assert held <= {"batch_id=3", "batch_id=4", "batch_id=5"}
    assert len(list((tmp_path / "t/_versions").glob("*.json"))) == 2
    assert len(list((tmp_path / "t/data").glob("*/_place=1"))) <= 2
    change((1, "last", "u", "11:00"))
    real, once = merged.folders.create, []

    def create(spark, *args):
        if not once:
            once.append(True)
            merged.fold_changes(spark, out, "0 minutes")
        return real(spark, *args)

    monkeypatch.setattr(merged.folders, "create", create)
    with pytest.raises(merged.VersionTaken):
        merged.fold_changes(spark, out, "0 minutes")
    assert rows(merged.read_merged(spark, out)) == [(1, "last"), (2, "b")]


def test_many_places_share_few_folders(spark, feed, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(merged, "MOST_FOLDERS", 3)
    folder, add = feed
    out, state = str(tmp_path / "t"), {i: "a" for i in range(-1, 29)}
    merged.load_base(spark.createDataFrame(list(state.items()), "id int, name string"), out, ["id"], place="id")
    assert len(list((tmp_path / "t/data").glob("*/_place=*"))) == 3

    def change(minute, *changes):
        add([(i, n, op, moment(f"10:{minute:02d}:00")) for i, n, op in changes], CHANGES)
        sinks.finish(merged.merge_stream(stream_files(spark, folder, "parquet", CHANGES), out, str(tmp_path / "c")))
        state.update({i: n for i, n, _ in changes})

    steps = [([(2, "b", "u"), (3, None, "d"), (40, "new", "c")], (31 - 1, 3)), ([(2, "c", "u")], (30, 1)), ([(i, "d", "u") for i in range(-1, 6)], (31, 10))]
    for minute, (changes, (places, rewritten)) in enumerate(steps):
        change(3 * minute, *changes)
        add([(None, "rejected", "u", moment("10:59:00"))], CHANGES)
        sinks.finish(merged.merge_stream(stream_files(spark, folder, "parquet", CHANGES), out, str(tmp_path / "c")))
        want = sorted(((i, n) for i, n in state.items() if n is not None), key=repr)
        assert rows(merged.read_merged(spark, out)) == want
        done = merged.fold_changes(spark, out, "0 minutes")
        assert (done.places, done.rewritten) == (places, rewritten)  # the last leaves less than half of a folder, and moves the rest
        assert rows(merged.read_merged(spark, out)) == want


def test_a_load_over_many_places_retires_few_folders(spark, merging, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(merged, "MOST_FOLDERS", 4)
    out, _ = merging
    for k in range(2):
        load = spark.createDataFrame([(i, f"{k}") for i in range(50)], "id int, name string")
        merged.load_base(load, out, ["id"], moment(f"1{k}:00:00"), place="id")
        assert rows(merged.read_merged(spark, out)) == sorted(((i, f"{k}") for i in range(50)), key=repr)
    facts = merged._in_force(spark, out)
    assert len(facts["places"]) == len(facts["retired"]) == 4 and sum(map(len, facts["places"].values())) == 50


def test_merged_table_that_is_empty_or_lacks_columns(spark, feed, tmp_path):
    folder, add = feed
    out = str(tmp_path / "t")
    with pytest.raises(ValueError):
        merged.read_merged(spark, out)
    merged.load_base(spark.createDataFrame([], "id int, name string"), out, ["id"])
    assert merged.read_merged(spark, out).collect() == []
    add([(1, "c", moment("10:00:00"))], "id int, operation string, changed_at timestamp")
    with pytest.raises(ValueError):
        merged.merge_stream(stream_files(spark, folder, "parquet", "id int, operation string, changed_at timestamp"), out, str(tmp_path / "c"))


def test_failed_query_raises(spark, feed, tmp_path):
    folder, add = feed
    add([(moment("10:00:00"), "a", 1.0)])
    broken = stream_files(spark, folder, "parquet", SALES).withColumn("x", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        sinks.finish(sinks.to_table(broken, str(tmp_path / "o"), str(tmp_path / "c")))


def test_console_sink_runs(spark, feed, tmp_path):
    folder, add = feed
    add([(moment("10:00:00"), "a", 1.0)])
    query = sinks.to_console(jobs.running_totals(stream_files(spark, folder, "parquet", SALES)), "update", None, str(tmp_path / "c"))
    assert sinks.finish(query).lastProgress["numInputRows"] == 1


def test_minute_bundles_are_bounded(spark, feed, tmp_path):
    folder, add = feed
    add([(moment(f"10:00:{s:02d}"), "a", float(s)) for s in range(25)] + [(moment("10:01:00"), "a", 99.0)])
    for late in ([], [(moment("10:10:00"), "b", 1.0)], [(moment("10:00:30"), "a", 1000.0)]):  # closes both windows; comes too late
        if late:
            add(late)
        stream = stream_files(spark, folder, "parquet", SALES)
        sinks.finish(sinks.bundle_stream(stream, str(tmp_path / "o"), str(tmp_path / "c"), "timestamp", ["category"], ["total_amount"], max_records=10, every=None))
    got = [(r["window_start"], r["bundle_no"], [x["total_amount"] for x in r["records"]]) for r in sinks.read_batches(spark, str(tmp_path / "o")).collect()]
    ten = moment("10:00:00")
    assert sorted(got) == [
        (ten, 1, [float(i) for i in range(10)]),
        (ten, 2, [float(i) for i in range(10, 20)]),
        (ten, 3, [float(i) for i in range(20, 25)]),
        (moment("10:01:00"), 1, [99.0]),
    ]
    assert not list((tmp_path / "c-scratch").glob("batch_id=*"))


def test_a_stream_runs_by_interval(spark, feed, tmp_path):
    folder, add = feed
    add([(moment("10:00:00"), "a", 1.0)])
    query = sinks.to_table(stream_files(spark, folder, "parquet", SALES), str(tmp_path / "o"), str(tmp_path / "c"), every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and spark.read.parquet(str(tmp_path / "o")).count() == 1
    finally:
        query.stop()


def test_a_stream_keeps_a_set_number_of_versions(spark, feed, tmp_path):
    folder, add = feed
    out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
    for i in range(6):
        add([(moment("10:00:00"), f"k{i}", 1.0)])
    totals = stream_files(spark, folder, "parquet", SALES, max_files=1).groupBy("category").count()
    sinks.finish(sinks.to_snapshot(totals, out, checkpoint, keep=2, hours=0))
    assert [r["version"] for r in snapshots.history(spark, out).collect()] == [5, 4]
    assert snapshots.read_as_of(spark, out).count() == 6
