"""A keyed table that a stream of changes is merged into.

The table is a base and a log. The base lies in places (hash buckets of the key, or any whole-number expression of it). A
folder of files holds one place or, of very many, a run of them, so the number of folders does not follow that of places. A
manifest per version names the folders with the places that count in each, and the mark, the change time up to which the
base is complete. The log holds the changes of each batch. Reading puts the log's changes after the mark over the base;
:func:`fold_changes` moves the mark on and rewrites only the places those changes fall into. Changes at or before the mark
never count again, so none beats a later load, and a delete leaves the log with its fold. A place written anew counts no more
in the folder it lay in; a folder in which less than half still counts is emptied by the fold that makes it so.

A manifest is created whole or not at all (``folders.create``), after all that it names is written. What a version replaces is
deleted by the fold after the next, so a reader may go on with the version before.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.joins import fits_broadcast
from tallyloom.operators.merge import latest_changes, usable_change
from tallyloom.operators.snapshots import VersionTaken
from tallyloom.session import checkpointed
from tallyloom.sources import folders
from tallyloom.sources.writers import gathered
from tallyloom.streaming.sinks import per_batch

PLACE, BEGIN, FOLDER = "_place", "_place_begin", "_place_folder"
#: A write uses at most so many folders, or one per so many rows of the load where that is more.
MOST_FOLDERS = 256
FOLDER_ROWS = 1_000_000


class Fold(NamedTuple):
    """What a fold did: the version then in force, its places, those written anew, and the keys whose changes went into them."""

    version: int
    places: int
    rewritten: int
    changes: int


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.removesuffix(".json")) for name in folders.files(spark, f"{path}/_versions"))


def _file(path: str, version: int) -> str:
    return f"{path}/_versions/{version:020d}.json"


def _manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest in force; its size goes with the number of places, not with the rows."""
    found = _versions(spark, path)
    if not found:
        return None
    manifest = json.loads(spark.read.text(_file(path, found[-1]), wholetext=True).first()[0])
    if "gone" not in manifest:  # written when each place had a folder of its own
        manifest |= {"places": {name: [int(p)] for p, name in manifest["places"].items()}, "gone": {}, "most": MOST_FOLDERS}
    return manifest


def _in_force(spark: SparkSession, path: str) -> dict:
    manifest = _manifest(spark, path)
    if manifest is None:
        raise ValueError(f"{path} has no base; load one first")
    return manifest


def _claim(spark: SparkSession, path: str, manifest: dict, written: Sequence[str]) -> None:
    """Put a manifest in force; if another writer was first, take back what was ``written`` for it."""
    if folders.create(spark, _file(path, manifest["version"]), json.dumps(manifest)):
        return
    for name in written:
        folders.delete(spark, f"{path}/{name}")
    raise VersionTaken(f"another writer has put version {manifest['version']} of {path} in force")


def _number(place: str) -> Column:
    return F.coalesce(F.expr(place).cast("long"), F.lit(-1))


def _write_places(df: DataFrame, path: str, place: str, places: Sequence[int], most: int) -> tuple[str, dict[str, list[int]]]:
    """Write rows that lie in ``places`` to at most ``most`` folders, each named after the first of its places; returns the
    folder above them, and of each the places that have rows."""
    spark, data = df.sparkSession, f"data/{uuid.uuid4().hex}"
    ordered, run = sorted(places), max(1, -(-len(places) // most))
    first = {p: ordered[i - i % run] for i, p in enumerate(ordered)}
    numbered = df.withColumn(PLACE, _number(place))
    if run > 1:
        begins = spark.createDataFrame(list(first.items()), f"{PLACE} long, {BEGIN} long")
        numbered = numbered.join(F.broadcast(begins), PLACE, "left").withColumn(PLACE, F.coalesce(BEGIN, PLACE)).drop(BEGIN)
    gathered(numbered, [PLACE]).write.partitionBy(PLACE).parquet(f"{path}/{data}")
    lying = {f"{data}/{name}": [] for name in folders.subfolders(spark, f"{path}/{data}")}
    if run == 1:
        return data, {name: [int(name.rpartition("=")[2])] for name in lying}
    for row in _rows(spark, path, list(lying), df.schema).select(_number(place).alias(PLACE)).distinct().collect():  # one row per place
        lying[f"{data}/{PLACE}={first.get(row[PLACE], row[PLACE])}"].append(row[PLACE])
    return data, lying


def _rows(spark: SparkSession, path: str, names: Sequence[str], schema: T.StructType) -> DataFrame:
    """Rows of some folders of the table; none give an empty table."""
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in names]) if names else spark.createDataFrame([], schema)


def _counting(spark: SparkSession, path: str, facts: dict, wanted: Sequence[str] | None = None) -> DataFrame:
    """Base rows of all folders, or of the ``wanted`` ones, without those of places that were written anew elsewhere."""
    schema, names = T.StructType.fromJson(facts["schema"]), sorted(facts["places"] if wanted is None else wanted)
    partly = [n for n in names if n in facts["gone"]]
    whole = _rows(spark, path, [n for n in names if n not in facts["gone"]], schema)
    if not partly:
        return whole
    gone = spark.createDataFrame([(n, p) for n in partly for p in facts["gone"][n]], f"{FOLDER} string, {PLACE} long")
    folder = F.regexp_extract("_metadata.file_path", f"(data/[0-9a-f]{{32}}/{PLACE}=-?[0-9]+)/[^/]*$", 1)
    rows = _rows(spark, path, partly, schema).withColumns({FOLDER: folder, PLACE: _number(facts["place"])})
    return whole.unionByName(rows.join(F.broadcast(gone), [FOLDER, PLACE], "left_anti").select(*schema.names))


def load_base(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    complete_to: dt.datetime | None = None,
    places: int = 64,
    place: str | None = None,
    ts: str = "changed_at",
    tiebreak: Sequence[str] = (),
) -> int:
    """Store all rows as the new base and return its version; keys must be unique in it.

    The rows hold all changes up to ``complete_to``; collected changes up to then no longer count, later ones do. Only the
    first load may go without, and then every change counts. ``place`` is an SQL expression of the keys that gives whole numbers,
    by default one of ``places`` hash buckets; take one under which keys that change together lie together.
    """
    spark, before = df.sparkSession, _manifest(df.sparkSession, path)
    if before is not None and complete_to is None:
        raise ValueError("a later load must say up to which change time it is complete")
    if taken := {PLACE, BEGIN, FOLDER} & set(df.columns):
        raise ValueError(f"a column may not be named {min(taken)}")
    mark = None
    if complete_to is not None:
        mark = spark.range(1).select(F.unix_micros(F.lit(complete_to).cast("timestamp"))).first()[0]
        if before is not None and before["mark"] is not None and mark < before["mark"]:
            raise ValueError("the base in force is complete up to a later time")
    place = place or f"pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), {places})"
    counted = df.groupBy(_number(place).alias(PLACE)).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per place
    most = max(MOST_FOLDERS, sum(r["n"] for r in counted) // FOLDER_ROWS)
    data, lying = _write_places(df, path, place, [r[PLACE] for r in counted], most)
    manifest = {
        "version": 0 if before is None else before["version"] + 1,
        "schema": df.schema.jsonValue(), "keys": list(keys), "ts": ts, "tiebreak": list(tiebreak), "place": place, "mark": mark, "places": lying, "gone": {}, "most": most,
        "through": -1 if before is None else before["through"], "carry": None if before is None else before["carry"],
        "late": [] if before is None else before["late"],
        "retired": [] if before is None else sorted(before["places"]),
    }
    _claim(spark, path, manifest, [data])
    if before is not None:
        _clear(spark, path, before)
    return manifest["version"]


def merge_stream(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Collect flat changes (``operators.merge``) beside a loaded base: the last one per key of each batch, a folder per batch.

    A batch costs as much as its changes. Each must hold the whole row. Those that lack a key, a time or a known operation are
    kept apart, see :func:`read_rejected`.
    """
    facts = _in_force(stream.sparkSession, path)
    keys, ts = facts["keys"], facts["ts"]
    missing = {f["name"] for f in facts["schema"]["fields"]} - set(stream.columns)
    if missing:
        raise ValueError(f"changes lack the columns {sorted(missing)}")
    usable = usable_change(keys) & F.col(ts).isNotNull()

    def handle(batch: DataFrame, batch_id: int) -> None:
        latest_changes(batch.filter(usable), keys, ts, facts["tiebreak"]).write.mode("overwrite").parquet(f"{path}/_changes/batch_id={batch_id}")
        batch.filter(~usable).write.mode("overwrite").parquet(f"{path}/_rejected/batch_id={batch_id}")

    return per_batch(stream, handle, checkpoint, "append", every)


def _waiting(spark: SparkSession, path: str, facts: dict) -> list[str]:
    """Folders of the batches that no fold has taken, the newest last."""
    numbers = sorted(int(n.removeprefix("batch_id=")) for n in folders.subfolders(spark, f"{path}/_changes"))
    return [f"_changes/batch_id={n}" for n in numbers if n > facts["through"]]


def _after(ts: str, mark: int | None) -> Column:
    return F.lit(True) if mark is None else F.col(ts).cast("timestamp") > F.timestamp_micros(F.lit(mark))


def _put_over(base: DataFrame, last: DataFrame, facts: dict) -> DataFrame:
    """Base rows without those that changed, and the changed ones that are not deleted. Only few changes are broadcast."""
    changed = last.select(*facts["keys"])
    kept = base.join(F.broadcast(changed) if fits_broadcast(changed) else changed, facts["keys"], "left_anti")
    return kept.select(*base.columns).union(last.filter(F.col("operation") != "d").select(*[F.col(f.name).cast(f.dataType) for f in base.schema.fields]))


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The table with all collected changes: per key the one of the latest time counts, whichever batch brought it."""
    facts = _in_force(spark, path)
    base = _counting(spark, path, facts)
    log = [*([facts["carry"]] if facts["carry"] else []), *_waiting(spark, path, facts)]
    if not log:
        return base
    changes = spark.read.parquet(*[f"{path}/{n}" for n in log]).filter(_after(facts["ts"], facts["mark"]))
    return _put_over(base, latest_changes(changes, facts["keys"], facts["ts"], facts["tiebreak"]), facts)


def fold_changes(spark: SparkSession, path: str, late: str = "10 minutes") -> Fold:
    """Put collected changes into the base, rewriting only the places they fall into. The table reads the same before and after.

    The mark moves to ``late`` before the newest change taken, so changes may come that much later than newer ones; those
    after the mark stay in the log, one per key. The newest batch is left alone, as the stream may run it again, and the mark
    stays before its changes. A change that comes after its time was folded is kept apart (:func:`read_late`). A stream may go
    on meanwhile; of two folds at once, or a fold and a load, one raises :class:`VersionTaken`.
    """
    facts = _in_force(spark, path)
    keys, ts = facts["keys"], facts["ts"]
    *taken, newest = _waiting(spark, path, facts) or [None]
    if not taken:
        return Fold(facts["version"], sum(map(len, facts["places"].values())), 0, 0)
    log = [*([facts["carry"]] if facts["carry"] else []), *taken]
    changes = spark.read.parquet(*[f"{path}/{n}" for n in log])
    moment = F.col(ts).cast("timestamp")
    reached = changes.agg(F.unix_micros(F.max(moment) - F.expr(f"INTERVAL {late}"))).first()[0]
    left_alone = spark.read.parquet(f"{path}/{newest}").filter(_after(ts, facts["mark"])).agg(F.unix_micros(F.min(moment)) - 1).first()[0]
    bounds = [m for m in (reached, left_alone) if m is not None]
    mark = max((m for m in (facts["mark"], min(bounds, default=None)) if m is not None), default=None)
    written: list[str] = []

    def store(df: DataFrame, kind: str) -> tuple[str, DataFrame]:
        written.append(f"{kind}/{uuid.uuid4().hex}")
        return written[-1], checkpointed(spark, df, kind, f"{path}/{written[-1]}")

    passed = changes.filter(~_after(ts, facts["mark"]))
    tardy = [] if facts["mark"] is None or passed.isEmpty() else [store(passed, "_late")[0]]
    current = changes.filter(_after(ts, facts["mark"]))
    carry, _ = store(latest_changes(current.filter(_after(ts, mark) if mark is not None else F.lit(False)), keys, ts, facts["tiebreak"]), "_carry")
    folder, due = store(latest_changes(current.filter(~_after(ts, mark) if mark is not None else F.lit(False)), keys, ts, facts["tiebreak"]), "_due")
    counted = due.groupBy(_number(facts["place"]).alias(PLACE)).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per place
    moved = {r[PLACE] for r in counted}
    lying, gone, replaced, opened = {}, dict(facts["gone"]), [], []
    for name, held in facts["places"].items():
        staying = [p for p in held if p not in moved]
        if len(staying) < len(held):
            opened.append(name)
            left = [*gone.pop(name, []), *(p for p in held if p in moved)]
            if 2 * len(staying) < len(staying) + len(left):
                replaced.append(name)
                moved.update(staying)
                continue
            gone[name] = left
        lying[name] = staying
    if moved:
        into = spark.createDataFrame([(p,) for p in sorted(moved)], f"{PLACE} long")
        base = _counting(spark, path, facts, opened)
        affected = base.withColumn(PLACE, _number(facts["place"])).join(F.broadcast(into), PLACE, "left_semi").select(*base.columns)
        data, anew = _write_places(_put_over(affected, due, facts), path, facts["place"], sorted(moved), facts["most"])
        written.append(data)
        lying |= anew
    manifest = facts | {
        "version": facts["version"] + 1, "mark": mark, "places": lying, "gone": gone, "carry": carry, "late": [*facts["late"], *tardy],
        "through": int(taken[-1].rpartition("=")[2]),
        "retired": [*sorted(replaced), *log],
    }
    _claim(spark, path, manifest, written)
    folders.delete(spark, f"{path}/{folder}")
    _clear(spark, path, facts)
    return Fold(manifest["version"], sum(map(len, lying.values())), len(moved), sum(r["n"] for r in counted))


def _clear(spark: SparkSession, path: str, before: dict) -> None:
    """Delete what the version before the last one had replaced, and older manifests."""
    for name in before["retired"]:
        folders.delete(spark, f"{path}/{name}")
    for version in _versions(spark, path)[:-2]:
        folders.delete(spark, _file(path, version))


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Changes of all batches that could not be applied."""
    return spark.read.option("basePath", f"{path}/_rejected").parquet(f"{path}/_rejected")


def read_late(spark: SparkSession, path: str) -> DataFrame | None:
    """Changes that folds met whose time the base had covered already; None if there were none."""
    late = _in_force(spark, path)["late"]
    return spark.read.parquet(*[f"{path}/{n}" for n in late]) if late else None
