"""Versioned Parquet tables: one folder per write and a small history record per version. Also whole-table migration.

A writer puts its rows into a folder that no other writer names, then claims the version by creating the version's record,
which names that folder. The record is created whole or not at all, so of several writers of one version exactly one
succeeds and the others' rows are nowhere in the table; a writer that dies half-way leaves the table as it was.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.reconcile import combine, reconcile
from tallyloom.sources import folders
from tallyloom.sources.writers import write_partitioned

RECORD_SCHEMA = "version long, revision long, operation string, rows long, committed_micros long, data string"


class VersionTaken(ValueError):
    """Another writer has recorded the version."""


def _records(spark: SparkSession, path: str) -> dict[int, tuple[int, str]]:
    """Per version the number and file of the record in force: the newest, if retries have replaced it."""
    found: dict[int, tuple[int, str]] = {}
    for name in folders.files(spark, f"{path}/_history"):
        version, _, revision = name.removesuffix(".json").partition("-")
        found[int(version)] = max(found.get(int(version), (-1, "")), (int(revision), f"{path}/_history/{name}"))
    return found


def _read_records(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.read.schema(RECORD_SCHEMA).json(names) if names else spark.createDataFrame([], RECORD_SCHEMA)


def latest_version(spark: SparkSession, path: str) -> int | None:
    return max(_records(spark, path), default=None)


def write_snapshot(df: DataFrame, path: str, operation: str = "WRITE", version: int | None = None, now: dt.datetime | None = None) -> int:
    """Store a new version and return its number.

    Giving the number makes a retry safe: the retry replaces the version if that was recorded under the same operation.
    A version of another operation, or one that another writer has recorded meanwhile, raises :class:`VersionTaken` and
    stays as it is.
    """
    spark = df.sparkSession
    records = _records(spark, path)
    revision = 0
    if version is None:
        version = max(records, default=-1) + 1
    elif version in records:
        revision, name = records[version]
        revision += 1
        if _read_records(spark, [name]).first()["operation"] != operation:
            raise VersionTaken(f"version {version} of {path} is of another operation")
    data = f"data/{version}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{path}/{data}")
    moment = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    counted = spark.read.schema(df.schema).parquet(f"{path}/{data}").agg(F.count(F.lit(1)).alias("rows"))
    facts = counted.select("rows", F.unix_micros(moment).alias("committed_micros")).first().asDict()
    record = {"version": version, "revision": revision, "operation": operation, "data": data} | facts
    if not folders.create(spark, f"{path}/_history/{version:020d}-{revision:06d}.json", json.dumps(record)):
        folders.delete(spark, f"{path}/{data}")
        raise VersionTaken(f"another writer has recorded version {version} of {path}")
    return version


def _data_of(spark: SparkSession, path: str, version: int | None) -> tuple[int, str]:
    records = _records(spark, path)
    wanted = max(records, default=None) if version is None else version
    if wanted not in records:
        raise ValueError(f"{path} has no version {wanted}")
    return wanted, f"{path}/{_read_records(spark, [records[wanted][1]]).first()['data']}"


def read_as_of(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table at a version, the newest by default."""
    return spark.read.parquet(_data_of(spark, path, version)[1])


@contextlib.contextmanager
def held(spark: SparkSession, path: str, version: int | None = None) -> Iterator[DataFrame]:
    """The table at a version that no expiry removes while the context is open."""
    wanted, _ = _data_of(spark, path, version)
    mark = f"{path}/_held/{wanted:020d}-{uuid.uuid4().hex}"
    folders.create(spark, mark, "")
    try:
        yield read_as_of(spark, path, wanted)  # looked up again: the mark may have come too late
    finally:
        folders.delete(spark, mark)


def _held(spark: SparkSession, path: str) -> set[int]:
    return {int(name.partition("-")[0]) for name in folders.files(spark, f"{path}/_held")}


def history(spark: SparkSession, path: str) -> DataFrame:
    """``version``, ``operation``, ``rows`` and ``committed_at`` of each version, the newest first."""
    records = _read_records(spark, [name for _, name in _records(spark, path).values()])
    return records.select("version", "operation", "rows", F.timestamp_micros("committed_micros").alias("committed_at")).orderBy(F.desc("version"))


def expire_snapshots(spark: SparkSession, path: str, hours: float = 168, now: dt.datetime | None = None, keep: int = 1) -> list[int]:
    """Drop versions older than the retention, never the newest ``keep`` nor one that is held; returns their numbers.

    Records go before the rows they name, so no reader finds a version without its rows; rows of a version that a reader
    took hold of in between stay.
    """
    cutoff = (F.current_timestamp() if now is None else F.lit(now).cast("timestamp")) - F.make_dt_interval(secs=F.lit(hours * 3600).cast("decimal(18,6)"))
    spared = set(sorted(_records(spark, path))[-max(1, keep) :]) | _held(spark, path)
    old = history(spark, path).filter(F.col("committed_at") < cutoff)
    expired = sorted({r["version"] for r in old.select("version").collect()} - spared)
    if not expired:
        return []
    every = [f"{path}/_history/{name}" for name in folders.files(spark, f"{path}/_history") if int(name.partition("-")[0]) in set(expired)]
    rows = _read_records(spark, every).select("version", "data").collect()
    for name in every:
        folders.delete(spark, name)
    still = _held(spark, path)
    for row in rows:
        if row["version"] not in still:
            folders.delete(spark, f"{path}/{row['data']}")
    return expired


def migrate(spark: SparkSession, source: str, path: str, by: Sequence[str], group: str, measure: str) -> DataFrame:
    """Copy a table plainly and partitioned, check the copies against the source, and report one row.

    The copies go to ``<path>/plain`` and ``<path>/partitioned``.
    """
    table = spark.table(source)
    table.write.mode("overwrite").parquet(f"{path}/plain")
    write_partitioned(table, f"{path}/partitioned", by, dynamic=False)
    plain, partitioned = spark.read.parquet(f"{path}/plain"), spark.read.parquet(f"{path}/partitioned")
    groups = reconcile(table, plain, group, measure).agg(
        F.count(F.lit(1)).alias("groups"), F.count_if(~F.col("matches")).alias("groups_differing")
    )
    counted = [df.agg(F.count(F.lit(1)).alias(name)) for name, df in (("source_count", table), ("plain_count", plain), ("partitioned_count", partitioned))]
    figures = ["source_count", "plain_count", "partitioned_count", "groups", "groups_differing"]
    report = combine([*counted, groups]).agg(*[F.max(c).alias(c) for c in figures])  # one-row results side by side
    agree = (F.col("source_count") == F.col("plain_count")) & (F.col("source_count") == F.col("partitioned_count"))
    return report.select(
        F.lit(source).alias("source"), F.lit(path).alias("target"), *figures, (agree & (F.col("groups_differing") == 0)).alias("matches")
    )
