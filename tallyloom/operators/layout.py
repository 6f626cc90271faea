"""Table layout: partitions, statistics, formats, caching, summaries, compaction, clustering, plan facts."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.sales import monthly_sales_summary
from tallyloom.session import scratch_path
from tallyloom.sources import folders
from tallyloom.sources.inventory import list_files
from tallyloom.sources.writers import write_partitioned

CLUSTER_BITS = 6
#: Rows from which the quantiles of text columns are taken; they reach the driver.
TEXT_SAMPLE = 6400


def partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def collect_stats(spark: SparkSession, table: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Compute table statistics (and those of ``cols``, or of all columns for an empty list) and describe the table."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if cols is not None:
        columns = f"COLUMNS {', '.join(cols)}" if cols else "ALL COLUMNS"
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR {columns}")
    return spark.sql(f"DESCRIBE EXTENDED {table}")


def format_sizes(spark: SparkSession, df: DataFrame, formats: Sequence[str] = ("csv", "orc", "parquet")) -> DataFrame:
    """Rows, files and bytes of the same rows in several formats; the copies are removed afterwards."""
    base = scratch_path(spark, "formats")
    rows = []
    for fmt in formats:
        df.write.format(fmt).save(f"{base}/{fmt}")
        count = spark.read.schema(df.schema).format(fmt).load(f"{base}/{fmt}").agg(F.count(F.lit(1)).alias("n")).first()["n"]
        files = list_files(spark, f"{base}/{fmt}", glob="part-*").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")).first()
        rows.append((fmt, count, files["files"], files["bytes"] or 0))
    folders.delete(spark, base)
    return spark.createDataFrame(rows, "format string, rows long, files long, bytes long")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def plan_facts(df: DataFrame) -> dict[str, object]:
    """What matters of a plan: exchanges, broadcasts, scans, join kinds and the filters that reach the files."""
    text, whole = plan_text(df, "simple"), plan_text(df, "formatted")  # only the latter gives filters in full
    return {
        "exchanges": len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range|Single|RoundRobin)", text)),
        "broadcasts": text.count("BroadcastExchange"),
        "scans": len(re.findall(r"FileScan |Scan parquet", text)),
        "sort_merge_joins": text.count("SortMergeJoin"),
        "broadcast_joins": text.count("BroadcastHashJoin"),
        "partition_filters": [f for f in re.findall(r"^PartitionFilters: \[(.*)\]$", whole, re.M) if f],
        "pushed_filters": [f for f in re.findall(r"^PushedFilters: \[(.*)\]$", whole, re.M) if f],
        "read_schemas": re.findall(r"^ReadSchema: struct<(.*)>$", whole, re.M),
    }


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """The DataFrame kept for the length of a ``with`` block, for parents that several results read."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def repartition(df: DataFrame, n: int, *cols: str) -> DataFrame:
    return df.repartition(n, *cols)


def refresh_summary(spark: SparkSession, tx: DataFrame, path: str, touched: DataFrame | None = None) -> DataFrame:
    """The stored monthly summary, built or refreshed.

    Distinct customers cannot be added up, so whole months are recomputed: all of them, or those in ``touched``
    (year, month). Only their folders are replaced, and of a table partitioned by month only their folders are read.
    """
    rows = tx
    if touched is not None:
        month = F.col("year") * 100 + F.col("month")
        rows = tx.filter(month.isin([r["m"] for r in touched.select(month.alias("m")).distinct().collect()]))
    summary = monthly_sales_summary(rows)
    write_partitioned(summary, path, ["year", "month"], dynamic=touched is not None)
    return read_summary(spark, path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_as_written(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder with the columns of all its files, and partition values as the text of their folder names."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    finally:
        spark.conf.set(key, before)


def compact(spark: SparkSession, path: str, target_bytes: int = 256 * 1024**2, by: Sequence[str] = ()) -> int:
    """Rewrite a Parquet folder into files of about ``target_bytes``; returns how many the plain layout gets.

    A plain folder is rewritten without a shuffle by merging scan tasks, unless the target is smaller than what one
    scan task reads. A partitioned one is shuffled by partition
    value and, for values above the target, by a hash of the row, so that no value is one task's work. The result is
    written beside the folder and switched in, once it holds as many rows and the same columns. Columns that only some
    files have are kept, and partition values stay the text of their folder names.
    """
    source = read_as_written(spark, path)
    rows = source
    files = max(1, math.ceil(folders.folder_bytes(spark, path) / target_bytes))
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    if not by:
        scan_bytes = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
        merged = rows.coalesce(files) if target_bytes >= scan_bytes else rows.repartition(files)
        merged.write.parquet(staged)
    else:
        file = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")]
        sizes = rows.select(*by, *file).distinct().groupBy(*by)
        parts = sizes.agg(F.greatest(F.lit(1), F.ceil(F.sum("size") / F.lit(target_bytes))).alias("pieces"))
        value = F.struct(*by)
        # One row per partition folder: no more than the file index that the driver holds anyway.
        few = F.broadcast(parts.select(value.alias("value"), "pieces"))
        sized = rows.withColumn("value", value).join(few, "value")
        piece = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in by]), F.col("pieces"))
        placed = sized.withColumn("piece", piece).repartition(*by, "piece").select(*rows.columns)
        placed.write.partitionBy(*by).parquet(staged)
    done = read_as_written(spark, staged)
    if done.count() != source.count() or set(done.columns) != set(source.columns):
        folders.delete(spark, staged)
        raise ValueError(f"{path} changed while it was compacted")
    folders.switch(spark, staged, path)
    return files


def _rank_of(value: Column, bounds: Sequence[object]) -> Column:
    """How many of the ascending bounds lie at or below the value, by halving."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(bounds[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return F.coalesce(search(0, len(bounds)), F.lit(0)) if bounds else F.lit(0)


def text_quantiles(df: DataFrame, cols: Sequence[str], n: int) -> dict[str, list[str]]:
    """Up to ``n - 1`` ascending bounds per text column, from the TEXT_SAMPLE rows of least hash."""
    if not cols:
        return {}
    sample = df.select(*cols, F.xxhash64(*df.columns).alias("_hash")).orderBy("_hash").limit(TEXT_SAMPLE).collect()
    bounds = {}
    for c in cols:
        values = sorted(r[c] for r in sample if r[c] is not None)
        bounds[c] = sorted({values[len(values) * i // n] for i in range(1, n)}) if values else []
    return bounds


def cluster_key(df: DataFrame, cols: Sequence[str], bits: int = CLUSTER_BITS) -> Column:
    """One number per row that keeps rows close in all ``cols`` close: the bits of each column's quantile rank, taken
    in turn. Texts rank in their own order. Quantiles are approximate; they steer the layout only."""
    probes = [i / 2**bits for i in range(1, 2**bits)]
    values: dict[str, Column] = {}
    texts = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    for c in cols:
        kind = df.schema[c].dataType
        if c in texts:
            values[c] = F.col(c)
        elif isinstance(kind, T.DateType):
            values[c] = F.unix_date(c).cast("double")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            values[c] = F.unix_micros(F.col(c).cast("timestamp")).cast("double")
        else:
            values[c] = F.col(c).cast("double")
    bounds: dict[str, list] = dict(text_quantiles(df, texts, 2**bits))
    numbers = [c for c in cols if c not in texts]
    if numbers:
        found = df.agg(*[F.percentile_approx(values[c], probes, 1000).alias(c) for c in numbers]).first()
        bounds |= {c: sorted(set(found[c] or [])) for c in numbers}
    ranks = [_rank_of(values[c], bounds[c]) for c in cols]
    key = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for rank in ranks:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long")))
    return key


def cluster_write(df: DataFrame, cols: Sequence[str], path: str, files: int, bits: int = CLUSTER_BITS) -> None:
    """Parquet files clustered by several columns at once, so that a filter on any of them skips most row groups.

    Rows are ranged by the key and, within one key value, by a hash of the row: a value held by many rows is split.
    """
    keyed = df.withColumns({"cluster_key": cluster_key(df, cols, bits), "cluster_tie": F.xxhash64(*df.columns)})
    placed = keyed.repartitionByRange(files, "cluster_key", "cluster_tie").sortWithinPartitions("cluster_key", *cols)
    placed.drop("cluster_key", "cluster_tie").write.mode("overwrite").parquet(path)
