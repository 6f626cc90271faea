"""Batch sinks and write modes."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources import folders
from tallyloom.sources.readers import read_any

_MODES = {"replace": "overwrite", "fail": "errorifexists", "ignore": "ignore", "append": "append"}


def write(df: DataFrame, path: str, fmt: str = "parquet", on_conflict: str = "fail", by: Sequence[str] = (), **options: object) -> str:
    """Write to a folder; ``on_conflict`` is replace, fail, ignore, append or rename (a unique suffix). Returns the path."""
    if on_conflict == "rename":
        if folders.exists(df.sparkSession, path):
            path = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
        on_conflict = "fail"
    df.write.format(fmt).mode(_MODES[on_conflict]).options(**options).partitionBy(*by).save(path)
    return path


def write_single(df: DataFrame, path: str, fmt: str = "parquet", max_bytes: int = 256 * 1024**2) -> None:
    """A small result as one file.

    The result is first written by all tasks. If that turned out larger than ``max_bytes`` it is refused, since one file
    would be one task's work.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    size = folders.folder_bytes(spark, staged)
    if size > max_bytes:
        folders.delete(spark, staged)
        raise ValueError(f"{size} bytes are too many for a single file of at most {max_bytes}")
    spark.read.schema(df.schema).parquet(staged).coalesce(1).write.format(fmt).mode("overwrite").save(path)
    folders.delete(spark, staged)


def append(df: DataFrame, table: str, fmt: str = "parquet", by: Sequence[str] = (), path: str | None = None) -> None:
    """Add rows to a table, creating it if needed; an existing table is matched by column name.

    Columns that the table lacks are added to it (older rows show null there); those that ``df`` lacks are null.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        known = spark.table(table)
        new = [f for f in df.schema.fields if f.name not in known.columns]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
            known = spark.table(table)
        given = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in known.schema.fields]
        df.select(*given).write.insertInto(table)
        return
    writer = df.write.format(fmt).partitionBy(*by)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def gathered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows brought together by ``by`` for writing, with even task sizes.

    Adaptive execution sizes the tasks from the real shuffle: small values share a task, and a value that holds much of
    the data is split over several, so neither thousands of small files nor one endless task result.
    """
    return df.hint("rebalance", *[F.col(c) for c in by])


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], dynamic: bool = True, fmt: str = "parquet") -> None:
    """One folder per value of the partition columns.

    Dynamic overwrite replaces only the folders that receive rows; static overwrite replaces all.
    """
    mode = "dynamic" if dynamic else "static"
    writer = gathered(df, by).write.format(fmt).mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(*by).save(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, cols: Sequence[str], path: str | None = None, fmt: str = "parquet") -> None:
    """A table bucketed and sorted by ``cols``.

    Rows are gathered by the bucket they will be written to, so a bucket is one file, or a few where it is large.
    """
    bucket = "bucket_number"
    placed = gathered(df.withColumn(bucket, F.pmod(F.hash(*cols), F.lit(buckets))), [bucket]).drop(bucket)
    writer = placed.write.format(fmt).mode("overwrite").bucketBy(buckets, *cols).sortBy(*cols)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def ctas(df: DataFrame, table: str, fmt: str = "parquet", codec: str | None = None, path: str | None = None) -> None:
    """A table in a format (csv, json, orc, parquet) with an optional compression codec."""
    writer = df.write.format(fmt).mode("overwrite")
    for key, value in (("compression", codec), ("path", path)):
        if value:
            writer = writer.option(key, value)
    writer.saveAsTable(table)


def convert(spark: SparkSession, src: str, fmt_in: str, dst: str, fmt_out: str, schema: T.StructType | str, **options: object) -> bool:
    """Files of one format rewritten in another; an input without records writes nothing. Tells whether it wrote."""
    rows = read_any(spark, fmt_in, src, schema, **options)
    if rows.isEmpty():
        return False
    rows.write.format(fmt_out).mode("overwrite").save(dst)
    return True


def write_parquet(
    df: DataFrame, path: str, compression: str = "snappy", page_bytes: int = 1024**2, dictionary: bool = True, block_bytes: int | None = None
) -> None:
    """Parquet with the writer's own settings: codec, page size, dictionary use and row-group size."""
    options = {"compression": compression, "parquet.page.size": page_bytes, "parquet.enable.dictionary": dictionary}
    if block_bytes:
        options["parquet.block.size"] = block_bytes
    df.write.mode("overwrite").options(**options).parquet(path)


def write_xml(df: DataFrame, path: str, row_tag: str, records: int = 100_000) -> None:
    """Rows as XML elements, at most ``records`` in a file: an XML file does not split, so a reader takes it in one task."""
    df.hint("rebalance").write.option("rowTag", row_tag).option("maxRecordsPerFile", records).xml(path)


def write_dated(df: DataFrame, base: str, ts_col: str, fmt: str = "parquet") -> None:
    """Rows below a year, month and day folder taken from a timestamp."""
    day = F.col(ts_col)
    dated = df.withColumns({"yyyy": F.date_format(day, "yyyy"), "MM": F.date_format(day, "MM"), "dd": F.date_format(day, "dd")})
    parts = ["yyyy", "MM", "dd"]
    gathered(dated, parts).write.format(fmt).mode("append").partitionBy(*parts).save(base)


def write_routes(df: DataFrame, path: str, column: str = "route", mode: str = "append") -> None:
    """Routed rows (``operators.quality``) in one pass, one folder per route."""
    df.write.mode(mode).partitionBy(column).parquet(path)


def write_split(df: DataFrame, path: str, flag: str = "is_valid", mode: str = "append") -> None:
    """Valid and invalid rows in one pass, below ``<flag>=true`` and ``<flag>=false``."""
    df.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).write.mode(mode).partitionBy(flag).parquet(path)


def write_run_metadata(spark: SparkSession, path: str, record: Mapping[str, object]) -> None:
    """One run's description as a JSON record with the time of writing."""
    line = json.dumps(dict(record), sort_keys=True, default=str)
    row = spark.range(1).select(F.parse_json(F.lit(line)).alias("run"), F.current_timestamp().alias("written_at"))
    row.select(F.to_json("run").alias("run"), "written_at").write.mode("overwrite").json(path)
