"""Facts about stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.inventory import list_files


def table_location(spark: SparkSession, table: str) -> tuple[str, str]:
    """Provider and folder of a table."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return described["Provider"], described["Location"]


def table_options(spark: SparkSession, table: str) -> dict[str, str]:
    """The reader's options that a table was created with."""
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    given = described.get("Storage Properties", "").strip("[]")
    pairs = (p.partition("=") for p in given.split(", ") if "=" in p)
    return {k: v for k, _, v in pairs if k not in ("path", "serialization.format")}


def bucket_bytes(spark: SparkSession, table: str) -> DataFrame:
    """Files and bytes per bucket of a bucketed table, from its file names."""
    _, path = table_location(spark, table)
    number = F.regexp_extract("name", r"_(\d+)(?:\..*)?$", 1).try_cast("int")
    files = list_files(spark, path, glob="part-*").withColumn("bucket", number)
    return files.groupBy("bucket").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


def largest_bucket(spark: SparkSession, table: str) -> int:
    return bucket_bytes(spark, table).agg(F.max("bytes").alias("bytes")).first()["bytes"] or 0


def in_partitions_of(table: DataFrame, source: DataFrame, by: Sequence[str]) -> Column:
    """Condition on the partition columns of a table that holds in the partitions some row of ``source`` belongs to.

    The partition values are collected (no more than the table has folders, and few of them in an incremental load), so
    that the scan prunes to them; a join would read the whole table first.
    """
    typed = source.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in by]).distinct()
    place = F.to_json(F.struct(*by))  # leaves nulls out, so a null partition compares too
    return place.isin([r["place"] for r in typed.select(place.alias("place")).collect()])
