"""Stream sources over files and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.sources.readers import TABLES


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | str,
    max_files: int | None = None,
    glob: str | None = None,
    **options: object,
) -> DataFrame:
    """Files of a folder, those already there and those to come; ``max_files`` limits what one batch takes in."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A Parquet table of a data folder as a stream."""
    return stream_files(spark, sf_dir, "parquet", TABLES[name], max_files, glob=f"{name}.parquet")
