"""Kafka as source and sink. The connector package is not part of Spark's own jars; only the options and the record
layout are covered by tests here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS_PER_TRIGGER = 10_000


def kafka_options(servers: str, topic: str, starting: str = "latest", max_records: int | None = RECORDS_PER_TRIGGER) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_records is not None:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest", max_records: int | None = RECORDS_PER_TRIGGER) -> DataFrame:
    """A topic as a stream of key, value and timestamp."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting, max_records)).load()
    return stream.select("key", "value", "timestamp")


def as_messages(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as key text and JSON value text, the layout a topic takes."""
    chosen = list(columns) if columns is not None else df.columns
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*chosen)).alias("value"))


def to_kafka(stream: DataFrame, servers: str, topic: str, checkpoint: str, key: str):
    """Publish a stream; returns the running query."""
    return (
        as_messages(stream, key)
        .writeStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint})
        .start()
    )
