"""Stream sinks. File sinks commit each batch once; those that run a function per batch write under the batch's own
name, so a batch that is run again after a failure replaces its first try. A sink's path belongs to one checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tallyloom.operators.ordering import bundle, latest_per_key
from tallyloom.operators.quality import threshold_alert
from tallyloom.operators.snapshots import expire_snapshots, history, latest_version, write_snapshot
from tallyloom.sources import folders


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A batch per interval such as ``30 seconds``; without one, all that is there now and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query that stops by itself; raises if it failed."""
    query.awaitTermination()
    return query


def await_any(spark: SparkSession) -> None:
    """Wait until one of the running queries ends; raises if it failed, whichever it is."""
    spark.streams.awaitAnyTermination()


def to_console(stream: DataFrame, mode: str = "update", every: str | None = "30 seconds", checkpoint: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).format("console").option("truncate", False)
    return _triggered(writer.option("checkpointLocation", checkpoint) if checkpoint else writer, every).start()


def to_memory(stream: DataFrame, name: str, mode: str = "update", every: str | None = None) -> StreamingQuery:
    """A small result as an in-memory table of the driver, for looking at while developing."""
    return _triggered(stream.writeStream.outputMode(mode).format("memory").queryName(name), every).start()


def to_table(stream: DataFrame, path: str, checkpoint: str, by: Sequence[str] = (), every: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Append to a folder of files, partitioned by ``by``; exactly once across restarts from the same checkpoint."""
    writer = stream.writeStream.outputMode("append").format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return _triggered(writer.partitionBy(*by), every).start()


def per_batch(stream: DataFrame, handle, checkpoint: str, mode: str, every: str | None) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` per batch; after a failure the last batch may come again under its number."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handle)
    return _triggered(writer, every).start()


def _applied(spark: SparkSession, path: str, label: str) -> bool:
    """Whether a batch is already among the versions of a table."""
    if latest_version(spark, path) is None:
        return False
    return not history(spark, path).filter(F.col("operation") == label).isEmpty()


def to_snapshot(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None, keep: int | None = None, hours: float = 1
) -> StreamingQuery:
    """The full result after each batch as a new version (``operators.snapshots``), for complete-mode aggregates.

    With ``keep``, versions beyond the newest so many are dropped after each batch once they are ``hours`` old, except those
    that a reader holds (``snapshots.held``).
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        label = f"batch {batch_id} of {checkpoint}"
        if not _applied(batch.sparkSession, path, label):
            write_snapshot(batch, path, label)
        if keep is not None:
            expire_snapshots(batch.sparkSession, path, hours, keep=keep)

    return per_batch(stream, handle, checkpoint, "complete", every)


def to_updates(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """The rows each batch changed, one folder per batch; :func:`read_updates` gives the current state."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return per_batch(stream, handle, checkpoint, "update", every)


def read_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row per key among all batches of an update sink."""
    rows = spark.read.option("basePath", path).parquet(path)
    return latest_per_key(rows, list(keys), "batch_id", "batch_id").drop("batch_id")


def alert_stream(
    stream: DataFrame, path: str, checkpoint: str, metric: Column, limit: float, name: str, by: tuple[str, ...] = (), every: str | None = None
) -> StreamingQuery:
    """Alert rows for batches (or groups in a batch) whose aggregate exceeds the limit, one folder per batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        threshold_alert(batch, metric, limit, name, by).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return per_batch(stream, handle, checkpoint, "append", every)


def bundle_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str,
    by: Sequence[str],
    order: Sequence[str],
    size: str = "1 minute",
    max_records: int = 1000,
    every: str | None = "1 minute",
    late: str = "1 minute",
    shards: int = 64,
) -> StreamingQuery:
    """Records gathered per event-time window and ``by`` into arrays of at most ``max_records``.

    A window is bundled once, when the watermark (``late`` behind the newest time seen) has passed its end, so the bundles
    do not depend on how the records fell into batches; later records are dropped. Open windows wait in the state, each
    in ``shards`` rows, so that a hot one is no single task's work.
    """
    timed = stream.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", late)
    shard = F.pmod(F.xxhash64(*order), F.lit(shards)).alias("shard")
    waiting = timed.groupBy(F.window("event_time", size), *by, shard).agg(F.collect_list(F.struct(*stream.columns)).alias("records"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        closed = batch.select(F.col("window.start").alias("window_start"), F.explode("records").alias("record")).select("window_start", "record.*")
        scratch = f"{checkpoint.rstrip('/')}-scratch/batch_id={batch_id}"
        gathered = bundle(closed, ["window_start", *by], list(order), max_records, scratch)
        gathered.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        folders.delete(batch.sparkSession, scratch)

    return per_batch(waiting, handle, checkpoint, "append", every)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a sink that writes one folder per batch."""
    return spark.read.option("basePath", path).parquet(path)


def progress_row(query: StreamingQuery) -> DataFrame:
    """One row on a query's health; null figures before its first batch is done."""
    progress = query.lastProgress or {}
    spark = SparkSession.active()
    durations = progress.get("durationMs") or {}
    operators = [str(o.get("operatorName")) for o in progress.get("stateOperators") or []]
    row = (
        query.isActive,
        progress.get("batchId"),
        progress.get("numInputRows"),
        progress.get("inputRowsPerSecond"),
        progress.get("processedRowsPerSecond"),
        durations.get("triggerExecution"),
        operators,
    )
    return spark.createDataFrame(
        [row],
        "is_active boolean, batch_id long, input_rows long, input_rows_per_second double, "
        "processed_rows_per_second double, batch_duration_ms long, state_operators array<string>",
    )

