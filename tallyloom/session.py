"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
FALLBACK_KEY = "tallyloom.scratch.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: partition counts, join strategy and hot-partition splitting follow real shuffle sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Streaming state on executors' disks instead of their heaps, checkpointed as changes to the shared folder.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "tallyloom", master: str | None = None, **settings: object) -> SparkSession:
    """A session with the library's settings; keyword names use ``__`` for the dots of a setting's key."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a fresh temporary folder, remembered in the session.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    fallback = spark.conf.get(FALLBACK_KEY, None)
    if fallback is None:
        fallback = tempfile.mkdtemp(prefix="tallyloom-")
        spark.conf.set(FALLBACK_KEY, fallback)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(spark: SparkSession, df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder (or to ``path``) and read it back, so that later steps do not recompute it.

    The written table outlives any executor, and each row is fixed: nothing drawn at run time (such as sampled range
    bounds) can come out differently on a retry. Whoever gives a path may delete it after the last use.
    """
    path = path or scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
