"""Merges on immutable files: every merge returns the new state of the target as a DataFrame.

Target keys are unique and sources are reduced to one row per key before the join, so no key can multiply or pile up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.parsing import json_record
from tallyloom.operators.ordering import latest_per_key
from tallyloom.session import checkpointed, scratch_path
from tallyloom.sources import folders, key_index
from tallyloom.sources.tables import in_partitions_of
from tallyloom.sources.writers import write_partitioned


def _moment(now: object) -> Column:
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")


def _on(keys: Sequence[str]) -> Column:
    condition = F.col(f"t.{keys[0]}") == F.col(f"s.{keys[0]}")
    for key in keys[1:]:
        condition = condition & (F.col(f"t.{key}") == F.col(f"s.{key}"))
    return condition


def merge_update(target: DataFrame, source: DataFrame, keys: Sequence[str], sets: Mapping[str, str | Column]) -> DataFrame:
    """Target rows, with columns of matched rows set from the source (``sets``: target column to source column).

    The source must hold one row per key. Unmatched rows stay as they are; nothing is inserted.
    """
    keys = list(keys)
    values = [(F.col(v) if isinstance(v, str) else v).alias(f"new_{c}") for c, v in sets.items()]
    slim = source.select(*keys, *values, F.lit(True).alias("matched"))
    joined = target.alias("t").join(slim.alias("s"), _on(keys), "left")
    matched = F.col("s.matched").isNotNull()
    return joined.select(
        *[
            (F.when(matched, F.col(f"s.new_{c}").cast(target.schema[c].dataType)).otherwise(F.col(f"t.{c}")) if c in sets else F.col(f"t.{c}")).alias(c)
            for c in target.columns
        ]
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    ts: str = "timestamp",
    tiebreak: Sequence[str] | None = None,
    now: object = None,
    created: str = "created_at",
    updated: str = "updated_at",
) -> DataFrame:
    """Insert new keys and update known ones whose source row is strictly newer; stamp both.

    The newest source row per key counts, ties going to the greatest ``tiebreak`` (the other source columns by
    default). A missing time on either side never updates.
    """
    keys = list(keys)
    values = [c for c in source.columns if c not in keys]
    newest = latest_per_key(source, keys, ts, tiebreak or [c for c in values if c != ts] or [ts])
    joined = target.alias("t").join(newest.withColumn("present", F.lit(True)).alias("s"), _on(keys), "full_outer")
    inserted = F.col(f"t.{keys[0]}").isNull() & F.col("s.present").isNotNull()
    taken = inserted | F.coalesce(F.col(f"s.{ts}") > F.col(f"t.{ts}"), F.lit(False))
    moment = _moment(now)

    def column(name: str) -> Column:
        kept = F.col(f"t.{name}")
        if name in keys:
            return F.when(inserted, F.col(f"s.{name}")).otherwise(kept)
        if name == created:
            return F.when(inserted, moment.cast(target.schema[name].dataType)).otherwise(kept)
        if name == updated:
            return F.when(taken, moment.cast(target.schema[name].dataType)).otherwise(kept)
        return F.when(taken, F.col(f"s.{name}")).otherwise(kept) if name in values else kept

    return joined.select(*[column(c).alias(c) for c in target.columns])


def upsert_partitions(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], by: Sequence[str], ts: str = "timestamp", **options: object
) -> None:
    """:func:`upsert` into a Parquet table partitioned by ``by``, rewriting only the partitions the source touches.

    A key must stay in its partition: one that the table holds in a partition that is not touched is refused, as it would be
    there twice. Where it may lie is asked of the table's key index (``sources.key_index``), which is built by the first
    merge and brought up to date with the folders written since, so only suspected folders are read. Columns that older files
    lack are kept. The new state is written beside the table first, since a folder cannot be overwritten while it is read;
    the touched folders are then replaced.
    """
    target, scratch = read_evolved(spark, path), scratch_path(spark, "upsert")
    touched = in_partitions_of(target, source, by)
    key_index.refresh(spark, path, keys, by)
    wanted = source.select(*[F.col(k).cast(target.schema[k].dataType).alias(k) for k in keys]).distinct()
    wanted = checkpointed(spark, wanted, "upsert", f"{scratch}/keys")
    moved = key_index.rows_elsewhere(spark, path, wanted, keys, by, touched)
    if moved is not None and not moved.isEmpty():
        folders.delete(spark, scratch)
        raise ValueError("a key of the source lies in another partition of the table")
    affected = target.filter(touched)
    merged = checkpointed(spark, upsert(affected, source, keys, ts, **options), "upsert", f"{scratch}/rows")
    write_partitioned(merged, path, by)
    folders.delete(spark, scratch)


def flatten_cdc(df: DataFrame, row_schema: T.StructType | str, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Change envelopes (JSON text or bytes with before, after, op, ts_ms) as flat rows.

    The key comes from the after image, or from the before image where a delete has no after image.
    """
    fields = T.StructType.fromDDL(row_schema) if isinstance(row_schema, str) else row_schema
    envelope = T.StructType.fromDDL("op string, ts_ms bigint").add("before", fields).add("after", fields)
    parsed = df.withColumn("change", json_record(value, envelope))
    names = [f.name for f in fields.fields]
    return parsed.select(
        *[
            (F.coalesce(f"change.after.{n}", f"change.before.{n}") if n in keys else F.col(f"change.after.{n}")).alias(n)
            for n in names
        ],
        F.col("change.op").alias("operation"),
        F.timestamp_millis("change.ts_ms").alias("changed_at"),
    )


def latest_changes(changes: DataFrame, keys: Sequence[str], ts: str = "changed_at", tiebreak: Sequence[str] = ()) -> DataFrame:
    """The last change per key. At equal times a delete wins over an update, and an update over a create."""
    strength = F.when(F.col("operation") == "d", 3).when(F.col("operation") == "u", 2).otherwise(1)
    ranked = changes.withColumn("strength", strength)
    others = [c for c in changes.columns if c not in {*keys, ts, "operation", *tiebreak}]
    return latest_per_key(ranked, list(keys), ts, [*tiebreak, "strength", *others]).drop("strength")


OPERATIONS = ("c", "u", "d", "r")


def usable_change(keys: Sequence[str]) -> Column:
    """Whether a flat change has its key and an operation: create, update, delete, or read (a snapshot's create)."""
    return reduce(and_, [F.col(k).isNotNull() for k in keys], F.coalesce(F.col("operation").isin(*OPERATIONS), F.lit(False)))


def rejected_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Flat changes that :func:`apply_cdc` cannot apply, broken envelopes among them, for a dead-letter output."""
    return changes.filter(~usable_change(list(keys)))


def apply_cdc(target: DataFrame, changes: DataFrame, keys: Sequence[str], ts: str = "changed_at", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Target after a batch of flat changes: the last change per key decides; applying a batch twice changes nothing.

    A create or update sets the row, a delete removes it. A delete of an unknown key does nothing. Changes without a full
    key or a known operation are not applied; :func:`rejected_changes` returns them.
    """
    keys = list(keys)
    last = latest_changes(changes.filter(usable_change(keys)), keys, ts, tiebreak).withColumn("_change", F.lit(True))
    joined = target.alias("t").join(last.alias("s"), _on(keys), "full_outer")
    changed = F.col("s._change").isNotNull()
    kept = joined.filter(~changed | (F.col("s.operation") != "d"))
    values = set(changes.columns)
    return kept.select(
        *[
            (F.when(changed, F.col(f"s.{c}").cast(target.schema[c].dataType)).otherwise(F.col(f"t.{c}")) if c in values else F.col(f"t.{c}")).alias(c)
            for c in target.columns
        ]
    )


def evolve(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The DataFrame with missing columns added as nulls of the given types."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns})


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files written under growing schemas, read with all columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Overwrite a Parquet folder with rows that may have been read from it: write beside, then switch."""
    staged = f"{path.rstrip('/')}.staged"
    df.write.mode("overwrite").parquet(staged)
    folders.switch(spark, staged, path)
