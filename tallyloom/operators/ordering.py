"""Latest row per key, exact positions in huge groups, bounded bundles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import checkpointed


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], tiebreak: str | Sequence[str]) -> DataFrame:
    """The row with the greatest order (then tiebreak) values per key; null order values lose.

    A maximum, not a ranking: each task keeps one row per key before the exchange, so a hot key costs nothing.
    """
    keys, rank = _names(keys), [*_names(order), *_names(tiebreak)]
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*rank_columns(rank))).alias("row"))
    return picked.select(*keys, "row.*").select(*df.columns)


def rank_columns(names: Sequence[str]) -> list[Column]:
    return [F.col(c).alias(f"rank_{i}") for i, c in enumerate(names)]


RANGE_ROWS = 1_000_000


def with_position(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    out: str = "position",
    scratch: str | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Row number from 1 within each key, in an order that must be unique within the key.

    ``row_number`` alone would sort a whole key in one task. Here rows are split by range of key and order, so a hot
    key spans many tasks, and each range is written with its number. Positions are the rank inside the range plus the
    number of the key's rows in earlier ranges, which is summed over one row per key and range. Ranges hold about
    ``range_rows`` rows however many there are: their number follows a count, where that gives more than the session's
    shuffle partitions, and their bounds a sample that grows with the number of ranges. The written ranges stay in the shared folder, or in ``scratch``, which the caller may delete once the result has been used.
    """
    spark = df.sparkSession
    keys, order = _names(keys), _names(order)
    needed = math.ceil(df.count() / range_rows)
    number = [needed] if needed > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    ranged = df.repartitionByRange(*number, *keys, *order).withColumn("range_no", F.spark_partition_id())
    # A struct is never null, so null keys form a group of their own, and one partitioning serves window and join.
    parts = checkpointed(spark, ranged, "positions", scratch).withColumn("group_key", F.struct(*keys))
    earlier = Window.partitionBy("group_key").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("group_key", "range_no")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("group_key", "range_no", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("group_key", "range_no").orderBy(*order)
    ranked = parts.withColumn("rank", F.row_number().over(inside))
    return ranked.join(offsets, ["group_key", "range_no"]).select(*df.columns, (F.col("rank") + F.col("before")).alias(out))


def bundle(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], max_records: int = 1000, scratch: str | None = None
) -> DataFrame:
    """Records of each key gathered into ordered arrays of at most ``max_records``, numbered from 1 per key.

    For ``scratch`` see :func:`with_position`.
    """
    keys, order = _names(keys), _names(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    placed = with_position(df, keys, order, scratch=scratch)
    bundle_no = F.ceil(F.col("position") / max_records).cast("long")
    gathered = placed.groupBy(*keys, bundle_no.alias("bundle_no")).agg(
        F.array_sort(F.collect_list(F.struct("position", *order, *rest))).alias("records")
    )
    return gathered.withColumn("records", F.transform("records", lambda r: r.dropFields("position")))
