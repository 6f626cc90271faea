"""Comparing datasets and recombining them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.joins import plan_bytes


def combine(dfs: Sequence[DataFrame]) -> DataFrame:
    """All rows, columns matched by name; a column some inputs lack is null there."""
    rows = [df.select(*df.columns) for df in dfs]  # plain rows, also from typed sources such as spark.range
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def row_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side holds more often than the other: the side, and by how many copies.

    One exchange: rows of both sides are counted with opposite signs, pre-summed in each task.
    """
    columns = a.columns
    signed = a.withColumn("copies", F.lit(1)).unionByName(b.select(*columns).withColumn("copies", F.lit(-1)))
    counted = signed.groupBy(*columns).agg(F.sum("copies").alias("copies")).filter(F.col("copies") != 0)
    return counted.withColumns(
        {"side": F.when(F.col("copies") > 0, "left").otherwise("right"), "copies": F.abs("copies")}
    )


def _null_safe_equal(names: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])


def reconcile(a: DataFrame, b: DataFrame, group: str, measure: str) -> DataFrame:
    """Rows and sum of a measure per group on both sides, and whether they agree; a group may be missing on one side."""

    def totals(df: DataFrame) -> DataFrame:
        return df.groupBy(group).agg(F.count(F.lit(1)).alias("cnt"), F.sum(measure).alias("total"))

    joined = totals(a).alias("a").join(totals(b).alias("b"), _null_safe_equal([group], "a", "b"), "full_outer")
    return joined.select(
        F.coalesce(f"a.{group}", f"b.{group}").alias(group),
        F.coalesce("a.cnt", F.lit(0)).alias("left_count"),
        F.coalesce("b.cnt", F.lit(0)).alias("right_count"),
        F.col("a.total").alias("left_total"),
        F.col("b.total").alias("right_total"),
        (F.col("a.cnt").eqNullSafe(F.col("b.cnt")) & F.col("a.total").eqNullSafe(F.col("b.total"))).alias("matches"),
    )


def count_match(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row counts of two datasets and whether they are equal."""
    sides = a.select(F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(b.select(F.lit(0).alias("l"), F.lit(1).alias("r")))
    counts = sides.agg(F.sum("l").alias("left_count"), F.sum("r").alias("right_count"))
    return counts.withColumn("matches", F.col("left_count") == F.col("right_count"))


def schema_equal(a: DataFrame, b: DataFrame) -> bool:
    """Same column names and types in the same order; nullability is ignored."""
    return [(f.name, f.dataType) for f in a.schema.fields] == [(f.name, f.dataType) for f in b.schema.fields]


def _tall(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    rows = [F.struct(F.lit(n).alias("item"), F.col(f"`{n}`").cast("long").alias("value")) for n in names]
    return counts.select(F.inline(F.array(*rows)))


def _profile(df: DataFrame) -> DataFrame:
    """Row count and null count per column, as item/value rows from one scan."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls:{c}") for c in df.columns]
    return _tall(df.agg(F.count(F.lit(1)).alias("rows"), *nulls), ["rows", *[f"nulls:{c}" for c in df.columns]])


DIGEST_BUCKETS = 1024
DIGEST_FROM = 1 << 30  # bytes of the larger side


def _bucket(keys: Sequence[str], level: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(level), *keys), F.lit(DIGEST_BUCKETS)).cast("int")


def _digests(df: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Row count and two order-free sums of row hashes per bucket; fixed-width, so each task pre-sums all its rows."""
    row = F.xxhash64(*values)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"), F.sum(F.pmod(row, F.lit(1 << 31))).alias("s"))


def _unlike(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Buckets whose digests are not the same on both sides, those on one side only among them."""
    sides = _digests(a, by, a.columns).unionByName(_digests(b, by, a.columns))
    return sides.groupBy(*by, "n", "x", "s").agg(F.count(F.lit(1)).alias("sides")).filter(F.col("sides") == 1).select(*by).distinct()


def differing_rows(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """The rows of both sides that lie in key buckets with different digests, and the rest of ``a``; None if no bucket differs.

    Two levels: of 1024 buckets by key hash those that differ, and of each of these 1024 finer ones, so that few changed keys
    leave some millionth of the rows each. Equal digests mean equal rows but for a chance of about 2^-64 a bucket. At most
    1024 x 1024 bucket numbers are broadcast. Columns that only one side has are left out.
    """
    shared = [c for c in a.columns if c in b.columns]
    first, second = "_bucket", "_bucket_2"
    left, right = (df.select(*shared).withColumns({first: _bucket(keys, 0), second: _bucket(keys, 1)}) for df in (a, b))
    numbers = [r[first] for r in _unlike(left, right, [first]).collect()]
    if not numbers:
        return None
    inside = F.col(first).isin(numbers)
    unlike = F.broadcast(_unlike(left.filter(inside), right.filter(inside), [first, second]))
    pick = lambda df, how: df.join(unlike, [first, second], how).drop(first, second)
    return pick(left.filter(inside), "left_semi"), pick(right.filter(inside), "left_semi"), pick(left, "left_anti")


def compare(a: DataFrame, b: DataFrame, keys: str | Sequence[str] = (), tolerance: float = 1e-6, digests: bool | None = None) -> DataFrame:
    """Comparison report as rows (item, left_value, right_value, matches).

    Items: ``schema_equal``, ``rows``, ``nulls:<column>`` and, with keys, ``keys_only_here``, ``duplicate_keys`` and
    ``different:<column>`` for keys that both sides hold once. Floating-point columns may differ by ``tolerance``.
    Each side is reduced to one row per key before the join, so repeated keys never multiply.

    With ``digests``, only rows of key buckets whose digests differ are joined (:func:`differing_rows`): equal tables
    compare without a join of rows, and repeated keys of equal buckets are counted on one side. By default that is done from
    ``DIGEST_FROM`` bytes on, as smaller tables are compared sooner by the join itself; the report is the same.
    """
    same_schema = schema_equal(a, b)
    spark = a.sparkSession
    schema_row = spark.range(1).select(
        F.lit("schema_equal").alias("item"),
        F.lit(len(a.columns)).cast("long").alias("left_value"),
        F.lit(len(b.columns)).cast("long").alias("right_value"),
        F.lit(same_schema).alias("matches"),
    )
    left, right = _profile(a).withColumnRenamed("value", "left_value"), _profile(b).withColumnRenamed("value", "right_value")
    profile = left.join(right, "item", "full_outer").withColumn("matches", F.col("left_value").eqNullSafe(F.col("right_value")))
    report = schema_row.unionByName(profile)
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys:
        return report
    shared = [c for c in a.columns if c in b.columns and c not in keys]
    if digests is None:
        digests = max(plan_bytes(a) or 0, plan_bytes(b) or 0) >= DIGEST_FROM
    if any("map<" in df.schema[c].dataType.simpleString() for df in (a, b) for c in [*keys, *shared]):
        digests = False  # maps have no hash
    repeated = None
    if digests:
        parts = differing_rows(a, b, keys)
        a, b, alike = parts if parts is not None else (a.limit(0), b.limit(0), a)
        repeated = alike.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("value"))

    def per_key(df: DataFrame) -> DataFrame:
        rest = F.struct(*shared) if shared else F.struct(F.lit(1).alias("present"))
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.any_value(rest).alias("row"))

    joined = per_key(a).alias("a").join(per_key(b).alias("b"), _null_safe_equal(keys, "a", "b"), "full_outer")
    both_once = (F.col("a.n") == 1) & (F.col("b.n") == 1)

    def differs(name: str) -> Column:
        x, y = F.col(f"a.row.{name}"), F.col(f"b.row.{name}")
        kind = a.schema[name].dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            close = F.coalesce(F.abs(x - y) <= tolerance, F.lit(False))
            return ~(x.eqNullSafe(y) | close)
        return ~x.eqNullSafe(y)

    counts = joined.agg(
        F.count_if(F.col("b.n").isNull()).alias("left_only"),
        F.count_if(F.col("a.n").isNull()).alias("right_only"),
        F.count_if(F.col("a.n") > 1).alias("left_dup"),
        F.count_if(F.col("b.n") > 1).alias("right_dup"),
        *[F.count_if(both_once & differs(c)).alias(f"different:{c}") for c in shared],
    )

    def line(item: str, x: Column, y: Column) -> Column:
        return F.struct(F.lit(item).alias("item"), x.alias("left_value"), y.alias("right_value"), ((x == 0) & (y == 0)).alias("matches"))

    rows = [
        line("keys_only_here", F.col("left_only"), F.col("right_only")),
        line("duplicate_keys", F.col("left_dup"), F.col("right_dup")),
        *[line(f"different:{c}", F.col(f"`different:{c}`"), F.col(f"`different:{c}`")) for c in shared],
    ]
    found = counts.select(F.inline(F.array(*rows)))
    if repeated is not None:
        more = repeated.select(F.lit("duplicate_keys").alias("item"), F.col("value").alias("left_value"), F.col("value").alias("right_value"), (F.col("value") == 0).alias("matches"))
        found = found.unionByName(more).groupBy("item").agg(*[F.sum(c).alias(c) for c in ("left_value", "right_value")], F.bool_and("matches").alias("matches"))
    return report.unionByName(found)
