"""A key index beside a partitioned Parquet table: per folder its key range and Bloom filters of its keys.

It answers in which folders a few keys may lie without reading the table. The filters are bitmaps that Spark's own aggregate
builds, in blocks whose number follows the folder's rows, and lie below ``_keys``, where readers of the table see nothing. Each
entry carries a digest of its folder's file names, so a folder written by whatever means is noticed and indexed again.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import checkpointed, scratch_path
from tallyloom.sources import folders
from tallyloom.sources.writers import write_partitioned

BLOCK_BITS = 32_768  # bits of one bitmap of ``bitmap_construct_agg``
HASHES = 8
BITS_PER_KEY = 3  # in each of the bitmaps; some 4 of 100,000 keys are suspected wrongly in a folder
_RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType)


def _folder(by: Sequence[str]) -> Column:
    """The partition folder of a row's file, encoded as in file names."""
    parts = F.split(F.col("_metadata.file_path"), "/")
    return F.array_join(F.slice(parts, -1 - len(by), len(by)), "/")


def _listing(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """Folders that hold files, with a digest of the names of their files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    named = files.select(_folder(by).alias("folder"), F.col("_metadata.file_name").alias("name"))
    return named.groupBy("folder").agg(F.sha2(F.array_join(F.sort_array(F.collect_set("name")), "/"), 256).alias("files"))


def _of_folders(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    return spark.read.option("basePath", path).option("mergeSchema", True).parquet(*[f"{path}/{unquote(n)}" for n in names])


def _block(keys: Sequence[Column]) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(-1)), F.col("blocks"))


def _bit(keys: Sequence[Column], i: int) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(i)), F.lit(BLOCK_BITS))


def refresh(spark: SparkSession, path: str, keys: Sequence[str], by: Sequence[str]) -> list[str]:
    """Index the folders that are new or whose files have changed, reading the keys of those only; returns them."""
    index, scratch = f"{path}/_keys", scratch_path(spark, "key-index")
    current = checkpointed(spark, _listing(spark, path, by), "listing", f"{scratch}/listing")  # before the rows are read
    known = spark.read.parquet(index).select("folder", "files") if folders.subfolders(spark, index) else current.limit(0)
    stale = [r["folder"] for r in current.join(known, ["folder", "files"], "left_anti").select("folder").collect()]
    if stale:
        rows = _of_folders(spark, path, stale).select(*keys, _folder(by).alias("folder"))
        values = [F.col(k) for k in keys]
        ranged = isinstance(rows.schema[keys[0]].dataType, _RANGED)
        least, greatest = (F.min(keys[0]), F.max(keys[0])) if ranged else (F.lit(None), F.lit(None))
        kind = rows.schema[keys[0]].dataType if ranged else "string"
        blocks = F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / BLOCK_BITS)
        measured = rows.groupBy("folder").agg(blocks.alias("blocks"), least.cast(kind).alias("low"), greatest.cast(kind).alias("high"))
        facts = checkpointed(spark, measured.join(current, "folder"), "facts", f"{scratch}/facts")  # one row per folder
        blocked = rows.join(facts.select("folder", "blocks"), "folder").groupBy("folder", _block(values).alias("block"))
        filters = blocked.agg(*[F.bitmap_construct_agg(_bit(values, i)).alias(f"bits_{i}") for i in range(HASHES)])
        write_partitioned(filters.join(facts, "folder"), index, ["folder"])
    folders.delete(spark, scratch)
    return stale


def suspected(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], by: Sequence[str], most: int = 100_000) -> list[str]:
    """Folders in which some key of ``source`` may lie; to be asked after :func:`refresh`, with keys of the table's types.

    More than ``most`` keys would be suspected everywhere by chance, so those are judged by the key ranges alone. Otherwise each
    key is looked up in the filters of the folders in whose range it lies.
    """
    index = spark.read.parquet(f"{path}/_keys")
    facts = index.groupBy("folder", "files").agg(F.first("blocks").alias("blocks"), F.first("low").alias("low"), F.first("high").alias("high"))
    facts = facts.join(_listing(spark, path, by), ["folder", "files"], "left_semi")
    lead = F.col(keys[0])
    count, lo, hi = source.agg(F.count(F.lit(1)), F.min(lead), F.max(lead)).first()
    facts = facts.filter(F.col("low").isNull() | ((F.col("low") <= F.lit(hi)) & (F.col("high") >= F.lit(lo))))
    described = F.struct("folder", "blocks", "low", "high")
    kind = facts.select(described.alias("f")).schema["f"].dataType
    near = [r["f"] for r in facts.select(F.to_json(described).alias("f")).collect()]  # one row per folder
    names = [r["folder"] for r in spark.createDataFrame([(f,) for f in near], "f string").select(F.get_json_object("f", "$.folder").alias("folder")).collect()] if near else []
    if count > most or not near:
        return names
    listed = F.from_json(F.lit("[" + ",".join(near) + "]"), T.ArrayType(kind))
    within = F.filter(listed, lambda f: f["low"].isNull() | lead.between(f["low"], f["high"]))
    values = [F.col(k) for k in keys]
    probes = source.select(*keys, F.inline(within)).select("folder", _block(values).alias("block"), *[_bit(values, i).alias(f"bit_{i}") for i in range(HASHES)])
    hits = probes.join(index.filter(F.col("folder").isin(names)).select("folder", "block", *[f"bits_{i}" for i in range(HASHES)]), ["folder", "block"])
    for i in range(HASHES):
        byte = F.conv(F.hex(F.expr(f"substring(bits_{i}, cast(bit_{i} div 8 as int) + 1, 1)")), 16, 10).cast("int")
        hits = hits.filter(F.getbit(byte, (F.col(f"bit_{i}") % 8).cast("int")) == 1)
    return [r["folder"] for r in hits.select("folder").distinct().collect()]


def rows_elsewhere(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], by: Sequence[str], touched: Column) -> DataFrame | None:
    """Rows of the table with a key of ``source`` outside the ``touched`` partitions, read from suspected folders only.

    None if no folder is suspected.
    """
    keys = list(keys)
    names = suspected(spark, path, source, keys, by)
    if not names:
        return None
    return _of_folders(spark, path, names).filter(~touched).join(source, keys, "left_semi")
