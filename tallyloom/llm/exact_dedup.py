"""Exact duplicates through a cuckoo-filter index of live digests.

Digests are summed per task first (largest id, count), then dealt over shards of bounded size. Each shard holds a cuckoo
filter beside its stored keys: a digest that the filter does not know is new and inserted; a hit is checked against the
stored keys. Digests found more than once are then checked against the contents themselves, grouped by digest and
text, of which one copy per task travels. Entries can be added and deleted; a filter that overflows is rebuilt at twice
the size from the stored keys.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import Scratch, fits

SLOTS = 4
MAX_KICKS = 200
SHARD_DIGESTS = 50_000
MIN_SHARDS = 64
SALTS = 8
MAX_BROADCAST_GROUPS = 200_000


class CuckooFilter:
    """16-bit fingerprints in buckets of four slots, each in one of two buckets; holds live digests (bytes)."""

    def __init__(self, buckets: int = 64):
        self.size = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.buckets = buckets
        self.table = [[] for _ in range(buckets)]

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") % self.buckets
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        return place ^ (mark * 0x5BD1E995 % self.buckets)  # a power of two of buckets: its own inverse

    def __contains__(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        return mark in self.table[a] or mark in self.table[b]

    def insert(self, digest: bytes) -> bool:
        """False on overflow; the filter then has to be rebuilt from the keys."""
        mark, a, b = self._places(digest)
        place = a if len(self.table[a]) <= len(self.table[b]) else b
        for kick in range(MAX_KICKS):
            bucket = self.table[place]
            if len(bucket) < SLOTS:
                bucket.append(mark)
                self.size += 1
                return True
            slot = kick % SLOTS
            mark, bucket[slot] = bucket[slot], mark
            place = self._other(place, mark)
        return False

    def delete(self, digest: bytes) -> None:
        """Remove one copy of the digest's fingerprint; the digest must have been inserted."""
        mark, a, b = self._places(digest)
        (self.table[a] if mark in self.table[a] else self.table[b]).remove(mark)
        self.size -= 1

    def rebuild(self, keys, buckets: int) -> None:
        while True:
            self._clear(buckets)
            self.size = 0
            if all(self.insert(k) for k in keys):
                return
            buckets *= 2


class CuckooIndex:
    """One shard: a cuckoo filter and, per stored digest, the largest id and the number of live rows."""

    def __init__(self, entries: dict[bytes, tuple[int | None, int]] | None = None):
        self.keys = dict(entries or {})
        self.filter = CuckooFilter()
        self.hits = 0
        if self.keys:
            self.filter.rebuild(self.keys, 64)

    def add(self, digest: bytes, keep_id, rows: int) -> None:
        if digest in self.filter:  # perhaps known: the stored keys decide
            self.hits += 1
            known = self.keys.get(digest)
            if known is not None:
                ids = [i for i in (known[0], keep_id) if i is not None]
                self.keys[digest] = (max(ids, default=None), known[1] + rows)
                return
        self.keys[digest] = (keep_id, rows)
        if not self.filter.insert(digest):
            self.filter.rebuild(self.keys, self.filter.buckets * 2)

    def delete(self, digest: bytes, rows: int = 1) -> None:
        """Take away live rows; without any left the digest goes. Unknown digests are ignored."""
        if digest not in self.filter or digest not in self.keys:
            return
        keep_id, live = self.keys[digest]
        if live > rows:
            self.keys[digest] = (keep_id, live - rows)
        else:
            del self.keys[digest]
            self.filter.delete(digest)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def shard_count(rows: int) -> int:
    return max(MIN_SHARDS, -(-rows // SHARD_DIGESTS))


def index(digests: DataFrame, shards: int, before: DataFrame | None = None) -> DataFrame:
    """The index entries (shard, digest, keep_id, group_size) of (digest, doc_id) rows added to those of ``before``.

    ``before`` is an earlier result with the same number of shards. A hot digest reaches its shard as at most SALTS rows
    per task of the summing step.
    """
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")
    summed = digests.groupBy(shard.alias("shard"), "digest", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")).agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    rows = summed.select("shard", "digest", "keep_id", "group_size")
    if before is not None:
        rows = rows.unionByName(before)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        held = CuckooIndex()
        for digest, keep_id, rows_ in zip(pdf.digest, pdf.keep_id.astype(object), pdf.group_size, strict=True):
            held.add(bytes.fromhex(digest), None if pd.isna(keep_id) else int(keep_id), int(rows_))
        return pd.DataFrame(
            {
                "shard": np.int32(pdf["shard"].iloc[0]),
                "digest": [k.hex() for k in held.keys],
                "keep_id": pd.array([v[0] for v in held.keys.values()], "Int64"),
                "group_size": [v[1] for v in held.keys.values()],
            }
        )

    return rows.groupBy("shard").applyInPandas(one, "shard int, digest string, keep_id long, group_size long")


def remove(entries: DataFrame, gone: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """Index entries after rows of ``gone`` (digest, doc_id) have left.

    ``digests`` holds the (digest, doc_id) rows that the entries were made of: the keeper of a touched digest is its largest
    id that is left. Without them only the row counts follow, and ``gone`` needs no ids.
    """
    shards = entries.select("shard", "digest", "keep_id", "group_size")
    counted = gone.groupBy("digest").agg(F.count(F.lit(1)).alias("gone_rows"))
    marked = shards.join(counted, "digest", "left")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        held = CuckooIndex({bytes.fromhex(d): (k, int(n)) for d, k, n in zip(pdf.digest, pdf.keep_id, pdf.group_size, strict=True)})
        for d, n in zip(pdf.digest, pdf.gone_rows, strict=True):
            if pd.notna(n):
                held.delete(bytes.fromhex(d), int(n))
        left = pdf.digest.map(lambda d: bytes.fromhex(d) in held.keys)
        out = pdf[left].copy()
        out["group_size"] = [held.keys[bytes.fromhex(d)][1] for d in out.digest]
        return out[["shard", "digest", "keep_id", "group_size"]]

    left = marked.groupBy("shard").applyInPandas(one, "shard int, digest string, keep_id long, group_size long")
    if digests is None:
        return left
    touched = digests.join(counted.select("digest"), "digest", "left_semi").select("digest", "doc_id", F.lit(1).alias("n"))
    live = touched.unionByName(gone.select("digest", "doc_id", F.lit(-1).alias("n"))).groupBy("digest", "doc_id").agg(F.sum("n").alias("n"))
    keepers = live.filter("n > 0").groupBy("digest").agg(F.max("doc_id").alias("new"), F.lit(True).alias("found"))
    keep = F.when(F.col("found"), F.col("new")).otherwise(F.col("keep_id")).alias("keep_id")
    return left.join(keepers, "digest", "left").select("shard", "digest", keep, "group_size")


def exact_duplicates(docs: DataFrame, digest=sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. Of equal texts the largest id stays; rows that repeat an id
    with its text are all marked kept. Null ids never win over others. Different texts of one digest are told apart by
    their content. An empty table gives no rows; other columns are not read. ``digest`` is a parameter for tests.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select("doc_id", digest(text).alias("digest"), text.alias("text"))
    digests = scratch.write(
        docs.select("doc_id", digest(text).alias("digest"), F.xxhash64(text).alias("body"), F.sha2(text, 256).alias("sha")), "digests"
    )
    entries = scratch.write(index(digests, shard_count(digests.count())), "entries")
    hits = scratch.write(entries.filter("group_size > 1").select("digest"), "hits")
    few = fits(hits, MAX_BROADCAST_GROUPS)
    near = F.broadcast if few else (lambda df: df)
    contents = read.join(near(hits), "digest", "left_semi").groupBy("digest", "text")
    groups = contents.agg(F.max("doc_id").alias("keep"), F.count(F.lit(1)).alias("n"))
    groups = scratch.write(groups.select("digest", F.xxhash64("text").alias("body"), "keep", "n"), "groups")
    joined = digests.join(near(groups), ["digest", "body"], "left")
    alone = F.col("n").isNull()
    rows = joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("sha").alias("text_sha256"),
    )
    return scratch.finish(rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))
