"""Near duplicates by HyperMinHash registers, banding, and verification on full shingle sets.

A document's shingles are hashed once; the hash's first bits choose one of BUCKETS registers, which keeps the smallest
remainder as its number of leading zeros and MANTISSA bits after them. Documents of the same shingle set are one class.
Bands of compressed registers make candidates: every class of a band is held against the band's smallest member, its
leader. Two classes that share a band share its leader, so what is then still apart under a leader is compared in blocks
of bounded size, by registers alone. The estimate from the registers, corrected for
accidental collisions, drops clear misses by a margin of MARGIN standard errors; every other candidate is decided on the
full sets. Links become components by repeated large-star and small-star steps.

An empty register is a value of its own, so that sets of few shingles, which differ in few registers, still share bands.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import Scratch, WordHashes, arrow_map, fits, lowered_words, mixed, text_bytes

SHINGLE = 5
BUCKETS = 512
MANTISSA = 10
#: Bands are made of PARTS wider registers, each the first of BUCKETS / PARTS neighbours that is not empty.
PARTS = 128
ROWS_PER_BAND = 4
BANDS = PARTS // ROWS_PER_BAND
MARGIN = 5.0
LEAST_MARGIN = 0.02
BLOCK = 500
PAIRS_AT_ONCE = 20_000
MAX_BROADCAST_IDS = 500_000

_hashes = WordHashes()
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; fewer words are one shingle, no words none."""
    words = lowered_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = _hashes(words)
    if len(h) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    n = len(h) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total += mixed(h[k : k + n] + _MULTIPLIERS[k]) * _MULTIPLIERS[k]
    return np.unique(mixed(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The compressed registers of a sorted hash array: 0 where empty, else (leading zeros, mantissa) in 16 bits."""
    out = np.zeros(BUCKETS, np.uint16)
    if not len(hashes):
        return out
    bits = np.uint64(64 - (BUCKETS.bit_length() - 1))
    bucket = (hashes >> bits).astype(np.int64)
    first = np.nonzero(np.diff(bucket, prepend=-1))[0]  # sorted: the first of a bucket is its least
    rest = (hashes[first] << (np.uint64(64) - bits)) | np.uint64(1)
    exponent = np.frexp(rest.astype(np.float64))[1]  # may round up to the next power; equal sets round alike
    zeros = (64 - np.minimum(exponent, 64)).astype(np.uint64)
    tail = (rest << zeros) << np.uint64(1)
    out[bucket[first]] = ((np.minimum(zeros, np.uint64(62)) + np.uint64(1)) << np.uint64(MANTISSA) | tail >> np.uint64(64 - MANTISSA)).astype(np.uint16)
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimates, registers used) of rows of registers; accidental agreement of compressed values is taken off.

    Two unequal minima agree in their compressed form about once in 2^MANTISSA times the chance of equal leading zeros
    (at most a half), so agreement c of m used registers estimates (c - e) / (m - e) with e = m / 2^(MANTISSA + 1).
    """
    used = ((a != 0) | (b != 0)).sum(-1)
    same = ((a == b) & (a != 0)).sum(-1)
    off = used / 2.0 ** (MANTISSA + 1)
    return np.where(used > 0, (same - off) / np.maximum(used - off, 1e-9), 0.0), used


def may_link(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the estimate leaves ``similarity`` possible, within MARGIN standard errors; ``sizes``: both sets' added up.

    The used registers are a sample of the union without replacement, which narrows the error of small sets.
    """
    j, used = estimate(a, b)
    union = np.maximum(sizes / (1 + similarity), 2)
    rest = np.clip((union - used) / (union - 1), 0, 1)
    error = np.sqrt(similarity * (1 - similarity) / np.maximum(used, 1) * rest)
    return j >= similarity - np.maximum(MARGIN * error, LEAST_MARGIN)


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_id, registers): set_id is a 128-bit digest of the shingle set, null when empty."""

    def run(rows: dict) -> dict:
        out = defaultdict(list)
        for text in rows["text"]:
            s = shingles(text)
            out["n_shingles"].append(len(s))
            out["set_id"].append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            out["registers"].append(registers(s).tobytes() if len(s) else None)
        return out

    return arrow_map(docs.select("doc_id", text_bytes().alias("text")), run, "n_shingles long, set_id binary, registers binary", ["doc_id"])


def bands(classes: DataFrame) -> DataFrame:
    """(band, node) of every class: a 64-bit value of the band's number and its registers; empty bands are left out."""

    def run(rows: dict) -> dict:
        regs = np.frombuffer(b"".join(rows["registers"]), np.uint16).reshape(len(rows["node"]), PARTS, BUCKETS // PARTS)
        first = (regs != 0).argmax(2)
        wide = np.take_along_axis(regs, first[:, :, None], 2)[:, :, 0].astype(np.uint64)
        wide |= np.where(wide > 0, first, 0).astype(np.uint64) << np.uint64(16)
        wide = wide.reshape(-1, BANDS, ROWS_PER_BAND)
        key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(wide), 0)
        for k in range(ROWS_PER_BAND):
            key = mixed(key * _MULTIPLIERS[1] + wide[:, :, k])
        at = wide.any(2)
        nodes = np.repeat(np.array(rows["node"], np.int64)[:, None], BANDS, 1)
        return {"band": key[at].view(np.int64), "node": nodes[at]}

    return arrow_map(classes.select("node", "registers"), run, "band long, node long")


def likely(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose registers leave the similarity possible."""
    regs = classes.select("node", "registers", "n_shingles")
    joined = pairs.join(regs.withColumnsRenamed({"node": "a", "registers": "ra", "n_shingles": "na"}), "a")
    joined = joined.join(regs.withColumnsRenamed({"node": "b", "registers": "rb", "n_shingles": "nb"}), "b")

    def run(rows: dict) -> dict:
        a, b = (np.frombuffer(b"".join(rows[c]), np.uint16).reshape(-1, BUCKETS) for c in ("ra", "rb"))
        sizes = np.array(rows["na"], np.int64) + np.array(rows["nb"], np.int64)
        at = np.nonzero(may_link(a, b, sizes, similarity))[0]
        return {"a": np.array(rows["a"], np.int64)[at], "b": np.array(rows["b"], np.int64)[at]}

    return arrow_map(joined, run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) of ids whose full shingle sets meet 100 * intersection >= percent * union.

    Only documents that occur in a pair have their sets computed; a hot document's pairs are split by adaptive execution.
    """
    pairs = scratch.write(pairs, f"{name}-pairs")
    ids = scratch.write(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), f"{name}-ids")
    wanted = F.broadcast(ids) if fits(ids, MAX_BROADCAST_IDS) else ids
    texts = docs.join(wanted, docs.doc_id == ids.node, "left_semi").select("doc_id", text_bytes().alias("text"))

    def run(rows: dict) -> dict:
        return {"shingles": [shingles(t).view(np.int64) for t in rows["text"]]}

    sets = arrow_map(texts, run, "shingles array<long>", ["doc_id"]).dropDuplicates(["doc_id"])
    sets = scratch.write(sets, f"{name}-sets")
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("c", common)
    links = both.filter(100 * F.col("c") >= percent * (F.size("sa") + F.size("sb") - F.col("c"))).select("a", "b")
    return scratch.write(links, f"{name}-links")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of every node of undirected links (a, b); the component is its smallest node.

    Large-star and small-star steps with minima only, no neighbour lists; each round is written before the next.
    """
    edges = scratch.write(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), f"{name}-0")
    state, step = None, 0
    while True:
        step += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.withColumnRenamed("m", "b")).filter("a > b").distinct()
        edges = scratch.write(small, f"{name}-{step}")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")


def apart(stars: DataFrame, classes: DataFrame, comps: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """Pairs of classes under one leader that are in different components so far and may be linked.

    ``stars`` holds (leader, member) rows (a, b). Members are dealt into blocks of about BLOCK; each pair of blocks is
    compared in one task by registers, and only pairs that may be linked leave it.
    """
    named = stars.join(comps, stars.b == comps.node, "left").select("a", "b", F.coalesce("component", "b").alias("component"))
    per = named.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    open_ = scratch.write(per.filter("lo < hi").select("a", F.ceil(F.col("n") / BLOCK).cast("int").alias("k")), "open-leaders")
    members = named.join(open_, "a").withColumn("own", F.pmod(F.xxhash64("b"), F.col("k")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    regs = classes.select(F.col("node").alias("b"), "registers", "n_shingles")
    members = members.join(regs, "b").select(
        "a", F.col("b").alias("node"), "component", "registers", "n_shingles", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        regs = np.frombuffer(b"".join(pdf.registers), np.uint16).reshape(-1, BUCKETS)
        node, comp, own, size = (pdf[c].to_numpy() for c in ("node", "component", "own", "n_shingles"))
        i, j = pdf.i.iloc[0], pdf.j.iloc[0]
        if i == j:
            x, y = np.triu_indices(len(node), 1)
        else:
            left, right = np.nonzero(own == i)[0], np.nonzero(own == j)[0]
            x, y = np.repeat(left, len(right)), np.tile(right, len(left))
        differ = comp[x] != comp[y]
        x, y = x[differ], y[differ]
        keep = [np.zeros(0, bool)]
        for at in range(0, len(x), PAIRS_AT_ONCE):
            p, q = x[at : at + PAIRS_AT_ONCE], y[at : at + PAIRS_AT_ONCE]
            keep.append(may_link(regs[p], regs[q], size[p] + size[q], similarity))
        keep = np.concatenate(keep)
        p, q = node[x[keep]], node[y[keep]]
        return pd.DataFrame({"a": np.minimum(p, q), "b": np.maximum(p, q)})

    return members.groupBy("a", "i", "j").applyInPandas(one, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets. Null and empty texts have no
    shingles and are linked with nothing; a null id is a class of its own unless its set is another's; rows that repeat
    an id and text are alike. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    similarity = percent / 100
    rows = scratch.write(sketch(docs), "sketches")
    classes = rows.filter("set_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("members"), F.first("registers").alias("registers"), F.first("n_shingles").alias("n_shingles")
    )
    classes = scratch.write(classes, "classes")
    nodes = classes.filter("node is not null").select("node", "registers", "n_shingles")
    band_rows = bands(nodes)
    leaders = band_rows.groupBy("band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    stars = band_rows.join(leaders, "band").filter("node > leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    stars = scratch.write(stars.distinct(), "stars")
    links = verified(likely(stars, nodes, similarity), docs, percent, scratch, "near-leader")
    comps = scratch.write(components(links, scratch, "cc1"), "components1")
    rest = apart(stars, nodes, comps, scratch, similarity)
    more = verified(rest, docs, percent, scratch, "rest")
    joined = links.unionByName(more)
    comps = scratch.write(components(joined, scratch, "cc2"), "components2")
    named = classes.join(comps, "node", "left").select("set_id", "node", "members", F.coalesce("component", "node").alias("component"))
    many = scratch.write(named.filter("members > 1 or component <> node").select("set_id", "component"), "named")
    # Documents alone in class and component need no join; for the others the names travel when they are few.
    many = F.broadcast(many) if fits(many, MAX_BROADCAST_IDS) else many
    out = rows.join(many, "set_id", "left")
    component = F.coalesce("component", "doc_id")
    result = out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
    return scratch.finish(result)


def one_of_each(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row of each group of near duplicates, all columns untouched: that of the least id, null ids last.

    Rows are told apart by a key of their own, so that repeated rows of one id leave one, an id of two texts is two
    documents, and rows without an id are judged by their texts. Texts without shingles all stay.
    """
    scratch = Scratch(docs.sparkSession, "one-of-each")
    key = "_row"
    while key in {c.lower() for c in docs.columns}:
        key += "_"
    rows = scratch.write(docs.withColumn(key, F.monotonically_increasing_id()), "rows")  # written: the keys are fixed
    named = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), percent).filter(~F.col("kept"))
    members = named.select(F.col("doc_id").alias("_key"), "component_id")
    members = members.unionByName(members.select(F.col("component_id").alias("_key"), "component_id").distinct())
    members = scratch.write(members, "members")
    few = F.broadcast(members) if fits(members, MAX_BROADCAST_IDS) else members
    ids = rows.select(F.col(key).alias("_key"), "doc_id").join(few, "_key")
    keepers = ids.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")).alias("least"))
    gone = members.join(keepers.select(F.col("least._key").alias("_key")), "_key", "left_anti").select("_key")
    gone = scratch.write(gone, "gone")
    gone = (F.broadcast(gone) if fits(gone, MAX_BROADCAST_IDS) else gone).withColumnRenamed("_key", key)
    return rows.join(gone, key, "left_anti").drop(key)
