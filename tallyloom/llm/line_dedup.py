"""Line de-duplication over levelled, sorted runs of line hashes.

Documents come in batches. A batch's line hashes are summed in each task and once over the batch, then merge-joined
against the runs there are: all runs are bucketed and sorted alike, so nothing is shuffled and no run is sorted again.
The batch then becomes a run itself, in which lines no run knew are marked. FANOUT runs of a level are compacted into one
of the next. A key's documents are the sum over the runs.
"""

from __future__ import annotations

import uuid
from functools import reduce

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import LOWER_ASCII, Scratch, arrow_map, fits, text_bytes
from tallyloom.sources.tables import table_location

BATCHES = 4
FANOUT = 4
KEY = ["h1", "h2"]
MAX_BROADCAST_KEYS = 500_000
MAX_PENDING = 300_000


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z lower-cased. ``bytes.strip`` strips the white space of the contract."""
    return line.strip().translate(LOWER_ASCII)


def long_enough(key: bytes, least: int) -> bool:
    """At least ``least`` code points."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def key_hash(key: bytes) -> tuple[int, int]:
    """128 bits as two signed longs."""
    h = xxhash.xxh3_128_intdigest(key)
    lo, hi = h & (1 << 64) - 1, h >> 64
    return hi - (1 << 64) if hi >> 63 else hi, lo - (1 << 64) if lo >> 63 else lo


def line_counts(docs: DataFrame, least: int, batches: int) -> DataFrame:
    """(batch, h1, h2, docs, last_doc) rows, summed within an Arrow batch; a document counts a line once."""

    def run(rows: dict) -> dict:
        found: dict[tuple, list] = {}
        for doc, batch, text in zip(rows["doc_id"], rows["batch"], rows["text"], strict=True):
            for key in {k for k in map(line_key, text.split(b"\n")) if long_enough(k, least)}:
                at = (batch, *key_hash(key))
                old = found.get(at)
                if old is None:
                    found[at] = [1, doc]
                else:
                    old[0] += 1
                    if doc is not None and (old[1] is None or doc > old[1]):
                        old[1] = doc
        keys = list(found)
        return {
            "batch": [k[0] for k in keys], "h1": [k[1] for k in keys], "h2": [k[2] for k in keys],
            "docs": [found[k][0] for k in keys], "last_doc": [found[k][1] for k in keys],
        }

    picked = docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"), text_bytes().alias("text"))
    return arrow_map(picked, run, "batch int, h1 long, h2 long, docs long, last_doc long")


class LineRuns:
    """The levels: bucketed, sorted tables of (h1, h2, docs, last_doc, fresh)."""

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _save(self, df: DataFrame, level: int) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).format("parquet").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> str:
        """Merge-anti-join a batch of (h1, h2, docs, last_doc), one row per key, with all runs and add it as a run."""
        batch = batch.repartition(self.buckets, *KEY)
        known = batch
        for run in self.runs():
            mark = run.select(*KEY, F.lit(True).alias("_known"))
            known = known.join(mark.hint("merge"), KEY, "left")
            old = F.coalesce(F.col("_known"), F.lit(False))
            known = known.withColumn("known", old | F.col("known") if "known" in known.columns else old).drop("_known")
        fresh = ~F.col("known") if "known" in known.columns else F.lit(True)
        name = self._save(known.select(*KEY, "docs", "last_doc", fresh.alias("fresh")), 0)
        level = 0
        while len(self.levels[level]) >= FANOUT:
            self.compact(level)
            level += 1
        return name

    def compact(self, level: int) -> None:
        """Merge the runs of a level into one run of the next."""
        names, self.levels[level] = self.levels[level], []
        self._save(self.totals(names).repartition(self.buckets, *KEY), level + 1)
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def totals(self, names: list[str] | None = None) -> DataFrame:
        """One row per key over the named runs (all by default)."""
        names = names if names is not None else [name for level in self.levels for name in level]
        # Read as plain files: this Spark takes a union of bucketed columnar scans for co-located, but does not zip it.
        runs = [self.spark.read.schema(self.spark.table(n).schema).parquet(table_location(self.spark, n)[1]) for n in names]
        if len(runs) == 1:
            return runs[0]
        union = reduce(DataFrame.unionByName, runs)
        return union.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("last_doc").alias("last_doc"), F.max("fresh").alias("fresh"))

    def drop(self) -> None:
        for level in self.levels:
            for name in level:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = []


def frequent_lines(docs: DataFrame, scratch: Scratch, least: int = 40, min_docs: int = 5, batches: int = BATCHES) -> DataFrame:
    """(h1, h2, last_doc) of the line keys of at least ``least`` code points in at least ``min_docs`` documents."""
    counts = line_counts(docs, least, batches).groupBy("batch", *KEY)
    counts = scratch.write(counts.agg(F.sum("docs").alias("docs"), F.max("last_doc").alias("last_doc")), "counts")
    runs = LineRuns(docs.sparkSession)
    for b in range(batches):
        runs.add(counts.filter(F.col("batch") == b).drop("batch"))
    found = scratch.write(runs.totals().filter(F.col("docs") >= min_docs).select(*KEY, "last_doc"), "frequent")
    runs.drop()
    return found


def dedup_lines(docs: DataFrame, scratch: Scratch, least: int = 40, min_docs: int = 5, passed: list[str] | None = None) -> DataFrame:
    """The ``passed`` columns (doc_id), n_lines, n_dropped and the text left (``kept_text``) of every document.

    Lines whose key occurs in enough documents go, but for those of the largest id that holds it. A null or empty text
    is one empty line. Equal ids count as documents of their own and are cleaned alike; a null id is smaller than any.
    An empty table gives no rows. Columns other than doc_id, text and ``passed`` are not read.
    """
    passed = passed or ["doc_id"]
    found = frequent_lines(docs, scratch, least, min_docs)
    rows = docs.select(*passed, F.col("doc_id").alias("_id"), text_bytes().alias("_text"))
    if fits(found, MAX_BROADCAST_KEYS):
        shared = docs.sparkSession.sparkContext.broadcast({(r.h1, r.h2): r.last_doc for r in found.toLocalIterator()})
    else:
        # Beyond the broadcast's bound each document gets its own frequent keys, at most its lines, by a join.
        shared = None
        own = long_lines(rows, least).join(found, KEY).groupBy("_own_id")
        own = own.agg(F.collect_set(F.struct(*KEY, "last_doc")).alias("_keys"))
        rows = rows.join(own, F.col("_id").eqNullSafe(F.col("_own_id")), "left").drop("_own_id")

    def run(cols: dict) -> dict:
        out: dict = {"n_lines": [], "n_dropped": [], "kept_text": []}
        for i, (doc, text) in enumerate(zip(cols["_id"], cols["_text"], strict=True)):
            last = shared.value if shared is not None else {(k["h1"], k["h2"]): k["last_doc"] for k in cols["_keys"][i] or ()}
            lines, left = text.split(b"\n"), []
            for line in lines:
                key = line_key(line)
                at = key_hash(key) if long_enough(key, least) else None
                if at not in last or last[at] == doc:
                    left.append(line)
            out["n_lines"].append(len(lines))
            out["n_dropped"].append(len(lines) - len(left))
            out["kept_text"].append(b"\n".join(left).decode("utf-8", "replace"))
        return out

    return arrow_map(rows, run, "n_lines long, n_dropped long, kept_text string", passed)


def long_lines(rows: DataFrame, least: int) -> DataFrame:
    """(_own_id, h1, h2) of the long lines of each row."""

    def run(cols: dict) -> dict:
        out: dict = {"_own_id": [], "h1": [], "h2": []}
        for doc, text in zip(cols["_id"], cols["_text"], strict=True):
            for key in {k for k in map(line_key, text.split(b"\n")) if long_enough(k, least)}:
                for name, value in zip(out, (doc, *key_hash(key)), strict=True):
                    out[name].append(value)
        return out

    return arrow_map(rows.select("_id", "_text"), run, "_own_id long, h1 long, h2 long")


def clean(docs: DataFrame, least: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents without their repeated lines; ``n_chars`` (if there) is counted anew, null texts stay null, and
    other columns are untouched, whatever their names."""
    scratch = Scratch(docs.sparkSession, "line-dedup")
    rest = F.struct(*[c for c in docs.columns if c != "text"], F.col("text").isNull().alias("_no_text"))
    done = dedup_lines(docs.select("doc_id", "text", rest.alias("_row")), scratch, least, min_docs, ["_row"])
    new = {"text": F.when(~F.col("_row._no_text"), F.col("kept_text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return done.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])
