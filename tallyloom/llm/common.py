"""What several corpus operators share: scratch tables, Arrow batches, words."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import scratch_path

#: White space of the word contracts: a run of anything else is a word.
SPACE = r"[\x20\x09-\x0D]"
LOWER_ASCII = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Rows of one Arrow batch handed to Python; whole texts are long, so batches stay small.
BATCH_ROWS = 512


class Scratch:
    """Intermediate tables below the shared folder, deleted together once nothing reads them any more."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, scratch_path(spark, label)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and read it back, so that its rows are fixed and outlive any executor."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def finish(self, df: DataFrame) -> DataFrame:
        """Write a small final table beside the intermediate ones, and delete those."""
        done = Scratch(self.spark, "result").write(df, "rows")
        self.drop()
        return done

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers: at most :data:`BATCH_ROWS` whole texts at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def text_bytes(name: str = "text") -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def crc_of_id(name: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def lowered_words(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased. ``bytes.split`` parts at exactly the white space of :data:`SPACE`."""
    return text.translate(LOWER_ASCII).split()


_holders: list = []


def hold(memory) -> None:
    """Let one operator at a time remember things in a Python worker, which outlives the stages that run in it.

    ``memory`` is that operator's own (anything with ``clear``); what another one has left behind is cleared.
    """
    if not _holders or _holders[0] is not memory:
        for other in _holders:
            other.clear()
        _holders[:] = [memory]


class WordHashes:
    """64-bit hashes of words, remembered up to a bound of words so that memory stays flat on any input."""

    BOUND = 100_000

    def __init__(self):
        self.seen: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        hold(self.seen)
        if len(self.seen) > self.BOUND:
            self.seen.clear()
        out = np.fromiter(map(self.seen.get, words, repeat(0)), np.uint64, len(words))
        for i in np.nonzero(out == 0)[0].tolist():
            out[i] = self.seen[words[i]] = xxhash.xxh64_intdigest(words[i]) or 1
        return out


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def arrow_map(df: DataFrame, make, schema: str, passed: list[str] | None = None) -> DataFrame:
    """``make(dict of Python lists) -> dict of columns`` over small Arrow batches.

    Columns named in ``passed`` go through as they are, row by row, before the new ones.
    """
    small_batches(df.sparkSession)
    passed = list(passed or [])
    made = df.sparkSession.createDataFrame([], schema).schema
    target = T.StructType([df.schema[c] for c in passed] + made.fields)
    names = made.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(made)
        for batch in batches:
            if batch.num_rows:
                out = make({c: batch.column(c).to_pylist() for c in batch.schema.names if c not in passed})
                arrays = [batch.column(c) for c in passed] + [pa.array(out[n], arrow.field(n).type) for n in names]
                yield pa.RecordBatch.from_arrays(arrays, passed + names)

    return df.mapInArrow(run, target)


def fits(df: DataFrame, rows: int) -> bool:
    """Whether a written table has at most ``rows`` rows, the proven bound of a broadcast."""
    return df.count() <= rows


def share_file(spark: SparkSession, label: str, data: bytes) -> str:
    """Give every executor a local copy of a file of bounded size, to be opened at ``SparkFiles.get(returned name)``.

    The file is kept in the shared folder; an executor that starts later fetches it as well.
    """
    path = scratch_path(spark, label)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    for at in range(0, len(data), 1 << 20):
        out.write(bytearray(data[at : at + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]
