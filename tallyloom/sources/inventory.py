"""Files as data: listings, usage, checksums."""

from __future__ import annotations

import _hashlib
import ctypes
import functools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import scratch_path
from tallyloom.sources import folders

#: Larger files are hashed in steps of so many bytes, held as pieces of at most so many.
WHOLE_BYTES, STEP_BYTES, PIECE_BYTES = 256 * 1024**2, 128 * 1024**2, 1024**2
_BOM = b"\xef\xbb\xbf"
_COMPRESSED = re.compile(r"\.(gz|bz2|deflate|lz4|snappy|zst|zstd|lzo|xz)$")  # Spark would read their content unpacked


def list_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Path, folder, name, size and modification time of files; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path",
        F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("bytes"),
        "modificationTime",
    )


def dir_usage(files: DataFrame) -> DataFrame:
    """Files and bytes per folder."""
    return files.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


@functools.cache
def _crypto() -> ctypes.CDLL | None:
    """The library behind hashlib; None where it does not offer a SHA-256 whose state can be kept between tasks."""
    library = ctypes.CDLL(_hashlib.__file__)
    return library if all(hasattr(library, f"SHA256_{f}") for f in ("Init", "Update", "Final")) else None


def _sha256(state: bytes | None, data: Iterable[bytes], last: bool = False) -> bytes:
    """The state after more bytes, or the digest; the state is the C structure of 112 bytes."""
    context = ctypes.create_string_buffer(state or b"", 128)
    if state is None:
        _crypto().SHA256_Init(context)
    for piece in data:
        _crypto().SHA256_Update(context, piece, ctypes.c_size_t(len(piece)))
    if not last:
        return context.raw
    digest = ctypes.create_string_buffer(32)
    _crypto().SHA256_Final(digest, context)
    return digest.raw


def _stepwise(spark: SparkSession, large: list[Row]) -> DataFrame:
    """Checksums of large files. Their bytes are staged in pieces by all tasks, then each step takes the next of them of every file;
    only the states of the hashes pass from step to step. SHA-256 goes through a file in order, so the steps follow its size."""
    limit = PIECE_BYTES

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines of a block put together again, each after the line feed before it, as numbered pieces."""

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": [here[0]], "block": [here[1]], "piece": [number], "data": [b"".join(held)]})

        here, number, held, size = None, 0, [], 0
        for batch in batches:
            for file, block, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, block) != here:
                    if held:
                        yield out()
                    here, number, size = (file, block), 0, 0
                    held = [] if block else [b""]
                    first = not block
                elif size >= limit:
                    yield out()
                    number, held, size = number + 1, [], 0
                held.append(line if first else b"\n" + line)
                size += len(held[-1])
                first = False
        if held:
            yield out()

    scratch = scratch_path(spark, "checksums")
    paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", r["path"]) for r in large]
    lines = spark.read.option("lineSep", "\n").text(paths).select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary"))
    staged = lines.mapInArrow(pieces, "file string, block long, piece long, data binary").withColumn("step", F.floor(F.col("block") / STEP_BYTES))
    staged.write.partitionBy("step").parquet(f"{scratch}/pieces")
    rows = spark.read.parquet(f"{scratch}/pieces")
    found = {r["file"]: r["n"] for r in rows.groupBy("file").agg(F.sum(F.length("data")).alias("n")).collect()}
    # What reading by lines leaves out: a byte order mark before the first and a line feed after the last.
    missing = {r["file"]: r["bytes"] - found.get(r["file"], 0) for r in large}
    if not set(missing.values()) <= {0, 1, 3, 4}:
        raise OSError(f"files changed while they were read: {sorted(f for f, n in missing.items() if n not in (0, 1, 3, 4))}")
    states = {f: _sha256(None, [_BOM] if n > 1 else []) for f, n in missing.items()}
    for step in sorted(int(n.partition("=")[2]) for n in folders.subfolders(spark, f"{scratch}/pieces")):
        before = dict(states)

        def go_on(group: pa.Table) -> pa.Table:
            group = group.sort_by([("block", "ascending"), ("piece", "ascending")])
            file = group.column("file")[0].as_py()
            return pa.table({"file": [file], "state": [_sha256(before[file], (d.as_py() for d in group.column("data")))]})

        now = rows.filter(F.col("step") == step).drop("step").groupBy("file").applyInArrow(go_on, "file string, state binary")
        states |= {r["file"]: bytes(r["state"]) for r in now.collect()}
    folders.delete(spark, scratch)
    done = [(r["path"], r["bytes"], _sha256(states[r["file"]], [b"\n"] if missing[r["file"]] in (1, 4) else [], True).hex()) for r in large]
    return spark.createDataFrame(done, "path string, bytes long, sha256 string")


def file_checksums(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """SHA-256 of each file's content. A file of at most WHOLE_BYTES passes through memory whole; larger ones go in steps."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    listed = files.filter(F.col("length") > WHOLE_BYTES).select("path", F.col("length").alias("bytes"), F.col("_metadata.file_path").alias("file"))
    listed = [] if _crypto() is None else listed.collect()  # few, as each is large
    large = [r for r in listed if not _COMPRESSED.search(r["path"])]
    whole = files
    if large:  # the test of the length is pushed down: no content of larger files is read
        whole = files.filter(F.col("length") <= WHOLE_BYTES)
        if len(large) < len(listed):
            others = files.filter(F.col("length") > WHOLE_BYTES).filter(F.col("path").rlike(_COMPRESSED.pattern))
            whole = whole.unionByName(others)
    whole = whole.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return whole.unionByName(_stepwise(spark, large)) if large else whole
