"""Hard negatives of anchors by a secondary sort: keys of (anchor, descending score, id), read as a stream.

All rows are scored against the anchors in blocks; only what can still matter leaves a task: its best rows of each anchor's
label, then, once the positives are known, its best rows of each positive's window. Those travel under packed binary keys
whose bytes sort as anchor, descending score, positives before negatives, id; hash partitions of the anchor are sorted by
Spark (``repartition`` and ``sortWithinPartitions``, the DataFrame form of ``repartitionAndSortWithinPartitions``), and an
iterator opens a window per positive and emits negatives into the windows open, holding nothing else of an anchor.

Anchors are sent to the tasks in chunks of about :data:`CHUNK` and at most :data:`MAX_VALUES` components, each chunk a scan of
the rows, so no task and no broadcast grows with the number of anchors.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import Scratch

CHUNK, MAX_VALUES = 16_384, 4 << 20
#: Rows scored at once, and scores held at once.
BLOCK_ROWS, MAX_SCORES = 8192, 1 << 21
SIGN = 1 << 63
#: Anchor id and row, descending score, kind (0 positive, 1 negative), id, row.
KEY = np.dtype([("anchor", ">u8"), ("anchor_row", ">u8"), ("down", ">u8"), ("kind", "u1"), ("id", ">u8"), ("row", ">u8")])
ANCHOR_BYTES = 16


class Windows(NamedTuple):
    """How many positives and negatives, and the shares of a positive's score, in percent, between which negatives lie."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


def usable(df: DataFrame, scale: int, vec_id: str, embedding: str, label: str, is_anchor: Column) -> DataFrame:
    """Rows with an id, a label and a vector of finite components, these as ``floor(scale * x)``, under a number of their own."""
    vector = F.col(embedding).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = df.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(embedding).isNotNull() & finite)
    ints = F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return kept.select(
        F.col(vec_id).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(label).cast("long").alias("label"),
        ints.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )


def matrix(column) -> np.ndarray:
    """A list column as a matrix; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())  # offsets and flatten() follow a slice
    out = np.zeros((len(column), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def largest(m: np.ndarray) -> float:
    return float(np.abs(m.astype(np.float64)).max(initial=0))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products, by floating point where every sum is a whole number it can hold."""
    wide = min(a.shape[1], b.shape[1])
    a, b = a[:, :wide], b[:, :wide]
    bound = wide * largest(a) * largest(b)
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def top(score: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (first axis, last axis) of the ``k`` highest fitting scores of each row of a matrix; ties go to the left."""
    n = score.shape[1]
    if score.size and max(abs(int(score.min())), abs(int(score.max()))) >= (1 << 61) // n:
        score = np.unique(score, return_inverse=True)[1].reshape(score.shape)
    order = np.where(fits, score * n + (n - 1 - np.arange(n)), -SIGN)
    if n > k:
        best = np.argpartition(order, n - k, axis=1)[:, n - k :]
        order = np.take_along_axis(order, best, 1)
    else:
        best = np.broadcast_to(np.arange(n), order.shape)
    rows, cols = np.nonzero(order != -SIGN)
    return rows, best[rows, cols]


def packed(anchor, anchor_row, score, kind: int, ids, rows) -> np.ndarray:
    out = np.zeros(len(score), KEY)
    out["anchor"], out["anchor_row"] = anchor.astype(np.uint64) ^ np.uint64(SIGN), anchor_row
    out["down"] = ~(score.astype(np.uint64) ^ np.uint64(SIGN))
    out["kind"], out["id"], out["row"] = kind, ids.astype(np.uint64) ^ np.uint64(SIGN), rows
    return out


class Anchors(NamedTuple):
    """A chunk of anchors and, in the second pass, the scores of their positives (``-1`` where there is none)."""

    ids: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    positives: np.ndarray | None = None


def block_keys(at: Anchors, ids, rows, labels, vectors, windows: Windows) -> np.ndarray:
    """Keys of what one block holds for the anchors: positives, or negatives within any positive's window."""
    order = np.lexsort((rows, ids))
    ids, rows, labels, vectors = ids[order], rows[order], labels[order], vectors[order]
    score, same = products(at.vectors, vectors), at.labels[:, None] == labels[None, :]
    if at.positives is None:
        a, r = top(score, same & (at.rows[:, None] != rows[None, :]), windows.positives)
        return packed(at.ids[a], at.rows[a], score[a, r], 0, ids[r], rows[r])
    found = []
    for j in range(at.positives.shape[1]):
        p = at.positives[:, j]
        # score * 100 within [low * p, high * p] by whole numbers
        inside = (score >= -(-windows.low * p // 100)[:, None]) & (score <= (windows.high * p // 100)[:, None]) & (p >= 0)[:, None]
        found.append(np.stack(top(score, inside & ~same, windows.negatives), 1))
    a, r = np.unique(np.concatenate(found), axis=0).T
    return packed(at.ids[a], at.rows[a], score[a, r], 1, ids[r], rows[r])


def merged(keys: list[np.ndarray], at: Anchors, windows: Windows) -> np.ndarray:
    """Of the keys of several blocks, those that are still among the best: the same choice as within a block."""
    raw = np.frombuffer(b"".join(k.tobytes() for k in keys), f"V{KEY.itemsize}")
    best = np.sort(raw).view(KEY)
    positives = None
    if at.positives is not None:
        positives = {(int(i), int(r)): p for i, r, p in zip(at.ids, at.rows, at.positives, strict=True)}
    return best[list(windowed(best, positives, windows))]


def windowed(keys: np.ndarray, positives: dict | None, windows: Windows) -> Iterator[int]:
    """Places of sorted keys that a stream over them could still use."""
    anchor, open_ = None, []
    score = (~keys["down"].astype(np.uint64) ^ np.uint64(SIGN)).view(np.int64).tolist()
    ids = (keys["anchor"].astype(np.uint64) ^ np.uint64(SIGN)).view(np.int64).tolist()
    for i, (s, key) in enumerate(zip(score, zip(ids, keys["anchor_row"].tolist(), strict=True), strict=True)):
        if key != anchor:
            anchor = key
            open_ = [[windows.positives, None]] if positives is None else [[windows.negatives, int(p)] for p in positives[key] if p >= 0]
        use = False
        for window in open_:
            if window[0] > 0 and (window[1] is None or windows.low * window[1] <= 100 * s <= windows.high * window[1]):
                window[0] -= 1
                use = True
        if use:
            yield i


def scored(rows: DataFrame, anchors: Anchors, windows: Windows, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``key`` of each pair of an anchor and a row that is among the best of its task."""
    sent = rows.sparkSession.sparkContext.broadcast(anchors)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                held.append(batch.slice(at, block_rows))
                if sum(b.num_rows for b in held) >= block_rows:
                    yield pa.Table.from_batches(held)
                    held = []
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = sent.value
        step, kept, waiting = max(1, MAX_SCORES // block_rows), {}, 0
        limit = 200_000 + 2 * len(every.ids) * windows.negatives * windows.positives
        for block in blocks(batches):
            ids, rows, labels = (block.column(c).to_numpy() for c in ("id", "row", "label"))
            vectors = matrix(block.column("v"))
            for a in range(0, len(every.ids), step):
                some = Anchors(*(None if x is None else x[a : a + step] for x in every))
                keys = block_keys(some, ids, rows, labels, vectors, windows)
                kept.setdefault(a, []).append(keys)
                waiting += len(keys)
            if waiting > limit:
                for a in kept:
                    some = Anchors(*(None if x is None else x[a : a + step] for x in every))
                    kept[a] = [merged(kept[a], some, windows)]
                waiting = sum(len(k[0]) for k in kept.values())
        for a in list(kept):
            some = Anchors(*(None if x is None else x[a : a + step] for x in every))
            keys = kept[a][0] if len(kept[a]) == 1 else merged(kept[a], some, windows)
            del kept[a]
            if len(keys):
                data = pa.py_buffer(np.ascontiguousarray(keys).tobytes())
                flat = pa.Array.from_buffers(pa.binary(KEY.itemsize), len(keys), [None, data])
                yield pa.RecordBatch.from_arrays([flat.cast(pa.binary())], ["key"])

    return rows.select("id", "row", "label", "v").mapInArrow(run, "key binary")


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, ...]]:
    """Anchor id, anchor row, score, kind, id and row of each batch of keys."""
    for batch in batches:
        if batch.num_rows:
            keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), KEY)
            signed = [(keys[c].astype(np.uint64) ^ np.uint64(SIGN)).view(np.int64) for c in ("anchor", "id")]
            score = (~keys["down"].astype(np.uint64) ^ np.uint64(SIGN)).view(np.int64)
            yield tuple(x.tolist() for x in (signed[0], keys["anchor_row"], score, keys["kind"], signed[1], keys["row"]))


def sorted_keys(keys: DataFrame) -> DataFrame:
    """Each anchor's keys side by side in one partition, by descending score and id."""
    return keys.repartition(F.substring("key", 1, ANCHOR_BYTES)).sortWithinPartitions("key")


def first_positives(keys: DataFrame, windows: Windows) -> DataFrame:
    """The first keys of each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, n = None, 0
        for batch in batches:
            keep = []
            for i, key in enumerate(batch.column("key").to_pylist()):
                n = n + 1 if key[:ANCHOR_BYTES] == anchor else 1
                anchor = key[:ANCHOR_BYTES]
                if n <= windows.positives:
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64()))

    return sorted_keys(keys).mapInArrow(run, "key binary")


def windows_of(keys: DataFrame, windows: Windows) -> DataFrame:
    """The stream over sorted keys: a positive opens a window, a negative is emitted into each window that it fits."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, open_ = None, []
        for columns in unpacked(batches):
            out = []
            for anchor_id, anchor_row, score, kind, id_, _ in zip(*columns, strict=True):
                if anchor != (anchor_id, anchor_row):
                    anchor, open_ = (anchor_id, anchor_row), []
                if kind == 0:
                    open_.append([id_, score, 0])
                    continue
                for window in open_:
                    if window[2] < windows.negatives and windows.low * window[1] <= 100 * score <= windows.high * window[1]:
                        window[2] += 1
                        out.append((anchor_id, window[0], window[2], id_, window[1], score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return sorted_keys(keys).mapInArrow(run, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def anchors_of(chunk: DataFrame, positives: DataFrame | None, windows: Windows) -> Anchors:
    """The anchors of a chunk (its size is bounded) in the driver, with their positives' scores if those are given."""
    table = chunk.select("id", "row", "label", "v").toArrow()
    ids, rows, labels = (table.column(c).to_numpy() for c in ("id", "row", "label"))
    scores = None
    if positives is not None:
        place = {r: i for i, r in enumerate(rows.tolist())}
        scores, used = np.full((len(rows), windows.positives), -1, np.int64), Counter()
        for _, anchor_rows, score, *_ in unpacked(iter(positives.select("key").toArrow().to_batches())):
            for r, s in zip(anchor_rows, score, strict=True):
                scores[place[r], used[r]] = s
                used[r] += 1
    return Anchors(ids, rows, labels, matrix(table.column("v")), scores)


def hard_negatives(
    df: DataFrame, is_anchor: Column, scratch: Scratch, windows: Windows = Windows(), scale: int = 256, vec_id: str = "vec_id",
    embedding: str = "embedding", label: str = "label", chunk_rows: int = CHUNK, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Ranked negatives of each anchor and positive: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    A score is the inner product of whole components ``floor(scale * x)`` and must fit a long. Higher scores come first, ties by
    id. Positives are the anchor's best other rows of its label; negatives have another label and a score between the windows'
    shares of the positive's, so a positive with a negative score has none. Rows without id, label or vector, or with a null or
    non-finite component, take no part; shorter vectors count as ending in zeros. Repeated rows count each, as anchors, too
    (an equal row is another row). Other columns are not read; an empty table has no result.
    """
    rows = scratch.write(usable(df, scale, vec_id, embedding, label, is_anchor), "rows")
    anchors = rows.filter("is_anchor")
    size = anchors.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(1)).alias("wide")).first()
    chunks = -(-size["n"] // max(1, min(chunk_rows, MAX_VALUES // max(1, size["wide"]))))
    results = []
    for k in range(chunks):
        mine = F.pmod(F.xxhash64("row"), F.lit(chunks)) == k
        chunk = anchors.filter(mine)
        found = scratch.write(first_positives(scored(rows, anchors_of(chunk, None, windows), windows, block_rows), windows), f"positives-{k}")
        negatives = scored(rows, anchors_of(chunk, found, windows), windows, block_rows)
        results.append(scratch.write(windows_of(found.unionByName(negatives), windows), f"negatives-{k}"))
    if not results:
        return df.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
