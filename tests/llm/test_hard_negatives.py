import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import hard_negatives, queries
from tallyloom.llm.common import Scratch
from tallyloom.llm.hard_negatives import Windows

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, is_anchor, windows=Windows()):
    used = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if None not in (i, v, lab) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, v, lab) in enumerate(used):
        if not is_anchor(i):
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, other) for k, (j, w, other) in enumerate(used) if k != at)
        for s, j, _ in [x for x in scores if x[2] == lab][: windows.positives]:
            fit = [(t, n) for t, n, other in scores if other != lab and windows.low * -s <= 100 * -t <= windows.high * -s]
            out += [(i, j, r, n, -s, -t) for r, (t, n) in enumerate(fit[: windows.negatives], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def values(df):
    return [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]


def test_query_against_brute_force(spark):
    rows = [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in values(queries.table(spark, "/root/testdata/sf0.001", "embeddings"))]
    expected = brute(rows, lambda i: i % 100 == 0)
    assert expected and found(queries.op12_hard_negatives(spark, "/root/testdata/sf0.001")) == expected


@pytest.fixture(scope="module")
def vectors(spark):
    """Ties, repeated rows, zero and opposite vectors, a hot label, unusable rows, unequal lengths, large components."""
    rnd = random.Random(3)
    rows = [(i, [rnd.choice((-0.5, 0.0, 0.25, 1.0)) for _ in range(6)], 0 if i % 3 == 0 else rnd.randrange(4)) for i in range(-20, 400)]
    rows += [(500, [0.0] * 6, 1), (600, [-1.0] * 6, 2), (610, [1.0] * 3, 2), (620, [], 3), (630, [1e6] * 6, 1), (631, [0.9e6] * 6, 2), (632, [0.5e6] * 6, 1)]
    rows += [(700, None, 1), (710, [None, 1.0], 1), (720, [float("nan")] * 6, 1), (730, [float("inf")] * 6, 1), (740, [1.0] * 6, None), (None, [1.0] * 6, 1)]
    rows += [rows[30], rows[30], (800, [1.0] * 6, 9)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit(1), "id": F.lit(2), "v": F.lit(3), "key": F.lit("k"), "is_anchor": F.lit(None)})


@pytest.mark.parametrize("chunk_rows, block_rows", [(hard_negatives.CHUNK, hard_negatives.BLOCK_ROWS), (7, 16)])
def test_odd_rows_in_one_chunk_and_in_many(spark, vectors, chunk_rows, block_rows):
    vectors = vectors.coalesce(1)
    done = hard_negatives.hard_negatives(vectors, F.col("vec_id") % 10 == 0, Scratch(spark, "t"), chunk_rows=chunk_rows, block_rows=block_rows)
    assert found(done) == brute(values(vectors), lambda i: i % 10 == 0)


def test_no_rows_and_no_anchors(spark, vectors, nothing):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(hard_negatives.hard_negatives(empty, F.col("vec_id") % 10 == 0, Scratch(spark, "t"))) == []
    assert found(hard_negatives.hard_negatives(vectors, F.lit(None).cast("boolean"), Scratch(spark, "t"))) == []


def test_best_of_blocks_are_the_best_of_all():
    rng = np.random.default_rng(5)
    at = hard_negatives.Anchors(np.arange(4), np.arange(4), np.arange(4) % 2, rng.integers(-9, 9, (4, 5)), rng.integers(-1, 90, (4, 5)))
    ids, labels, vectors = np.arange(90), rng.integers(0, 3, 90), rng.integers(-9, 9, (90, 5))
    for anchors in (at, at._replace(positives=None)):
        split = [hard_negatives.block_keys(anchors, ids[p], ids[p] + 100, labels[p], vectors[p], Windows()) for p in (slice(0, 31), slice(31, 90))]
        whole = hard_negatives.block_keys(anchors, ids, ids + 100, labels, vectors, Windows())
        assert hard_negatives.merged(split, anchors, Windows()).tolist() == hard_negatives.merged([whole], anchors, Windows()).tolist()
        assert len(whole) == len(hard_negatives.merged([whole], anchors, Windows()))


def test_scores_too_large_to_pack_with_a_place_are_ranked():
    score = np.array([[1 << 61, -(1 << 61), 1 << 61, 5]])
    rows, cols = hard_negatives.top(score, np.ones(score.shape, bool), 2)
    assert sorted(cols.tolist()) == [0, 2] and rows.tolist() == [0, 0]
