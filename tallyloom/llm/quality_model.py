"""A quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features are hashed unigrams and bigrams of the words (A-Z lower-cased) and of the words' shapes, weighted by the logarithm
of their counts and brought to length one. The model is trained row after row on a bounded sample of labelled rows, in
SHARDS tasks whose weights are averaged; with few labels each further task weakens the mean, so there is one. It is a
sparse vector of at most DIM entries, and a score is a sparse dot product.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import LOWER_ASCII, arrow_map, crc_of_id, hold, mixed, small_batches, text_bytes

DIM = 1 << 18
SHARDS = 1
EPOCHS = 3
#: Bound of the training sample, in labelled rows (about; rows are picked by a hash of their id).
MAX_TRAINING = 20_000
MAX_REMEMBERED = 200_000
SHAPES = bytes(
    ord("a") if 97 <= c <= 122 or c >= 128 else ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57 else c for c in range(256)
)
_runs = re.compile(rb"(.)\1+", re.S)
_place: dict[bytes, int] = {}
_hashes_at = np.zeros((2, MAX_REMEMBERED), np.uint64)


def _hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of their shapes, remembered up to a bound of words."""
    hold(_place)
    at = np.fromiter(map(_place.get, words, repeat(-1)), np.int64, len(words))
    new = np.nonzero(at < 0)[0].tolist()
    if len(_place) + len(new) > MAX_REMEMBERED:
        _place.clear()
        if len(words) > MAX_REMEMBERED:  # one text with more words than are remembered
            pairs = [_hash(w) for w in words]
            return np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.uint64)
        return _hashes(words)
    for i in new:
        w = words[i]
        if w not in _place:
            _hashes_at[:, len(_place)] = _hash(w)
            _place[w] = len(_place)
        at[i] = _place[w]
    return _hashes_at[0, at], _hashes_at[1, at]


def _hash(w: bytes) -> tuple[int, int]:
    return xxhash.xxh64_intdigest(w.translate(LOWER_ASCII), 1), xxhash.xxh64_intdigest(_runs.sub(rb"\1", w.translate(SHAPES)), 2)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of a text; index 0 is the bias and the only feature of an empty text."""
    words = text.split()
    if not words:
        return np.zeros(1, np.int64), np.ones(1)
    parts = []
    for h in _hashes(words):
        parts.append(h)
        parts.append(mixed(h[:-1] * np.uint64(3) + h[1:]))
    index = (np.concatenate(parts) % np.uint64(DIM - 1)).astype(np.int64) + 1
    index, count = np.unique(index, return_counts=True)
    value = 1 + np.log(count)
    value /= np.sqrt((value * value).sum())
    return np.append(index, 0), np.append(value, 0.2)


class FollowTheLeader:
    """FTRL-proximal logistic regression over DIM hashed features."""

    def __init__(self, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(DIM), np.zeros(DIM)

    def weights(self, index: np.ndarray) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(index)
        g = (sigmoid(float(w @ value)) - label) * value
        n = self.n[index]
        self.z[index] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[index] = n + g * g


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def train(docs: DataFrame, labels: DataFrame, held_out_remainder: int = 2, folds: int = 4, max_rows: int = MAX_TRAINING) -> np.ndarray:
    """The dense weight vector (DIM doubles), from labelled rows outside the held-out fold.

    Each shard of the rows trains a model of its own, wherever its rows lie; the weights are the mean of the models that had
    rows. Of two labels of one id the larger counts; null labels and ids are left out. Without any row all weights are 0.
    """
    spark = docs.sparkSession
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (crc_of_id() % folds != held_out_remainder))
    usable = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_label"))
    share = min(1.0, max_rows / max(1, usable.count()))
    sample = usable.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 62)) < int(share * (1 << 62)))
    rows = docs.join(F.broadcast(sample), docs.doc_id == F.col("_id")).select("_id", "_label", text_bytes().alias("text"))
    rows = rows.withColumn("_shard", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(SHARDS)))

    def run(shard: pa.Table) -> pa.Table:  # at most about MAX_TRAINING / SHARDS rows
        data = []
        for i, label, text in zip(*(shard.column(c).to_pylist() for c in ("_id", "_label", "text")), strict=True):
            data.append((mixed(np.array([i], np.int64).view(np.uint64))[0], int(label > 0), *features(text)))
        # The same order on every attempt, whatever the shuffle brought first.
        data.sort(key=lambda d: (d[0], len(d[2]), d[2].tobytes(), d[3].tobytes()))
        model = FollowTheLeader()
        for _ in range(EPOCHS):
            for _, label, index, value in data:
                model.update(index, value, label)
        w = model.weights(np.arange(DIM))
        at = np.nonzero(w)[0]
        return pa.table({"at": np.append(at, -1), "w": np.append(w[at], 1.0)})  # at -1: that this shard had rows

    small_batches(spark)
    found = rows.groupBy("_shard").applyInArrow(run, "at long, w double").groupBy("at").agg(F.sum("w").alias("w"))
    out, models = np.zeros(DIM), 1.0
    for r in found.toLocalIterator():  # at most DIM + 1 rows
        if r["at"] < 0:
            models = r["w"]
        else:
            out[r["at"]] = r["w"]
    out /= models
    return out


def score(docs: DataFrame, weights: np.ndarray, threshold: float = 0.7) -> DataFrame:
    """doc_id, score and predicted of every document; a null or empty text scores by the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(rows: dict) -> dict:
        w, scores = shared.value, []
        for text in rows["text"]:
            index, value = features(text)
            scores.append(sigmoid(float(w[index] @ value)))
        return {"score": scores, "predicted": [int(s >= threshold) for s in scores]}

    return arrow_map(docs.select("doc_id", text_bytes().alias("text")), run, "score double, predicted int", ["doc_id"])


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, the model trained on the labels outside the held-out fold.

    Repeated rows are scored alike; an empty table gives no rows; only text is an input of a score, and only doc_id and
    quality of ``labels`` are read. A null id belongs to the fold of an empty one.
    """
    scored = score(docs, train(docs.select("doc_id", "text"), labels.select("doc_id", "quality")))
    return scored.select("doc_id", (crc_of_id() % 4 == 2).alias("held_out"), "score", "predicted")
