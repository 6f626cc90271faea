"""Variants of spelling: Bloom-guided neighbourhoods of a vocabulary.

Words are counted first. Each word's possible deletions and replacements are generated as hashes only and probed against
broadcast Bloom filters, one shard per word length, each key within one 64-bit block. What a filter lets through is written
out and joined to the vocabulary, which removes false positives: only likely neighbours are shuffled. Insertions are the
deletions of the longer word, so each pair is generated once.

Filters are sent in rounds of at most :data:`MAX_FILTER_BYTES`; a larger vocabulary takes more rounds, not more memory.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import Scratch, arrow_map, mixed, small_batches

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: Letters a word of :data:`RUN` can hold once A-Z are lowered; replacements are drawn from these.
ALPHABET = np.array([*range(97, 123), *range(0xC0, 0x100)], np.uint64)
#: Words of at least so many letters share a shard.
LONGEST = 64
BITS_PER_WORD = 24
MAX_FILTER_BYTES = 32 << 20
#: Distinct words a task counts before it hands them on, and hashes it generates at once.
MAX_COUNTED, MAX_PROBES = 200_000, 1 << 21
BASE = np.uint64(0x9E3779B97F4A7C15)
PART = np.uint64(0xD1B54A32D192ED03)


def spelled(doc_id: str, run: str, damage: int | None) -> str:
    """A lowered run; if ``damage`` divides the CRC of ``id:run``, without the code point at the CRC's remainder."""
    if damage:
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        if h % damage == 0:
            at = h % len(run)
            return run[:at] + run[at + 1 :]
    return run


def count_words(df: DataFrame, min_length: int = 6, damage: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words of at least ``min_length`` code points in whole texts, summed within each task first.

    Null texts hold none; a null id counts as an empty one.
    """
    small_batches(df.sparkSession)
    rows = df.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for i, t in zip(batch.column("i").to_pylist(), batch.column("t").to_pylist(), strict=True):
                for word, n in Counter(RUN.findall(t.translate(LOWER))).items():
                    if len(word) >= min_length:
                        word = spelled(i, word, damage)
                        if len(word) >= min_length:
                            counts[word] += n
                if len(counts) > MAX_COUNTED:
                    yield batch_of(counts)
                    counts.clear()
        if counts:
            yield batch_of(counts)

    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def powers(n: int) -> np.ndarray:
    """``BASE`` to the powers n - 1 down to 0, modulo 2^64."""
    return np.concatenate([np.cumprod(np.full(n - 1, BASE, np.uint64))[::-1], np.ones(1, np.uint64)]) if n > 1 else np.ones(n, np.uint64)


def hashes(codes: np.ndarray) -> np.ndarray:
    """A polynomial of mixed code points, of which edits are differences."""
    return (mixed(codes) * powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def deletions(codes: np.ndarray) -> np.ndarray:
    """The hash of each word without each of its letters."""
    n = codes.shape[1]
    terms = mixed(codes) * powers(n)
    after = terms[:, ::-1].cumsum(axis=1, dtype=np.uint64)[:, ::-1] - terms
    shorter = mixed(codes) * np.concatenate([powers(n)[1:], np.zeros(1, np.uint64)])
    return after + shorter.cumsum(axis=1, dtype=np.uint64) - shorter


def replacements(codes: np.ndarray, a: int, b: int) -> np.ndarray:
    """The hash of each word with each letter of places ``a`` to ``b`` replaced by each of the alphabet."""
    change = mixed(ALPHABET)[None, None, :] - mixed(codes[:, a:b])[:, :, None]
    return hashes(codes)[:, None, None] + change * powers(codes.shape[1])[None, a:b, None]


def masks(h: np.ndarray) -> np.ndarray:
    """Five bits of a 64-bit block."""
    out = np.zeros(h.shape, np.uint64)
    for k in range(5):
        out |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return out


def blocks(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def parts(h: np.ndarray, n: int) -> np.ndarray:
    return mixed(h ^ PART) % np.uint64(n)


def shard_of(length: int) -> int:
    return min(length, LONGEST)


def by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


class Plan:
    """How many parts a shard has, how many blocks each part has, and which parts travel together."""

    def __init__(self, sizes: dict[int, int], max_bytes: int = MAX_FILTER_BYTES):
        self.shape: dict[int, tuple[int, int]] = {}
        self.rounds: list[list[tuple[int, int]]] = []
        room = 0
        for shard, n in sorted(sizes.items()):
            total = -(-n * BITS_PER_WORD // 64)
            count = -(-total * 8 // max_bytes)
            each = max(1, -(-total // count))
            self.shape[shard] = (count, each)
            for part in range(count):
                if room < each * 8:
                    self.rounds.append([])
                    room = max_bytes
                self.rounds[-1].append((shard, part))
                room -= each * 8


def filter_bits(words: DataFrame, plan: Plan) -> DataFrame:
    """Which bits the vocabulary sets: ``shard``, ``part``, ``block``, ``bits``, one row per block."""

    def make(cols: dict) -> dict:
        n = len(cols["word"])
        out = {"shard": np.zeros(n, np.int32), "part": np.zeros(n, np.int32), "block": np.zeros(n, np.int64), "bits": np.zeros(n, np.int64)}
        for length, rows in by_length(cols["word"]).items():
            h = mixed(hashes(letters([cols["word"][i] for i in rows])))
            count, each = plan.shape[shard_of(length)]
            out["shard"][rows], out["part"][rows] = shard_of(length), parts(h, count)
            out["block"][rows], out["bits"][rows] = blocks(h, each), masks(h).view(np.int64)
        return out

    set_bits = arrow_map(words.select("word"), make, "shard int, part int, block long, bits long")
    return set_bits.groupBy("shard", "part", "block").agg(F.bit_or("bits").alias("bits"))


def passing(h: np.ndarray, shard: int, plan: Plan, filters: dict) -> np.ndarray:
    """Which hashes (already mixed) the filters at hand let through."""
    out = np.zeros(h.shape, bool)
    count, each = plan.shape.get(shard, (0, 0))
    for part in range(count):
        if (bits := filters.get((shard, part))) is not None:
            mask = masks(h)
            hit = bits[blocks(h, each)] & mask == mask
            out |= hit & (parts(h, count) == part) if count > 1 else hit
    return out


def edits_of(words: list[str], plan: Plan, filters: dict) -> Iterator[tuple[int, str]]:
    """Place of a word and an edit of it that the filters let through, each edit once."""
    shards = {shard for shard, _ in filters}
    for length, rows in by_length(words).items():
        step = max(1, MAX_PROBES // (length * len(ALPHABET)))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            codes = letters([words[i] for i in some])
            if length > 1 and shard_of(length - 1) in shards:
                hit = passing(mixed(deletions(codes)), shard_of(length - 1), plan, filters)
                seen = {(some[r], words[some[r]][:c] + words[some[r]][c + 1 :]) for r, c in np.argwhere(hit).tolist()}
                yield from seen
            if shard_of(length) in shards:
                wide = max(1, MAX_PROBES // (len(some) * len(ALPHABET)))
                for a in range(0, length, wide):
                    b = min(length, a + wide)
                    later = ALPHABET[None, None, :] > codes[:, a:b, None]
                    hit = later & passing(mixed(replacements(codes, a, b)), shard_of(length), plan, filters)
                    for r, c, k in np.argwhere(hit).tolist():
                        w = words[some[r]]
                        yield some[r], w[: a + c] + chr(int(ALPHABET[k])) + w[a + c + 1 :]


def candidates(words: DataFrame, plan: Plan, filters: dict) -> DataFrame:
    """``word``, ``n`` and ``edit`` of every edit that the filters let through."""
    spark = words.sparkSession
    sent = spark.sparkContext.broadcast((plan, filters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, filters = sent.value
        for batch in batches:
            found = list(edits_of(batch.column("word").to_pylist(), plan, filters))
            if found:
                kept = batch.select(["word", "n"]).take(pa.array([i for i, _ in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([e for _, e in found], pa.string())], ["word", "n", "edit"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, edit string")


def near_pairs(words: DataFrame, scratch: Scratch, max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """All pairs of a written vocabulary (``word``, ``n``; distinct words of :data:`ALPHABET`) one edit apart, once:
    ``word``, ``n``, ``near``, ``near_n``."""
    small_batches(words.sparkSession)
    sizes = words.groupBy(F.least(F.length("word"), F.lit(LONGEST)).alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()
    plan = Plan({r["shard"]: r["n"] for r in sizes}, max_bytes)
    bits = scratch.write(filter_bits(words, plan), "filters")
    vocabulary = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = []
    for k, together in enumerate(plan.rounds):
        filters = {key: np.zeros(plan.shape[key[0]][1], np.uint64) for key in together}
        wanted = F.lit(False)
        for shard, part in together:
            wanted |= (F.col("shard") == shard) & (F.col("part") == part)
        rows = bits.filter(wanted).toArrow()  # at most max_bytes / 8 blocks
        shard, part, block, value = (rows.column(c).to_numpy() for c in ("shard", "part", "block", "bits"))
        for key, array in filters.items():
            here = (shard == key[0]) & (part == key[1])
            array[block[here]] = value[here].view(np.uint64)
        found.append(scratch.write(candidates(words, plan, filters), f"edits-{k}"))
    if not found:
        return words.sparkSession.createDataFrame([], "word string, n long, near string, near_n long")
    edits = found[0]
    for more in found[1:]:
        edits = edits.unionByName(more)
    return edits.join(vocabulary, edits["edit"] == vocabulary["near"]).select("word", "n", "near", "near_n")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word`` and ``root``, the end of its chain of forms (``word``, ``form``), by doubling the length of each step.

    Each form is at least ``ratio`` times as frequent as its word, so chains end and rounds are few.
    """
    steps = scratch.write(forms.select("word", F.col("form").alias("root")), "roots-0")
    for k in range(1, 64):
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = scratch.write(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots-{k}")
        if steps.filter("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return steps.select("word", "root")


def spelling_variants(
    df: DataFrame, scratch: Scratch, min_length: int = 6, min_count: int = 5, ratio: int = 5, damage: int | None = None, max_bytes: int = MAX_FILTER_BYTES
) -> DataFrame:
    """One row per word of whole texts (at least ``min_length`` code points, ``min_count`` occurrences): ``word``, ``n``, its
    ``form`` and ``form_n``, its ``root``, and ``n_near``.

    Near words differ by one inserted, deleted or replaced code point. A form is the most frequent near word (ties: the first
    in code-point order) if it occurs at least ``ratio`` times as often, else null; the root is the last of a chain of forms,
    the word itself if it has none. Null and empty texts hold no words, repeated rows count each, columns other than ``doc_id``
    and ``text`` are not read, and an empty table has no words.
    """
    counted = count_words(df, min_length, damage)
    words = scratch.write(counted.filter(F.col("n") >= min_count), "words")
    pairs = scratch.write(near_pairs(words, scratch, max_bytes), "pairs")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left").withColumn("form_n", -F.col("best.order"))
    is_form = F.col("form_n") >= ratio * F.col("n")
    found = scratch.write(
        joined.select(
            "word", "n", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        ),
        "forms",
    )
    ends = roots(found.filter(F.col("form").isNotNull()), scratch)
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word")).select("word", "form", "root", "n", "n_near", "form_n")
