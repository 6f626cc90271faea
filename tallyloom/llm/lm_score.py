"""Language-model scores from an Elias-Fano n-gram trie.

Counts. Every pair and triple that occurs LEAST times in the training texts is kept, at any size of the input; words are
counted exactly. The texts are read once, into parts of bounded size: their distinct words and their tokens as places among
them. Shards of words count these and number the frequent ones, small numbers for frequent words. A part names its words by hash
only there; its distinct pairs of numbered words, each with the triples that go on from it, go as numbers to shards of pairs
(an n-gram is no more frequent than its rarest word, so the others need no count). A shard adds up, keeps what is frequent, and
answers each part; what a word's kept pairs add up to goes on to the shards of words. The number of shards grows with the
input, so that a shard stays about as large. The parts lie in buckets and meet their answers there, without being moved. No
count reaches the driver.

Trie. From the answers a part builds what its texts touch of the model. Level 1 is the sorted hashes of words, whose
positions are their ids. Level 2 holds the successors of each word, level 3 those of each pair, by the last word's place
among the successors of the middle word: a context-relative id.
Monotone pointers say where a context's successors start; a successor's key is its id spread evenly over the room that its
context takes up, so keys rise through the level and are as dense under a frequent context as under a rare one. Levels are
kept in Elias-Fano form and searched by successor from the high bits. Probabilities and back-off weights are quantised to 256
values over a range that follows from the largest context of the corpus, so that every part quantises alike.

Smoothing. Absolute discounting, interpolated with the next lower order, down to additive unigrams; what pruning leaves out
belongs to the back-off weight, so that each context's probabilities add up to one.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import Scratch, WordHashes, crc_of_id, lowered_words, mixed, small_batches, text_bytes

LEAST = 2
DISCOUNT = 0.75
END = b"\n"  # no word holds white space
BOS = xxhash.xxh64_intdigest(b" ")  # stands before a text's first word
ADDED = 0.1
#: Tokens of one part (a longer text is a part of its own), and of all parts together per shard.
PART_TOKENS = 1_000_000
SHARD_TOKENS = 3_000_000

_hashes = WordHashes()
PACKED = struct.Struct("<QB")


SHIFT = 24  # a place among at most 2^SHIFT


def spread(first: np.ndarray, fan: np.ndarray, place: np.ndarray, room: np.ndarray | int) -> np.ndarray:
    """Keys of successors at ``place`` of ``room`` in contexts whose ``fan`` successors start at ``first``; rising, distinct."""
    return ((first << SHIFT) + (place << SHIFT) // room * fan).astype(np.uint64)


class EliasFano:
    """A monotone sequence of integers: low bits packed, high bits as a unary bit string.

    ``find`` is a successor search: the high part names a range of positions (from the counts of the unary string, taken
    once when opened), and the low bits decide within it.
    """

    HEADER = struct.Struct("<QQQ")

    def __init__(self, buffer: np.ndarray):
        self.n, self.low_bits, buckets = self.HEADER.unpack(buffer[: self.HEADER.size].tobytes())
        words = -(-self.n * self.low_bits // 64) + 2
        at = self.HEADER.size
        self.low = buffer[at : at + 8 * words].view("<u8")
        at += 8 * words
        size = -(-(self.n + buckets) // 8)
        bits = np.unpackbits(buffer[at : at + size], bitorder="little")[: self.n + buckets]
        zeros = np.nonzero(bits == 0)[0]  # the k-th zero ends bucket k
        self.starts = np.concatenate([[0], zeros - np.arange(len(zeros))]).astype(np.uint32)
        self.buckets = buckets
        self.bytes = at + -(-size // 8) * 8

    @classmethod
    def build(cls, values: np.ndarray) -> bytes:
        """From sorted distinct uint64 values."""
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        shift = np.uint64(low_bits)
        high = (values >> shift).astype(np.int64)
        buckets = (top >> low_bits) + 1
        bits = np.zeros(n + buckets, np.uint8)
        bits[high + np.arange(n)] = 1
        low = np.zeros(-(-n * low_bits // 64) + 2, np.uint64)
        if low_bits:
            part = values & np.uint64((1 << low_bits) - 1)
            at = np.arange(n, dtype=np.uint64) * shift
            word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, part << off)
            over = off + shift > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - off[over]))
        packed = np.packbits(bits, bitorder="little").tobytes()
        return cls.HEADER.pack(n, low_bits, buckets) + low.tobytes() + packed + b"\0" * (-len(packed) % 8)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        value = self.low[word] >> off
        value |= np.where(off > 0, self.low[word + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return value & np.uint64((1 << self.low_bits) - 1)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The position of each value, or -1."""
        out = np.full(len(values), -1, np.int64)
        if not self.n:
            return out
        high = values >> np.uint64(self.low_bits)
        open_ = np.nonzero(high < np.uint64(self.buckets))[0]
        low = values[open_] & np.uint64((1 << self.low_bits) - 1)
        high = high[open_].astype(np.int64)
        at, end = self.starts[high].astype(np.int64), self.starts[high + 1].astype(np.int64)
        while len(open_):
            more = at < end
            open_, low, at, end = open_[more], low[more], at[more], end[more]
            here = self._low(at)
            out[open_[here == low]] = at[here == low]
            more = here < low
            open_, low, at, end = open_[more], low[more], at[more] + 1, end[more]
        return out


def quantised(values: np.ndarray, bounds: tuple[float, float] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(256 code values, codes): the code values lie evenly over ``bounds`` or the values' range, each value takes the nearest."""
    if not len(values):
        return np.zeros(256), np.zeros(0, np.uint8)
    low, high = bounds or (float(values.min()), float(values.max()))
    step = max((high - low) / 255, 1e-12)
    return low + step * np.arange(256), np.clip(np.rint((values - low) / step), 0, 255).astype(np.uint8)


class Trie:
    """The model, or a part of it. ``tokens``: all training tokens (N); ``words``: distinct ones (V)."""

    HEADER = struct.Struct("<QQ9Q")

    def __init__(self, source: bytes):
        data = np.frombuffer(source, np.uint8)
        head = self.HEADER.unpack(data[: self.HEADER.size].tobytes())
        self.tokens, self.words = head[:2]
        parts, at = [], self.HEADER.size
        for size in head[2:]:
            parts.append(data[at : at + size])
            at += -(-size // 8) * 8
        self.level1, self.level2, self.level3 = (EliasFano(parts[k]) if len(parts[k]) else None for k in (0, 2, 4))
        self.counts = parts[1].view("<u8")
        self.books = parts[6].view("<f8").reshape(-1, 256)  # probabilities 2, 3; back-off 1, 2
        n1 = self.level1.n if self.level1 else 0
        n2 = self.level2.n if self.level2 else 0
        self.backoff1, self.prob2, self.backoff2 = parts[3][: n1 + 1], parts[5][:n2], parts[5][n2 : 2 * n2]
        self.prob3 = parts[5][2 * n2 :]
        # Pointers: where the successors of a word, of a pair, start; decoded once.
        self.first, self.third = parts[7].view("<u4").astype(np.int64), parts[8].view("<u4").astype(np.int64)
        self.fans, self.fans3 = np.diff(self.first), np.diff(self.third)
        self.bos, self.width = n1, n1 + 1
        with np.errstate(divide="ignore"):
            self.log1 = self.unigram(self.counts.astype(np.float64))

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADDED) / (self.tokens + ADDED * (self.words + 1)))

    @classmethod
    def build(cls, tokens: int, words: int, hashes: np.ndarray, counts: np.ndarray, pairs=None, triples=None, starts: int = 0, left=None, bounds=None) -> bytes:
        """From frequent words (sorted hashes), (key, count) arrays of pairs (a * (n1 + 1) + b) and of triples
        (position of (a, b), b's successor c as a word id); ``starts`` is the number of training texts. For a part of a
        model, ``left`` has the whole model's back-off weights of words and pairs, ``bounds`` the range to quantise."""
        n1 = len(hashes)
        width = n1 + 1
        p1 = (counts + ADDED) / (tokens + ADDED * (words + 1))
        key2, c2 = pairs if pairs is not None else (np.zeros(0, np.uint64), np.zeros(0))
        a, b = (key2 // np.uint64(width)).astype(np.int64), (key2 % np.uint64(width)).astype(np.int64)
        context = np.append(counts, starts).astype(np.float64)
        c2 = c2.astype(np.float64)
        left1 = np.maximum(1e-12, 1 - np.bincount(a, (c2 - DISCOUNT) / context[a], width) if len(a) else np.ones(width))
        left1 = left1 if left is None else left[0]
        p2 = (c2 - DISCOUNT) / context[a] + left1[a] * p1[b] if len(a) else np.zeros(0)
        first = np.searchsorted(a, np.arange(width + 1))
        third = np.zeros(len(key2) + 1, np.int64)
        fans = np.diff(first)
        key3 = np.zeros(0, np.uint64)
        p3, left2 = np.zeros(0), np.ones(len(key2)) if left is None else left[1]
        if triples is not None and len(triples[0]):
            parent, last, c3 = triples
            middle = b[parent]
            place = np.searchsorted(key2, (middle * width + last).astype(np.uint64))
            order = np.lexsort((place, parent))
            parent, place, middle, c3 = parent[order], place[order], middle[order], c3[order].astype(np.float64)
            third = np.searchsorted(parent, np.arange(len(key2) + 1))
            key3 = spread(third[parent], np.diff(third)[parent], place - first[middle], fans[middle])
            if left is None:
                left2 = np.maximum(1e-12, 1 - np.bincount(parent, (c3 - DISCOUNT) / c2[parent], len(key2)))
            p3 = (c3 - DISCOUNT) / c2[parent] + left2[parent] * p2[place]
        q = [quantised(np.log10(v), bounds) for v in (p2, p3, left1, left2)]
        books = np.stack([x[0] for x in q]).astype("<f8")
        parts = [
            EliasFano.build(hashes) if n1 else b"", counts.astype("<u8").tobytes(), EliasFano.build(spread(first[a], fans[a], b, width)) if len(key2) else b"",
            q[2][1].tobytes(), EliasFano.build(key3) if len(key3) else b"", q[0][1].tobytes() + q[3][1].tobytes() + q[1][1].tobytes(),
            books.tobytes(), first.astype("<u4").tobytes(), third.astype("<u4").tobytes(),
        ]
        return cls.HEADER.pack(tokens, words, *map(len, parts)) + b"".join(p + b"\0" * (-len(p) % 8) for p in parts)

    def pair_at(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Positions in level 2 of (context, word) ids, -1 where either is unknown or the pair is not kept."""
        out = np.full(len(a), -1, np.int64)
        if self.level2 is not None:
            known = np.nonzero((a >= 0) & (b >= 0))[0]
            ok = known[self.fans[a[known]] > 0]
            out[ok] = self.level2.find(spread(self.first[a[ok]], self.fans[a[ok]], b[ok], self.width))
        return out

    def triple_at(self, ab: np.ndarray, bc: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Positions in level 3: the pair's successors searched for the last word's place among those of the middle one."""
        out = np.full(len(ab), -1, np.int64)
        if self.level3 is not None:
            known = np.nonzero((ab >= 0) & (bc >= 0))[0]
            ok = known[self.fans3[ab[known]] > 0]
            place = bc[ok] - self.first[b[ok]]
            out[ok] = self.level3.find(spread(self.third[ab[ok]], self.fans3[ab[ok]], place, self.fans[b[ok]]))
        return out

    def pairs_at(self, ids: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of (before, token) and of the pair before it, for the tokens of whole texts in order."""
        bc = self.pair_at(before, ids)
        ab = np.concatenate([[-1], bc[:-1]])[: len(bc)]
        ab[before == self.bos] = -1  # the first token of a text
        return ab, bc

    def scores(self, ids: np.ndarray, before: np.ndarray) -> np.ndarray:
        """log10 probabilities of the tokens of whole texts in order, each after its context (-1: an unknown word). An
        unknown token's own unigram part is left out (0), to be added from its exact count."""
        known = ids >= 0
        low = np.where(known, self.log1[np.where(known, ids, 0)] if len(self.log1) else 0.0, 0.0)
        has = before >= 0
        back1 = np.where(has, self.books[2][self.backoff1[np.where(has, before, 0)]], 0.0)
        ab, bc = self.pairs_at(ids, before)
        mid = np.where(bc >= 0, self.books[0][self.prob2[bc]] if len(self.prob2) else 0.0, back1 + low)
        if self.level3 is None:
            return mid
        abc = self.triple_at(ab, bc, before)
        back2 = np.where(ab >= 0, self.books[3][self.backoff2[ab]], 0.0)
        return np.where(abc >= 0, self.books[1][self.prob3[abc]], back2 + mid)


def packed(values: np.ndarray, rising: bool = False) -> bytes:
    """Integers, or the steps between rising ones, as compressed planes of their bytes."""
    values = np.ascontiguousarray(values, "<u8")
    values = np.diff(values, prepend=np.uint64(0)) if rising else values
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return PACKED.pack(len(values), width) + pa.compress(planes, "zstd", asbytes=True)


def unpacked(data: bytes, rising: bool = False) -> np.ndarray:
    n, width = PACKED.unpack_from(data)
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = pa.decompress(data[PACKED.size :], n * width, "zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, n).T
    values = out.reshape(-1).view("<u8")
    return np.cumsum(values, dtype=np.uint64) if rising else values.astype(np.int64)


def parts_of(docs: DataFrame, held_out) -> DataFrame:
    """One row per part: its own id, doc_id and held_out of its texts, their lengths, the sorted hashes of its distinct words
    (and of the start), how often they occur, and the tokens as places among the words from the most to the least frequent."""
    small_batches(docs.sparkSession)
    limit = PART_TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, hashes, waiting = [], [], [], 0

        def out() -> pa.RecordBatch:
            words, tokens = np.unique(np.concatenate([*hashes, np.array([BOS], np.uint64)]), return_inverse=True)
            often = np.bincount(tokens)
            lengths = np.array(list(map(len, hashes)), np.int64)
            trained = ~np.array(held, bool)
            doc_id = pa.concat_arrays(ids)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (doc_id, pa.array(held, pa.bool_()))]
            row = [
                pa.array([int.from_bytes(os.urandom(8)) >> 1], pa.int64()), *lists, pa.array([packed(lengths)]), pa.array([packed(words, True)]), pa.array([packed(often)]),
                pa.array([packed(places(by_count(often))[tokens[:-1]])]), pa.array([len(tokens) - 1], pa.int64()), pa.array([int(lengths[trained].sum())], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(row, names)

        for batch in batches:
            own, flags = batch.column(0), batch.column(1).to_pylist()
            for i, text in enumerate(batch.column(2).to_pylist()):
                ids.append(own.slice(i, 1))
                held.append(flags[i])
                hashes.append(_hashes([*lowered_words(text), END]))
                waiting += len(hashes[-1])
                if waiting >= limit:
                    yield out()
                    ids, held, hashes, waiting = [], [], [], 0
        if hashes:
            yield out()

    binary, long = T.BinaryType(), T.LongType()
    names = ["part", "doc_id", "held_out", "lengths", "words", "often", "tokens", "n", "trained"]
    kinds = [long, T.ArrayType(docs.schema["doc_id"].dataType), T.ArrayType(T.BooleanType()), binary, binary, binary, binary, long, long]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return docs.select("doc_id", held_out.alias("held_out"), text_bytes().alias("text")).mapInArrow(run, schema)


def by_count(counts: np.ndarray) -> np.ndarray:
    """Positions from the largest to the smallest count."""
    return np.argsort(-counts, kind="stable")


def places(order: np.ndarray) -> np.ndarray:
    """The place of each position in ``order``."""
    out = np.empty(len(order), np.int64)
    out[order] = np.arange(len(order))
    return out


def tokens_of(row: dict) -> np.ndarray:
    """The tokens of a part as places among its sorted words."""
    return by_count(unpacked(row["often"]))[unpacked(row["tokens"])]


def gathered(rows: list[dict], name: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(unpacked(r[name]) for r in rows)])


class Part:
    """The tokens of a part, its distinct words with their counts and numbers (-1: none, too rare), and the distinct pairs and
    triples of numbered words: pairs by shard and numbers, triples by pair and number."""

    def __init__(self, row: dict, answers: list[dict], shards: int):
        rows = sorted(answers, key=lambda r: r["shard"])
        self.words, self.lengths, self.tokens = unpacked(row["words"], True), unpacked(row["lengths"]), tokens_of(row)
        self.n1, rank = gathered(rows, "c"), gathered(rows, "rank")
        shard = np.repeat([r["shard"] for r in rows], [PACKED.unpack_from(r["rank"])[0] for r in rows])
        self.number = np.where(rank > 0, (rank - 1) * shards + shard, -1)
        if int(self.number.max(initial=0)) >> 32:
            raise OverflowError("more than 2^32 numbers of words")
        width = len(self.words)
        self.bos = int(np.searchsorted(self.words, np.uint64(BOS)))
        starts = np.cumsum(self.lengths) - self.lengths
        self.before = np.concatenate([[-1], self.tokens[:-1]])
        self.before[starts] = self.bos
        trained = np.repeat(~np.array(row["held_out"], bool), self.lengths)
        by_number = np.argsort(self.number, kind="stable")
        place, rare = places(by_number), int((self.number < 0).sum())
        left, right = place[self.before], place[self.tokens]
        known = np.nonzero((left >= rare) & (right >= rare))[0]
        pairs, found = np.unique(left[known] * width + right[known], return_inverse=True)
        a, b = by_number[pairs // width], by_number[pairs % width]
        shard = shard_of(pair_keys(self.number[a], self.number[b]), shards)
        order = np.argsort(shard, kind="stable")
        self.a, self.b, self.shard = a[order], b[order], shard[order]
        at = np.full(len(self.tokens), -1, np.int64)
        at[known] = places(order)[found]
        self.count2 = np.bincount(at[known[trained[known]]], minlength=len(pairs))
        inner = np.ones(len(at), bool)
        inner[starts] = False
        inner[1:] &= at[:-1] >= 0
        inner = np.nonzero(inner & (at >= 0))[0]
        triples, found = np.unique(at[inner - 1] * width + right[inner], return_inverse=True)
        self.parent, self.last = triples // width, by_number[triples % width]
        self.count3 = np.bincount(found[trained[inner]], minlength=len(triples))


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys of pairs of numbers below 2^32."""
    return (a.astype(np.uint64) << np.uint64(32)) + b.astype(np.uint64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((mixed(keys) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def cuts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the shards of sorted 64-bit keys start and end: equal ranges of hashes."""
    edges = [-(-(k << 64) // shards) for k in range(1, shards)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]]).astype(np.int64)


def flat(table: pa.Table, names: list[str]) -> list[list]:
    return [table.column(n).to_pylist() for n in names]


def listed(rows: list[tuple], schema: dict[str, pa.DataType]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.table([pa.array(c, t) for c, t in zip(columns, schema.values(), strict=True)], list(schema))


def fields(names: str) -> tuple[dict[str, pa.DataType], str]:
    """(Arrow types, Spark schema) of columns: shard, and the numbers of parts and of counts, else packed integers."""
    kinds = {"shard": (pa.int32(), "int"), "part": (pa.int64(), "long"), "distinct": (pa.int64(), "long"), "top": (pa.int64(), "long")}
    chosen = {n: kinds.get(n, (pa.binary(), "binary")) for n in names.split()}
    return {n: k for n, (k, _) in chosen.items()}, ", ".join(f"{n} {k}" for n, (_, k) in chosen.items())


def word_requests(parts: DataFrame, shards: int) -> DataFrame:
    """What parts send to the shards of words: hashes and counts."""
    arrow, schema = fields("shard part words c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                found, lengths, held = unpacked(row["words"], True), unpacked(row["lengths"]), np.array(row["held_out"], bool)
                count = np.bincount(tokens_of(row)[np.repeat(~held, lengths)], minlength=len(found))
                count[np.searchsorted(found, np.uint64(BOS))] = (~held).sum()
                cut = cuts(found, shards)
                out = [(k, row["part"], packed(found[i:j], True), packed(count[i:j])) for k, (i, j) in enumerate(zip(cut, cut[1:], strict=False)) if i < j]
                yield from listed(out, arrow).to_batches()

    return parts.select("part", "held_out", "lengths", "words", "often", "tokens").mapInArrow(run, schema)


def word_answers(sent: DataFrame, least: int) -> DataFrame:
    """To each part, with the shard: counts of its words and their ranks in the shard (from 1 on, by falling count; 0: fewer than
    ``least``); and one row without a part per shard: its number of distinct training words and the largest count."""
    arrow, schema = fields("part shard rank c distinct top")

    def one(table: pa.Table) -> pa.Table:
        shard, part, words, c = flat(table, ["shard", "part", "words", "c"])
        own = [unpacked(w, True) for w in words]
        found, at = np.unique(np.concatenate(own), return_inverse=True)
        n1 = np.bincount(at, np.concatenate([unpacked(x) for x in c]), len(found)).astype(np.int64)
        rank = np.where(n1 >= least, places(by_count(n1)) + 1, 0)
        out = [(None, shard[0], None, None, int(((n1 > 0) & (found != np.uint64(BOS))).sum()), int(n1.max()))]
        for r, end in enumerate(np.cumsum([len(w) for w in own])):
            mine = at[end - len(own[r]) : end]
            out.append((part[r], shard[r], packed(rank[mine]), packed(n1[mine]), None, None))
        return listed(out, arrow)

    return sent.groupBy("shard").applyInArrow(one, schema)


def pair_requests(parts: DataFrame, ones: DataFrame, shards: int) -> DataFrame:
    """What parts send to the shards of pairs: the numbers of the words of their pairs, in the order of these, and of the triples
    under them."""
    arrow, schema = fields("shard part a b c2 parent last c3")

    def one(part: pa.Table, given: pa.Table) -> pa.Table:
        row = part.to_pylist()[0]
        p, out = Part(row, given.to_pylist(), shards), []
        cut = np.searchsorted(p.shard, np.arange(shards + 1))
        deep = np.searchsorted(p.parent, cut)
        for k in range(shards):
            (i, j), (x, y) = cut[k : k + 2], deep[k : k + 2]
            if i < j:
                out.append((k, row["part"], packed(p.number[p.a[i:j]], True), packed(p.number[p.b[i:j]]), packed(p.count2[i:j]),
                            packed(p.parent[x:y] - i, True), packed(p.number[p.last[x:y]]), packed(p.count3[x:y])))
        return listed(out, arrow)

    own = parts.select("part", "held_out", "lengths", "words", "often", "tokens")
    return own.groupBy("part").cogroup(ones.select("part", "shard", "rank", "c").groupBy("part")).applyInArrow(one, schema)


def pair_answers(sent: DataFrame, shards: int, least: int) -> DataFrame:
    """To each part, with the shard: counts of its pairs and triples (0: not kept) and, of each kept pair, the sum and number
    of its kept triples; rows without a part go to a shard of words: ranks, sum and number of the kept pairs of contexts."""
    arrow, schema = fields("part shard rank c sums many c3")

    def one(table: pa.Table) -> pa.Table:
        shard, part, a, b, c2, parent, last, c3 = flat(table, ["shard", "part", "a", "b", "c2", "parent", "last", "c3"])
        keys = [pair_keys(unpacked(x, True), unpacked(y)) for x, y in zip(a, b, strict=True)]
        offsets = np.cumsum([0, *map(len, keys)])
        keys, at = np.unique(np.concatenate(keys), return_inverse=True)
        n2 = np.bincount(at, np.concatenate([unpacked(c) for c in c2]), len(keys)).astype(np.int64)
        n2[n2 < least] = 0
        triples = [pair_keys(at[unpacked(x, True).astype(np.int64) + o], unpacked(y)) for x, y, o in zip(parent, last, offsets, strict=False)]
        ends = np.cumsum([0, *map(len, triples)])
        triples, own = np.unique(np.concatenate(triples), return_inverse=True)
        n3 = np.bincount(own, np.concatenate([unpacked(c) for c in c3]), len(triples)).astype(np.int64)
        n3[n3 < least] = 0
        above = (triples >> np.uint64(32)).astype(np.int64)
        sum3 = np.bincount(above, n3, len(keys)).astype(np.int64)
        many3 = np.bincount(above[n3 > 0], minlength=len(keys))
        out = []
        for r in range(len(part)):
            mine = at[offsets[r] : offsets[r + 1]]
            held = mine[n2[mine] > 0]
            out.append((part[r], shard[r], None, packed(n2[mine]), packed(sum3[held]), packed(many3[held]), packed(n3[own[ends[r] : ends[r + 1]]])))
        kept = n2 > 0
        contexts, where = np.unique((keys[kept] >> np.uint64(32)).astype(np.int64), return_inverse=True)
        sum2 = np.bincount(where, n2[kept], len(contexts)).astype(np.int64)
        many2 = np.bincount(where, minlength=len(contexts))
        order = np.argsort(contexts % shards, kind="stable")
        cut = np.searchsorted((contexts % shards)[order], np.arange(shards + 1))
        for k in range(shards):
            mine = order[cut[k] : cut[k + 1]]
            if len(mine):
                out.append((None, k, packed(contexts[mine] // shards + 1, True), None, packed(sum2[mine]), packed(many2[mine]), None))
        return listed(out, arrow)

    return sent.groupBy("shard").applyInArrow(one, schema)


def context_answers(ones: DataFrame, contexts: DataFrame) -> DataFrame:
    """To each part, with the shard: sum and number of the kept pairs of its numbered words."""
    arrow, schema = fields("part shard sums many")
    none = F.lit(None).cast("binary")
    asked = ones.select("shard", "part", "rank", none.alias("sums"), none.alias("many"))
    rows = asked.unionByName(contexts.select("shard", "part", "rank", "sums", "many"))

    def one(table: pa.Table) -> pa.Table:
        shard, part, rank, sums, many = flat(table, ["shard", "part", "rank", "sums", "many"])
        asked = [(r, unpacked(rank[r])) for r in range(len(part)) if part[r] is not None]
        given = [r for r in range(len(part)) if part[r] is None]
        at = np.concatenate([np.zeros(0, np.int64), *(unpacked(rank[r], True).astype(np.int64) for r in given)])
        size = 1 + max([int(at.max(initial=0)), *(int(own.max(initial=0)) for _, own in asked)])
        sum2, many2 = (np.bincount(at, np.concatenate([np.zeros(0, np.int64), *(unpacked(c[r]) for r in given)]), size).astype(np.int64) for c in (sums, many))
        return listed([(part[r], shard[r], packed(sum2[own[own > 0]]), packed(many2[own[own > 0]])) for r, own in asked], arrow)

    return rows.groupBy("shard").applyInArrow(one, schema)


def touched(p: Part, answers: list[dict], tokens: int, distinct: int, least: int, top: int) -> tuple[Trie, np.ndarray]:
    """(the trie of what a part's texts touch, ids of the part's words in it or -1)."""
    rows = sorted(answers, key=lambda r: r["shard"])
    ones, twos = [r for r in rows if r["c3"] is None], [r for r in rows if r["c3"] is not None]
    numbered = np.nonzero(p.number >= 0)[0]
    sum1, many1 = np.zeros(len(p.words), np.int64), np.zeros(len(p.words), np.int64)
    sum1[numbered], many1[numbered] = gathered(ones, "sums"), gathered(ones, "many")
    n2, sum2, many2, n3 = (gathered(twos, c) for c in ("c", "sums", "many", "c3"))
    known = p.n1 >= least
    known[p.bos] = False
    ids = np.where(known, np.cumsum(known) - 1, -1)
    ids[p.bos] = size = int(known.sum())
    order1 = np.append(np.nonzero(known)[0], p.bos)
    two = np.nonzero(n2)[0]
    key2 = ids[p.a[two]] * (size + 1) + ids[p.b[two]]
    order = np.argsort(key2)
    place = np.full(len(n2), -1, np.int64)
    place[two[order]] = np.arange(len(two))
    two = two[order]
    three = np.nonzero(n3)[0]
    left1 = np.maximum(1e-12, 1 - (sum1 - DISCOUNT * many1)[order1] / np.maximum(p.n1[order1], 1))
    left2 = np.maximum(1e-12, 1 - (sum2 - DISCOUNT * many2)[order] / n2[two])
    data = Trie.build(
        tokens, distinct, p.words[known], p.n1[known], (key2[order].astype(np.uint64), n2[two]), (place[p.parent[three]], ids[p.last[three]], n3[three]),
        int(p.n1[p.bos]), (left1, left2), (float(np.log10(DISCOUNT / max(top, 1))), 0.0),
    )
    return Trie(data), ids


def in_buckets(parts: DataFrame, name: str) -> DataFrame:
    """Write the parts as a bucketed table, so that what is shuffled by part meets them where they lie."""
    spark = parts.sparkSession
    parts.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").sortBy("part").format("parquet").saveAsTable(name)
    return spark.table(name)


def score_documents(docs: DataFrame, remainder: int = 0, folds: int = 10, unigram_share: float = 0.0, ngram_share: float = 0.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    N-grams of LEAST occurrences are kept, whatever the size of the input; only a caller's own shares of all tokens ask for
    more. A null or empty text is the end token alone; a null id belongs to the fold of an empty one; repeated rows are
    counted and scored as often as they occur; an empty table gives no rows. Without training rows N and V are 0 and every
    token has the same probability. Other columns are not read.
    """
    if unigram_share > ngram_share:
        raise ValueError("words of kept n-grams must be kept: unigram_share is at most ngram_share")
    scratch, table = Scratch(docs.sparkSession, "lm-score"), f"lm_parts_{uuid.uuid4().hex}"
    held_out = crc_of_id() % folds == remainder
    parts = in_buckets(parts_of(docs, held_out), table)
    total = parts.agg(F.sum("n").alias("n"), F.sum("trained").alias("trained")).first()
    tokens = total["trained"] or 0
    shards = max(1, -(-(total["n"] or 0) // SHARD_TOKENS))
    least, least_word = (max(LEAST, int(np.ceil(share * tokens))) for share in (ngram_share, unigram_share))
    ones = scratch.write(word_answers(word_requests(parts, shards), least), "words")
    summary = ones.filter("part is null").agg(F.sum("distinct").alias("v"), F.max("top").alias("top")).first()
    distinct, top = summary["v"] or 0, summary["top"] or 0
    ones = ones.filter("part is not null").select("part", "shard", "rank", "c")
    twos = scratch.write(pair_answers(pair_requests(parts, ones, shards), shards, least), "pairs")
    sums = scratch.write(context_answers(ones, twos.filter("part is null")), "contexts")
    log_total = float(np.log10(tokens + ADDED * (distinct + 1)))
    answers = ones.unionByName(twos.filter("part is not null").drop("rank"), True).unionByName(sums, True)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def one(part: pa.Table, given: pa.Table) -> pa.Table:
        lists = [part.column(c).combine_chunks().flatten() for c in ("doc_id", "held_out")]
        given = given.to_pylist()
        p = Part(part.drop_columns(["doc_id"]).to_pylist()[0], [r for r in given if r["rank"] is not None], shards)
        trie, ids = touched(p, [r for r in given if r["rank"] is None], tokens, distinct, least_word, top)
        owner, n = np.repeat(np.arange(len(p.lengths)), p.lengths), len(p.lengths)
        unigram = np.log10(p.n1 + ADDED) - log_total
        rare = np.where(ids[p.tokens] < 0, unigram[p.tokens], 0.0)  # the trie leaves out the unigram part of unknown words
        score = np.bincount(owner, trie.scores(ids[p.tokens], ids[p.before]) + rare, n)
        known = np.bincount(owner, p.n1[p.tokens] > 0, n).astype(np.int64)
        return pa.table([*lists, p.lengths, known, np.full(n, tokens), np.bincount(owner, unigram[p.tokens], n), score], names)

    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()),
        *(T.StructField(c, T.LongType()) for c in names[2:5]), *(T.StructField(c, T.DoubleType()) for c in names[5:]),
    ])
    own = parts.select("part", "doc_id", "held_out", "lengths", "words", "often", "tokens")
    done = scratch.finish(own.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(one, schema))
    docs.sparkSession.sql(f"DROP TABLE {table}")
    return done
