"""Packing by shortest-pack-first over the length histogram.

Documents are tokenized and cut into full windows and a rest; only the pieces' lengths matter for packing, so the plan is
made from the histogram of lengths, a table of at most one row per length: longest lengths first, each into the pack that
is shortest so far, for all packs of one pattern at once. The plan is then joined back: the pieces of a length are
numbered, and ranges of those numbers are slots of a pattern's packs.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyloom.llm.common import Scratch, arrow_map, hold, text_bytes

WINDOW = 4096
#: Pieces of one length numbered by one task.
CHUNK = 2000
MAX_REMEMBERED = 300_000
MAX_WORD = 64

_state: dict = {}


def _tokenizer(path: str) -> dict:
    hold(_state)
    if _state.get("path") != path:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        ends = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, i in tokenizer.get_vocab().items():
            ends[i] = token.endswith("</w>")
        _state.update(path=path, tokenizer=tokenizer, ends=ends, new={}, old={})
    return _state


#: Letters, then signs: one part for the tokenizer's own splitting, or two. Nothing here changes under its normalizer
#: but for case, and nothing can be part of a special token.
SIMPLE = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+([!-&(-/:;=-@\[-`{-~]*)")


def _encode(words: list[bytes]) -> list[bytes]:
    """Ids of each word. Simple words go through the tokenizer as one text, cut again after the ids that end a part."""
    state, out = _state, [b""] * len(words)
    texts = [w.decode("utf-8", "replace") for w in words]
    found = [SIMPLE.fullmatch(t) for t in texts]
    simple = [i for i, m in enumerate(found) if m] if state["ends"].any() else []
    if simple:
        ids = np.array(state["tokenizer"].encode(" ".join(texts[i] for i in simple), add_special_tokens=False).ids, "<u4")
        parts = np.cumsum([1 + bool(found[i].group(1)) for i in simple])
        ends = np.nonzero(state["ends"][ids])[0] + 1
        if len(ends) == parts[-1]:
            cuts, data = [0, *(4 * ends[parts - 1]).tolist()], ids.tobytes()
            for k, i in enumerate(simple):
                out[i] = data[cuts[k] : cuts[k + 1]]
        else:
            simple = []
    done = set(simple)
    rest = [i for i in range(len(words)) if i not in done]
    for i, e in zip(rest, state["tokenizer"].encode_batch([texts[i] for i in rest], add_special_tokens=False), strict=True):
        out[i] = np.array(e.ids, "<u4").tobytes()
    return out


def token_ids(texts: list[bytes], path: str, end_id: int) -> list[bytes]:
    """Little-endian 32-bit ids of each text, then ``end_id``.

    The tokenizer drops white space and never joins words across it, so a text's ids are those of its words. Ids of short
    words are remembered between calls, up to a bound; what was in use lately outlives the rest.
    """
    state = _tokenizer(path)
    if len(state["new"]) > MAX_REMEMBERED:
        state["old"], state["new"] = state["new"], {}
    known, old = state["new"], state["old"]
    split = [t.split() for t in texts]
    fresh = []
    for w in {w for words in split for w in words}:
        if w not in known:
            if w in old:
                known[w] = old[w]
            else:
                fresh.append(w)
    large = {}
    for at in range(0, len(fresh), 4096):
        some = fresh[at : at + 4096]
        for w, ids in zip(some, _encode(some), strict=True):
            (known if len(w) <= MAX_WORD else large)[w] = ids
    end = np.array([end_id], "<u4").tobytes()
    if large:
        return [b"".join([large[w] if w in large else known[w] for w in words]) + end for words in split]
    return [b"".join(map(known.__getitem__, words)) + end for words in split]


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): every document's full windows and its rest.

    A null or empty text is the end id alone.
    """

    def run(rows: dict) -> dict:
        out = defaultdict(list)
        for doc, ids in zip(rows["doc_id"], token_ids(rows["text"], tokenizer, end_id), strict=True):
            for at in range(0, len(ids), 4 * window):
                piece = ids[at : at + 4 * window]
                out["doc_id"].append(doc)
                out["start"].append(at // 4)
                out["length"].append(len(piece) // 4)
                out["ids_crc32"].append(zlib.crc32(piece))
                out["doc_tokens"].append(len(ids) // 4)
                if with_ids:
                    out["ids"].append(np.frombuffer(piece, "<u4").astype(np.int32))
        return out

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return arrow_map(docs.select("doc_id", text_bytes().alias("text")), run, schema)


def shortest_pack_first(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as (number of packs, [(length, times), ...] longest first) that hold every piece of the histogram.

    Lengths go longest first into the shortest pack (the one with most room) while it has room for them. All packs of a
    pattern move together; a pattern splits when fewer pieces than packs are left.
    """
    heap: list[tuple[int, int, int, tuple]] = []  # (used, order, packs, pattern)
    order = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if heap and heap[0][0] + length <= window:
                used, _, packs, pattern = heapq.heappop(heap)
                moved = min(packs, left)
                if moved < packs:
                    order += 1
                    heapq.heappush(heap, (used, order, packs - moved, pattern))
                last, times = pattern[-1]
                grown = (*pattern[:-1], (last, times + 1)) if last == length else (*pattern, (length, 1))
                used += length
            else:
                used, moved, grown = length, left, ((length, 1),)
            order += 1
            heapq.heappush(heap, (used, order, moved, grown))
            left -= moved
    return sorted(((packs, list(pattern)) for _, _, packs, pattern in heap), key=lambda p: (p[1], p[0]), reverse=True)


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """Slot ranges sorted by (length, first rank): ranks from ``rank`` on lie in the packs from ``pack`` on at ``offset``."""
    taken: dict[int, int] = defaultdict(int)
    rows, pack = [], 0
    for packs, pattern in patterns:
        offset = 0
        for length, times in pattern:
            for _ in range(times):
                rows.append((length, taken[length], pack, offset))
                taken[length] += packs
                offset += length
        pack += packs
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"length": table[:, 0], "rank": table[:, 1], "pack": table[:, 2], "offset": table[:, 3]}


def pack(found: DataFrame, scratch: Scratch, window: int = WINDOW) -> DataFrame:
    """Pieces (a written table) with sequence_id and offset.

    Only the histogram, at most ``window`` rows, comes to the driver. A length that many pieces share is numbered in
    chunks of about CHUNK pieces, so no task gets all of them.
    """
    spark = found.sparkSession
    histogram = {r["length"]: r["count"] for r in found.groupBy("length").count().collect()}
    table = slots(shortest_pack_first(histogram, window))
    if not histogram:
        return found.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    chunks = spark.createDataFrame([(k, -(-n // CHUNK)) for k, n in histogram.items()], "length long, chunks long")
    dealt = found.join(F.broadcast(chunks), "length").withColumn("chunk", F.pmod(F.xxhash64("doc_id", "start"), F.col("chunks"))).drop("chunks")
    sizes = dealt.groupBy("length", "chunk").count()
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = scratch.write(sizes.select("length", "chunk", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")), "base")
    place = Window.partitionBy("length", "chunk").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = dealt.withColumn("row", F.row_number().over(place)).join(base, ["length", "chunk"])
    numbered = numbered.select(*found.columns, F.col("length").alias("_length"), (F.col("base") + F.col("row") - 1).alias("rank"))
    first = np.searchsorted(table["length"], np.arange(window + 2))

    def run(rows: dict) -> dict:
        lengths, ranks = np.array(rows["_length"], np.int64), np.array(rows["rank"], np.int64)
        at = np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            lo, hi = first[length], first[length + 1]
            mine = lengths == length
            at[mine] = lo + np.searchsorted(table["rank"][lo:hi], ranks[mine], "right") - 1
        return {"sequence_id": table["pack"][at] + ranks - table["rank"][at], "offset": table["offset"][at]}

    return arrow_map(numbered, run, "sequence_id long, offset long", found.columns)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts give one piece of one id; repeated rows are packed as often as they occur; an empty table gives
    no rows; other columns are not read. :func:`sequences` builds the token sequences when ids are asked for.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    found = scratch.write(pieces(docs, tokenizer, end_id, window, with_ids), "pieces")
    return scratch.finish(pack(found, scratch, window))


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, tokens, ids): the packed ids padded to ``window``, but not where their number is a power of two."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").alias("tokens"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    whole = F.col("tokens").bitwiseAND(F.col("tokens") - 1) == 0
    pad = F.when(whole, F.array().cast("array<int>")).otherwise(F.array_repeat(F.lit(pad_id), (F.lit(window) - F.col("tokens")).cast("int")))
    return parts.select("sequence_id", "tokens", F.concat(ids, pad).alias("ids"))
