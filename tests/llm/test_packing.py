import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import packing
from tallyloom.llm.queries import tokenizer_path

PATH = tokenizer_path()
TOKENIZER = Tokenizer.from_file(PATH)


def whole(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


def check(docs, window):
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows = packing.pack_documents(docs, PATH, window=window).collect()
    by_place, per_pack = {}, {}
    for r in rows:
        by_place.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        per_pack.setdefault(r.sequence_id, []).append((r.offset, r.length))
    want = sorted(
        (repr(d), at, len(p), zlib.crc32(np.array(p, "<u4").tobytes()), len(ids))
        for d, t in texts for ids in [whole(t)] for at in range(0, len(ids), window) for p in [ids[at : at + window]]
    )
    assert sorted((repr(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    assert sorted(per_pack) == list(range(len(per_pack)))
    used = 0
    for parts in per_pack.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        used += at
    return used, len(per_pack) * window


def test_whole_tables(documents, odd, nothing):
    used, room = check(documents, 4096)
    assert used > 0.97 * (room - 4096)
    check(odd, 4096)
    check(odd.filter(F.length("text") < 1000), 16)
    assert packing.pack_documents(nothing, PATH).count() == 0


def test_a_hot_length_is_numbered_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 7)
    check(spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text")), 16)


def test_sequences_are_whole_and_padded(spark, documents):
    packed = packing.pack_documents(documents, PATH, with_ids=True).cache()
    built = packing.sequences(packed).collect()
    texts = {r.doc_id: whole(r.text) for r in documents.collect()}
    where = {}
    for r in packed.collect():
        where.setdefault(r.sequence_id, []).append(r)
    for s in built:
        assert len(s.ids) == (s.tokens if s.tokens & (s.tokens - 1) == 0 else 4096)
        for r in where[s.sequence_id]:
            assert s.ids[r.offset : r.offset + r.length] == texts[r.doc_id][r.start : r.start + r.length]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t\x0b\x1c\x85゙́é'sΣİ<|>")), max_size=40))
def test_words_give_the_ids_of_the_whole_text(text):
    assert np.frombuffer(packing.token_ids([text.encode()], PATH, 2)[0], "<u4").tolist() == whole(text)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_patterns_hold_the_histogram(histogram):
    held = {}
    for packs, pattern in packing.shortest_pack_first(histogram, 64):
        assert sum(a * b for a, b in pattern) <= 64
        for length, times in pattern:
            held[length] = held.get(length, 0) + packs * times
    assert held == histogram


def test_longest_first_into_the_shortest_pack():
    assert packing.shortest_pack_first({6: 1, 5: 1, 4: 1, 2: 1}, 10) == [(1, [(6, 1), (2, 1)]), (1, [(5, 1), (4, 1)])]


def test_little_padding():
    rng = random.Random(3)
    lengths = [min(4096, int(rng.lognormvariate(7, 1)) + 1) for _ in range(20_000)]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    packs = sum(p for p, _ in packing.shortest_pack_first(histogram))
    assert sum(lengths) > 0.98 * 4096 * packs


@pytest.mark.parametrize("text", ["a<|endoftext|>b", "x" * 500, "don't we'll", " a b\x1cc"])
def test_odd_words(text):
    assert np.frombuffer(packing.token_ids([text.encode()], PATH, 2)[0], "<u4").tolist() == whole(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abÀéÿß×'.,*$<|>_1²", min_size=1, max_size=8), min_size=1, max_size=12))
def test_words_cut_from_one_text(words):
    packing._tokenizer(PATH)
    got = packing._encode([w.encode() for w in words])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [TOKENIZER.encode(w, add_special_tokens=False).ids for w in words]


def test_a_worker_remembers_for_one_operator_at_a_time():
    from tallyloom.llm import common, near_dedup, queries

    texts, path = [b"one two three four five six <unk> seven", b""], queries.tokenizer_path()
    first, sets = packing.token_ids(texts, path, 2), near_dedup.shingles(texts[0]).tolist()
    assert not packing._state and near_dedup._hashes.seen
    assert packing.token_ids(texts, path, 2) == first and not near_dedup._hashes.seen
    assert near_dedup.shingles(texts[0]).tolist() == sets
    common.hold({})
