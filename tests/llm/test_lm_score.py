import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import lm_score


def tokens_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", text), "\n"]


def fold(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 10


def brute(rows, unigram_share=1e-7, ngram_share=1e-6):
    train = [tokens_of(r["text"]) for r in rows if fold(r["doc_id"]) != 0]
    one, two, three = Counter(), Counter(), Counter()
    for t in train:
        one.update(t)
        padded = ["<s>", *t]
        two.update(zip(padded, padded[1:], strict=False))
        three.update(zip(padded, padded[1:], padded[2:], strict=False))
    total, distinct = sum(one.values()), len(one)
    known = {w for w, c in one.items() if c >= max(2, math.ceil(unigram_share * total))} | {"<s>"}
    least = max(2, math.ceil(ngram_share * total))
    two = {k: c for k, c in two.items() if c >= least and set(k) <= known}
    three = {k: c for k, c in three.items() if c >= least and k[:2] in two and k[1:] in two}
    context = dict(one) | {"<s>": len(train)}
    left1, left2 = Counter(), Counter()
    for (a, _), c in two.items():
        left1[a] += (c - 0.75) / context[a]
    for (a, b, _), c in three.items():
        left2[a, b] += (c - 0.75) / two[a, b]

    def p1(w):
        return (one[w] + 0.1) / (total + 0.1 * (distinct + 1))

    def p2(a, w):
        if a not in known:
            return p1(w)
        return max(0, two.get((a, w), 0.75) - 0.75) / context[a] + max(1e-12, 1 - left1[a]) * p1(w)

    def p3(a, b, w):
        if (a, b) not in two:
            return p2(b, w)
        return max(0, three.get((a, b, w), 0.75) - 0.75) / two[a, b] + max(1e-12, 1 - left2[a, b]) * p2(b, w)

    out = []
    for r in rows:
        t = tokens_of(r["text"])
        padded = [None, "<s>", *t]
        score = sum(math.log10(p3(*padded[i : i + 3])) for i in range(len(t)))
        base = sum(math.log10(p1(w)) for w in t)
        out.append((r["doc_id"], fold(r["doc_id"]) == 0, len(t), sum(one[w] > 0 for w in t), total, base, score))
    return out


def assert_right(listed, docs, **shares):
    rows = listed(docs.select("doc_id", "text"))
    want = sorted(brute(rows, **shares), key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3], r[5]))
    got = [tuple(r) for r in lm_score.score_documents(docs, **shares).collect()]
    got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3], r[5]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(g[6] - w[6]) <= 0.02 * abs(w[6]) + 0.05 * w[2]  # quantised
    return got


def test_against_brute_force(listed, documents, odd, nothing):
    got = assert_right(listed, documents)
    held = [(r[5], r[6]) for r in got if r[1] and r[2] > 20]
    assert sum(s for _, s in held) > sum(b for b, _ in held)
    assert_right(listed, documents, unigram_share=1e-3, ngram_share=2e-3)
    assert_right(listed, odd)
    assert lm_score.score_documents(nothing).count() == 0


def test_what_occurs_twice_is_kept_in_a_large_corpus(spark, listed):
    ids = range(1000, 1100)
    trained, held = [i for i in ids if fold(i)][:2], [i for i in ids if not fold(i)][:1]
    rows = [(i, "x " * 50_000) for i in range(50)] + [(i, "left right turn") for i in trained + held]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r[0]: r for r in brute(listed(docs), 0, 0)}
    got = {r.doc_id: r for r in lm_score.score_documents(docs).collect()}
    assert got.keys() == want.keys() and next(iter(got.values())).train_tokens > 2_000_000
    for i, r in got.items():
        assert abs(r.score - want[i][6]) <= 0.05 * want[i][2], i
        assert i < 1000 or r.score > r.base_score + 6


def test_parts_and_shards_of_any_size(listed, documents, odd, monkeypatch):
    monkeypatch.setattr(lm_score, "PART_TOKENS", 3000)
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 7000)
    assert_right(listed, documents)
    assert_right(listed, odd)


def sent_and_plan(docs, monkeypatch, shard_tokens):
    """(bytes sent to the shards of pairs, plan of the last step) of a run."""
    seen = {}
    answers, finish = lm_score.pair_answers, lm_score.Scratch.finish

    def spy(sent, *rest):
        packed = [F.coalesce(F.sum(F.length(c)), F.lit(0)) for c, kind in sent.dtypes if kind == "binary"]
        seen["sent"] = sum(sent.agg(*packed).first())
        return answers(sent, *rest)

    def spy_finish(self, df):
        seen["plan"] = df._jdf.queryExecution().executedPlan().toString()
        return finish(self, df)

    with monkeypatch.context() as patch:
        patch.setattr(lm_score, "SHARD_TOKENS", shard_tokens)
        patch.setattr(lm_score, "pair_answers", spy)
        patch.setattr(lm_score.Scratch, "finish", spy_finish)
        lm_score.score_documents(docs).count()
    return seen["sent"], seen["plan"]


def test_what_is_sent_does_not_grow_with_the_shards(spark, monkeypatch):
    words = np.random.default_rng(3).zipf(1.2, 600_000) % 40_009
    docs = spark.createDataFrame([(i, " ".join(f"w{w}" for w in words[1500 * i : 1500 * i + 1500])) for i in range(400)], "doc_id long, text string")
    monkeypatch.setattr(lm_score, "PART_TOKENS", 300_000)
    few, plan = sent_and_plan(docs, monkeypatch, 200_000)
    many, _ = sent_and_plan(docs, monkeypatch, 20_000)
    assert many < 1.25 * few
    assert plan.count("Exchange hashpartitioning(part") == 1  # the answers; the parts stay where they lie


def test_rare_words_and_contexts(spark, listed, monkeypatch):
    """Words at the threshold, words of held-out texts alone, and n-grams of them; each in parts and shards of its own."""
    trained, held = [i for i in range(200) if fold(i)], [i for i in range(200) if not fold(i)]
    rows = [(trained[0], "once twice here"), (trained[1], "twice here apart"), (trained[2], "Apart"), (trained[3], None), (held[0], "unseen twice here twice unseen twice"),
            (held[0], "once twice here"), (None, "here apart"), (trained[0], "once twice here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert_right(listed, docs)
    monkeypatch.setattr(lm_score, "PART_TOKENS", 2)
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 1)
    assert_right(listed, docs)
    assert_right(listed, docs, ngram_share=0.15)


def test_no_training_rows(spark):
    doc = next(i for i in range(1000) if fold(i) == 0)
    row = lm_score.score_documents(spark.createDataFrame([(doc, "a b")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.base_score == row.score == 0.0


def test_each_context_adds_up_to_one():
    rng = np.random.default_rng(2)
    hashes, counts = np.arange(1, 6, dtype=np.uint64) * np.uint64(1 << 40), np.array([50, 40, 30, 20, 10])
    key2 = np.unique(rng.integers(0, 36, 14)).astype(np.uint64)
    key2 = key2[key2 % np.uint64(6) < 5]
    trie = lm_score.Trie(lm_score.Trie.build(150, 5, hashes, counts, (key2, np.full(len(key2), 3)), starts=20))
    ids = np.arange(5)
    for context in range(6):
        total = sum(10 ** trie.scores(ids[i : i + 1], np.array([context]))[0] for i in range(5))
        assert abs(total - (150.5 / 150.6)) < 0.02


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=60, unique=True), st.integers(0, 63))
def test_elias_fano_finds_what_it_holds(values, shift):
    values = sorted({v >> shift for v in values})
    held = lm_score.EliasFano(np.frombuffer(lm_score.EliasFano.build(np.array(values, np.uint64)), np.uint8))
    probe = np.array(values + [v + 1 for v in values if v < (1 << 64) - 1] + [0, 1, (1 << 64) - 1], np.uint64)
    want = [values.index(v) if v in values else -1 for v in probe.tolist()]
    assert held.find(probe).tolist() == want


def test_the_trie_is_compact():
    values = np.sort(np.random.default_rng(1).choice(1 << 30, 100_000, replace=False)).astype(np.uint64)
    assert len(lm_score.EliasFano.build(values)) < 100_000 * 16 / 8
