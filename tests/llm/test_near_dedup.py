import random
import re

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import near_dedup


def sets_of(rows):
    out = []
    for r in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    return out


def brute(rows, percent=85):
    sets = sets_of(rows)
    where = {}
    for i, s in enumerate(sets):
        for g in s:
            where.setdefault(g, []).append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = {(a, b) for ids in where.values() for k, a in enumerate(ids) for b in ids[k + 1 :]}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for i, r in enumerate(rows):
        ids = [x for x in (least.get(root(i)), r["doc_id"]) if x is not None]
        least[root(i)] = min(ids, default=None)
    out = []
    for i, r in enumerate(rows):
        c = least[root(i)]
        out.append({"doc_id": r["doc_id"], "n_shingles": len(sets[i]), "component_id": c, "kept": r["doc_id"] == c})
    return out


def assert_right(listed, docs):
    rows = listed(docs.select("doc_id", "text"))
    assert listed(near_dedup.near_duplicates(docs)) == sorted(brute(rows), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, repr(r)))


def family(seed, size, words, edits, start):
    """An original and copies with some words changed, chained: each from a random earlier one."""
    rng = random.Random(seed)
    texts = [[f"v{rng.randrange(5000)}" for _ in range(words)]]
    while len(texts) < size:
        t = list(rng.choice(texts))
        for _ in range(rng.randrange(edits + 1)):
            t[rng.randrange(words)] = f"n{rng.randrange(10**6)}"
        texts.append(t)
    return [(start + i, " ".join(t)) for i, t in enumerate(texts)]


def test_whole_table(spark, listed):
    assert_right(listed, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_odd_rows(listed, odd, nothing):
    assert_right(listed, odd)
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_chains_and_groups_without_a_common_centre(spark, listed, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 20)
    rows = []
    for k, (size, words, edits) in enumerate([(60, 200, 6), (60, 60, 2), (40, 12, 1), (80, 400, 20), (30, 1000, 30)]):
        rows += family(k, size, words, edits, 1000 * k)
    assert_right(listed, spark.createDataFrame(rows, "doc_id long, text string"))


def test_one_of_each(listed, odd, documents):
    kept = near_dedup.one_of_each(documents)
    assert kept.columns == documents.columns
    assert kept.count() == near_dedup.near_duplicates(documents).filter("kept").count()
    left = near_dedup.one_of_each(odd)
    assert left.columns == odd.columns and left.filter("doc_id in (6, 7, 8)").count() == 0


def test_one_of_each_by_row(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(5, a), (None, a), (None, b), (None, None), (None, c), (None, c), (7, b + " end"), (8, d), (8, d), (9, a), (9, c + " end"), (10, None), (10, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _row", "2 AS _key", "3 AS _gone", "4 AS component_id").repartition(3)
    left = near_dedup.one_of_each(df)
    assert left.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    assert got == sorted([(5, a), (7, b + " end"), (8, d), (9, c + " end"), (None, None), (10, None), (10, None)], key=repr)


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(4)
    for true in (0.3, 0.85):
        found = []
        for _ in range(60):
            both = rng.integers(0, 1 << 63, 2000, np.uint64) * np.uint64(2)
            n = int(2000 * true)
            rest = (2000 - n) // 2
            a, b = np.unique(both[: n + rest]), np.unique(np.concatenate([both[:n], both[n + rest :]]))
            j, _ = near_dedup.estimate(near_dedup.registers(a)[None], near_dedup.registers(b)[None])
            found.append(j[0])
        assert abs(np.mean(found) - true) < 0.02


def test_no_pair_at_the_threshold_is_dropped():
    rng = np.random.default_rng(8)
    for union in (7, 20, 60, 150, 400, 1000, 4000):
        for _ in range(150):
            h = rng.integers(0, 1 << 63, union, np.uint64) * np.uint64(2) + np.uint64(1)
            common = -(-union * 85 // 100)
            rest = (union - common) // 2
            a, b = np.unique(h[: common + rest]), np.unique(np.concatenate([h[:common], h[common + rest :]]))
            ra, rb = near_dedup.registers(a)[None], near_dedup.registers(b)[None]
            assert near_dedup.may_link(ra, rb, np.array([len(a) + len(b)]), 0.85)[0]


def test_components(spark):
    from tallyloom.llm.common import Scratch

    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (200, 201), (200, 202), (201, 202)]
    df = spark.createDataFrame(edges, "a long, b long").withColumn("x", F.lit(1)).drop("x")
    got = {r.node: r.component for r in near_dedup.components(df, Scratch(spark, "t"), "c").collect()}
    want = {i: 0 for i in range(1, 41)} | {101: 100, 102: 100, 201: 200, 202: 200}
    assert {k: v for k, v in got.items() if k != v} == want
    assert near_dedup.components(df.filter("a < 0"), Scratch(spark, "t"), "c").count() == 0
