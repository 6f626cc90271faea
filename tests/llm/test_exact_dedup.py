import hashlib
import random

from pyspark.sql import functions as F

from tallyloom.llm import exact_dedup


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["text"] or "", []).append(r["doc_id"])
    out = []
    for r in rows:
        ids = groups[r["text"] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256((r["text"] or "").encode()).hexdigest()
        out.append({"doc_id": r["doc_id"], "keep_id": keep, "group_size": len(ids), "text_sha256": sha, "kept": r["doc_id"] == keep})
    return sorted(out, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, repr(r)))


def test_against_brute_force(listed, documents, odd, nothing):
    for docs in (documents, odd, nothing):
        assert listed(exact_dedup.exact_duplicates(docs)) == brute(listed(docs.select("doc_id", "text")))


def test_different_texts_of_one_digest_stay_apart(listed, odd):
    weak = exact_dedup.exact_duplicates(odd, digest=lambda text: F.sha2(F.substring(text, 1, 1), 256))
    assert listed(weak) == brute(listed(odd.select("doc_id", "text")))


def test_filter_inserts_deletes_and_grows():
    rng = random.Random(5)
    keys = [rng.randbytes(32) for _ in range(5000)]
    index = exact_dedup.CuckooIndex()
    for i, k in enumerate(keys):
        index.add(k, i, 1)
        index.add(k, i + 1, 2)
    assert index.filter.buckets > 64 and index.filter.size == 5000
    assert all(k in index.filter for k in keys)
    for k in keys[:2500]:
        index.delete(k, 3)
    assert len(index.keys) == 2500 and index.filter.size == 2500
    assert all(k in index.filter for k in keys[2500:])
    assert sum(k in index.filter for k in keys[:2500]) < 50
    index.delete(keys[2500])
    assert index.keys[keys[2500]] == (2501, 2)
    index.delete(rng.randbytes(32))


def test_index_takes_more_and_gives_back(spark, documents):
    digests = documents.select("doc_id", F.sha2("text", 256).alias("digest"))
    first, second = digests.filter("doc_id % 2 = 0"), digests.filter("doc_id % 2 = 1")
    both = exact_dedup.index(second, 8, exact_dedup.index(first, 8))
    want = {(r.digest, r.k, r.n) for r in digests.groupBy("digest").agg(F.max("doc_id").alias("k"), F.count("*").alias("n")).collect()}
    assert {(r.digest, r.keep_id, r.group_size) for r in both.collect()} == want
    left = exact_dedup.remove(both, digests.select("digest").limit(20))
    assert left.agg(F.sum("group_size")).first()[0] == documents.count() - 20


def test_the_next_keeper_follows_a_removed_one(spark):
    rows = [("aa", 1), ("aa", 5), ("aa", 9), ("bb", 2), ("bb", 3), ("cc", 4), ("dd", 7), ("dd", 7), ("ee", None), ("ee", 6)]
    digests = spark.createDataFrame(rows, "digest string, doc_id long")
    gone = spark.createDataFrame([("aa", 9), ("bb", 2), ("cc", 4), ("dd", 7), ("ee", 6)], "digest string, doc_id long")
    left = exact_dedup.remove(exact_dedup.index(digests, 4), gone, digests)
    assert {(r.digest, r.keep_id, r.group_size) for r in left.collect()} == {("aa", 5, 2), ("bb", 3, 1), ("dd", 7, 1), ("ee", None, 1)}
