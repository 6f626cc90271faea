from test_near_dedup import brute

import corpus_pipeline


def test_near_stage_links_from_80_percent_on(spark, listed, documents):
    words = [f"w{i}" for i in range(100)]
    other = [f"n{i}" if i in (30, 60) else w for i, w in enumerate(words)]  # 86 of 106 shingles in common
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:70] + other[:30]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_stage(spark, df, "").collect()} == {1, 3}
    want = {r["doc_id"] for r in brute(listed(documents.select("doc_id", "text")), 80) if r["kept"]}
    assert {r.doc_id for r in corpus_pipeline.near_stage(spark, documents, "").collect()} == want
