import zlib

import numpy as np

from tallyloom.llm import quality_model


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in quality_model.scored_documents(docs, labels).collect()}
    assert len(got) == docs.count()
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(held) > 50 and all(zlib.crc32(str(i).encode()) % 4 == 2 for i, r in got.items() if r.held_out)
    assert np.mean([r.predicted == q for r, q in held]) >= 0.95
    good, bad = [r.score for r, q in held if q], [r.score for r, q in held if not q]
    assert np.mean([g > b for g in good for b in bad]) >= 0.97
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_have_no_influence(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    assert np.array_equal(quality_model.train(documents, labels), quality_model.train(documents, flipped))


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 0, 1), (7, None, 0), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, text int")
    rows = quality_model.scored_documents(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert quality_model.scored_documents(nothing, labels).count() == 0
    assert {r.score for r in quality_model.scored_documents(odd, labels.limit(0)).collect()} == {0.5}


def test_bounded_sample(documents, spark):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    assert np.any(quality_model.train(documents, labels, max_rows=20) != quality_model.train(documents, labels))


def test_updates_follow_the_leader():
    """One coordinate against the closed form of the proximal step."""
    model = quality_model.FollowTheLeader(alpha=0.3, beta=1.0, l1=0.1, l2=0.2)
    z = n = 0.0
    for label in (1, 1, 0, 1):
        w = 0.0 if abs(z) <= 0.1 else -(z - np.sign(z) * 0.1) / ((1 + n**0.5) / 0.3 + 0.2)
        assert np.isclose(model.weights(np.array([7]))[0], w)
        g = 1 / (1 + np.exp(-w)) - label
        z, n = z + g - ((n + g * g) ** 0.5 - n**0.5) / 0.3 * w, n + g * g
        model.update(np.array([7]), np.array([1.0]), label)


def test_the_mean_is_of_the_models_that_had_rows(spark):
    """One labelled row trains one shard's model: the mean is that model, in however many partitions the rows lie."""
    docs = spark.createDataFrame([(1, "good words here")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    model = quality_model.FollowTheLeader()
    for _ in range(quality_model.EPOCHS):
        model.update(*quality_model.features(b"good words here"), 1)
    expected = model.weights(np.arange(quality_model.DIM))
    assert expected.any()
    for partitions in (1, 13):
        assert np.allclose(quality_model.train(docs.repartition(partitions), labels, held_out_remainder=-1), expected)
