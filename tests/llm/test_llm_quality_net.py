import zlib

import numpy as np

from tripweave.llm import quality_net as q

SHAPE = "doc_id long, text string"


def auc(scores, labels):
    rank = np.argsort(np.argsort(scores, kind="stable"), kind="stable")
    ones = labels == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")
    out = {r.doc_id: r for r in q.op3_quality_net(docs, labels).collect()}
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in out.items())
    held = [(out[r.doc_id].score, r.quality) for r in labels.collect() if out[r.doc_id].held_out]
    score, label = np.array([x[0] for x in held]), np.array([x[1] for x in held])
    assert auc(score, label) > 0.85 and ((score >= 0.5) == label).mean() > label.mean() - 0.02


def test_chunks_cover_every_window():
    for n in (1, 7, q.CHUNK - 1, q.CHUNK, q.CHUNK + 1, 5 * q.CHUNK + 3):
        data = (np.arange(n) % 251).astype(np.uint8)
        rows = q.chunks_of(data)
        assert rows.shape[1] == q.CHUNK
        whole = np.full((len(rows) - 1) * q._STEP + q.CHUNK, q._PAD)
        for k, row in enumerate(rows):
            whole[k * q._STEP : k * q._STEP + q.CHUNK] = row
        assert (whole[:n] == data).all() and (whole[n:] == q._PAD).all() and len(whole) - n < q.CHUNK
        assert abs(q.weights_of(n, len(rows)).sum() - 1) < 1e-9
    assert len(q.chunks_of(np.empty(0, np.uint8))) == 0


def test_a_score_depends_on_text_alone(spark):
    rng = np.random.default_rng(0)
    net = q.fit([(q.chunks_of(rng.integers(97, 120, 3000).astype(np.uint8)).copy(), q.weights_of(3000, 3)) for _ in range(40)], np.arange(40) % 2, 0.5)
    rows = [(1, None), (2, ""), (3, "x" * 5000), (3, "x" * 5000), (None, "x" * 5000)]
    docs = spark.createDataFrame(rows, SHAPE).selectExpr("*", "'a' as score", "1 as bytes")
    out = q.with_quality(docs, net).collect()
    assert out[0].score == out[1].score and len({r.score for r in out[2:]}) == 1 and out[0].bytes == 1
    assert q.with_quality(docs.where("false"), net).count() == 0


def test_without_both_labels_the_share_stands_for_all(spark):
    usable, hidden = ([k for k in range(1, 30) if (zlib.crc32(str(k).encode()) % 3 == 1) == h] for h in (False, True))
    docs = spark.createDataFrame([(usable[0], "a"), (hidden[0], "b")], SHAPE)
    labels = spark.createDataFrame([(usable[0], 1), (hidden[0], 0), (None, 0), (usable[1], None)], "doc_id long, quality int")
    assert q.train(docs, labels) == 1.0 and q.train(docs, labels.where("false")) == 0.5
    assert {r.score for r in q.op3_quality_net(docs, labels).collect()} == {1.0}
