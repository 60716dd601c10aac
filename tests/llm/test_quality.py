import numpy as np
import pyarrow as pa

from basketflow.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark, shared):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = queries.op3_quality_classifier(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    table = {(r.quality, r.kept): r["count"] for r in
             got.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    good, bad = table.get((1, True), 0), table.get((0, False), 0)
    assert good / (good + table.get((1, False), 0)) >= 0.97
    assert bad / (bad + table.get((0, True), 0)) >= 0.85


def test_estimation_recovers_the_labellers():
    rng = np.random.default_rng(3)
    n, alarm = 40_000, np.array([0.9, 0.7, 0.5, 0.3])
    good = rng.random(n) < 0.85
    votes = np.where(good[:, None], -(rng.random((n, 4)) < 0.01).astype(int), -(rng.random((n, 4)) < alarm).astype(int))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_labels(patterns, counts.astype(float))
    assert abs(model.prior - 0.85) < 0.02
    assert np.abs(model.votes[:, 0, 0] - alarm).max() < 0.05
    assert np.all(model.votes[:, 1, 0] < 0.02) and np.all(model.accuracy() > 0.8)


def test_edges_pass_through(docs, edges, shared):
    frame = docs(edges + edges[:3])
    scorer, _ = quality.train(frame)
    out = quality.score_documents(frame, scorer)
    rows = out.collect()
    assert len(rows) == len(edges) + 3 and out.columns == [*frame.columns, "score"]
    assert all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.text or "", set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())


def test_empty_table(docs, shared):
    scorer, model = quality.train(docs([]))
    assert quality.score_documents(docs([]), scorer).count() == 0
    assert 0 < model.prior < 1


def test_hashing_stays_inside_rows():
    both = pa.array(["abc abc x", None, "abc"])
    row, bucket, weight = quality.hashed(both)
    for r, text in enumerate(both.to_pylist()):
        _, alone, w = quality.hashed(pa.array([text], pa.string()))
        assert sorted(bucket[row == r].tolist()) == sorted(alone.tolist())
        assert weight[row == r].sum() == w.sum()
