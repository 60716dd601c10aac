import hashlib
import string

from pyspark.sql import functions as F

from basketflow.llm import exact_dedup

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        seen = False
        for i in ids:
            kept = i == keep and not seen
            seen |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edges(docs, edges, rows):
    assert rows(exact_dedup.group_copies(docs(edges))) == brute(edges)


def test_real_over_several_batches(docs, real, rows):
    assert rows(exact_dedup.group_copies(docs(real), files_per_batch=1)) == brute(real)


def test_full_texts_decide_when_digests_collide(docs, edges, real, rows):
    pairs = edges + real[:80] + real[:10]
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 1)
    assert rows(exact_dedup.group_copies(docs(pairs), digest=weak)) == brute(pairs)


def test_state_survives_a_restart(spark, shared, tmp_path):
    staged, schema = str(tmp_path / "staged"), "digest string, doc_id long, locator long"
    for part in ([("a", 1, 1), ("b", 2, 2)], [("a", 5, 9), ("c", 3, 3)]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(staged)
        stream = spark.readStream.schema(schema).parquet(staged)
        exact_dedup.stream_groups(stream, str(tmp_path / "checkpoint"), str(tmp_path / "ledger"))
    got = exact_dedup.read_ledger(spark, str(tmp_path / "ledger")).select("digest", "keep.doc_id", "rows").collect()
    assert sorted(map(tuple, got)) == [("a", 5, 2), ("b", 2, 1), ("c", 3, 1)]


def test_drop_copies(docs, edges):
    got = sorted(((r.doc_id, r.text) for r in exact_dedup.drop_copies(docs(edges)).collect()), key=repr)
    texts = [(t or "").translate(LOWER) for _, t in got]
    assert len(texts) == len(set(texts)) == len({(t or "").translate(LOWER) for _, t in edges})
    assert docs([]).columns == exact_dedup.drop_copies(docs([])).columns
    assert exact_dedup.drop_copies(docs([])).count() == 0
