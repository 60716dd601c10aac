import base64
import string

import public_tokenizers
import tiktoken

import corpus_pipeline
from basketflow.llm import exact_dedup, queries
from tests.llm.conftest import SF_DIR
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_ngram_join import brute as groups

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def test_stages_equal_plain_versions(spark, shared, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in docs.collect()}
        pairs = [(i, r.text) for i, r in before.items()]
        if name == "quality":
            assert 0.7 * len(before) < len(after) < len(before)
        elif name == "exact_dedup":
            last = {(t or "").translate(LOWER): i for i, t in sorted(pairs)}
            assert set(after) == set(last.values())
        elif name == "near_dedup":
            assert set(after) == {i for i, _, c in groups(pairs, 5, 80) if i == c}
        elif name == "decontamination":
            assert set(after) == set(before) - {w[0] for w in leaks(pairs, items)}
        else:
            assert {i: list(r.ids) for i, r in after.items()} == {i: library.encode_ordinary(t or "") for i, t in pairs}
            assert all(r.round_trip for r in after.values())
            break
        assert docs.columns == columns and all(after[i] == before[i] for i in after)
        before = after


def test_run_and_query(spark, shared):
    got = queries.QUERIES["pipeline"](spark, SF_DIR)
    assert got.count() == got.select("doc_id").distinct().count() > 100


CLASHES = ["_row", "_hash", "_sha256", "_quality", "_id", "row", "hash", "sha", "order", "quality", "key", "node"]


def test_stages_take_edges(spark, shared, docs, edges, tmp_path):
    """Nulls, repeats and extra columns with inner names: what stays is known row by row."""
    extra = [f"cast(null as string) as `{c}`" if k % 2 else f"'x' as `{c}`" for k, c in enumerate(CLASHES)]
    good = [(20 + k, " ".join(f"the {w}{k} of and to" for w in ("green", "river", "house", "table", "paper", "stone"))) for k in range(3)]
    near = [(None, good[0][1] + " more"), (31, good[0][1])]  # a null identifier in the group of 20, and an exact copy
    for pairs in (edges + good + near, []):
        frame = docs(pairs).selectExpr("doc_id", "text", "cast(null as string) lang", "'s' source", "cast(1 as bigint) n_chars", *extra)
        columns = frame.columns
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES[1:]):
            folder = str(tmp_path / f"{len(pairs)}-{k}")
            stage(spark, frame, SF_DIR).write.parquet(folder)
            frame = spark.read.parquet(folder)
            if name != "byte_bpe":
                assert frame.columns == columns
            kept = sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr) if name != "byte_bpe" else None
            if name == "exact_dedup" and pairs:
                assert kept == sorted(copies_left(pairs), key=repr)
            if name == "near_dedup" and pairs:
                left = copies_left(pairs)
                assert kept == sorted([p for p in left if p[1] != near[0][1]], key=repr)
        assert frame.count() <= len(pairs)
        good_stage = corpus_pipeline.STAGES[0][1](spark, docs(pairs).selectExpr("doc_id", "text", *extra), SF_DIR)
        assert good_stage.columns == ["doc_id", "text", *CLASHES]
        assert good_stage.count() <= len(pairs)


def copies_left(pairs):
    """One row for each text, that of the largest identifier (null lowest)."""
    last = {}
    for i, t in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0)):
        last[(t or "").translate(LOWER)] = (i, t)
    return list(last.values())


def test_rows_equal_in_identifier_and_text_are_chosen_alike(spark, shared):
    rows = [(1, "same", x) for x in "abcdef"] + [(2, "SAME", "z"), (2, "same", "y")]
    first = None
    for seed in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, more string").repartition(seed)
        got = sorted(tuple(r) for r in exact_dedup.drop_copies(docs).collect())
        assert len(got) == 1 and got[0][0] == 2
        docs = spark.createDataFrame(rows[:6], docs.schema).repartition(seed)
        got = sorted(tuple(r) for r in exact_dedup.drop_copies(docs).collect())
        assert first in (None, got) and len(got) == 1
        first = got
