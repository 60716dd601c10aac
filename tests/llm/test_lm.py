import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from basketflow.llm import lm, queries

SF = "/root/testdata/sf0.01"


def split(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def brute(pairs):
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % 7 == 2 for i, _ in pairs]
    counts = Counter(w for (_, t), h in zip(pairs, held) if not h for w in split(t))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for (i, t), h in zip(pairs, held):
        score = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in split(t))
        out.append((i, h, len(split(t)), sum(counts[w] > 0 for w in split(t)), total, round(score, 6)))
    return sorted(out, key=repr)


def compare(frame, pairs):
    got = frame.collect()
    rows = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got], key=repr)
    want = brute(pairs)
    assert [r[:5] for r in rows] == [w[:5] for w in want]
    assert np.allclose([r[5] for r in rows], [w[5] for w in want], atol=1e-4)
    return got


@pytest.mark.parametrize("head", [lm.HEAD, 200])
def test_counts_and_base(docs, edges, real, shared, monkeypatch, head):
    monkeypatch.setattr(lm, "HEAD", head)
    pairs = [(i if i is None else i + 100_000, t) for i, t in edges] + real
    compare(lm.score_documents(docs(pairs)), pairs)


def test_held_out_texts_score_above_the_base(spark, shared):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = compare(queries.op4_lm_scoring(spark, SF), pairs)
    for held in (True, False):
        chosen = [r for r in got if r.held_out == held]
        gain = (sum(r.score for r in chosen) - sum(r.base_score for r in chosen)) / sum(r.n_tokens for r in chosen)
        assert gain > 0.05


def test_probabilities_add_up_to_one(spark, docs, real, shared):
    train = docs(real).select("text")
    counts = lm.count_words(train).persist()
    known = lm.vocabulary(counts)
    noise = (known.output_count + 1) / (known.output_count + 1).sum()
    model = lm.train_round(train, known, lm.Model.start(noise), 0)
    table = 10.0 ** model.log_probabilities().astype(float)
    assert np.allclose(table.sum(axis=1), 1, atol=1e-4)
    short = set(known.short.tolist())
    share = Counter()
    for r in counts.where("suffix >= 0").collect():
        if r.word % 2**64 not in short:
            out = 1 + lm.SHORTLIST + r.suffix
            share[out] += (r.n + 1) / (known.output_count[out] + known.class_words[out] + 1)
    for out, total in share.items():  # what is left is the unknown words' share
        assert math.isclose(total + 1 / (known.output_count[out] + known.class_words[out] + 1), 1)
    counts.unpersist()


def test_tokens_end_every_row():
    row, number, suffix, end = lm.tokens(pa.array(["a b", None, "", "C"]))
    assert row.tolist() == [0, 0, 0, 1, 2, 3, 3] and end.tolist() == [False, False, True, True, True, False, True]


def test_empty_table_and_no_training(docs, shared):
    assert lm.score_documents(docs([])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    only = lm.score_documents(docs([(held, "a b")])).collect()
    assert [(r.held_out, r.n_known, r.train_tokens, r.base_score) for r in only] == [(True, 0, 0, 0.0)]
