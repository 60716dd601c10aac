import random
import re

import pytest

from basketflow.llm import ngram_join, queries
from tests.llm.conftest import SF_DIR


def shingle_set(text, width):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    size = min(width, len(found))
    return frozenset(tuple(found[i:i + size]) for i in range(len(found) - size + 1))


def brute(pairs, width, percent):
    sets = [shingle_set(t, width) for _, t in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    postings = {}
    for k, s in enumerate(sets):
        for other in {o for t in s for o in postings.get(t, ())}:
            both = len(s & sets[other])
            if 100 * both >= percent * (len(s) + len(sets[other]) - both):
                root[find(k)] = find(other)
        for t in s:
            postings.setdefault(t, []).append(k)
    least = {}
    for k, (i, _) in enumerate(pairs):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted([(i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(pairs)], key=repr)


def near_copies(seed, groups, size, words, edits):
    """Copies of copies: each member changes a few words of an earlier one."""
    rng = random.Random(seed)
    pairs = []
    for _ in range(groups):
        made = [rng.choices(range(1000), k=rng.choice(words))]
        for _ in range(size - 1):
            copy = list(rng.choice(made[:1] if rng.random() < 0.6 else made))
            for _ in range(rng.choice(edits)):
                at = rng.randrange(len(copy))
                copy[at:at + rng.choice([0, 1, 1])] = rng.choices(range(3000), k=rng.choice([0, 1, 1]))
                copy = copy or [1]
            made.append(copy)
        pairs += [(len(pairs) + k, " ".join(f"w{w}" for w in m)) for k, m in enumerate(made)]
    rng.shuffle(pairs)
    return pairs


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_edges_and_real(docs, edges, real, rows, width, percent):
    pairs = [(i if i is None else i + 100_000, t) for i, t in edges] + real
    assert rows(ngram_join.group_similar(docs(pairs), width=width, percent=percent)) == brute(pairs, width, percent)


@pytest.mark.parametrize("width,percent,bucket", [(3, 90, 5), (5, 80, 100), (3, 90, 100)])
def test_large_group_of_near_copies(docs, rows, monkeypatch, width, percent, bucket):
    pairs = near_copies(1, 1, 250, [150], [1, 2, 3, 4, 6]) + [
        (i + 1000, t) for i, t in near_copies(2, 12, 12, [4, 8, 30, 400], [0, 1, 2, 5, 12])]
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)
    monkeypatch.setattr(ngram_join, "SMALL", bucket // 4)
    assert rows(ngram_join.group_similar(docs(pairs), width=width, percent=percent)) == brute(pairs, width, percent)


def test_query_on_real_table(spark, shared, real, rows):
    assert rows(queries.op5_ngram_jaccard_join(spark, SF_DIR), "doc_id", "n_shingles", "component_id") == brute(real, 3, 90)


def test_one_document_of_each_group_stays(docs, edges, rows):
    pairs = near_copies(3, 4, 10, [60], [0, 1, 2]) + [(i if i is None else i + 1000, t) for i, t in edges]
    groups = brute(pairs, 5, 80)
    kept = ngram_join.drop_similar(docs(pairs))
    assert sorted({r.doc_id for r in kept.collect() if r.doc_id is not None}) == sorted(
        {i for i, _, c in groups if i is not None and i == c})
    assert ngram_join.drop_similar(docs([])).count() == 0


def test_null_and_repeated_identifiers_row_by_row(docs):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    near = " ".join([*a.split()[:-1], "other"])
    alone = [(None, "one of its own"), (None, "another text"), (5, "unique under a used id"), (None, None), (None, "")]
    pairs = [(5, a), (None, near), *alone, (None, b), (None, b), (None, b + " more"), (7, c), (7, c), (7, c + " more")]
    for given in (pairs, pairs[::-1]):
        kept = [(r.doc_id, r.text) for r in ngram_join.drop_similar(docs(given)).collect()]
        assert (5, a) in kept and (None, near) not in kept and all(p in kept for p in alone)
        assert len([t for i, t in kept if i is None and t and t.startswith("b0")]) == 1
        assert len([t for i, t in kept if i == 7]) == 1 and len(kept) == 1 + len(alone) + 2


def test_identifiers_that_are_all_null(docs):
    kept = ngram_join.drop_similar(docs([(None, f"text {k % 20} of its own") for k in range(60)]))
    assert sorted(r.text for r in kept.collect()) == sorted({f"text {k} of its own" for k in range(20)})
