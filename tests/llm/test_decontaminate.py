import random
import re

import pytest

from basketflow.llm import decontaminate, queries
from tests.llm.conftest import SF_DIR


def runs(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    size = min(width, len(words)) if width else len(words)
    return words, {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if size else set()


def brute(pairs, items, width=5, threshold=0.8):
    out = []
    for j, item in items:
        words, want = runs(item, width)
        size = min(width, len(words))
        for i, text in pairs if size else ():
            there = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
            have = {tuple(there[k:k + size]) for k in range(len(there) - size + 1)}
            if len(want & have) >= threshold * len(want) - 1e-9:
                out.append((i, j, len(want), len(want & have), len(want & have) / len(want)))
    return sorted(out, key=repr)


@pytest.fixture
def made():
    rng = random.Random(7)
    vocabulary = [f"w{i}é" if i % 9 == 0 else f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 5, 8, 20, 60])))) for i in range(60)]
    items += [(100, items[5][1]), (101, None), (102, " "), (None, items[6][1])]
    pairs = []
    for i in range(60):
        words = rng.choices(vocabulary, k=rng.choice([0, 4, 50, 3000]))
        for _, item in rng.sample(items, 3):
            part = (item or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                if part:
                    part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        pairs.append((100 + i, "\n".join(words).upper() if i % 3 else " ".join(words)))
    return pairs, items


def test_search_equals_brute_force(spark, docs, edges, made, rows, monkeypatch):
    pairs, items = made
    pairs = pairs + edges
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute(pairs, items)
    assert len(want) > 50
    assert rows(decontaminate.search(docs(pairs), benchmark)) == want
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)  # several passes
    assert rows(decontaminate.search(docs(pairs), benchmark)) == want
    kept = decontaminate.drop_contaminated(docs(pairs), benchmark)
    bad = {w[0] for w in want}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        ((i, t) for i, t in pairs if i not in bad), key=repr)
    assert kept.columns == docs(pairs).columns


def test_query_on_real_tables(spark, shared, real, rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert rows(queries.op2_benchmark_decontamination(spark, SF_DIR)) == brute(real, items)


def test_empty_tables(spark, docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.search(docs([(1, "a")]), nothing).count() == 0
    assert decontaminate.drop_contaminated(docs([(1, "a")]), nothing).count() == 1
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.search(docs([]), some).count() == 0
