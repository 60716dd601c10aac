import math
import random
import re
from collections import Counter

import pytest

from basketflow.llm import queries, search
from checks import compare
from tests.llm.conftest import SF_DIR


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, best=10):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    length = [sum(c.values()) for _, c in held]
    whole = sum(length)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for (i, c), n in zip(held, length):
            m = 25 + (75 * n * len(held)) // whole
            score = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scored)[:best], 1)]
    return sorted(out, key=repr)


def found(frame):
    assert [f.dataType.simpleString() for f in frame.select("rank", "score").schema] == ["int", "bigint"]
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect()), key=repr)


@pytest.fixture
def items(spark):
    def make(pairs):
        rows = [(i, t, "q", 1, 2, "n") for i, t in pairs]
        return spark.createDataFrame(rows, "item_id long, text string, query string, term int, block int, name string").repartition(2)
    return make


@pytest.mark.parametrize("at_once", [search.LEAVES, 40])
def test_small_tables_match_brute_force(docs, items, edges, shared, at_once):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(40)] + ["Straße", "été", "É", "a1b2"]
    pairs = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(1, 60)))) for k in range(100, 300)]
    pairs += [(400 + k % 7, "w1 w2 w3 w3") for k in range(60)] + edges  # a group of copies with repeated identifiers
    asked = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(1, 25)))) for k in range(30)]
    asked += [(50, "w1 w1 w2"), (51, None), (52, ""), (53, "!?"), (54, "nowhere"), (None, "w4 W5"), (2, "word3 and same")]
    assert found(search.search(docs(pairs), items(asked), leaves_at_once=at_once)) == brute(pairs, asked)


def test_repeated_queries_are_each_ranked(docs, items, shared):
    got = search.search(docs([(1, "a b"), (2, "a"), (3, "c")]), items([(1, "a"), (1, "a")])).collect()
    assert sorted((r.item_id, r.rank, r.doc_id) for r in got) == [(1, 1, 2), (1, 1, 2), (1, 2, 1), (1, 2, 1)]


def test_empty_tables(docs, items, shared):
    assert search.search(docs([(1, "a")]).where("false"), items([(1, "a")])).count() == 0
    assert search.search(docs([(1, "a b"), (2, "c")]), items([(1, "a")]).where("false")).count() == 0


def test_shared_nodes_are_evaluated_once(spark, items, shared, tmp_path):
    same = " ".join(f"w{k}" for k in range(16))
    table = search.query_terms(items([(k, f"{same} own{k}") for k in range(20)]), "item_id", "text")
    table.withColumn("block", search.F.lit(0)).write.parquet(f"{tmp_path}/terms")
    leaves, nodes, roots = search.share_graph(spark.read.parquet(f"{tmp_path}/terms"), f"{tmp_path}/graph")
    assert roots.count() == 20
    assert leaves.select("place").distinct().count() == 21  # the 16 shared terms are one atom
    inner = nodes.where("left is not null and right is not null")
    assert inner.count() <= 2 * 20


def test_query_matches_sql(spark, shared):
    con = compare.connect(SF_DIR)
    assert compare.compare(spark, con, SF_DIR, queries.op11_ranked_search, queries.ORACLES["op11_ranked_search"]) is None
