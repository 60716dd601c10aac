import pytest
from tokenizers import Tokenizer, models
from sentencepiece import sentencepiece_model_pb2 as proto

from basketflow.llm import queries, token_counts
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def library():
    """The same pieces and scores as a unigram model of the tokenizers library (double precision)."""
    model = proto.ModelProto()
    with open(queries.PIECES, "rb") as f:
        model.ParseFromString(f.read())
    return Tokenizer(models.Unigram([(p.piece, p.score) for p in model.pieces], unk_id=0, byte_fallback=True))


def spelt(text):
    return token_counts.BLANK + text.replace(" ", token_counts.BLANK)


def test_query_equals_the_library(spark, shared, real, library):
    got = {r.doc_id: r.n_tokens for r in queries.op6_token_counts(spark, SF_DIR).collect()}
    assert got == {i: len(library.encode(spelt(t)).ids) if t else 0 for i, t in real}


def test_edges(docs, edges, library):
    odd = [(30, "\U0001f9d1‍\U0001f52c  two  blanks "), (31, "▁▁ a▁b"), (32, "\n\n x\ny"), (33, "ééé 你好 \x00")]
    frame = docs(edges + odd)
    out = token_counts.count_tokens(frame, queries.PIECES)
    assert out.columns == [*frame.columns, "n_tokens", "token_score"]
    for r in out.collect():
        assert r.n_tokens == (len(library.encode(spelt(r.text)).ids) if r.text else 0)
    assert token_counts.count_tokens(docs([]), queries.PIECES).count() == 0


def all_paths(text, scores, unknown):
    """Every segmentation of a short text as (score, tokens, lengths)."""
    if not text:
        return [(0.0, 0, ())]
    out = []
    for k in range(1, len(text) + 1):
        head = text[:k]
        if head in scores:
            value, n = scores[head], 1
        elif k == 1:
            value, n = unknown, len(head.encode())
        else:
            continue
        out += [(value + s, n + t, (k, *p)) for s, t, p in all_paths(text[k:], scores, unknown)]
    return out


def test_ties_go_to_the_earliest_start():
    vocabulary = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("é", -2.0), (token_counts.BLANK, -1.0)]
    counter = token_counts.Counter(vocabulary)
    scores = dict(vocabulary)
    for text in ("ab", "aba", "abab", "babab", "xaébax", "abaaba"):
        paths = all_paths(text, scores, counter.unknown)
        top = max(p[0] for p in paths)
        # among the best, the last piece starts earliest, then the piece before it, and so on
        best = max((p for p in paths if p[0] == top), key=lambda p: tuple(reversed(p[2])))
        assert counter.best(text) == (best[1], top)
