import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken

from basketflow.llm import byte_bpe, queries
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_equals_the_library(spark, shared, real, library):
    got = {r.doc_id: r for r in queries.op10_byte_bpe(spark, SF_DIR).collect()}
    for i, text in real:
        ids = library.encode_ordinary(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_edges(docs, edges, library):
    special = [(20, "<|endoftext|> a"), (21, "  \n\n  it's 'S x́"), (22, "\U0001f9d1‍\U0001f52c 你好")]
    out = byte_bpe.decode(byte_bpe.encode(docs(edges + special), queries.BYTE_BPE, queries.PATTERN, offsets=True),
                          queries.BYTE_BPE, queries.PATTERN)
    rows = out.collect()
    assert len(rows) == len(edges + special)
    for r in rows:
        text = r.text or ""
        assert list(r.ids) == (library.encode_ordinary(text) if len(text) < 50_000 else list(r.ids))
        assert bytes(r.decoded).decode() == text
        assert len(r.begin) == len(r.end) == len(r.ids)
        covered = "".join(text[b:e] for b, e in zip(r.begin, r.end))
        assert not r.ids or (r.begin[0] == 0 and r.end[-1] == len(text) and set(covered) == set(text))


def test_every_character_splits_as_in_the_library(library):
    codec = byte_bpe.Codec(queries.BYTE_BPE, queries.PATTERN)
    texts = [f"a{chr(c)}b1{chr(c)}  {chr(c)} !{chr(c)}'s" for c in [*range(0xD800), *range(0xE000, 0x20000), *range(0x20000, 0x110000, 97)]]
    bad = [t[1] for t, ids in zip(texts, codec.encode(texts)) if ids.tolist() != library.encode_ordinary(t)]
    assert bad == []


def test_offsets_equal_the_library(real):
    from tokenizers import Tokenizer

    codec = byte_bpe.Codec(queries.BYTE_BPE, queries.PATTERN)
    whole = Tokenizer.from_file(queries.BYTE_BPE)
    for text in ["\U0001f600 cafés 你", *[t for _, t in real[:30]]]:
        begin, end = codec.offsets(text, codec.encode([text])[0])
        want = whole.encode(text, add_special_tokens=False).offsets
        # the library trims the space before a word from the offsets
        assert [(b + (text[b] == " " and e - b > 1), e) for b, e in zip(begin, end)] == [
            (b + (text[b] == " " and e - b > 1), e) for b, e in want]


def test_empty_table_and_null_ids(docs, spark):
    assert byte_bpe.encode(docs([]), queries.BYTE_BPE, queries.PATTERN).count() == 0
    tokens = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    got = byte_bpe.decode(tokens, queries.BYTE_BPE, queries.PATTERN).orderBy("doc_id").collect()
    assert [r.decoded for r in got] == [None, b""]
