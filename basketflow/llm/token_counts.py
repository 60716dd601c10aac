"""Token counts under a unigram vocabulary, without making the tokens.

Aho-Corasick enumerates the vocabulary's matches in a text; a pass over the characters
carries the best score of each prefix and the number of pieces on that path.  The rules are
those of the public unigram tokenizers: a later candidate replaces an earlier one only when
its score is higher, candidates come in order of their start, a character that is no
piece itself may be unknown at the lowest score minus 10, and an unknown character counts
one token for each of its bytes (byte fallback).  Blanks become U+2581 and one is put in front.

Pieces, scores and kinds come from the vocabulary file as they are.  If no piece holds a
blank after another character, the best path never crosses the start of a word, so each
distinct word is worked out once while a worker remembers it.

Defined results: null and empty texts have no tokens and score 0; other columns pass through.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
# Distinct words that a worker remembers before it starts again.
CACHE = 1_000_000
SLICE = 256
_PAIR = np.dtype([("n", "<i8"), ("score", "<f8")])
_WORKER: dict = {}


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of the ordinary pieces of a SentencePiece model file."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return [(p.piece, p.score) for p in model.pieces if p.type == 1]


class Counter:
    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        inner = any(BLANK in p.lstrip(BLANK) for p, _ in vocabulary)
        cut = "" if any("\n" in p for p, _ in vocabulary) else "\n"
        # chunks between which no piece can lie
        self.chunks = (lambda t: [t]) if inner else re.compile(f"\n|{BLANK}*[^{BLANK}{cut}]+|{BLANK}+").findall
        self.known: dict[str, bytes] = {}

    def best(self, text: str) -> tuple[int, float]:
        """(tokens, score) of the best path through ``text``, as it stands."""
        size = len(text)
        score, tokens = [0.0] * (size + 1), [0] * (size + 1)
        found: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        for end, match in self.automaton.iter(text):
            found[end].append(match)
        for end in range(size):
            top, count, single = None, 0, False
            for length, value in sorted(found[end], reverse=True):
                start = end + 1 - length
                candidate = score[start] + value
                single |= length == 1
                if top is None or candidate > top:
                    top, count = candidate, tokens[start] + 1
            if not single:
                candidate = score[end] + self.unknown
                if top is None or candidate > top:
                    top, count = candidate, tokens[end] + len(text[end].encode("utf-8", "replace"))
            score[end + 1], tokens[end + 1] = top, count
        return tokens[size], score[size]

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        known = self.known
        if len(known) > CACHE:
            known.clear()
        chunks = self.chunks(BLANK + text.replace(" ", BLANK))
        for chunk in set(chunks).difference(known):
            known[chunk] = struct.pack("<qd", *self.best(chunk))
        pairs = np.frombuffer(b"".join(map(known.__getitem__, chunks)), dtype=_PAIR)
        return int(pairs["n"].sum()), float(pairs["score"].sum())


def count_tokens(docs: DataFrame, vocabulary: str, text: str = "text", n_tokens: str = "n_tokens",
                 score: str = "token_score") -> DataFrame:
    """``docs`` plus the number of tokens of each whole text and the score of its best path."""
    kept = [f for f in docs.schema.fields if f.name not in (n_tokens, score)]
    schema = T.StructType([*kept, T.StructField(n_tokens, T.LongType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _WORKER:
            _WORKER[vocabulary] = Counter(read_vocabulary(vocabulary))
        counter = _WORKER[vocabulary]
        for batch in batches:
            found = [counter.count(t or "") for at in range(0, batch.num_rows, SLICE)
                     for t in batch.column(text).slice(at, SLICE).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array([n for n, _ in found], pa.int64()),
                 pa.array([s for _, s in found], pa.float64())], names=[f.name for f in schema])

    return docs.mapInArrow(run, schema)
