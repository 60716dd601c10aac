"""Byte-level BPE with the tokenizers library over Arrow batches.

A text is split by the vocabulary's pattern; each distinct piece of a batch goes through
the library once and is remembered while the memory of pieces is below ``CACHE`` entries.
Offsets come from the byte lengths of the tokens and a map from bytes to characters; a token
that holds part of a character covers the whole character, as in the library.  Decoding
puts the bytes of the tokens together again: the printable letters of the vocabulary
file are turned back by the reversed byte table, so characters split over tokens are whole.

Defined results: a null text gives no tokens and decodes to empty bytes; null ids decode to
null; strings of special tokens are ordinary text; other columns pass through unchanged.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Distinct pieces that a Python worker remembers before it starts again.
CACHE = 1_000_000
# Rows of one Arrow batch inside the worker, so that few long texts are held at once.
SLICE = 256
# Characters on which the fast splitter and the library agree about letters, digits and
# blanks; a text with any other character is split by the library.
AGREED = "\x00-\u052f\u2000-\u206f\u20a0-\u20bf\u3040-\u3096\u4e00-\u9fef\uac00-\ud7a3\U0001f300-\U0001f64f"
_WORKER: dict = {}


def byte_table() -> dict[str, int]:
    """Letter -> byte of the byte-level vocabulary: printable bytes stand for themselves,
    the others, in order, for the characters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """The vocabulary of one file, loaded once in a worker."""

    def __init__(self, vocabulary: str, pattern: str) -> None:
        import regex
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.tokenizer = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges))
        self.fast = regex.compile(pattern).findall
        self.odd = regex.compile(f"[^{AGREED}]").search
        self.slow = pre_tokenizers.Split(Regex(pattern), "isolated").pre_tokenize_str
        back = byte_table()
        self.letters = {b: ord(c) for c, b in back.items()}
        size = max(model["vocab"].values()) + 1
        spelt = [""] * size
        for token, i in model["vocab"].items():
            spelt[i] = token
        self.lengths = np.array([len(t) for t in spelt], dtype=np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.array([back[c] for c in "".join(spelt)], dtype=np.uint8)
        self.known: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        if not text.isascii() and self.odd(text):
            return [piece for piece, _ in self.slow(text)]
        return self.fast(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text.  Pieces not yet known go through the library in one call."""
        known = self.known
        if len(known) > CACHE:
            known.clear()
        pieces = [self.split(t) for t in texts]
        new = list(set().union(*pieces).difference(known))
        if new:
            spelt = [p.encode("utf-8").decode("latin-1").translate(self.letters) for p in new]
            for p, e in zip(new, self.tokenizer.encode_batch_fast(spelt, add_special_tokens=False)):
                known[p] = array("i", e.ids).tobytes()
        return [np.frombuffer(b"".join(map(known.__getitem__, row)), dtype=np.int32) for row in pieces]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens in a row, and the number of bytes of each token."""
        lengths = self.lengths[ids]
        stop = np.cumsum(lengths)
        total = int(stop[-1]) if len(stop) else 0
        places = np.repeat(self.begins[ids] - (stop - lengths), lengths) + np.arange(total)
        return self.bytes[places], lengths

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last character of each token."""
        raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        stop = np.cumsum(self.lengths[ids])
        begin = stop - self.lengths[ids]
        return char[begin].astype(np.int32), (char[stop - 1] + 1).astype(np.int32)


def _codec(vocabulary: str, pattern: str) -> Codec:
    key = (vocabulary, pattern)
    if key not in _WORKER:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _WORKER[key] = Codec(vocabulary, pattern)
    return _WORKER[key]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def _lists(rows: list, kind: pa.DataType) -> pa.Array:
    sizes = np.array([0, *(len(r) for r in rows)], dtype=np.int64)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(flat, kind))


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", offsets: bool = False,
           ids: str = "ids", begin: str = "begin", end: str = "end") -> DataFrame:
    """``docs`` plus ``ids``, and with ``offsets`` the characters each token covers.

    The text stays when its column is wanted; columns named like a new one are replaced.
    """
    names = [ids, begin, end] if offsets else [ids]
    kept = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType([*kept, *[T.StructField(n, T.ArrayType(T.IntegerType())) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for batch in _slices(batches):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            found = codec.encode(texts)
            columns = [found]
            if offsets:
                places = [codec.offsets(t, i) for t, i in zip(texts, found)]
                columns += [[p[0] for p in places], [p[1] for p in places]]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], *[_lists(c, pa.int32()) for c in columns]],
                names=[f.name for f in schema])

    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, vocabulary: str, pattern: str, ids: str = "ids",
           decoded: str = "decoded") -> DataFrame:
    """``tokens`` plus the bytes of its ids."""
    kept = [f for f in tokens.schema.fields if f.name != decoded]
    schema = T.StructType([*kept, T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for batch in _slices(batches):
            rows = batch.column(ids)
            data, lengths = codec.decode(np.asarray(rows.flatten(), dtype=np.int64))
            ends = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(pc.list_value_length(rows).fill_null(0)))]
            out = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(rows), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
            out = pc.if_else(rows.is_null(), pa.scalar(None, pa.large_binary()), out).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], out], names=[f.name for f in schema])

    return tokens.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids",
               same: str = "round_trip") -> DataFrame:
    """``docs`` without its text, plus ``ids`` and whether their decoding is the text's bytes.

    As ``encode`` and ``decode`` in one worker, so a task holds one codec and no decoded text is sent.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text, ids, same)]
    schema = T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(same, T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary, pattern)
        for batch in _slices(batches):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            found = codec.encode(texts)
            equal = [codec.decode(i)[0].tobytes() == t.encode("utf-8") for t, i in zip(texts, found)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], _lists(found, pa.int32()), pa.array(equal, pa.bool_())],
                names=[f.name for f in schema])

    return docs.mapInArrow(run, schema)


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(F.transform(ids, lambda i: i.cast("string")), " "), 256)
