"""Benchmark items inside documents: MinHash containment search, verified exactly.

An item is found when at least ``threshold`` of its distinct shingles are shingles of the
document.  Items are partitioned by size (powers of two of their shingle count).  Each
partition has its own sketch length: an item of n shingles is sketched by its
n - ceil(threshold * n) + 1 shingles of smallest hash.  A document that misses no more than the
allowed shingles must hold one of these, so the search loses no item however long the
document is; a banded signature of the whole document would (an item of 16 shingles in a
document of 20,000 words has a Jaccard similarity under 0.001).  Each partition is probed
with the shingles of the whole text, and candidates are counted on the shingles themselves.

Items are sent to the tasks in blocks of at most BLOCK_BYTES of text, one pass over the
documents for each block.

Defined results: words are runs of non-blank characters, A-Z in lower case; an item of
fewer than ``width`` words is one shingle of its own length; an item without words is in no
document; null texts have no words; null identifiers are carried; repeated rows give repeated
matches; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketflow.llm.text import Words, mix, slices, words

WIDTH, THRESHOLD = 5, 0.8
BLOCK_BYTES = 32 << 20
_FOUND = "doc_id long, item_id long, item_shingles long, shared long, containment double"


def _numbers(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, number) of every run of exactly ``width`` words inside a row."""
    n = len(found.number) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(found.row[:n] == found.row[width - 1:])
    value = np.full(len(at), width, dtype=np.uint64)
    for k in range(width):
        value = mix(value * np.uint64(0xD6E8FEB86659FD93) + found.number[at + k])
    return at, value


def _texts(found: Words, at: np.ndarray, width: int) -> set[bytes]:
    """The runs of words themselves, joined by one blank; ``at`` ascends within one row."""
    first, last = int(at[0]), int(at[-1]) + width
    base = int(found.start[first])
    raw = found.data[base:int(found.end[last - 1])].tobytes()
    word = [raw[a:b] for a, b in zip((found.start[first:last] - base).tolist(), (found.end[first:last] - base).tolist())]
    return {b" ".join(word[i:i + width]) for i in (at - first).tolist()}


class Partition:
    """Items of one shingle width and one size class with their sketches."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.items: list[tuple[int | None, set[bytes], int]] = []
        self.postings: dict[int, list[int]] = defaultdict(list)

    def add(self, item_id: int | None, shingles: set[bytes], numbers: np.ndarray, threshold: float) -> None:
        need = math.ceil(threshold * len(numbers) - 1e-9)
        for h in np.sort(numbers)[:len(numbers) - need + 1].tolist():
            self.postings[h].append(len(self.items))
        self.items.append((item_id, shingles, need))

    def freeze(self) -> None:
        self.sketch = np.array(sorted(self.postings), dtype=np.uint64)
        self.gate = np.zeros(1 << 20, dtype=bool)
        self.gate[self.sketch >> np.uint64(44)] = True

    def hits(self, numbers: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.gate[numbers >> np.uint64(44)])
        place = np.searchsorted(self.sketch, numbers[maybe]).clip(max=len(self.sketch) - 1)
        return maybe[self.sketch[place] == numbers[maybe]]


def build_index(items: list[tuple[int | None, str | None]], width: int = WIDTH,
                threshold: float = THRESHOLD) -> list[Partition]:
    parts: dict[tuple[int, int], Partition] = {}
    for item_id, text in items:
        found = words(pa.array([text], pa.string()))
        size = min(width, len(found.number))
        if not size:
            continue
        at, numbers = _numbers(found, size)
        shingles, numbers = _texts(found, at, size), np.unique(numbers)
        key = (size, len(numbers).bit_length())
        parts.setdefault(key, Partition(size)).add(item_id, shingles, numbers, threshold)
    for part in parts.values():
        part.freeze()
    return list(parts.values())


def matches(texts: pa.Array, index: list[Partition]) -> Iterator[tuple[int, int | None, int, int]]:
    """(row, item, shingles of the item, shared) for every item found in a row."""
    found = words(texts)
    runs = {w: _numbers(found, w) for w in {p.width for p in index}}
    sets: dict[tuple[int, int], set[bytes]] = {}
    for part in index:
        at, numbers = runs[part.width]
        if not len(numbers):
            continue
        rows = found.row[at]
        pairs = {(int(rows[i]), k) for i in part.hits(numbers) for k in part.postings[int(numbers[i])]}
        for row, k in sorted(pairs):
            item_id, shingles, need = part.items[k]
            if (row, part.width) not in sets:
                here = at[np.searchsorted(rows, row):np.searchsorted(rows, row, side="right")]
                sets[row, part.width] = _texts(found, here, part.width)
            shared = len(shingles & sets[row, part.width])
            if shared >= need:
                yield row, item_id, len(shingles), shared


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int | None, str | None]]]:
    block, size = [], 0
    for row in benchmark.select(item_id, text).toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1] or "") + 64
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text", width: int = WIDTH,
           threshold: float = THRESHOLD) -> DataFrame:
    """Every (document, item) pair with the item's shingles, those shared and the containment."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], _FOUND)
    columns = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    for block in _blocks(benchmark, item_id, item_text):
        items = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = build_index(items.value, width, threshold)
            for batch in slices(batches, 1):
                rows = list(matches(batch.column(1), index)) if index else []
                ids = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([ids[r[0]] for r in rows], pa.int64()),
                    "item_id": pa.array([r[1] for r in rows], pa.int64()),
                    "item_shingles": pa.array([r[2] for r in rows], pa.int64()),
                    "shared": pa.array([r[3] for r in rows], pa.int64()),
                    "containment": pa.array([r[3] / r[2] for r in rows], pa.float64())})

        out = out.unionByName(columns.mapInArrow(run, _FOUND))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                      item_text: str = "text", width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that hold an item, all columns kept."""
    for block in _blocks(benchmark, item_id, item_text):
        items = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = build_index(items.value, width, threshold)
            for batch in slices(batches, text):
                keep = np.ones(batch.num_rows, dtype=bool)
                for row, *_ in matches(batch.column(text), index) if index else ():
                    keep[row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
