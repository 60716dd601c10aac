"""Words and shingles of Arrow string columns, as arrays of 64-bit numbers.

A word is a run of bytes outside 0x20 and 0x09-0x0D, after lower-casing A-Z.  UTF-8
keeps these bytes out of longer characters, so working on bytes gives the same words as
working on characters.  Equal words have equal numbers; unequal words share one with a
probability of about 2**-64 for each pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLICE_BYTES = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


# Bytes that Spark sends to Python at a time.  Its own default of 64 MB, held a few times over by each
# of an executor's tasks on both sides, is much of a small executor.
# The driver keeps a text of every plan it has run, of any length by default.
SMALL = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20), "spark.sql.maxPlanStringLength": "10000"}


def small_batches(spark: SparkSession) -> None:
    """Let the session send texts in small batches and keep short plan texts, unless it was started with sizes of its own."""
    for setting, value in SMALL.items():
        if spark.sparkContext.getConf().get(setting) is None:
            spark.conf.set(setting, value)


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, made longer until no column has it (names are compared as Spark does, without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character unchanged."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1), kept for the next call."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        out = np.full(max(n, 2 * SLICE_BYTES), base, dtype=np.uint64)
        out[:1] = 1
        _POWERS[base] = np.cumprod(out, dtype=np.uint64)
    return _POWERS[base][:n]


def slices(batches: Iterable[pa.RecordBatch], column: int | str) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about SLICE_BYTES of text in ``column``; a longer text is alone.

    The arrays made from a part take some tens of bytes for each of its bytes.
    """
    for batch in batches:
        size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


@dataclass
class Words:
    """``number``, ``row`` (of the column), ``start`` and ``end`` (bytes in ``data``) of each word."""

    number: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    rows: int

    def first_of_row(self) -> np.ndarray:
        """Index of each row's first word, and the number of words at the end."""
        return np.searchsorted(self.row, np.arange(self.rows + 1))


def words(texts: pa.Array, gap: np.ndarray = _SPACE) -> Words:
    """All words of a string column; a null has none.  ``gap`` marks the bytes that are in no word."""
    texts = pa.array(texts.cast(pa.large_string()).fill_null(""))
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    raw = np.frombuffer(buffer, dtype=np.uint8) if buffer else np.empty(0, np.uint8)
    data = _LOWER[raw[offsets[0]:offsets[-1]]] if len(offsets) else raw[:0]
    bounds = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    none = np.empty(0, np.int64)
    if not len(data):
        return Words(np.empty(0, np.uint64), none, none, none, data, len(texts))
    inside = ~gap[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=total[1:])
    number = (total[end] - total[start]) * _powers(_BASE_INVERSE, len(data))[start]
    number = mix(number + (end - start).astype(np.uint64))
    return Words(number, np.searchsorted(bounds, start, side="right") - 1, start, end, data, len(texts))


def shingles(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) of every run of ``width`` words inside a row, in order, with repeats.

    A row with fewer words has its whole sequence as one shingle; a row without words none.
    """
    count = len(found.number)
    first = found.first_of_row()
    lengths = np.diff(first)
    out = np.zeros(count, dtype=np.uint64)
    take = np.zeros(count, dtype=bool)
    for size in range(1, width + 1):
        n = count - size + 1
        if n <= 0:
            break
        same = found.row[:n] == found.row[size - 1:] if size > 1 else np.ones(n, dtype=bool)
        here = np.flatnonzero(same & ((lengths[found.row[:n]] == size) if size < width else True))
        value = np.full(len(here), size, dtype=np.uint64)
        for k in range(size):
            value = mix(value * np.uint64(0xD6E8FEB86659FD93) + found.number[here + k])
        out[here], take[here] = value, True
    return found.row[take], out[take]
