"""Line deduplication within a small edit distance: a segment-partition join.

Distinct lines are joined when their edit distance is at most ``edits``.  A line of length l is
cut into edits + 1 segments; edits can touch all but one, so a line at that distance holds
one segment unchanged, not far from its place.  Segments are indexed by (length, number,
text); a line probes the indexes of its own and the lengths below with the substrings that can
match (multi-match-aware selection).  A pair is a candidate only if counts of its characters by
class, which one edit changes by two at most, are near enough.  Candidates are verified by a
banded bit-parallel edit distance, many pairs at a time.  Lines within that distance form classes (links
chained); of a class the first line of the smallest document stays.

Defined results: lines are split at line feeds; lines of fewer than ``least`` characters
join no edits, and those of ``shortest`` (1 if not given) and more are grouped by equality; shorter ones, and
always empty ones, are left alone; null and empty texts have no lines to compare.  ``dropped_lines`` speaks of
identifiers: with repeated or null ones a line stays where (doc_id, position) is smallest, nulls first, and of
equal places all stay.  ``strip_lines`` gives every row a key of its own, so that rows with the same identifier
keep their own lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.graph import components, only_wanted
from basketflow.llm.text import slices, unused
from basketflow.session import scratch_dir

EDITS, LEAST = 2, 24
# Characters of the pairs that are verified at a time, padding included; a longer pair is alone.
CELLS = 1 << 18


def cuts(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of edits + 1 segments of nearly equal size, the longer ones last."""
    parts = edits + 1
    short, longer = divmod(length, parts)
    out, at = [], 0
    for k in range(parts):
        size = short + (k >= parts - longer)
        out.append((at, size))
        at += size
    return out


def probes(length: int, target: int, edits: int) -> list[tuple[int, int, int]]:
    """(segment number, start, size) of the substrings of a line that may match a segment of a
    shorter or equal line of ``target`` characters."""
    delta, out = length - target, []
    for k, (at, size) in enumerate(cuts(target, edits)):
        # up to k edits before the segment, up to edits - k after it
        low = max(0, at - k, at + delta - (edits - k))
        high = min(length - size, at + k, at + delta + (edits - k))
        out += [(k, start, size) for start in range(low, high + 1)]
    return out


def distances(first: list[str], second: list[str], edits: int) -> np.ndarray:
    """Edit distance of each pair, or edits + 1 where it is larger.

    Bit-parallel columns over a band of 2 * edits + 1 diagonals, one pair in each element of
    the arrays; a pair leaves when its whole band is above ``edits``.
    """
    out = np.full(len(first), edits + 1, dtype=np.int64)
    size_a = np.array([len(s) for s in first], dtype=np.int64)
    size_b = np.array([len(s) for s in second], dtype=np.int64)
    live = np.flatnonzero(np.abs(size_a - size_b) <= edits)
    if not len(live):
        return out
    width = 2 * edits + 1
    pad = int(max(size_a[live].max(), size_b[live].max())) + width + 1
    a = np.full((len(live), pad + edits), 0x110000, dtype=np.uint32)
    b = np.full((len(live), pad), 0x110001, dtype=np.uint32)
    for k, i in enumerate(live.tolist()):
        a[k, edits:edits + size_a[i]] = np.frombuffer(first[i].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        b[k, :size_b[i]] = np.frombuffer(second[i].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    # bit e of state[d]: diagonal e - edits is reached in this column with at most d edits
    state = [np.full(len(live), sum(1 << (edits + e) for e in range(-d, d + 1)), dtype=np.uint32) for d in range(edits + 1)]
    mask = np.uint32((1 << width) - 1)
    stop = size_b[live]
    for column in range(int(stop.max()) + 1):
        done = stop == column
        if done.any():
            bit = (size_a[live] - size_b[live] + edits).astype(np.uint32)
            for d in range(edits, -1, -1):
                hit = done & ((state[d] >> bit) & 1 == 1)
                out[live[hit]] = d
            left = ~done & (state[edits] != 0)
            live, stop, a, b = live[left], stop[left], a[left], b[left]
            state = [s[left] for s in state]
            if not len(live):
                break
        same = np.zeros(len(live), dtype=np.uint32)
        for e in range(width):
            same |= (a[:, column + e] == b[:, column]).astype(np.uint32) << np.uint32(e)
        after = []
        for d in range(edits + 1):
            # along a diagonal by equal characters, or with one more edit: replaced, or only in b (one diagonal down)
            reach = state[d] & same
            if d:
                reach |= state[d - 1] | (state[d - 1] >> np.uint32(1))
                # only in a: one diagonal up inside the new column
                reach |= (after[d - 1] << np.uint32(1)) & mask
            after.append(reach)
        state = after
    return out


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    parts = F.split(F.coalesce(docs[text], F.lit("")), "\n", -1)
    return docs.select(docs[doc_id].alias("doc_id"), F.posexplode(parts).alias("place", "line"))


def sketches(lines: list[str]) -> np.ndarray:
    """Counts of the characters of each line in 16 classes, modulo 16, packed into 64 bits."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32) & 15
    row = np.repeat(np.arange(len(lines)), [len(t) for t in lines])
    count = np.bincount(row * 16 + codes, minlength=16 * len(lines)).reshape(-1, 16).astype(np.uint64) & np.uint64(15)
    return (count << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64).astype(np.int64)


def _alike(a: str, b: str, edits: int) -> str:
    """SQL: the packed counts differ by at most two for each edit."""
    def apart(k: int) -> str:
        d = f"pmod((shiftrightunsigned({a}, {4 * k}) & 15) - (shiftrightunsigned({b}, {4 * k}) & 15), 16)"
        return f"least({d}, 16 - {d})"

    return f"({' + '.join(apart(k) for k in range(16))}) <= {2 * edits}"


def _keys(lines: DataFrame, edits: int) -> DataFrame:
    """(key, probe, line, sketch): index entries and probes of each distinct line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        plan: dict[int, tuple[list, list]] = {}
        digest = xxhash.xxh64_intdigest
        for batch in slices(batches, 1):
            keys, probe, times = [], [], []
            texts = batch.column(1).to_pylist()
            for line in texts:
                n = len(line)
                if n not in plan:
                    plan[n] = ([(at, at + size, n * 8 + k) for k, (at, size) in enumerate(cuts(n, edits))],
                               [(at, at + size, m * 8 + k) for m in range(max(n - edits, edits + 1), n + 1)
                                for k, at, size in probes(n, m, edits)])
                index, search = plan[n]
                if line.isascii():
                    raw = line.encode()
                    keys += [digest(raw[a:b], seed) for a, b, seed in index]
                    keys += [digest(raw[a:b], seed) for a, b, seed in search]
                else:
                    keys += [digest(line[a:b].encode("utf-8", "surrogatepass"), seed) for a, b, seed in index]
                    keys += [digest(line[a:b].encode("utf-8", "surrogatepass"), seed) for a, b, seed in search]
                probe += [False] * len(index) + [True] * len(search)
                times.append(len(index) + len(search))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(keys, dtype=np.uint64).astype(np.int64)), pa.array(probe, pa.bool_()),
                 pa.array(np.repeat(batch.column(0).to_numpy(), times)), pa.array(np.repeat(sketches(texts), times))],
                names=["key", "probe", "line", "sketch"])

    return lines.select("number", "line").mapInArrow(run, "key long, probe boolean, line long, sketch long")


def _verified(pairs: DataFrame, edits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # pairs of like lengths together, so that little is padded and long ones are few at a time
            size = np.maximum(*[pc.utf8_length(batch.column(c)).to_numpy() for c in (2, 3)]).astype(np.int64)
            order = np.argsort(size, kind="stable")
            batch, at = batch.take(pa.array(order)), 0
            size = size[order]
            while at < len(size):
                fits = (np.arange(1, 513) * size[at:at + 512] if at + 512 <= len(size)
                        else np.arange(1, len(size) - at + 1) * size[at:]) <= CELLS
                step = max(1, int(fits.sum()))
                part = batch.slice(at, step)
                near = distances(part.column(2).to_pylist(), part.column(3).to_pylist(), edits) <= edits
                yield part.select([0, 1]).filter(pa.array(near))
                at += step

    return pairs.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def line_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS,
                 least: int = LEAST, shortest: int = 1) -> DataFrame:
    """(number, keeper): for every distinct line with a class of its own the place that stays.

    ``number`` is the 64-bit hash of the line, ``keeper`` the struct (doc_id, place).  Lines of
    ``shortest`` to ``least`` - 1 characters are grouped by equality alone.
    """
    if least <= edits or edits > 7:
        raise ValueError("lines must be longer than the edits, and at most 7 edits are allowed")
    spark = docs.sparkSession
    root = scratch_dir(spark, "line-dedup")
    places = _lines(docs, doc_id, text).where(F.char_length("line") >= max(1, min(shortest, least)))
    distinct = places.groupBy("line").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
    distinct.withColumn("number", F.xxhash64("line")).write.parquet(f"{root}/lines")
    lines = spark.read.parquet(f"{root}/lines")
    keys = _keys(lines.where(F.char_length("line") >= least), edits)
    index, probe = keys.where(~F.col("probe")), keys.where("probe")
    found = (index.select("key", F.col("line").alias("a"), F.col("sketch").alias("sa"))
             .join(probe.select("key", F.col("line").alias("b"), F.col("sketch").alias("sb")), "key")
             .where("a <> b").where(_alike("sa", "sb", edits)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found.write.parquet(f"{root}/candidates")
    found = spark.read.parquet(f"{root}/candidates")
    wanted = found.select(F.col("a").alias("number")).unionByName(found.select(F.col("b").alias("number"))).distinct()
    only_wanted(lines.select("number", "line"), wanted, "number").write.parquet(f"{root}/texts")
    texts = spark.read.parquet(f"{root}/texts")
    pairs = (found.join(texts.select(F.col("number").alias("a"), F.col("line").alias("ta")), "a")
             .join(texts.select(F.col("number").alias("b"), F.col("line").alias("tb")), "b"))
    links = components(_verified(pairs, edits))
    classed = (lines.select("number", "first", "n").join(links.withColumnRenamed("id", "number"), "number", "left")
               .withColumn("class", F.coalesce("component", "number")))
    keepers = classed.groupBy("class").agg(F.min("first").alias("keeper"), F.sum("n").alias("lines"))
    keepers.where("lines > 1").write.parquet(f"{root}/keepers")
    keepers = spark.read.parquet(f"{root}/keepers")
    out = classed.select("number", "class").join(keepers, "class").select("number", "class", "keeper")
    out.write.parquet(f"{root}/classes")
    return spark.read.parquet(f"{root}/classes")


def dropped_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS,
                  least: int = LEAST, shortest: int = 1) -> DataFrame:
    """One row per identifier: doc_id, n_lines, n_dropped, dropped (places of the lines to drop, ascending)."""
    classes = line_classes(docs, doc_id, text, edits, least, shortest)
    places = _lines(docs, doc_id, text)
    marked = places.select("doc_id", "place", F.when(F.char_length("line") >= max(1, min(shortest, least)), F.xxhash64("line")).alias("number"))
    keeper = F.struct("doc_id", "place")
    again = (marked.where("number is not null").join(classes, "number")
             .where(~keeper.eqNullSafe(F.col("keeper"))).select("doc_id", "place"))
    lists = again.groupBy("doc_id").agg(F.array_sort(F.collect_set("place")).alias("dropped"))
    counted = docs.groupBy(docs[doc_id].alias("doc_id")).agg(
        F.sum(F.size(F.split(F.coalesce(docs[text], F.lit("")), "\n", -1))).cast("long").alias("n_lines"))
    lists = lists.withColumnRenamed("doc_id", "_id")
    return counted.join(lists, counted["doc_id"].eqNullSafe(lists["_id"]), "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def strip_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS,
                least: int = LEAST, shortest: int = 1) -> DataFrame:
    """``docs`` without the repeated lines of its texts; of a class the first line of the smallest identifier stays.

    Rows are written with a key of their own (identifier, number) that the lines go by.
    """
    spark = docs.sparkSession
    key, cut = unused("line_key", docs.columns), unused("line_cut", docs.columns)
    root = scratch_dir(spark, "strip-lines")
    keyed = docs.withColumn(key, F.struct(docs[doc_id].alias("id"), F.monotonically_increasing_id().alias("row")))
    keyed.write.parquet(f"{root}/keyed")
    keyed = spark.read.schema(keyed.schema).parquet(f"{root}/keyed")
    dropped = dropped_lines(keyed, key, text, edits, least, shortest).where("n_dropped > 0")
    dropped = dropped.select(F.col("doc_id.row").alias(cut), F.col("dropped").alias(f"{cut}_places"))
    joined = keyed.join(dropped, F.col(f"{key}.row") == F.col(cut), "left")
    kept = F.array_join(F.filter(F.split(F.col(text), "\n", -1),
                                 lambda line, at: ~F.array_contains(f"{cut}_places", at)), "\n")
    return joined.withColumn(text, F.when(F.col(cut).isNull(), F.col(text)).otherwise(kept)).select(*docs.columns)
