"""Ranked lexical search of a set of queries, evaluated along a graph that the queries share.

A query is the sum of its leaves; a leaf is a term with its number of repeats.  Leaves that the
same queries hold are one atom.  Atoms are put in an order that sets those of similar query sets
side by side (minima of hashes of the queries that hold them), and the order is cut into blocks of
2, 4, 8, ... atoms.  What a query holds of a block is a node, named by the set of its atoms: queries
with the same atoms there share it.  A node is the sum of its two halves, so the nodes of all
queries form one graph whose roots are the queries.  All of this is grouping and joining in
Spark, linear in the queries' terms (times the number of levels).

Documents are read once into postings: their length and the counts of terms that may be in a
query (a bitmap of fixed size).  A task then works on a few documents at a time: it adds up the
atoms, every node once from its halves, and keeps the best documents of each query.  Scores are 64-bit
integers.  The graph is sent to the tasks in blocks of queries of at most LEAVES leaves (a single
longer query is a block of its own), and the postings are read once for each block.

Defined results: terms are runs of ASCII letters, digits and all characters beyond ASCII, A-Z in lower case;
null and empty texts have no terms, neither match nor count; a query without terms has no rows; every
row of a table is a document or a query of its own, also where identifiers repeat; of equal
scores the smallest identifier comes first, null last; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.llm.graph import bitmap, may_hold
from basketflow.llm.text import slices, small_batches, words
from basketflow.session import scratch_dir

BEST = 10
LEAVES = 1 << 15
# Sums that a task holds at a time (node x document).
CELLS = 1 << 21
# Numbers kept in a task before they are added up and sent on.
WINDOW = 1_000_000

_GAP = np.zeros(256, dtype=bool)
_GAP[:0x30] = _GAP[0x3A:0x41] = _GAP[0x5B:0x61] = _GAP[0x7B:0x80] = True


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of the distinct terms of each text, and the number of all its terms."""
    found = words(texts, _GAP)
    order = np.lexsort((found.number, found.row))
    row, number = found.row[order], found.number[order]
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (number[1:] != number[:-1]))) if len(row) else row
    count = np.diff(np.append(first, len(row)))
    return row[first], number[first].view(np.int64), count, np.bincount(row, minlength=found.rows)


def query_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(query, id, term, repeats): a row for each distinct term of each query; ``query`` numbers the rows."""
    rows = items.select(F.monotonically_increasing_id().alias("query"), items[item_id].alias("id"),
                        F.coalesce(items[text], F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            row, term, count, _ = _terms(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(term), pa.array(count)],
                names=["query", "id", "term", "repeats"])

    return rows.mapInArrow(run, f"query long, id {dict(rows.dtypes)['id']}, term long, repeats long")


def postings(docs: DataFrame, doc_id: str, text: str, wanted: np.ndarray) -> DataFrame:
    """(id, n, terms, counts): length and wanted terms of each document that has a term."""
    rows = docs.select(docs[doc_id].alias("id"), docs[text].alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row, term, count, n = _terms(batch.column(1))
            keep = may_hold(sent.value, pa.array(term)).to_numpy(zero_copy_only=False)
            cuts = pa.array(np.append(0, np.cumsum(np.bincount(row[keep], minlength=len(n)))), pa.int32())
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.ListArray.from_arrays(cuts, pa.array(term[keep])),
                 pa.ListArray.from_arrays(cuts, pa.array(count[keep], pa.int32()))], names=["id", "n", "terms", "counts"])
            yield out.filter(pa.array(n > 0))

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, n long, terms array<long>, counts array<int>")


def document_counts(held: DataFrame) -> DataFrame:
    """(term, df): in how many documents of the postings a term occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def counted() -> pa.RecordBatch:
            term, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(term), pa.array(n)], names=["term", "df"])

        for batch in batches:
            parts.append(batch.column(0).flatten().to_numpy())
            size += len(parts[-1])
            if size > WINDOW:
                yield counted()
                parts, size = [], 0
        if size:
            yield counted()

    return held.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def share_graph(terms: DataFrame, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The shared graph of the queries in ``terms`` (block, query, term, repeats), written below ``root``.

    Leaves (block, term, repeats, place), nodes (block, level, name, queries, left, right, place)
    and roots (block, query, name).  ``place`` is that of an atom, ``name`` a 64-bit name of a set of atoms
    of one span, ``queries`` the number of queries that share it; a half without atoms is null.
    """
    spark = terms.sparkSession
    own = F.xxhash64("query", F.lit(1))
    leaves = terms.groupBy("block", "term", "repeats").agg(
        F.bit_xor(F.xxhash64("query")).alias("holders"), F.count(F.lit(1)).alias("held"),
        F.min(own).alias("low"), F.min(F.xxhash64("query", F.lit(2))).alias("low2"))
    leaves = leaves.withColumn("atom", F.xxhash64("holders", "held", "low", "low2"))
    atoms = leaves.groupBy("block", "atom").agg(F.min("low").alias("low"), F.min("low2").alias("low2"), F.max("held").alias("held"))
    side_by_side = Window.partitionBy("block").orderBy("low", "low2", F.col("held").desc(), "atom")
    atoms = atoms.withColumn("place", F.row_number().over(side_by_side) - 1).select("block", "atom", "place")
    leaves = leaves.join(atoms, ["block", "atom"]).select("block", "term", "repeats", "place")
    leaves.write.parquet(f"{root}/leaves")
    leaves = spark.read.parquet(f"{root}/leaves")
    most = leaves.agg(F.max("place")).first()[0]
    top = int(most or 0).bit_length()
    held = terms.join(leaves, ["block", "term", "repeats"]).select("block", "query", "place").distinct()
    level = F.explode(F.sequence(F.lit(0), F.lit(top)))
    # what a query holds of each block of 2^level atoms, named by its atoms
    parts = held.select("block", "query", "place", level.alias("level"))
    parts = (parts.withColumn("span", F.expr("shiftright(place, level)"))
             .groupBy("block", "level", "span", "query")
             .agg(F.bit_xor(F.xxhash64("place")).alias("name"), F.count(F.lit(1)).alias("size")))
    parts = parts.withColumn("name", F.xxhash64("level", "span", "name", "size"))
    nodes = parts.groupBy("block", "level", "span", "name").agg(F.min("query").alias("query"), F.count(F.lit(1)).alias("queries"))
    half = parts.select("block", (F.col("level") + 1).alias("level"), F.expr("shiftright(span, 1)").alias("up"),
                        "query", (F.col("span") % 2).alias("side"), F.col("name").alias("half"))
    joined = nodes.join(half.withColumnRenamed("up", "span"), ["block", "level", "span", "query"], "left").groupBy(
        "block", "level", "name", "queries").agg(
            F.max(F.when(F.col("side") == 0, F.col("half"))).alias("left"),
            F.max(F.when(F.col("side") == 1, F.col("half"))).alias("right"),
            F.max(F.when(F.col("level") == 0, F.col("span"))).alias("place"))
    joined.write.parquet(f"{root}/nodes")
    parts.where(F.col("level") == top).select("block", "query", "name").write.parquet(f"{root}/roots")
    return leaves, spark.read.parquet(f"{root}/nodes"), spark.read.parquet(f"{root}/roots")


@dataclass
class Graph:
    """One block of queries as arrays; nodes are numbered level by level, those of level 0 are atoms."""

    term: np.ndarray  # of each leaf, ascending
    repeats: np.ndarray
    weight: np.ndarray
    atom: np.ndarray  # node of each leaf
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # (node, left, right)
    roots: np.ndarray  # node of each query
    nodes: int

    def scores(self, row: np.ndarray, term: np.ndarray, count: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Score of every query (rows) on every document (columns)."""
        total = np.zeros((self.nodes, len(m)), dtype=np.int64)
        low, high = np.searchsorted(self.term, term, "left"), np.searchsorted(self.term, term, "right")
        times = high - low
        at = np.repeat(np.arange(len(term)), times)
        leaf = np.repeat(low - np.append(0, np.cumsum(times)[:-1]), times) + np.arange(len(at))
        part = (1_000_000_000 * count[at]) // (1000 * count[at] + 8 * m[row[at]])
        np.add.at(total, (self.atom[leaf], row[at]), self.weight[leaf] * self.repeats[leaf] * part)
        for node, left, right in self.levels:
            total[node] = total[left] + total[right]
        return total[self.roots]


def _graph(block: int, leaves: DataFrame, nodes: DataFrame, roots: DataFrame, weights: DataFrame) -> tuple[Graph, list[int]]:
    """The written graph of one block, and its queries in the order of the roots."""
    mine = F.col("block") == block
    inner = nodes.where(mine).select("level", "name", "left", "right", "place").orderBy("level", "name").toArrow()
    node: dict[int, int] = {}  # by name, which holds the level
    places: dict[int, int] = {}
    levels: dict[int, list[tuple[int, int, int]]] = {}
    count = 0
    for level, name, left, right, place in zip(*[c.to_pylist() for c in inner.columns]):
        if level and (left is None or right is None):
            node[name] = node[right if left is None else left]  # all its atoms are in one half
            continue
        node[name] = count
        if level:
            levels.setdefault(level, []).append((count, node[left], node[right]))
        else:
            places[place] = count
        count += 1
    leaf = leaves.where(mine).join(weights, "term").select("term", "repeats", "w", "place").orderBy("term").toArrow()
    ends = roots.where(mine).select("query", "name").orderBy("query").toArrow()
    return Graph(*[leaf.column(c).to_numpy() for c in ("term", "repeats", "w")],
                 np.array([places[p] for p in leaf.column("place").to_pylist()], dtype=np.int64),
                 [tuple(np.array(levels[k], dtype=np.int64).T) for k in sorted(levels)],
                 np.array([node[n] for n in ends.column("name").to_pylist()], dtype=np.int64), count), ends.column("query").to_pylist()


def best_of_block(held: DataFrame, graph: Graph, queries: list[int], best: int, total_terms: int, documents: int) -> DataFrame:
    """(query, id, score): the ``best`` documents of each query among those of each task."""
    sent = held.sparkSession.sparkContext.broadcast((graph, np.array(queries, dtype=np.int64)))
    step = max(1, min(4096, CELLS // max(1, graph.nodes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, names = sent.value
        least = np.ones(len(names), dtype=np.int64)  # what a document must reach
        kept, size = None, 0
        parts: list[pa.Table] = []

        def cut() -> pa.Table:
            table = pa.concat_tables(parts).sort_by([("query", "ascending"), ("score", "descending"), ("id", "ascending")])
            query = table.column("query").to_numpy()
            first = np.searchsorted(query, query, "left")
            table = table.filter(pa.array(np.arange(len(query)) - first < best))
            query, score = table.column("query").to_numpy(), table.column("score").to_numpy()
            full, n = np.unique(query, return_counts=True)
            last = np.searchsorted(query, full, "right") - 1
            least[full[n == best]] = score[last[n == best]]
            return table

        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                lists = part.column(2)
                sizes = np.diff(lists.offsets.to_numpy())
                row = np.repeat(np.arange(part.num_rows), sizes)
                m = 25 + (75 * part.column(1).to_numpy() * documents) // total_terms
                score = graph.scores(row, lists.flatten().to_numpy(), part.column(3).flatten().to_numpy().astype(np.int64), m)
                query, doc = np.nonzero(score >= least[:, None])
                parts.append(pa.table({"query": query, "id": part.column(0).take(pa.array(doc)), "score": score[query, doc]}))
                size += len(query)
                if size > max(20_000, 4 * best * len(names)):
                    parts = [cut()]
                    size = 0
        if parts:
            kept = cut()
            kept = kept.set_column(0, "query", pa.array(names[kept.column("query").to_numpy()]))
            yield from kept.to_batches(max_chunksize=10_000)

    kind = dict(held.dtypes)["id"]
    return held.mapInArrow(run, f"query long, id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", best: int = BEST, leaves_at_once: int = LEAVES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents of every item with a score above 0."""
    spark = docs.sparkSession
    small_batches(spark)
    root = scratch_dir(spark, "search")
    query_terms(items, item_id, item_text).write.parquet(f"{root}/terms")
    terms = spark.read.parquet(f"{root}/terms")
    postings(docs, doc_id, text, bitmap(terms, "term")).write.parquet(f"{root}/postings")
    held = spark.read.parquet(f"{root}/postings")
    seen = held.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("all")).first()
    refs = terms.count()
    blocks = max(1, -(-refs // leaves_at_once))
    # weights of the queries' terms; the bitmap may have let others through
    asked = terms.select("term").distinct()
    df = asked.join(document_counts(held), "term")
    ratio = F.lit(2.0 * seen["n"] + 2) / (2 * F.col("df") + 1).cast("double")
    df.select("term", F.floor(1000 * F.log(ratio)).cast("long").alias("w")).write.parquet(f"{root}/weights")
    weights = spark.read.parquet(f"{root}/weights")
    dealt = terms.join(weights.select("term"), "term", "left_semi").withColumn(
        "block", F.pmod(F.xxhash64("query", F.lit(3)), F.lit(blocks)).cast("int"))
    leaves, nodes, roots = share_graph(dealt, root)
    for block in range(blocks):
        graph, queries = _graph(block, leaves, nodes, roots, weights)
        part = best_of_block(held, graph, queries, best, seen["all"] or 1, seen["n"])
        part.write.mode("append").parquet(f"{root}/best")
    found = spark.read.schema(part.schema).parquet(f"{root}/best")
    ids = terms.select("query", F.col("id").alias("item")).distinct()
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(ids, "query").select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
