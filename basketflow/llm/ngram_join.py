"""Groups of documents whose sets of word n-grams are similar: a Jaccard join, exact.

Shingles (runs of ``width`` words) are ordered rare class first, then by number; frequent
shingles are those found repeatedly in one window of text, summed over all windows.  Two
linked sets share K of the first n - need + K shingles of this order.  A rare shingle of
this prefix is a signature by itself, frequent ones in pairs.  Sets of more than LONG
shingles, whose prefixes would give very many pairs, use single frequent shingles too.  The
classes only decide how much work there is, never the result.

Sets that share a signature held by few sets are candidates if they share K of them, or one
when both prefixes hold frequent shingles.  A signature held by many is cut into bands of like
sizes, as linked sets lie in one band or two adjacent ones; where a band still has many sets,
they are compared with one of them, the pivot (few rare shingles), not with each other.  What is
left of these is joined on the differences to the pivot: with D = set xor pivot, two sets are
linked exactly if D1 and D2 overlap enough, and two sets linked to the pivot need no
comparison.  Signatures of this second join are the rarest differences, and a signature
that many sets share gets a pivot of its own.  So a group of very many near copies costs a
comparison with its pivot for each, not one for each pair.

Equal sets are one node.  Nodes are 64-bit digests of sets; links are exact up to digests of
unequal shingles or sets that agree (about 2**-64 a pair).

Defined results: a text with fewer words than ``width`` is one shingle of its own length;
null, empty and blank texts have no shingles and are linked with nothing; repeated rows are in
one group; a component takes the smallest identifier, nulls left out; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.graph import bitmap, components, may_hold, only_wanted
from basketflow.llm.text import mix, shingles, slices, unused, words
from basketflow.session import scratch_dir

# Shingles found LOCAL times in one window are counted; those with FREQUENT in all are frequent.
WINDOW, LOCAL, FREQUENT = 3_000_000, 2, 8
# The frequent class never has more members (8 MB); it is the only thing sent to every task.
MOST_FREQUENT = 1 << 20
# Shingles that linked sets share in their prefixes, at most.
K = 4
# Signatures with more sets than this are cut into bands; bands with more get a pivot.
SMALL = 24
# Signatures of differences with more sets than this get a pivot of their own ...
BUCKET = 100
# ... for this many rounds; after that the sets that share one are compared directly.
ROUNDS = 4
_SEED = np.uint64(0xA0761D6478BD642F)


def need(n: Column, m: Column, percent: int) -> Column:
    """Least overlap of linked sets of n and m shingles."""
    return F.ceil(percent * (n + m) / F.lit(100 + percent))


def sets(texts: pa.Array, width: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, is frequent) of the distinct shingles in the order rare, frequent, number."""
    row, number = shingles(words(texts), width)
    often = np.zeros(len(number), dtype=bool)
    if len(frequent):
        place = np.searchsorted(frequent, number).clip(max=len(frequent) - 1)
        often = frequent[place] == number
    order = np.lexsort((number, often, row))
    row, number, often = row[order], number[order], often[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (number[1:] != number[:-1])
    return row[new], number[new], often[new]


def nodes(row: np.ndarray, number: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, size, digest) of each row's set."""
    first = np.searchsorted(row, np.arange(rows + 1))
    total = np.append(np.uint64(0), np.cumsum(mix(number ^ _SEED), dtype=np.uint64))
    size = np.diff(first)
    digest = mix((total[first[1:]] - total[first[:-1]]) ^ size.astype(np.uint64))
    return first, size, digest.astype(np.int64)


def shared_at_least(percent: int) -> int:
    """K, or less where unequal linked sets may share less."""
    return min(K, percent // (100 - percent))


def signatures(number: np.ndarray, often: np.ndarray, percent: int, longest: int) -> tuple[np.ndarray, bool]:
    """Signatures of one set given in order, and whether its prefix has frequent shingles."""
    n = len(number)
    prefix = min(n, n - -(-percent * n // 100) + max(2, shared_at_least(percent)))
    head, common = number[:prefix], often[:prefix]
    parts = [mix(head[~common])]
    hot = head[common]
    if n <= longest and len(hot) > 1:
        a, b = np.triu_indices(len(hot), 1)
        parts.append(mix(mix(hot[a]) * np.uint64(3) + hot[b]))
    if n * 100 > longest * percent:
        parts.append(mix(hot + _SEED))
    return np.concatenate(parts).astype(np.int64), len(hot) > 0


def _key(docs: DataFrame, doc_id: str, text: str) -> Column:
    return F.coalesce(docs[doc_id], F.xxhash64(docs[text]))


def frequent_shingles(docs: DataFrame, width: int, text: str = "text") -> np.ndarray:
    def counted(window: list[np.ndarray]) -> pa.RecordBatch:
        value, count = np.unique(np.concatenate([np.empty(0, np.uint64), *window]), return_counts=True)
        many = count >= LOCAL
        return pa.RecordBatch.from_arrays([pa.array(value[many].astype(np.int64)), pa.array(count[many])],
                                          names=["token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, size = [], 0
        for batch in slices(batches, 0):
            window.append(sets(batch.column(0), width, np.empty(0, np.uint64))[1])
            size += len(window[-1])
            if size > WINDOW:
                yield counted(window)
                window, size = [], 0
        yield counted(window)

    found = (docs.select(text).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= FREQUENT).orderBy(F.col("n").desc(), "token").limit(MOST_FREQUENT))
    table = found.select("token").toArrow()
    return np.sort(table.column("token").to_numpy().astype(np.int64).view(np.uint64))


class _Folder:
    """Written tables of one run; a table is read back, so what was read before is not kept."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.root = spark, scratch_dir(spark, "ngram-join")

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")


def _signed(docs: DataFrame, doc_id: str, text: str, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    longest = 2200 // (100 - percent)
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            row, number, often = sets(batch.column(2), width, sent.value)
            first, size, digest = nodes(row, number, batch.num_rows)
            signed = [signatures(number[a:b], often[a:b], percent, longest) for a, b in zip(first, first[1:])]
            rare = np.array([int((~often[a:b]).sum()) for a, b in zip(first, first[1:])], dtype=np.int64)
            hot = np.array([h for _, h in signed], dtype=bool)
            signed = [s for s, _ in signed]
            offsets = np.cumsum([0, *(len(s) for s in signed)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digest), pa.array(size.astype(np.int64)), pa.array(rare), pa.array(hot),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(signed)))],
                names=["doc_id", "key", "node", "n", "rare", "hot", "signs"])

    return docs.select(docs[doc_id].cast("long").alias("doc_id"), _key(docs, doc_id, text).alias("key"),
                       docs[text].alias("text")).mapInArrow(
        run, "doc_id long, key long, node long, n long, rare long, hot boolean, signs array<long>")


def _sets_of(docs: DataFrame, doc_id: str, text: str, width: int, wanted: DataFrame) -> DataFrame:
    """(node, tokens) of the wanted nodes, from the documents whose key is wanted.

    The texts stay where they are read: a bitmap of the wanted keys passes over the others.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices((b.filter(may_hold(sent.value, b.column(0))) for b in batches), 1):
            row, number, _ = sets(part.column(1), width, np.empty(0, np.uint64))
            first, _, digest = nodes(row, number, part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(number.astype(np.int64)))],
                names=["node", "tokens"])

    made = (docs.select(_key(docs, doc_id, text).cast("long").alias("key"), docs[text].alias("text"))
            .mapInArrow(run, "node long, tokens array<long>"))
    return made.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _banded(signs: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Rows (sign, band, own, node, n, rare, hot) of the shared signatures.

    A set is in its own band of sizes and the next one, so linked sets meet in the larger of
    their own bands.  Signatures of few sets have one band.  The step is a little wider than
    the ratio of linked sizes, beyond any rounding of the logarithm.
    """
    step = 1.001 * math.log(100 / percent)
    rows = only_wanted(signs.select("sign", "node", "n", "rare", "hot"), shared, "sign").join(
        shared.select("sign", (F.col("size") > SMALL).alias("crowded")), "sign")
    rows = rows.withColumn("own", F.when(F.col("crowded"), F.floor(F.ln("n") / step)).otherwise(-1).cast("int"))
    bands = F.when(F.col("crowded"), F.array(F.col("own"), F.col("own") + 1)).otherwise(F.array("own"))
    return rows.withColumn("band", F.explode(bands)).drop("crowded")


def _few(rows: DataFrame, percent: int) -> DataFrame:
    """Candidates (pivot, node) that share signatures of few sets."""
    a, b = rows.alias("a"), rows.alias("b")
    like = (F.greatest("a.n", "b.n") * percent <= F.least("a.n", "b.n") * 100)
    both = a.join(b, (F.col("a.sign") == F.col("b.sign")) & (F.col("a.band") == F.col("b.band"))
                  & (F.greatest("a.own", "b.own") == F.col("a.band")) & (F.col("a.node") < F.col("b.node")) & like)
    return (both.groupBy(F.col("a.node").alias("pivot"), F.col("b.node").alias("node"))
            .agg(F.count(F.lit(1)).alias("shared"), F.max(F.col("a.hot") & F.col("b.hot")).alias("hot"))
            .where(F.col("hot") | (F.col("shared") >= shared_at_least(percent))).select("pivot", "node"))


def _against_pivots(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Members with their overlap with the pivot and, where these are used, their differences to it."""
    pivots = tokens.select(F.col("node").alias("pivot"), F.col("tokens").alias("ptokens"))
    both = pairs.join(tokens, "node").join(pivots, "pivot")
    n, m = F.size("tokens").cast("long"), F.size("ptokens").cast("long")
    left, gone = F.array_except("tokens", "ptokens"), F.array_except("ptokens", "tokens")
    return _state(both.select("pivot", "node", "scope", n.alias("n"), m.alias("pn"),
                              F.when(F.col("scope"), F.concat(left, gone)).alias("diff"),
                              (n - F.size(left)).alias("same")), percent)


def _state(rows: DataFrame, percent: int) -> DataFrame:
    linked = F.col("same") * (100 + percent) >= percent * (F.col("n") + F.col("pn"))
    return rows.withColumn("linked", linked)


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    found = rows.join(labels.select(F.col("id").alias("node"), "component"), "node", "left")
    return found.withColumn("component", F.coalesce("component", "node"))


def _difference_signs(state: DataFrame, percent: int, folder: _Folder, step: int) -> DataFrame | None:
    """Rows (pivot, kind, token, node, ...) of the rarest differences, as many as the bound asks for; None if
    no pair is left to be compared.

    Sets linked to the pivot need no comparison with each other, so a pair has one such set
    (kind cross) or none (kind apart); an overlap below ``least`` cannot link a pair of the kind.
    """
    scopes = (state.groupBy("pivot").agg(F.min("component").alias("low"), F.max("component").alias("high"))
              .where("low < high").select("pivot"))
    scopes = folder.save(scopes, f"scopes{step}")
    if not scopes.take(1):  # every pivot's sets are in one component
        return None
    members = folder.save(state.join(scopes, "pivot", "left_semi"), f"members{step}")
    tokens = members.select("pivot", "node", F.explode("diff").alias("token"))
    shared = folder.save(tokens.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), f"df{step}")
    ranked = (tokens.join(shared, ["pivot", "token"]).groupBy("pivot", "node")
              .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("order")))
    rows = members.withColumn("d", F.size("diff").cast("long")).drop("diff").join(ranked, ["pivot", "node"])
    gap = F.floor(percent * (F.col("n") - F.col("pn")) / F.lit(100 + percent)) + F.col("pn") - F.col("same")
    near = need(F.col("n"), F.col("pn"), percent) - F.col("same")
    # differences that no other set has would come first in the order, and match nothing
    rows = rows.withColumn("e", F.size("order").cast("long")).withColumn("gap", gap)
    linked = rows.where("linked").withColumn("least", F.greatest(F.lit(1), F.col("gap") + 1)).where("e >= least")
    # a pair's least overlap is the near of the set apart and the gap of the linked one, together
    closest = linked.groupBy("pivot").agg(F.min("gap").alias("closest"))
    apart = rows.where("not linked")
    crossing = (apart.join(closest, "pivot").withColumn("least", F.greatest(F.lit(1), near + F.col("closest")))
                .drop("closest"))
    apart = apart.withColumn("least", F.greatest(F.lit(1), F.col("gap") + 1))
    rows = (linked.unionByName(crossing).withColumn("kind", F.lit("cross"))
            .unionByName(apart.withColumn("kind", F.lit("apart"))).where("e >= least").drop("gap"))
    return (rows.withColumn("token", F.explode(F.slice("order", F.lit(1), (F.col("e") - F.col("least") + 1).cast("int"))))
            .withColumn("token", F.col("token.token")).drop("order", "least"))


def _open(marked: DataFrame) -> DataFrame:
    """Signatures of differences that some pair to be compared shares."""
    return (marked.groupBy("pivot", "kind", "token")
            .agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("linked", "d", "node")).alias("p"),
                 F.min("component").alias("low"), F.max("component").alias("high"),
                 F.min("linked").alias("some_apart"), F.max("linked").alias("some_linked"))
            .where("low < high and (kind = 'apart' or (some_linked and not some_apart))")
            .select("pivot", "kind", "token", "size", F.col("p.node").alias("next")))


def _least_overlap(percent: int) -> Column:
    """Overlap of the differences of a and b that makes them linked."""
    return need(F.col("a.n"), F.col("b.n"), percent) - (F.col("a.same") + F.col("b.same") - F.col("a.pn"))


def _direct(signs: DataFrame, state: DataFrame, percent: int, folder: _Folder, step: int) -> DataFrame:
    """Links between sets that share a signature of differences, each pair compared once."""
    columns = ["pivot", "kind", "token", "node", "linked", "component", "n", "pn", "same", "e"]
    a, b = signs.select(columns).alias("a"), signs.select(columns).alias("b")
    small = F.least(F.col("a.e"), F.col("b.e"))
    pairs = (a.join(b, (F.col("a.pivot") == F.col("b.pivot")) & (F.col("a.token") == F.col("b.token"))
                    & (F.col("a.kind") == F.col("b.kind")) & ~(F.col("a.linked") & F.col("b.linked"))
                    & (F.col("a.node") < F.col("b.node")) & (F.col("a.component") != F.col("b.component"))
                    & (_least_overlap(percent) <= small))
             .select(F.col("a.pivot").alias("pivot"), F.col("a.node").alias("a"), F.col("b.node").alias("b"),
                     _least_overlap(percent).alias("least")).distinct())
    pairs = folder.save(pairs, f"pairs{step}")
    diffs = state.select("pivot", "node", "diff")
    return (pairs.join(diffs.withColumnsRenamed({"node": "a", "diff": "da"}), ["pivot", "a"])
            .join(diffs.withColumnsRenamed({"node": "b", "diff": "db"}), ["pivot", "b"])
            .where(F.size(F.array_intersect("da", "db")) >= F.col("least")).select("a", "b"))


def _next_state(members: DataFrame, state: DataFrame, percent: int) -> DataFrame:
    """Members of large signatures against the pivot of the signature, through their differences."""
    rows = members.join(state.select("pivot", "node", "n", "pn", "same", "diff"), ["pivot", "node"])
    chosen = state.select("pivot", F.col("node").alias("next"), F.col("n").alias("qn"), F.col("diff").alias("qdiff"))
    rows = rows.join(chosen, ["pivot", "next"])
    diff = F.concat(F.array_except("diff", "qdiff"), F.array_except("qdiff", "diff"))
    rows = rows.select(F.col("next").alias("pivot"), "node", "n", F.col("qn").alias("pn"), diff.alias("diff"))
    same = ((F.col("n") + F.col("pn") - F.size("diff")) / 2).cast("long")
    return _state(rows.withColumn("same", same).dropDuplicates(["pivot", "node"]), percent)


def group_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5,
                  percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents are linked when 100 * intersection >= percent * union (percent over 50).
    """
    if not 50 < percent < 100:
        raise ValueError("percent must be between 51 and 99")
    folder = _Folder(docs.sparkSession)
    frequent = frequent_shingles(docs, width, text)
    signed = folder.save(_signed(docs, doc_id, text, width, percent, frequent), "signed")
    own = signed.where("n > 0").groupBy("node").agg(F.min(F.struct("key", "n", "rare", "hot", "signs")).alias("r"))
    signs = own.select("node", "r.key", "r.n", "r.rare", "r.hot", F.explode("r.signs").alias("sign"))
    signs = folder.save(signs, "signs")
    shared = signs.groupBy("sign").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = folder.save(shared, "shared")
    rows = folder.save(_banded(signs, shared, percent), "banded")
    by = ["sign", "band"]
    bands = (rows.groupBy(*by).agg(F.min(F.struct("rare", "node")).alias("p"), F.count(F.lit(1)).alias("size"))
             .where("size > 1").select(*by, F.col("p.node").alias("pivot"), "size"))
    bands = folder.save(bands, "bands")
    many = (rows.join(bands.where(F.col("size") > SMALL), by).where("node <> pivot").select("pivot", "node"))
    small = rows.join(bands.where(F.col("size") <= SMALL).select(*by), by)
    pairs = (many.distinct().withColumn("scope", F.lit(True))
             .unionByName(_few(small, percent).withColumn("scope", F.lit(False)))
             .groupBy("pivot", "node").agg(F.max("scope").alias("scope")))
    pairs = folder.save(pairs, "pairs")
    wanted = pairs.select("node").unionByName(pairs.select(F.col("pivot").alias("node"))).distinct()
    keys = signs.select("node", "key").distinct()
    wanted = folder.save(keys.join(wanted, "node"), "wanted")
    tokens = folder.save(_sets_of(docs, doc_id, text, width, wanted), "tokens")
    state = folder.save(_against_pivots(pairs, tokens, percent), "state")
    links = state.where("linked").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    labels = folder.save(components(links), "labels0")
    state = state.where("scope").drop("scope")
    for step in range(1, ROUNDS + 1):
        state = _labelled(state, labels)
        marked = _difference_signs(state, percent, folder, step)
        if marked is None:
            break
        marked = folder.save(marked, f"differences{step}")
        buckets = folder.save(_open(marked), f"buckets{step}")
        if not buckets.take(1):
            break
        by = ["pivot", "kind", "token"]
        large = buckets.where(F.col("size") > BUCKET) if step < ROUNDS else buckets.where("false")
        small = buckets.where(F.col("size") <= BUCKET) if step < ROUNDS else buckets
        found = _direct(marked.join(small.select(by), by, "left_semi"), state, percent, folder, step)
        members = (marked.join(large.select(*by, "next"), by).where("node <> next")
                   .select("pivot", "node", "next").distinct())
        state = folder.save(_next_state(members, state.drop("component"), percent), f"state{step}")
        more = state.where("linked").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        links = folder.save(links.unionByName(found).unionByName(more).distinct(), f"links{step}")
        labels = folder.save(components(links), f"labels{step}")
        if not state.take(1):
            break
    named = _labelled(signed.select("doc_id", "node", "n"), labels)
    smallest = folder.save(named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id")), "smallest")
    out = named.join(smallest, "component", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def drop_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5,
                 percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: the one of the smallest identifier, nulls last.

    Among rows of one identifier the text's hash and then that of the place in the table decide, so
    null and repeated identifiers cost no row of another group.  Rows are written with a key of
    their own, which the groups and the choice go by: a hash (one to one on 64 bits), as bitmaps of
    keys need evenly spread ones.
    """
    folder = _Folder(docs.sparkSession)
    row, digest = unused("row", docs.columns), unused("hash", docs.columns)
    keyed = folder.save(docs.select("*", F.xxhash64(F.monotonically_increasing_id()).alias(row), F.xxhash64(docs[text]).alias(digest)), "keyed")
    place = F.struct(keyed[doc_id].isNull().alias("none"), keyed[doc_id].alias("id"), keyed[digest].alias("hash"), keyed[row].alias("row"))
    groups = group_similar(keyed, row, text, width, percent).select(F.col("doc_id").alias("row"), "component_id")
    kept = (keyed.select(keyed[row].alias("row"), place.alias("place")).join(groups, "row")
            .groupBy("component_id").agg(F.min("place").alias("first")).select(F.col("first.row").alias(row)))
    return keyed.join(folder.save(kept, "kept"), row, "left_semi").select(*docs.columns)
