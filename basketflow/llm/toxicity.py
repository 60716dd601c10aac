"""Toxicity by non-negative positive-unlabelled learning.

Known are some toxic documents and a mass of unlabelled text.  With p the share of toxic
documents, the risk of a classifier g is estimated without one clean label as

    p * E_toxic[loss(g)] + max(0, E_any[loss(-g)] - p * E_toxic[loss(-g)]);

where the second part falls below zero, on a step, its gradient is turned round (the model has
begun to fit the unlabelled toxic documents).  The loss is logistic, the classifier linear in the
presence of words and the density of beginnings of words (hashed into BUCKETS; the FEATURES that
tell the two sets apart most surely), fitted with numpy.  MEMBERS classifiers, each on
unlabelled documents of its own, train as tasks of one Spark job; a score is the mean of theirs.

The share p is taken from the labels unless given.  A member fits on at most about 2 * TOXIC toxic and
2 * UNLABELLED other documents, chosen by a hash (whole texts); every document is scored on its whole text.
Labels of documents with crc32(identifier as text) mod ``folds`` equal to ``held_out`` are never read.

Defined results: null and empty texts have no words and get the members' bias; repeated rows are scored
alike; a document with several labels is toxic if one says so; null labels say nothing; without
a toxic document (or an empty table) every score is the share p; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.llm.text import mix, slices, small_batches, words
from basketflow.session import scratch_dir

BUCKETS = 1 << 20
TOXIC, UNLABELLED, MEMBERS = 2000, 6000, 4
FEATURES = 1024
PREFIXES = (4, 5, 6)
THRESHOLD = 0.7
# The share of toxic documents where labels cannot tell it.
PRIOR = 0.1

_GAP = np.zeros(256, dtype=bool)
_GAP[:0x30] = _GAP[0x3A:0x41] = _GAP[0x5B:0x61] = _GAP[0x7B:0x80] = True


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value): 1 for each distinct word of a text, and for each beginning of a word (its first
    bytes, as many as PREFIXES says) how dense it is: times / (times + 1 + words / 100)."""
    found = words(texts, _GAP)
    length = np.bincount(found.row, minlength=found.rows)
    size = found.end - found.start
    rows, buckets, values = [], [], []

    def counted(row: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        both, times = np.unique(row * BUCKETS + (mix(number) % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
        return both // BUCKETS, both % BUCKETS, times

    row, bucket, _ = counted(found.row, found.number)
    rows.append(row)
    buckets.append(bucket)
    values.append(np.ones(len(row), dtype=np.float32))
    for width in PREFIXES:
        long = np.flatnonzero(size >= width)
        number = np.full(len(long), width, dtype=np.uint64)
        for k in range(width):
            number = (number << np.uint64(8)) | found.data[found.start[long] + k]
        row, bucket, times = counted(found.row[long], number)
        rows.append(row)
        buckets.append(bucket)
        values.append((times / (times + 1 + length[row] / 100)).astype(np.float32))
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return row[order], np.concatenate(buckets)[order], np.concatenate(values)[order]


def training_fold(doc_id: Column, folds: int, held_out: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds != held_out


def _share(rows: int, wanted: int) -> Column:
    """Whether a row's hash falls into the share that gives about ``wanted`` of ``rows``."""
    cut = -2**63 + int(min(1.0, wanted / max(rows, 1)) * (2**64 - 1))
    return F.col("draw") <= F.lit(min(cut, 2**63 - 1))


def select_features(row: np.ndarray, bucket: np.ndarray, value: np.ndarray, toxic: np.ndarray,
                    most: int = FEATURES) -> np.ndarray:
    """The buckets whose mean among the toxic documents departs most surely from that among the others."""
    n_toxic, n_other = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    used, at = np.unique(bucket, return_inverse=True)
    p = np.bincount(at, weights=toxic[row] * value, minlength=len(used))
    u = np.bincount(at, weights=~toxic[row] * value, minlength=len(used))
    n = n_toxic + n_other
    spread = (np.bincount(at, weights=value * value, minlength=len(used)) + 1) / n - ((p + u) / n) ** 2
    surely = np.abs(p / n_toxic - u / n_other) / np.sqrt(np.maximum(spread, 1 / n) * (1 / n_toxic + 1 / n_other))
    surely[np.bincount(at, minlength=len(used)) < 3] = 0
    order = np.argsort(-surely, kind="stable")[:most]
    return np.sort(used[order[surely[order] > 2]])


def fit(x: np.ndarray, toxic: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05,
        decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of the smallest non-negative risk, by Adam over all rows.

    ``x`` has a row for each document; those not ``toxic`` are unlabelled.
    """
    n_toxic, n_other = max(int(toxic.sum()), 1), max(int((~toxic).sum()), 1)
    w, b = np.zeros(x.shape[1], np.float32), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for step in range(1, steps + 1):
        z = np.clip(x @ w + b, -30, 30)
        p = 1 / (1 + np.exp(-z))
        low = np.logaddexp(0, z)  # the loss of calling it clean
        clean_part = low[~toxic].sum() / n_other - prior * low[toxic].sum() / n_toxic
        # gradients by document: of the loss as toxic (p - 1), of the loss as clean (p)
        as_toxic = np.where(toxic, prior / n_toxic * (p - 1), 0)
        as_clean = np.where(toxic, -prior / n_toxic * p, p / n_other)
        g = (as_toxic + as_clean if clean_part >= 0 else -as_clean).astype(np.float32)
        full = np.append(x.T @ g + decay * w, g.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full * full
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = (w - move[:-1]).astype(np.float32), b - float(move[-1])
    return w, b


def _member(table: pa.Table, prior: float) -> pa.Table:
    """One classifier from rows of (member, toxic, draw, buckets, values)."""
    toxic = table.column("toxic").to_numpy()
    lists = table.column("buckets").combine_chunks()
    # documents are numbered by their draws: the order in which they arrive would change the last digits
    order = np.lexsort((table.column("draw").to_numpy(), toxic))
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    toxic = toxic[order]
    row = np.repeat(place, np.diff(lists.offsets.to_numpy()))
    bucket = lists.flatten().to_numpy().astype(np.int64)
    value = table.column("values").combine_chunks().flatten().to_numpy()
    chosen = select_features(row, bucket, value, toxic)
    x = np.zeros((len(toxic), len(chosen)), dtype=np.float32)
    at = np.searchsorted(chosen, bucket)
    known = at < len(chosen)
    known[known] = chosen[at[known]] == bucket[known]
    np.add.at(x, (row[known], at[known]), value[known])
    w, b = fit(x, toxic, prior)
    return pa.table({"member": table.column("member")[:1], "buckets": pa.array([chosen], pa.list_(pa.int64())),
                     "weights": pa.array([w], pa.list_(pa.float32())), "bias": pa.array([b], pa.float64())})


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          folds: int = 3, held_out: int = 1, prior: float | None = None) -> tuple[list[tuple[np.ndarray, np.ndarray, float]], float]:
    """The members as (buckets, weights, bias), and the share of toxic documents."""
    spark = docs.sparkSession
    small_batches(spark)
    root = scratch_dir(spark, "toxicity")
    known = (labels.where(training_fold(labels[doc_id], folds, held_out) & labels[label].isNotNull() & labels[doc_id].isNotNull())
             .groupBy(labels[doc_id].alias("id")).agg(F.max((labels[label] > 0).cast("int")).alias("toxic")))
    share = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    if prior is None:
        told = share["n"] and 0 < share["toxic"] < share["n"]
        prior = float(np.clip(share["toxic"] / share["n"], 0.005, 0.5)) if told else PRIOR
    if not share["toxic"]:
        return [], prior
    rows = docs.where(training_fold(docs[doc_id], folds, held_out)).select(
        docs[doc_id].alias("id"), docs[text].alias("text"), F.xxhash64(docs[doc_id], docs[text]).alias("draw"))
    count = rows.count()
    # a draw for each use: the toxic ones by it, the others by a second one
    toxic = (rows.join(known.where("toxic = 1").select("id"), "id", "left_semi").where(_share(share["toxic"], TOXIC))
             .select("text", "draw").limit(2 * TOXIC))
    other = (rows.withColumn("draw", F.xxhash64("draw", F.lit(1))).where(_share(count, UNLABELLED * MEMBERS))
             .select("text", "draw").limit(2 * UNLABELLED * MEMBERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            row, bucket, value = features(batch.column(0))
            cuts = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=batch.num_rows))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.ListArray.from_arrays(cuts, pa.array(bucket, pa.int32())),
                 pa.ListArray.from_arrays(cuts, pa.array(value))], names=["draw", "buckets", "values"])

    toxic.mapInArrow(run, "draw long, buckets array<int>, values array<float>").write.parquet(f"{root}/toxic")
    other.mapInArrow(run, "draw long, buckets array<int>, values array<float>").write.parquet(f"{root}/other")
    toxic, other = spark.read.parquet(f"{root}/toxic"), spark.read.parquet(f"{root}/other")
    dealt = toxic.select(F.explode(F.sequence(F.lit(0), F.lit(MEMBERS - 1))).alias("member"), F.lit(True).alias("toxic"), "draw", "buckets", "values").unionByName(
        other.select(F.pmod("draw", F.lit(MEMBERS)).cast("int").alias("member"), F.lit(False).alias("toxic"), "draw", "buckets", "values"))
    members = dealt.groupBy("member").applyInArrow(
        lambda table: _member(table, prior), "member int, buckets array<long>, weights array<float>, bias double").collect()
    members.sort(key=lambda r: r["member"])
    return [(np.array(r["buckets"], dtype=np.int64), np.array(r["weights"], dtype=float), r["bias"]) for r in members], prior


def score_documents(docs: DataFrame, members: list[tuple[np.ndarray, np.ndarray, float]], prior: float,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score): the members' mean probability that a document is toxic."""
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(members)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.unique(np.concatenate([np.zeros(0, np.int64), *[m[0] for m in sent.value]]))
        table = np.zeros((len(used) + 1, len(sent.value)))
        for k, (bucket, weight, _) in enumerate(sent.value):
            table[np.searchsorted(used, bucket), k] = weight
        place = np.full(BUCKETS, len(used), dtype=np.int32)
        place[used] = np.arange(len(used))
        for batch in slices(batches, 1):
            row, bucket, value = features(batch.column(1))
            at = place[bucket]
            known = at < len(used)
            row, at, value = row[known], at[known], value[known]
            score = np.zeros(batch.num_rows)
            for k, (_, _, bias) in enumerate(sent.value):
                z = np.bincount(row, weights=table[at, k] * value, minlength=batch.num_rows) + bias
                score += 1 / (1 + np.exp(-np.clip(z, -30, 30))) / len(sent.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.minimum(score, 1.0) if sent.value else np.full(batch.num_rows, prior))], names=["doc_id", "score"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double")


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
             folds: int = 3, held_out: int = 1, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    members, prior = train(docs, labels, doc_id, text, label, folds, held_out)
    scored = score_documents(docs, members, prior, doc_id, text)
    return scored.select("doc_id", (~training_fold(F.col("doc_id"), folds, held_out)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
