"""Scores of a log-bilinear language model trained with noise-contrastive estimation.

Outputs are the end of text, the most frequent words and CLASSES classes of all other words by
their last two bytes; within a class a word has the add-one share of its count, one
share being left for unknown words, so probabilities add up to one.  The model predicts
an output from the two before it: the context vector is the sum of their vectors, each
scaled by a vector of its position, and an output's score is its product with the
output's vector plus a bias.

Word counts come from all training documents.  Every task trains on all training tokens it
reads, counted by (context, output), from common weights; the weights are averaged by
the number of tokens, ROUNDS times.  For scoring, one batched matrix product gives the
normalised log-probabilities of all contexts.  Counts of the HEAD most frequent words are sent to
the tasks; those of all others are joined.

Defined results: tokens are words (A-Z in lower case) and one end per text; null and empty
texts have the end alone; without training documents every count is 0; a null identifier is
hashed as an empty text; repeated rows are counted and scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.text import slices, words
from basketflow.session import scratch_dir

SHORTLIST, CLASSES = 191, 64
OUTPUTS = 1 + SHORTLIST + CLASSES
WIDTH, NOISE, BATCH, ROUNDS, RATE = 16, 48, 2048, 2, 0.15
HEAD = 1 << 16
# Tokens that a task gathers before it trains on them.
WINDOW = 2_000_000


@dataclass
class Vocabulary:
    """Counts of the training tokens."""

    short: np.ndarray  # numbers of the shortlist, sorted
    short_id: np.ndarray
    head: np.ndarray  # numbers of the most frequent words, sorted
    head_count: np.ndarray
    output_count: np.ndarray  # tokens of each output
    class_words: np.ndarray  # distinct words of each output that is a class
    tokens: int
    distinct: int

    def outputs(self, number: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        out = 1 + SHORTLIST + suffix
        if len(self.short):
            place = np.searchsorted(self.short, number).clip(max=len(self.short) - 1)
            out = np.where(self.short[place] == number, self.short_id[place], out)
        return out

    def counts(self, number: np.ndarray) -> np.ndarray:
        """The word's count, or -1 where it is not in the head."""
        if not len(self.head):
            return np.full(len(number), -1)
        place = np.searchsorted(self.head, number).clip(max=len(self.head) - 1)
        return np.where(self.head[place] == number, self.head_count[place], -1)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, number, suffix class, is end): the words of each row, then its end."""
    found = words(texts)
    last = found.data[found.end - 1].astype(np.int64) if len(found.end) else found.end
    before = found.data[np.maximum(found.end - 2, found.start)].astype(np.int64) if len(found.end) else found.end
    suffix = ((last * 257 + before) * 40503 >> 4) % CLASSES
    at = found.first_of_row()[1:]
    ends = np.arange(len(texts))
    return (np.insert(found.row, at, ends), np.insert(found.number, at, np.uint64(0)),
            np.insert(suffix, at, 0), np.insert(np.zeros(len(found.row), dtype=bool), at, True))


def contexts(row: np.ndarray, output: np.ndarray) -> np.ndarray:
    """Number of the two outputs before each token of the same row; the end stands for none."""
    one, two = np.zeros_like(output), np.zeros_like(output)
    one[1:] = np.where(row[1:] == row[:-1], output[:-1], 0)
    two[2:] = np.where(row[2:] == row[:-2], output[:-2], 0)
    return two * OUTPUTS + one


class Model:
    """inputs (OUTPUTS, WIDTH), positions (2, WIDTH), vectors (OUTPUTS, WIDTH), bias (OUTPUTS)."""

    SHAPES = ((OUTPUTS, WIDTH), (2, WIDTH), (OUTPUTS, WIDTH), (OUTPUTS,))

    def __init__(self, flat: np.ndarray) -> None:
        self.parts, at = [], 0
        for shape in self.SHAPES:
            size = int(np.prod(shape))
            self.parts.append(np.array(flat[at:at + size], dtype=np.float32).reshape(shape))
            at += size

    @classmethod
    def start(cls, noise: np.ndarray) -> Model:
        rng = np.random.default_rng(1)
        parts = [rng.normal(0, 0.3, s) for s in cls.SHAPES[:3]]
        return cls(np.concatenate([parts[0].ravel(), np.ones(2 * WIDTH), 0.3 * parts[2].ravel(), np.log(noise)]))

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def log_probabilities(self) -> np.ndarray:
        """log10 P(output | context) of every context, in batches of matrix products."""
        inputs, positions, vectors, bias = self.parts
        out = np.empty((OUTPUTS * OUTPUTS, OUTPUTS), dtype=np.float32)
        for two in range(OUTPUTS):
            score = (inputs[two] * positions[1] + inputs * positions[0]) @ vectors.T + bias
            score -= score.max(axis=1, keepdims=True)
            score -= np.log(np.exp(score).sum(axis=1, keepdims=True))
            out[two * OUTPUTS:(two + 1) * OUTPUTS] = score / np.float32(np.log(10))
        return out


def _add_rows(total: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    order = np.argsort(index, kind="stable")
    index = index[order]
    first = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
    total[index[first]] += np.add.reduceat(rows[order], first, axis=0)


def train_window(model: Model, speed: list[np.ndarray], context: np.ndarray, output: np.ndarray,
                 weight: np.ndarray, noise: np.ndarray, rng: np.random.Generator) -> None:
    """One pass of noise-contrastive estimation over counted (context, output) pairs, with Adagrad."""
    inputs, positions, vectors, bias = model.parts
    log_noise = np.log(NOISE * noise).astype(np.float32)
    edges = np.cumsum(noise)
    order = rng.permutation(len(context))
    for at in range(0, len(order), BATCH):
        part = order[at:at + BATCH]
        two, one, w = context[part] // OUTPUTS, context[part] % OUTPUTS, output[part]
        mass = (weight[part] / weight[part].sum()).astype(np.float32)[:, None]
        drawn = np.searchsorted(edges, rng.random(NOISE) * edges[-1]).clip(max=OUTPUTS - 1)
        a, b = inputs[one], inputs[two]
        context_vector = a * positions[0] + b * positions[1]
        data = (context_vector * vectors[w]).sum(axis=1) + bias[w] - log_noise[w]
        other = context_vector @ vectors[drawn].T + bias[drawn] - log_noise[drawn]
        # gradients of the log-likelihood of telling data from noise
        g_data = mass * (1 / (1 + np.exp(np.clip(data, -20, 20))))[:, None]
        g_other = -mass / (1 + np.exp(-np.clip(other, -20, 20)))
        g_context = g_data * vectors[w] + g_other @ vectors[drawn]
        grads = [np.zeros_like(p) for p in model.parts]
        _add_rows(grads[2], w, g_data * context_vector)
        _add_rows(grads[3], w, g_data[:, 0])
        np.add.at(grads[2], drawn, g_other.T @ context_vector)
        np.add.at(grads[3], drawn, g_other.sum(axis=0))
        _add_rows(grads[0], one, g_context * positions[0])
        _add_rows(grads[0], two, g_context * positions[1])
        grads[1][0], grads[1][1] = (g_context * a).sum(axis=0), (g_context * b).sum(axis=0)
        for p, g, s in zip(model.parts, grads, speed):
            s += g * g
            p += RATE * g / (np.sqrt(s) + 1e-6)


def count_words(train: DataFrame) -> DataFrame:
    """(word, suffix, n) over the texts of ``train``; the end is word 0 with suffix -1."""
    def counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        number = np.concatenate([p[0] for p in parts])
        suffix = np.concatenate([p[1] for p in parts])
        value, first, count = np.unique(number, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(suffix[first]), pa.array(count)],
                                          names=["word", "suffix", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in slices(batches, 0):
            _, number, suffix, end = tokens(batch.column(0))
            parts.append((number, np.where(end, -1, suffix)))
            size += len(number)
            if size > WINDOW:
                yield counted(parts)
                parts, size = [], 0
        if parts:
            yield counted(parts)

    return (train.select("text").mapInArrow(run, "word long, suffix long, n long")
            .groupBy("word", "suffix").agg(F.sum("n").alias("n")))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The bounded tables sent to the tasks, from the written counts."""
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"),
                       F.sum(F.when(F.col("suffix") < 0, F.col("n"))).alias("ends")).first()
    top = counts.where("suffix >= 0").orderBy(F.col("n").desc(), "word").limit(HEAD).toPandas()
    short = top.head(SHORTLIST)
    tails = {r.suffix: (r.n, r.v) for r in counts.where("suffix >= 0").groupBy("suffix").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    output_count, class_words = np.zeros(OUTPUTS), np.zeros(OUTPUTS)
    output_count[0] = total.ends or 0
    output_count[1:1 + len(short)] = short["n"]
    for suffix, (n, v) in tails.items():
        own = short[short["suffix"] == suffix]
        output_count[1 + SHORTLIST + suffix] = n - own["n"].sum()
        class_words[1 + SHORTLIST + suffix] = v - len(own)

    def ordered(table, value) -> tuple[np.ndarray, np.ndarray]:
        number = table["word"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(number)
        return number[order], np.asarray(value)[order]

    s, s_id = ordered(short, np.arange(1, 1 + len(short)))
    h, h_n = ordered(top, top["n"].to_numpy())
    return Vocabulary(s, s_id, h, h_n, output_count, class_words, int(total.n or 0), int(total.v))


def train_round(train: DataFrame, known: Vocabulary, start: Model, seed: int) -> Model:
    """All tasks train from ``start`` on the tokens they read; the weights are averaged in Spark."""
    sent = train.sparkSession.sparkContext.broadcast((known, start.flat()))
    noise = (known.output_count + 1) / (known.output_count + 1).sum()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, flat = sent.value
        model, seen = Model(flat), 0
        speed = [np.full_like(p, 1e-4) for p in model.parts]
        rng = np.random.default_rng(seed)
        parts, size = [], 0

        def learn() -> None:
            code, count = np.unique(np.concatenate(parts), return_counts=True)
            train_window(model, speed, code // OUTPUTS, code % OUTPUTS, count.astype(float), noise, rng)

        for batch in slices(batches, 0):
            row, number, suffix, end = tokens(batch.column(0))
            output = np.where(end, 0, known.outputs(number, suffix))
            parts.append(contexts(row, output) * OUTPUTS + output)
            size += len(row)
            seen += len(row)
            if size > WINDOW:
                learn()
                parts, size = [], 0
        if parts:
            learn()
        if seen:
            yield pa.RecordBatch.from_pydict({"n": [seen], "weights": pa.array([model.flat().tolist()], pa.list_(pa.float32()))})

    each = train.select("text").mapInArrow(run, "n long, weights array<float>")
    mean = (each.select("n", F.posexplode("weights").alias("at", "w")).groupBy("at")
            .agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w"))).toPandas().sort_values("at")
    return Model(mean["w"].to_numpy()) if len(mean) else start


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7,
                    held_out: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from documents whose crc32(doc_id as text) mod ``folds`` is not ``held_out``.
    """
    spark = docs.sparkSession
    root = scratch_dir(spark, "lm")
    fold = F.crc32(F.coalesce(docs[doc_id].cast("string"), F.lit(""))) % folds
    rows = docs.select(docs[doc_id].alias("doc_id"), (fold == held_out).alias("held_out"),
                       F.coalesce(docs[text], F.lit("")).alias("text"))
    train = rows.where(~F.col("held_out"))
    count_words(train).write.parquet(f"{root}/counts")
    counts = spark.read.parquet(f"{root}/counts")
    known = vocabulary(counts)
    noise = (known.output_count + 1) / (known.output_count + 1).sum()
    model = Model.start(noise)
    for seed in range(ROUNDS):
        model = train_round(train, known, model, seed)
    sent = spark.sparkContext.broadcast((known, model.flat()))
    base = np.log10(known.tokens + known.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, flat = sent.value
        table = Model(flat).log_probabilities()
        within = np.log10(known.output_count + known.class_words + 1)
        for batch in slices(batches, 2):
            row, number, suffix, end = tokens(batch.column(2))
            output = np.where(end, 0, known.outputs(number, suffix))
            count = np.where(end, int(known.output_count[0]), known.counts(number))
            rare = count < 0
            log_count = np.log10(np.where(rare, 0, count) + 1.0)
            model_score = table[contexts(row, output), output].astype(float)
            tail = output > SHORTLIST
            model_score += np.where(tail, log_count - within[output], 0)

            def total(x: np.ndarray) -> pa.Array:
                return pa.array(np.bincount(row, weights=x, minlength=batch.num_rows))

            cuts = np.append(0, np.cumsum(np.bincount(row[rare], minlength=batch.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.bincount(row, minlength=batch.num_rows)),
                 total(count > 0).cast(pa.int64()), total(log_count - base), total(model_score),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(number[rare].astype(np.int64)))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare"])

    kind = dict(rows.dtypes)["doc_id"]
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, "
                                  "model double, rare array<long>")
    scored.withColumn("serial", F.monotonically_increasing_id()).write.parquet(f"{root}/scored")
    scored = spark.read.parquet(f"{root}/scored")
    rare = scored.select("serial", F.explode("rare").alias("word"))
    extra = (rare.join(counts.where("suffix >= 0").select("word", "n"), "word").groupBy("serial")
             .agg(F.sum(F.log10(F.col("n") + 1)).alias("log_count"), F.count(F.lit(1)).alias("known")))
    more = F.coalesce(F.col("log_count"), F.lit(0.0))
    return scored.join(extra, "serial", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
        (F.col("model") + more).alias("score"))
