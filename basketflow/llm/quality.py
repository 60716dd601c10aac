"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document.  The votes
are counted by pattern over the whole table: at most 3^labellers rows, whatever its size.
Expectation-maximisation on these counts estimates how often each labeller gives each
vote on good and on bad documents, and with them a posterior for each pattern.  The posterior
labels train a linear scorer on hashed runs of three bytes; the scorer decides.

The counts cover all documents.  The scorer is fitted on about TRAIN_ROWS documents,
chosen by a hash of the identifier; every document is scored on its whole text.

Defined results: null and empty texts get the scorer's bias alone; with no documents, or when
all labellers agree on one class, the posterior itself decides through a constant scorer;
repeated rows are scored alike; other columns pass through ``score_documents`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.llm.text import slices, unused, words

TRAIN_ROWS = 4000
BUCKETS = 2048
# A document is kept when the scorer gives it at least this probability of good quality.
KEEP_SCORE = 0.3
# Words in which the labeller of variety counts the distinct ones, again and again along a text.
SPAN = 200
# Share of good documents where there is nothing to estimate it from.
PRIOR = 0.8
# A labeller is held to name at most this share of the good documents bad.
FALSE_ALARM = 0.02

# Frequent function words of four languages.
FUNCTION_WORDS = (
    "the of and to in is that it was for on are as with be by this from at or an a "
    "der die das und in den von zu mit sich auf ist im dem nicht ein eine als auch es "
    "le la les de des et un une du en que qui dans pour par sur au avec il elle est "
    "el los las y que del se con por su para al lo como más no").split()


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


LABELLERS = ("function_words", "sentences", "empty", "capitals", "symbols", "repeated_words", "variety",
             "repeated_lines")


def with_votes(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` plus ``votes``: for each labeller 1 good, -1 bad, 0 none.

    The labellers of symptoms (capitals, symbols, repeats, no words) never vote good: a
    document without one symptom may have another.
    """
    body = F.coalesce(docs[text], F.lit(""))
    of_words, of_lines = unused("of_words", docs.columns), unused("of_lines", docs.columns)
    rows = docs.withColumn(of_words, F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = rows.withColumn(of_lines, F.filter(F.split(body, r"\n"), lambda x: F.char_length(x) > 20))
    words, lines = F.col(of_words), F.col(of_lines)
    n = F.size(words)
    chars = F.char_length(body)
    letters = F.char_length(F.regexp_replace(body, r"[^\p{L}]", ""))
    upper = F.char_length(F.regexp_replace(body, r"[^\p{Lu}]", ""))
    symbols = chars - F.char_length(F.translate(body, "#$%&*|<>{}[]~^_=+\\@!", ""))
    common = F.size(F.filter(words, lambda w: F.lower(w).isin(FUNCTION_WORDS)))
    ends = F.size(F.filter(words, lambda w: w.rlike(r"[.?!:;]$")))
    twice = F.size(F.filter(F.zip_with(words, F.slice(words, 2, F.greatest(n - 1, F.lit(1))),
                                       lambda a, b: a == b), lambda same: same))
    # distinct words of each span, so that a long text is judged like a short one
    distinct = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(SPAN)),
                    lambda at: F.size(F.array_distinct(F.slice(words, at, SPAN)))), F.lit(0), lambda a, b: a + b)
    none = F.lit(False)
    rules = {  # labeller: votes good when, votes bad when
        "function_words": (_share(common, n) >= 0.15, (n >= 25) & (_share(common, n) < 0.06)),
        "sentences": ((n >= 8) & _share(ends, n).between(0.02, 0.35), (n >= 40) & (_share(ends, n) < 0.005)),
        "empty": (none, n == 0),
        "capitals": (none, (letters >= 20) & (_share(upper, letters) >= 0.3)),
        "symbols": (none, (chars >= 20) & (_share(symbols, chars) >= 0.03)),
        "repeated_words": (none, (n >= 10) & (_share(twice, n) >= 0.1)),
        "variety": (none, (n >= 20) & (_share(distinct, n) < 0.3)),
        "repeated_lines": (none, (F.size(lines) >= 3) & (F.size(F.array_distinct(lines)) <= 0.75 * F.size(lines))),
    }
    votes = [F.when(rules[k][1], -1).when(rules[k][0], 1).otherwise(0) for k in LABELLERS]
    return rows.withColumn("votes", F.array(*votes)).drop(of_words, of_lines)


@dataclass
class LabelModel:
    """``votes[i, y, v]``: the estimated probability that labeller i votes v - 1 on class y."""

    prior: float
    votes: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of class good for each row of votes."""
        odds = np.full(len(patterns), np.log(self.prior / (1 - self.prior)))
        for i in range(patterns.shape[1]):
            ratio = np.log(self.votes[i, 1] / self.votes[i, 0])
            odds += ratio[patterns[:, i] + 1]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def accuracy(self) -> np.ndarray:
        """Share of each labeller's votes that name the right class."""
        share = np.array([1 - self.prior, self.prior])
        right = share[0] * self.votes[:, 0, 0] + share[1] * self.votes[:, 1, 2]
        wrong = share[0] * self.votes[:, 0, 2] + share[1] * self.votes[:, 1, 0]
        return right / np.maximum(right + wrong, 1e-12)


def fit_labels(patterns: np.ndarray, counts: np.ndarray, steps: int = 200) -> LabelModel:
    """Expectation-maximisation over vote patterns and their counts.

    Votes are independent given the class.  Without the bound FALSE_ALARM the likelihood may
    prefer to call one kind of bad document a class of its own and all others good.
    """
    start = patterns.sum(axis=1) - 2 * (patterns == -1).sum(axis=1)
    good = 1 / (1 + np.exp(-2.0 * (start + 0.5)))
    for _ in range(steps):
        weight = np.stack([counts * (1 - good), counts * good])
        votes = np.stack([
            np.stack([(weight * (patterns[:, i] == v)).sum(axis=1) for v in (-1, 0, 1)], axis=1) + 0.5
            for i in range(patterns.shape[1])])
        votes /= votes.sum(axis=2, keepdims=True)
        kept = np.minimum(votes[:, 1, 0], FALSE_ALARM)
        votes[:, 1, 1:] *= ((1 - kept) / (1 - votes[:, 1, 0]))[:, None]
        votes[:, 1, 0] = kept
        model = LabelModel(float(np.clip((weight[1].sum() + 8) / (counts.sum() + 10), 0.05, 0.95)), votes)
        after = model.posterior(patterns)
        moved = np.abs(after - good).max()
        good = after
        if moved < 1e-9:
            break
    return model


def label_model(docs: DataFrame, text: str = "text") -> tuple[LabelModel, dict[tuple[int, ...], float]]:
    """The model of the whole table's votes, and the posterior of each pattern seen."""
    rows = with_votes(docs, text).groupBy("votes").count().collect()
    if not rows:
        return LabelModel(PRIOR, np.full((len(LABELLERS), 2, 3), 1 / 3)), {}
    rows.sort(key=lambda r: r["votes"])
    patterns = np.array([r["votes"] for r in rows], dtype=int)
    model = fit_labels(patterns, np.array([r["count"] for r in rows], dtype=float))
    return model, dict(zip(map(tuple, patterns.tolist()), model.posterior(patterns).tolist()))


def hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, weight): every run of three bytes of each text, blanks around it
    included, and, in the last bucket, the bytes of words that repeat the word before."""
    raw = [b" " + (t or "").encode() + b"  " for t in texts.to_pylist()]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.uint32)
    code = (data[:-2] * np.uint32(65599) + data[1:-1]) * np.uint32(65599) + data[2:] if len(data) > 2 else data[:0]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(raw)), sizes)[:len(code)]
    inside = np.ones(len(code), dtype=bool)
    for back in (1, 2):
        stop = ends - back
        inside[stop[stop < len(code)]] = False
    found = words(texts)
    again = np.flatnonzero((found.number[1:] == found.number[:-1]) & (found.row[1:] == found.row[:-1])) + 1
    row = np.concatenate([row[inside], found.row[again]])
    bucket = np.concatenate([code[inside].astype(np.int64), np.full(len(again), BUCKETS)])
    weight = np.ones(len(row))
    weight[len(row) - len(again):] = found.end[again] - found.start[again] + 1
    return row, bucket, weight


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        row, bucket, weight = hashed(texts)
        total = np.bincount(row, weights=self.weights[bucket] * weight, minlength=len(texts))
        mean = total / np.maximum(np.bincount(row, weights=weight, minlength=len(texts)), 1)
        return 1 / (1 + np.exp(-np.clip(mean + self.bias, -30, 30)))


def fit_scorer(features: np.ndarray, target: np.ndarray, steps: int = 150, decay: float = 1e-5) -> Scorer:
    """Logistic regression on posterior labels by Adam over all rows."""
    n, d = features.shape
    if n == 0 or target.max() < 0.5 or target.min() >= 0.5:
        share = float(np.clip(target.mean(), 0.01, 0.99)) if n else PRIOR
        return Scorer(np.zeros(d), float(np.log(share / (1 - share))))
    centre = features.mean(axis=0)
    scale = 1 / (np.sqrt(centre) + 1e-2)
    x = features - centre
    x *= scale
    target = target.astype(np.float32)
    w, b = np.zeros(d, np.float32), 0.0
    m, v, mb, vb = np.zeros(d, np.float32), np.zeros(d, np.float32), 0.0, 0.0
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
        error = ((p - target) / n).astype(np.float32)
        g, gb = x.T @ error + decay * w, float(error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix, fix2 = 1 - 0.9 ** step, 1 - 0.999 ** step
        w = w - 0.1 * (m / fix) / (np.sqrt(v / fix2) + 1e-8)
        b = b - 0.1 * (mb / fix) / (np.sqrt(vb / fix2) + 1e-8)
    weights = w.astype(float) * scale
    return Scorer(weights, float(b - centre.astype(float) @ weights))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
          train_rows: int = TRAIN_ROWS) -> tuple[Scorer, LabelModel]:
    """Label model on all votes, scorer on about ``train_rows`` documents (never over twice that)."""
    model, posterior = label_model(docs, text)
    rows = docs.count()
    share = min(1.0, train_rows / max(rows, 1))
    cut = int(-2**63 + share * (2**64 - 1))
    body = F.coalesce(docs[text], F.lit("")).alias("text")
    chosen = with_votes(
        docs.where(F.xxhash64(docs[doc_id].cast("string"), docs[text]) <= F.lit(min(cut, 2**63 - 1)))
        .select(body).limit(2 * train_rows), "text")
    table = dict(posterior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                _, bucket, weight = hashed(batch.column(0).slice(r, 1))
                count = np.bincount(bucket, weights=weight, minlength=BUCKETS + 1)
                out.append((count / max(count.sum(), 1)).astype(np.float32).tobytes())
            target = [table[tuple(v)] for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"x": pa.array(out, pa.binary()), "y": pa.array(target, pa.float64())})

    sample = chosen.mapInArrow(run, "x binary, y double").toArrow()
    x = np.empty((sample.num_rows, BUCKETS + 1), dtype=np.float32)
    for k, row in enumerate(sample.column("x")):
        x[k] = np.frombuffer(row.as_buffer(), dtype=np.float32)
    y = sample.column("y").to_numpy()
    del sample
    pa.default_memory_pool().release_unused()
    return fit_scorer(x, y), model


def score_documents(docs: DataFrame, scorer: Scorer, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` plus the scorer's probability of good quality."""
    kept = [f for f in docs.schema.fields if f.name != score]
    schema = T.StructType([*kept, T.StructField(score, T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(sent.value.score(batch.column(text)))],
                names=[f.name for f in schema])

    return docs.mapInArrow(run, schema)
