"""Documents to tokens: each stage reads what the one before has written.

Quality classifier, exact dedup, near dedup, decontamination and byte-level BPE.  Every
stage but the last returns the columns of ``documents``.  No SQL checks the result, as
trained scores and tokens cannot be written in SQL; tests compare each stage with a plain version.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import byte_bpe, decontaminate, exact_dedup, ngram_join, quality
from basketflow.llm.text import small_batches, unused
from basketflow.session import scratch_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    scorer, _ = quality.train(docs)
    score = unused("quality", docs.columns)
    scored = quality.score_documents(docs, scorer, score=score)
    return scored.where(F.col(score) >= quality.KEEP_SCORE).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return exact_dedup.drop_copies(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_join.drop_similar(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and whether decoding gives the text back."""
    small_batches(spark)
    tokens = byte_bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), VOCABULARY, public_tokenizers.PATTERN)
    return tokens.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_similar),
    ("decontamination", drop_contaminated),
    ("byte_bpe", to_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, root = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
