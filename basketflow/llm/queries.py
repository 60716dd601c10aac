"""The registered queries of this subpackage and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from basketflow.llm import (
    byte_bpe, decontaminate, exact_dedup, line_dedup, lm, ngram_join, phrases, pii, quality, search, secrets,
    token_counts, toxicity,
)
from basketflow.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

# The tokenizer files are parameters; these are the ones the queries use.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")
# The key of the surrogates is a parameter; this one is for the query.
SURROGATE_KEY = "basketflow"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_mentions(docs, SURROGATE_KEY)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scorer, _ = quality.train(docs)
    scored = quality.score_documents(docs.select("doc_id", "text"), scorer)
    return scored.select("doc_id", "score", (F.col("score") >= quality.KEEP_SCORE).alias("kept"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.group_similar(_table(spark, sf_dir, "documents"), width=3, percent=90)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, PIECES).select("doc_id", "n_tokens", "token_score")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = secrets.scan(docs, f"{scratch_dir(spark, 'secrets')}/ledger", path="doc_id", content="text")
    base = [r.name for r in secrets.RULES if r.base]

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("path").alias("doc_id"), *[count(k) for k in base],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dropped_lines(_table(spark, sf_dir, "documents"), shortest=1)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.group_copies(_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    tokens = byte_bpe.encode(docs, BYTE_BPE, PATTERN).drop("text")
    return byte_bpe.decode(tokens, BYTE_BPE, PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        byte_bpe.ids_digest(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "pipeline": corpus_pipeline.run,
    "op1_pii_surrogates": op1_pii_surrogates,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_token_counts": op6_token_counts,
    "op7_secret_scan": op7_secret_scan,
    "op8_line_dedup": op8_line_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_ranked_search": op11_ranked_search,
    "op12_toxicity": op12_toxicity,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLES: dict[str, str] = {
    "op9_exact_dedup": """
        WITH rows AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM rows""",
    "op11_ranked_search": r"""
        WITH terms AS (
            SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[0-9a-z\x{80}-\x{10FFFF}]+') AS t FROM documents),
        docs AS (SELECT doc_id, d, t, len(t) AS n FROM terms WHERE len(t) > 0),
        whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM docs),
        tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(t) AS term FROM docs) GROUP BY d, term),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, whole),
        items AS (SELECT item_id, q, term, count(*) AS times FROM (
            SELECT item_id, row_number() OVER () AS q, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark) GROUP BY item_id, q, term),
        scores AS (
            SELECT item_id, q, d, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * whole.docs) // words))))::BIGINT AS score
            FROM items JOIN weights USING (term) JOIN tf USING (term) JOIN docs USING (d), whole GROUP BY item_id, q, d),
        ranked AS (
            SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank
            FROM scores JOIN docs USING (d) WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_phrase_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents),
        split AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS w FROM pieces),
        grams AS (
            SELECT lang, w[i:i + size - 1] AS phrase FROM (
                SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
                FROM split, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size)),
        f AS (SELECT lang, phrase, count(*) AS n FROM grams GROUP BY lang, phrase HAVING count(*) >= 30),
        words AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
        found AS (SELECT lang, phrase, n AS a FROM f WHERE len(phrase) > 1),
        cut AS (SELECT lang, phrase, a, unnest(range(1, len(phrase))) AS k FROM found),
        scored AS (
            SELECT cut.*, l.n AS l, r.n AS r, (2000000::HUGEINT * a) // (l.n + r.n) AS score
            FROM cut JOIN f AS l ON l.lang = cut.lang AND l.phrase = cut.phrase[1:k]
            JOIN f AS r ON r.lang = cut.lang AND r.phrase = cut.phrase[k + 1:len(cut.phrase)]),
        weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        spans AS (
            SELECT lang, phrase, a, size, unnest(range(1, len(phrase) - size + 2)) AS i
            FROM found, (SELECT unnest([2, 3]) AS size) WHERE len(phrase) > size),
        longest AS (SELECT lang, phrase[i:i + size - 1] AS phrase, max(a) AS longer FROM spans GROUP BY 1, 2),
        kept AS (
            SELECT weakest.* FROM weakest LEFT JOIN longest USING (lang, phrase)
            WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
        ranked AS (
            SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, score::BIGINT AS score FROM kept),
        ordered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ordered JOIN words USING (lang) WHERE rank <= 2000""",
}
