"""Secrets in versions of files, scanned once per content and rule version.

Each version's content is addressed by its SHA-256.  A ledger in the shared folder holds,
for every scanned blob, the rule versions applied and the spans found.  A scan takes only
the blobs for which some rule version is new, applies only those rules, appends to the ledger
and joins the findings back to every path that has the content.  All of it is DataFrame code.

Defined results: a null content counts as empty; versions with the same path are all
reported; an empty table gives an empty result; columns beside path and content are not
read.  Spans are in code points, the end exclusive.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow.session import scratch_dir

SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# The base kinds in their order, then formats of well-known credentials.
RULES = (
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         group=2, least=12, base=True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=18, base=True),
    Rule("hex", 1, r"[0-9a-f]{16,}", least=16, base=True),
    Rule("key_block", 1, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("web_token", 1, r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("forge_token", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", 1, r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("login_url", 1, r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@"),
)


def _hits(content: Column, rule: Rule) -> Column:
    """(length before, length, length of the group) of each match, one after the other."""
    before = F.transform(F.split(content, rule.pattern, -1), F.char_length)
    found = F.transform(F.regexp_extract_all(content, F.lit(rule.pattern), F.lit(0)), F.char_length)
    group = found if not rule.group else F.transform(
        F.regexp_extract_all(content, F.lit(rule.pattern), F.lit(rule.group)), F.char_length)
    zipped = F.arrays_zip(before.alias("gap"), found.alias("length"), group.alias("group"))
    return F.when(content.rlike(rule.pattern), F.slice(zipped, 1, F.size(found)))


def _spans(hits: Column, rank: int, rule: Rule) -> Column:
    """Positions from the lengths before them; matches with a short group are left out."""
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPAN).alias("spans"))

    def step(seen: Column, hit: Column) -> Column:
        begin = seen["at"] + hit["gap"]
        end = begin + hit["length"]
        span = F.array(F.struct(begin.alias("start"), F.lit(rank).alias("rank"),
                                F.lit(rule.name).alias("kind"), end.alias("end")))
        spans = F.when(hit["group"] < rule.least, seen["spans"]).otherwise(
            F.concat(F.coalesce(seen["spans"], F.array().cast(SPAN)), span))
        return F.struct(end.alias("at"), spans.cast(SPAN).alias("spans"))

    empty = F.array().cast(SPAN)
    return F.coalesce(F.aggregate(hits, start, step)["spans"], empty)


def find(blobs: DataFrame, rules: Sequence[Rule] = RULES, todo: str | None = None) -> DataFrame:
    """``blobs`` (with ``content``) plus ``spans``: of all rules, or of those listed in ``todo``."""
    hits = {f"_hits_{r.name}": _hits(F.col("content"), r) if todo is None else
            F.when(F.array_contains(todo, r.key), _hits(F.col("content"), r)) for r in rules}
    marked = blobs.select("*", *[c.alias(n) for n, c in hits.items()]).drop("content")
    spans = F.concat(*[_spans(F.col(n), i, r) for i, (n, r) in enumerate(zip(hits, rules))])
    return marked.withColumn("spans", F.array_sort(spans)).drop(*hits)


def _ledger(spark: SparkSession, folder: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(f"blob string, scanned array<string>, spans {SPAN}").parquet(folder)


def scan(versions: DataFrame, ledger: str, path: str = "path", content: str = "content",
         rules: Sequence[Rule] = RULES) -> DataFrame:
    """Scan what the ledger lacks, append it, and return path, blob and spans of every version.

    A text that many versions share is scanned once: duplicates go in each task before the
    shuffle.  Spans of older rule versions stay in the ledger but are not returned.
    """
    spark = versions.sparkSession
    kinds = {r.name: r for r in rules}
    text = F.coalesce(versions[content], F.lit(""))
    rows = versions.select(versions[path].alias("path"), F.sha2(text, 256).alias("blob"), text.alias("content"))
    first = Window.partitionBy("blob").orderBy("path")
    blobs = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n", "path")
    keys = F.array(*[F.lit(r.key) for r in rules])
    known = _ledger(spark, ledger)
    if known is None:
        blobs = blobs.withColumn("scanned", keys)
    else:
        seen = (known.select("blob", F.explode("scanned").alias("key")).groupBy("blob")
                .agg(F.collect_set("key").alias("seen")))
        blobs = (blobs.join(seen, "blob", "left")
                 .withColumn("scanned", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))))
                 .drop("seen").where(F.size("scanned") > 0))
    (find(blobs, rules, None if known is None else "scanned")
     .withColumn("spans", F.transform("spans", lambda s: s.withField("kind", _with_version(s["kind"], kinds))))
     .select("blob", "scanned", "spans").write.mode("append").parquet(ledger))
    now = F.transform(
        F.filter(F.flatten(F.collect_list("spans")), lambda s: F.array_contains(keys, s["kind"])),
        lambda s: s.withField("kind", F.substring_index(s["kind"], "@", 1)))
    found = (_ledger(spark, ledger).where(F.size("spans") > 0).groupBy("blob")
             .agg(F.array_sort(now).alias("spans")))
    # written, so that the join has no aggregation in its stage and can split a frequent blob
    folder = scratch_dir(spark, "findings")
    found.write.parquet(folder)
    found = spark.read.schema(found.schema).parquet(folder)
    return (rows.select("path", "blob").join(found, "blob", "left")
            .select("path", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans")))


def _with_version(kind: Column, kinds: dict[str, Rule]) -> Column:
    version = F.create_map(*[F.lit(x) for r in kinds.values() for x in (r.name, r.key)])
    return version[kind]
