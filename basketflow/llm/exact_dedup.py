"""Exact deduplication with keyed streaming state.

Every row is staged as (digest, identifier, locator).  A stream over the staged rows
keeps one state entry per digest in a disk-backed store, without expiry: the identifier
and the locator of the row that stays and the number of rows seen.  Rows of one digest are
combined before the shuffle, so a text that a third of all rows share adds one row per
task.  Equal digests are then held against the full texts; digests that turn out to
stand for several texts are grouped by text.

Defined results: null texts count as empty; a null identifier ranks below all others; of
rows that repeat both identifier and text exactly one stays; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketflow.llm.graph import only_wanted
from basketflow.llm.text import ascii_lower, small_batches, unused
from basketflow.session import scratch_dir

# Staged files that one micro-batch reads.
FILES_PER_BATCH = 256
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # without reserved file space: a small partition takes what it holds, not 4 MB and more
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    # stores are closed soon after the stream has ended
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
    "spark.sql.streaming.metricsEnabled": "false",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def normalised(docs: DataFrame, text: str) -> Column:
    return ascii_lower(F.coalesce(docs[text], F.lit("")))


def stream_groups(staged: DataFrame, checkpoint: str, ledger: str) -> None:
    """Run a stream of (digest, doc_id, locator) rows until its input is used up.

    ``ledger`` receives, per batch, the entries that changed.  A restarted run goes on
    from ``checkpoint``; a repeated batch overwrites its own folder.
    """
    entries = staged.groupBy("digest").agg(
        F.max(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("rows"))

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{ledger}/batch={batch_id}")

    query = (entries.writeStream.outputMode("update").foreachBatch(save)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The last entry of each digest: digest, keep (doc_id, locator), rows."""
    entries = spark.read.parquet(ledger)
    last = entries.groupBy("digest").agg(
        F.max(F.struct("batch", "keep", "rows")).alias("last"))
    return last.select("digest", "last.keep", "last.rows")


def group_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 digest: Callable[[Column], Column] = sha256,
                 files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; the largest identifier stays.
    ``digest`` may be any function of the text; a weak one only costs time.
    """
    spark = docs.sparkSession
    small_batches(spark)
    root = scratch_dir(spark, "exact-dedup")
    clean = normalised(docs, text)
    rows = docs.select(docs[doc_id].alias("doc_id"), clean.alias("clean"))
    (rows.select("doc_id", digest(F.col("clean")).alias("digest"), sha256(F.col("clean")).alias("text_sha256"),
                 F.monotonically_increasing_id().alias("locator"))
     .write.parquet(f"{root}/staged"))
    staged = spark.read.parquet(f"{root}/staged")
    with _settings(spark, STATE_CONF):
        stream = (spark.readStream.schema(staged.schema).option("maxFilesPerTrigger", files_per_batch)
                  .parquet(f"{root}/staged"))
        stream_groups(stream, f"{root}/checkpoint", f"{root}/ledger")
    groups = read_ledger(spark, f"{root}/ledger") if staged.take(1) else (
        staged.select("digest", F.struct("doc_id", "locator").alias("keep"), F.lit(1).cast("long").alias("rows")))
    # written, so that the join below has no aggregation in its stage and can split a large group
    groups.write.parquet(f"{root}/groups")
    groups = spark.read.schema(groups.schema).parquet(f"{root}/groups")
    shared = _shared_digests(rows, digest, groups.where("rows > 1"))
    shared.write.parquet(f"{root}/shared")
    shared = spark.read.schema(shared.schema).parquet(f"{root}/shared")
    out = staged.join(groups, "digest", "left")
    if shared.take(1):
        out = _by_text(rows, digest, staged, out, shared)
    return out.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("rows").alias("group_size"),
        (F.col("locator") == F.col("keep.locator")).alias("kept"), "text_sha256")


def _shared_digests(rows: DataFrame, digest: Callable[[Column], Column], hits: DataFrame) -> DataFrame:
    """Digests that stand for more than one text: every hit is compared in full.

    Only texts whose digest was seen again move (a bitmap of these passes over the others).  Equal
    texts collapse inside each task, so a digest's set has one text unless it is shared.
    """
    key = F.xxhash64("digest").alias("key")
    texts = only_wanted(rows.select(digest(F.col("clean")).alias("digest"), "clean").select(key, "digest", "clean"),
                        hits.select(key), "key")
    return (texts.groupBy("digest").agg(F.size(F.collect_set("clean")).alias("texts"))
            .where("texts > 1").select("digest"))


def _by_text(rows: DataFrame, digest: Callable[[Column], Column], staged: DataFrame, out: DataFrame,
             shared: DataFrame) -> DataFrame:
    """Entries of shared digests anew, grouped by the text itself."""
    texts = (rows.withColumn("digest", digest(F.col("clean"))).join(shared, "digest", "left_semi")
             .select("clean", sha256(F.col("clean")).alias("text_sha256")).distinct())
    members = staged.join(shared, "digest", "left_semi")
    exact = (members.join(texts, "text_sha256").groupBy("clean", "text_sha256")
             .agg(F.max(F.struct("doc_id", "locator")).alias("keep"), F.count(F.lit(1)).alias("rows"))
             .drop("clean"))
    return (out.join(shared, "digest", "left_anti").unionByName(
        members.join(exact, "text_sha256").select(out.columns)))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows with the same identifier and text the one with the smallest hash of all columns stays.
    """
    groups = group_copies(docs, doc_id, text)
    sha, order = unused("sha", docs.columns), unused("order", docs.columns)
    kept = groups.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha"))
    marked = docs.withColumn(sha, sha256(normalised(docs, text)))
    out = marked.join(kept, marked[doc_id].eqNullSafe(kept["kept_id"]) & (marked[sha] == kept["kept_sha"]), "left_semi")
    repeated = groups.groupBy("doc_id", "text_sha256").count().where("count > 1")
    if repeated.take(1):
        first = Window.partitionBy(doc_id, sha).orderBy(F.xxhash64(*docs.columns))
        out = out.withColumn(order, F.row_number().over(first)).where(F.col(order) == 1)
    return out.select(*docs.columns)
