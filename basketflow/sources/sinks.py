"""Writers.

A table is a folder of numbered snapshots, ``<base>/snapshot=<n>``; the highest one
that carries a ``_SUCCESS`` file is current.  A job reads the current snapshot and
writes the next, so a path is never overwritten while it is read and a failed or
repeated write leaves the current snapshot alone.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow import schemas

MONTH = "yyyymm"
_SNAPSHOT = re.compile(r"snapshot=(\d+)$")


# --- snapshots ----------------------------------------------------------------
def _snapshots(spark: SparkSession, base: str) -> tuple[object, list[tuple[int, object, bool]]]:
    """The file system and (number, path, complete) of each snapshot, through Hadoop."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    if fs.exists(root):
        for status in fs.listStatus(root):
            match = _SNAPSHOT.search(status.getPath().getName())
            if match:
                done = fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
                found.append((int(match.group(1)), status.getPath(), done))
    return fs, sorted(found, key=lambda entry: entry[0])


def current_snapshot(spark: SparkSession, base: str) -> str | None:
    done = [path for _, path, complete in _snapshots(spark, base)[1] if complete]
    return done[-1].toString() if done else None


def read_snapshot(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The current rows, none if the table was never written."""
    path = current_snapshot(spark, base)
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def write_snapshot(df: DataFrame, base: str, partition_by: Sequence[str] = (),
                   commit: bool = True) -> str:
    """Write the next snapshot and return its path.

    With ``commit=False`` it only becomes current by ``commit_snapshot``.
    """
    numbers = [n for n, _, _ in _snapshots(df.sparkSession, base)[1]]
    path = f"{base.rstrip('/')}/snapshot={max(numbers, default=0) + 1}"
    writer = df.write.mode("error").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", str(commit).lower())
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def _path(spark: SparkSession, path: str) -> tuple[object, object]:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder has ended."""
    return exists(spark, f"{path}/_SUCCESS")


def move_partitions(spark: SparkSession, source: str, target: str) -> None:
    """Put the partition folders of ``source`` in place of those in ``target``; may be repeated.

    Folders are renamed, no row is read or written.  A folder leaves ``source`` only when it is in place.
    """
    fs, origin = _path(spark, source)
    _, goal = _path(spark, target)
    fs.mkdirs(goal)
    for status in fs.listStatus(origin):
        if status.isDirectory():
            name = status.getPath().getName()
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(goal, name)
            fs.delete(place, True)
            if not fs.rename(status.getPath(), place):
                raise OSError(f"could not move {status.getPath()} to {place}")


def commit_snapshot(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, f"{path}/_SUCCESS")
    fs.create(target).close()


def discard_snapshot(spark: SparkSession, path: str) -> None:
    """Delete a snapshot that was written but not committed."""
    fs, marker = _path(spark, f"{path}/_SUCCESS")
    if fs.exists(marker):
        raise ValueError(f"{path} is committed")
    fs.delete(marker.getParent(), True)


def drop_old_snapshots(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Delete all but the newest complete snapshots, and the remains of failed writes
    before them; returns how many went."""
    fs, found = _snapshots(spark, base)
    kept = [number for number, _, complete in found if complete][-max(keep, 1):]
    old = [path for number, path, complete in found
           if kept and number < kept[-1] and not (complete and number in kept)]
    for path in old:
        fs.delete(path, True)
    return len(old)


# --- plain writes -------------------------------------------------------------
def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def partition_by_month(df: DataFrame, date_col: str) -> DataFrame:
    """Add the month column a mart is partitioned by."""
    return df.withColumn(MONTH, F.date_format(date_col, "yyyyMM").cast("int"))


def months_between(df: DataFrame, date_col: str, first: date, last: date) -> DataFrame:
    """Rows of a date range; the month filter prunes partitions of a written mart."""
    lo, hi = (d.year * 100 + d.month for d in (first, last))
    return df.where(F.col(MONTH).between(lo, hi)).where(F.col(date_col).between(first, last))


def sorted_within_files(df: DataFrame, keys: Sequence[str],
                        partition_by: Sequence[str] = ()) -> DataFrame:
    """Files of an even size, each sorted by the keys, few of them per partition folder.

    ``rebalance`` lets AQE join small and split large shuffle partitions, so a month
    with most of the rows does not end up in one task.
    """
    even = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    order = [*partition_by, *keys]
    return even.sortWithinPartitions(*order) if order else even


# --- marts --------------------------------------------------------------------
def _mart_layout(df: DataFrame, mart: str) -> tuple[DataFrame, list[str]]:
    month = schemas.MART_MONTH_COLUMN.get(mart)
    parts = [MONTH] if month else []
    out = partition_by_month(df, month) if month else df
    return sorted_within_files(out, schemas.MART_SORT[mart], parts), parts


def mart_schema(mart: str) -> T.StructType:
    fields = list(schemas.MART[mart].fields)
    if mart in schemas.MART_MONTH_COLUMN:
        fields.append(T.StructField(MONTH, T.IntegerType()))
    return T.StructType(fields)


def read_mart(spark: SparkSession, base: str, mart: str) -> DataFrame:
    return read_snapshot(spark, f"{base}/{mart}", mart_schema(mart))


def publish(df: DataFrame, base: str, mart: str, commit: bool = True) -> str:
    """Replace a mart by ``df``, partitioned by month and sorted; returns the path."""
    laid_out, parts = _mart_layout(df, mart)
    return write_snapshot(laid_out, f"{base}/{mart}", parts, commit)


def replace_recent(existing: DataFrame, new: DataFrame, date_col: str, as_of: date,
                   days: int = 30) -> DataFrame:
    """Rows older than ``as_of - days`` stay, later ones are taken from ``new``."""
    cut = F.lit(as_of - timedelta(days=days))
    old = existing.where(F.coalesce(F.col(date_col) < cut, F.lit(True)))
    return old.unionByName(new.where(F.col(date_col) >= cut))


def replace_months(df: DataFrame, base: str, mart: str, as_of: date, days: int = 30) -> None:
    """Replace the last ``days`` days of a mart by months, in the months they touch only.

    These months are first written to a pending folder, old rows before the days included, then
    put in place of the ones in the current snapshot.  A run that was interrupted while
    putting them in place is finished by the next.  Readers should wait meanwhile.
    """
    spark, root = df.sparkSession, f"{base}/{mart}"
    finish_months(spark, base, mart)
    column, cut = schemas.MART_MONTH_COLUMN[mart], as_of - timedelta(days=days)
    first = cut.year * 100 + cut.month
    old = read_mart(spark, base, mart).where(F.col(MONTH) >= first).select(*schemas.MART[mart].names)
    laid_out, parts = _mart_layout(replace_recent(old, df, column, as_of, days), mart)
    pending = f"{root}/_pending"
    laid_out.write.mode("overwrite").partitionBy(*parts).parquet(f"{pending}/months")
    spark.range(first, first + 1).write.mode("overwrite").parquet(f"{pending}/first")
    commit_snapshot(spark, pending)
    finish_months(spark, base, mart)


def finish_months(spark: SparkSession, base: str, mart: str) -> None:
    """Put complete pending months in place, forget incomplete ones; may be repeated."""
    pending, target = f"{base}/{mart}/_pending", current_snapshot(spark, f"{base}/{mart}")
    if is_complete(spark, pending):
        first = spark.read.parquet(f"{pending}/first").first()[0]
        new = spark.read.schema(mart_schema(mart)).parquet(f"{pending}/months")
        # one row per month in both lists
        gone = (read_mart(spark, base, mart).where(F.col(MONTH) >= first).select(MONTH).distinct()
                .join(new.select(MONTH).distinct(), MONTH, "left_anti").collect())
        (sorted_within_files(new, schemas.MART_SORT[mart], [MONTH]).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(target))
        for month in gone:
            fs, folder = _path(spark, f"{target}/{MONTH}={month[0]}")
            fs.delete(folder, True)
    fs, folder = _path(spark, pending)
    fs.delete(folder, True)


def compact(spark: SparkSession, base: str, schema: T.StructType,
            sort_keys: Sequence[str] = ()) -> str:
    """Rewrite the current snapshot into files of an even size, sorted by the keys.

    The size is that of ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.  A table by
    month stays one.
    """
    parts = [MONTH] if MONTH in schema.names else []
    df = read_snapshot(spark, base, schema)
    return write_snapshot(sorted_within_files(df, sort_keys, parts), base, parts)
