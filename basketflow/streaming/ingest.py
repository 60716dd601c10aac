"""The ingest stream: topic in, raw tables out.

One write per micro-batch, in folders ``route=<table>/batch_id=<n>``.  A batch that
is run again overwrites its own folders, so every message lands once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from basketflow import schemas
from basketflow.streaming.router import (
    SERIAL, WIDE_SCHEMA, fail_on_bad, message_fields, parse_messages,
)

LANDED_SCHEMA = T.StructType([
    T.StructField("serial", T.LongType()), *WIDE_SCHEMA.fields,
    T.StructField("received_at", T.TimestampNTZType()),
    T.StructField("route", T.StringType()), T.StructField("batch_id", T.LongType())])


def read_events_stream(spark: SparkSession, source: str, fmt: str = "kafka",
                       batch_size: int | None = None, **options: str) -> DataFrame:
    """A stream of messages with one column, ``value``.

    ``kafka``: ``source`` is the topic, ``kafka__bootstrap__servers`` and other options
    come in by name (``__`` for dots); needs the Kafka connector on the class path.
    ``text``: ``source`` is a folder of JSON lines.  ``batch_size`` bounds a micro-batch:
    messages for Kafka, files for text.
    """
    reader = spark.readStream
    for name, value in options.items():
        reader = reader.option(name.replace("__", "."), value)
    if fmt == "kafka":
        reader = reader.format("kafka").option("subscribe", source)
        if "startingOffsets" not in options:
            reader = reader.option("startingOffsets", "latest")
        if batch_size:
            reader = reader.option("maxOffsetsPerTrigger", batch_size)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    if fmt == "text":
        if batch_size:
            reader = reader.option("maxFilesPerTrigger", batch_size)
        return reader.text(source)
    raise ValueError(f"unknown message source {fmt}")


def _serial(batch_id: int):
    """Row numbers that grow with the batch: 23 bits batch, 14 bits task, 26 bits row.

    The rows come straight from the source, so a task that runs again counts the same.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    task = F.spark_partition_id().cast("bigint")
    fits = (task < (1 << 14)) & (row < (1 << 26))
    number = F.lit(batch_id << 40) + F.shiftleft(task, 26) + row
    return F.when(fits, number).otherwise(
        F.raise_error(F.lit("micro-batch too large, set batch_size")).cast("bigint"))


def append_raw(base: str, on_bad: str = "quarantine", then: Callable[[int], None] | None = None):
    """The ``foreachBatch`` function that lands one micro-batch under ``base``.

    ``then`` is called with the number of each landed batch, again if the batch runs again.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        # A file per route is open at a time in each task, so wide rows need not be sorted by route first.
        batch.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", len(schemas.RAW) + 1)
        wide = parse_messages(batch)
        if on_bad == "fail":
            wide = fail_on_bad(wide)
        (wide.withColumns({"serial": _serial(batch_id), "batch_id": F.lit(batch_id).cast("bigint"),
                           "received_at": F.current_timestamp().cast("timestamp_ntz")})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("route", "batch_id").parquet(base))
        if then is not None:
            then(batch_id)
    return land


def start_ingest(messages: DataFrame, base: str, checkpoint: str, on_bad: str = "quarantine",
                 interval: str | None = None, then: Callable[[int], None] | None = None) -> StreamingQuery:
    """Start the ingest; without ``interval`` it drains what is there and stops."""
    writer = messages.writeStream.foreachBatch(append_raw(base, on_bad, then)).option(
        "checkpointLocation", checkpoint)
    writer = (writer.trigger(processingTime=interval) if interval
              else writer.trigger(availableNow=True))
    return writer.start()


def read_landed(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(LANDED_SCHEMA).parquet(base)


def landed_batches(spark: SparkSession, base: str) -> list[int]:
    """The numbers of the landed batches, by their folders; there is one row per batch."""
    found = read_landed(spark, base).select("batch_id").distinct().orderBy("batch_id")
    return [row["batch_id"] for row in found.collect()]


def read_raw(spark: SparkSession, base: str, table: str, first: int | None = None,
             last: int | None = None) -> DataFrame:
    """A raw table, or its batches from ``first`` to ``last``; only its own folders and columns are read."""
    rows = read_landed(spark, base).where(F.col("route") == table)
    if first is not None:
        rows = rows.where(F.col("batch_id") >= first)
    if last is not None:
        rows = rows.where(F.col("batch_id") <= last)
    has_received = "received_at" in schemas.RAW[table].names
    return rows.select(
        F.col("serial").alias(SERIAL[table]), *[f.name for f in message_fields(table)],
        *(["received_at"] if has_received else []))
