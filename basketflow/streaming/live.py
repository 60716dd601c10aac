"""Streaming twins of batch rules: unique events, and orders that follow a campaign's touch.

State is kept as long as the watermark needs it: a key of ``unique_events`` for ``delay``, a
touch of ``attributed_orders`` for the attribution span and ``delay``.  Rows that come more than ``delay``
behind the newest row of the batch before the last are left out, as Spark's watermark has it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketflow.plans.marts import ATTRIBUTION

EVENT_KEY = ["user_id", "event_type", "timestamp"]


def _watermarked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """A watermark needs a time with a zone; the session's is UTC."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def _plain_times(df: DataFrame, *times: str) -> DataFrame:
    return df.withColumns({ts: F.col(ts).cast("timestamp_ntz") for ts in times})


def unique_events(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The first event to come of each user, type and time (V3).

    Equal keys have equal times, so a row that is not late always meets the key it repeats.
    """
    return _plain_times(_watermarked(events, "timestamp", delay).dropDuplicatesWithinWatermark(EVENT_KEY), "timestamp")


def attributed_orders(touches: DataFrame, orders: DataFrame, delay: str = "1 hour") -> DataFrame:
    """(touch, order) pairs: successful orders of the user within the span after a touch (as in M7).

    ``touches`` has campaign_event_id, campaign_id, user_id, generated_at; ``orders`` order_id, user_id,
    order_ts, total_usd, status.  The join by user and time lets Spark drop a touch once no order
    can follow it any more, and an order once no touch can come before it.  The result has a row per
    pair; for the totals of busy users, which need no pairs, take the batch mart.
    """
    touch = touches.where("campaign_id IS NOT NULL").select(
        "campaign_event_id", "campaign_id", "user_id", "generated_at")
    order = orders.where("status = 'success'").select(
        "order_id", F.col("user_id").alias("buyer"), "order_ts", "total_usd")
    within = ((F.col("user_id") == F.col("buyer")) & (F.col("order_ts") >= F.col("generated_at"))
              & (F.col("order_ts") <= F.col("generated_at") + F.expr(ATTRIBUTION)))
    pairs = _watermarked(touch, "generated_at", delay).join(_watermarked(order, "order_ts", delay), within)
    return _plain_times(pairs.drop("buyer"), "generated_at", "order_ts")


def start_append(rows: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append a stream to a Parquet table; without ``interval`` it drains what is there and stops.

    The sink's log takes each batch once, also when it runs again.
    """
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start(path)
