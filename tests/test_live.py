"""The streaming twins against the batch rules, with repeats, late rows and restarts."""

import os
import random
from datetime import datetime, timedelta

import pytest

from basketflow.operators.keyed import dedup
from basketflow.streaming import live

START = datetime(2024, 1, 1)
EVENTS = "event_id long, user_id long, event_type string, timestamp timestamp_ntz"
TOUCHES = "campaign_event_id long, campaign_id string, user_id long, generated_at timestamp_ntz"
ORDERS = "order_id string, user_id long, order_ts timestamp_ntz, total_usd decimal(18,2), status string"


def put(spark, path, rows, schema, number):
    """One file of a stream's folder."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/_new{number}")
    file = next(f for f in os.listdir(f"{path}/_new{number}") if f.endswith(".parquet"))
    os.rename(f"{path}/_new{number}/{file}", f"{path}/{number:04d}.parquet")


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*.parquet")


def drain(spark, base, rows):
    live.start_append(rows, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out")


def random_events(rng, n):
    return [(i, rng.choice([1, 1, 1, 2, None]), rng.choice(["view", "buy", None]),
             START + timedelta(minutes=i // 8)) for i in range(n)]


def test_unique_events_equal_the_batch_rule_over_restarts(spark, rows, tmp_path):
    base, given = str(tmp_path), random_events(random.Random(3), 240)
    out = None
    for part in range(3):
        put(spark, f"{base}/in", given[part * 80:part * 80 + 80], EVENTS, part)
        out = drain(spark, base, live.unique_events(stream(spark, f"{base}/in", EVENTS)))
    batch = dedup(spark.createDataFrame(given, EVENTS), live.EVENT_KEY, "event_id")
    assert rows(out, *live.EVENT_KEY) == rows(batch, *live.EVENT_KEY)


def test_repeats_within_the_delay_go_and_late_rows_too(spark, rows, tmp_path):
    base, event = str(tmp_path), (1, 1, "view", START)
    put(spark, f"{base}/in", [event, (2, 1, "view", START + timedelta(minutes=50))], EVENTS, 0)
    put(spark, f"{base}/in", [(3, *event[1:]), (4, 1, "view", START + timedelta(hours=5))], EVENTS, 1)
    put(spark, f"{base}/in", [(5, 2, "view", START + timedelta(hours=6))], EVENTS, 2)
    put(spark, f"{base}/in", [(6, 3, "view", START), (7, 3, "view", START + timedelta(hours=6))], EVENTS, 3)
    out = drain(spark, base, live.unique_events(stream(spark, f"{base}/in", EVENTS)))
    assert [r[0] for r in rows(out, "event_id")] == [1, 2, 4, 5, 7]


@pytest.mark.parametrize("seed", [1, 2])
def test_attributed_orders_equal_all_pairs(spark, rows, tmp_path, seed):
    base, rng = str(tmp_path), random.Random(seed)
    day = lambda n: START + timedelta(hours=6 * n)
    touches = [(i, rng.choice(["c1", "c2", None]), rng.choice([1, 1, 2, None]), day(i)) for i in range(160)]
    orders = [(f"o{i}", rng.choice([1, 1, 2, 3, None]), day(i), None, rng.choice(["success", "success", "failed"]))
              for i in range(160)]
    touches.append((900, "c1", 9, START))
    orders += [("exact", 9, START + timedelta(days=14), None, "success"),
               ("over", 9, START + timedelta(days=14, microseconds=1), None, "success")]
    orders.sort(key=lambda o: o[2])
    touches.sort(key=lambda t: t[3])
    for part in range(4):
        put(spark, f"{base}/t", touches[part * 41:part * 41 + 41], TOUCHES, part)
        put(spark, f"{base}/o", orders[part * 41:part * 41 + 41], ORDERS, part)
        out = drain(spark, base, live.attributed_orders(stream(spark, f"{base}/t", TOUCHES), stream(spark, f"{base}/o", ORDERS)))
    want = [(t[0], o[0]) for t in touches for o in orders
            if t[1] and t[2] is not None and t[2] == o[1] and o[4] == "success" and t[3] <= o[2] <= t[3] + timedelta(days=14)]
    assert rows(out, "campaign_event_id", "order_id") == sorted(want, key=repr)
    assert (900, "exact") in want and (900, "over") not in want
