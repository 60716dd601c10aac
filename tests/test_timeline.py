import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from basketflow.operators import timeline

START = datetime(2024, 1, 1)


def random_times(rng, n):
    return [(rng.choice([1, 1, 1, 2, 3]), START + timedelta(minutes=15 * rng.randint(0, 400)))
            for _ in range(n)]


def test_totals_in_span_equals_brute_force(spark):
    rng = random.Random(5)
    points = {}
    for user, at in random_times(rng, 120):
        points[(user, at)] = points.get((user, at), 0) + rng.randint(1, 9)
    probes = sorted(set(random_times(rng, 80)) | {(9, START)})
    span = timedelta(hours=6)
    df = timeline.totals_in_span(
        spark.createDataFrame([(u, t, f"{u}") for u, t in probes], "u int, t timestamp_ntz, tag string"),
        spark.createDataFrame([(u, t, n) for (u, t), n in points.items()],
                              "u int, t timestamp_ntz, n bigint"),
        "u", "t", ["u", "t"], F.expr("interval 6 hours"), ["n"])
    got = {(r.u, r.t): (r.hi_n - r.lo_n, r.tag) for r in df.collect()}
    assert got == {
        (u, t): (sum(n for (pu, pt), n in points.items() if pu == u and t <= pt <= t + span), f"{u}")
        for u, t in probes}


def test_neighbours_equal_brute_force(spark):
    rng = random.Random(6)
    times = sorted(set(random_times(rng, 150)))
    df = spark.createDataFrame(times, "u int, t timestamp_ntz")
    got = {(r.u, r.t): (r.prev_ts, r.next_ts) for r in timeline.neighbours(df, ["u"], "t").collect()}
    want = {}
    for u, t in times:
        mine = [x for v, x in times if v == u]
        want[(u, t)] = (max((x for x in mine if x < t), default=None),
                        min((x for x in mine if x > t), default=None))
    assert got == want


def test_running_totals_carry_over_hours(spark, rows):
    df = spark.createDataFrame(
        [(1, START, 0, 1), (1, START + timedelta(minutes=5), 0, 2),
         (1, START + timedelta(hours=3), 0, 4), (2, START, 0, 8)],
        "u int, t timestamp_ntz, tie int, n int")
    out = timeline.running_totals(df, ["u"], "t", "tie", ["n"])
    assert rows(out, "u", "n") == [(1, 1), (1, 3), (1, 7), (2, 8)]
