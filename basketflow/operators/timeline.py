"""Running totals and neighbours along time, per key.

A key's rows are cut into hours.  Windows run inside (key, hour) and a second,
much smaller window carries values from hour to hour, so the rows of one very busy
key spread over many tasks while the results stay exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOUR = "_hour"


def _with_hour(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(_HOUR, F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz"))


def running_totals(df: DataFrame, keys: Sequence[str], ts: str, tie: str,
                   values: Sequence[str], summed: DataFrame | None = None) -> DataFrame:
    """Replace each value by its sum over the key's rows up to and with this one,
    in the order (ts, tie).

    ``summed`` names a frame that is cheaper to add up per hour than ``df``: it has at
    least the same keys and hours and gives the same sums.
    """
    keys = list(keys)
    rows = _with_hour(df, ts)
    before = Window.partitionBy(*keys).orderBy(_HOUR).rowsBetween(Window.unboundedPreceding, -1)
    per_hour = rows if summed is None else _with_hour(summed, ts)
    carried = (per_hour.groupBy(*keys, _HOUR).agg(*[F.sum(v).alias(v) for v in values])
               .select(*keys, _HOUR, *[
                   F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_carry_{v}")
                   for v in values]))
    inside = Window.partitionBy(*keys, _HOUR).orderBy(ts, tie).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    running = rows.withColumns({f"_run_{v}": F.sum(v).over(inside) for v in values})
    kept = [c for c in df.columns if c not in values]
    return running.join(carried, [*keys, _HOUR]).select(*kept, *[
        (F.coalesce(F.col(f"_run_{v}"), F.lit(0)) + F.col(f"_carry_{v}")).alias(v)
        for v in values])


def neighbours(df: DataFrame, keys: Sequence[str], ts: str,
               times: DataFrame | None = None) -> DataFrame:
    """Add ``prev_ts`` and ``next_ts``, the key's times just before and after this row.

    Times must be distinct within a key.  ``times`` names a cheaper frame with the same
    keys and times, which may repeat there.
    """
    keys = list(keys)
    inside = Window.partitionBy(*keys, _HOUR).orderBy(ts)
    rows = _with_hour(df, ts).select(
        "*", F.lag(ts).over(inside).alias("_prev"), F.lead(ts).over(inside).alias("_next"))
    hours = Window.partitionBy(*keys).orderBy(_HOUR)
    edges = ((rows if times is None else _with_hour(times, ts)).groupBy(*keys, _HOUR)
             .agg(F.min(ts).alias("_first"), F.max(ts).alias("_final"))
             .select(*keys, _HOUR, F.lag("_final").over(hours).alias("_prev_hour"),
                     F.lead("_first").over(hours).alias("_next_hour")))
    return rows.join(edges, [*keys, _HOUR]).select(
        *df.columns,
        F.coalesce("_prev", "_prev_hour").alias("prev_ts"),
        F.coalesce("_next", "_next_hour").alias("next_ts"))


def totals_in_span(probes: DataFrame, points: DataFrame, key: str, ts: str,
                   probe_id: Sequence[str], span: Column, values: Sequence[str],
                   times: DataFrame | None = None) -> DataFrame:
    """For each probe the totals of the key's points with ``ts <= point ts <= ts + span``.

    ``points`` has (key, ts, *values); every probe is told apart by ``probe_id``, which
    includes key and ts.  No pair of probe and point is built: a probe is put into the
    stream of points twice, at its start and at its end, and reads the running total
    there.  Returns the probes with ``lo_<v>`` (total before the start) and ``hi_<v>``
    (total up to the end).  ``times`` names a cheaper frame with the probes' keys and
    times.
    """
    carried = [c for c in probes.columns if c not in probe_id]
    ends = F.inline(F.array(
        F.struct(F.col(ts).alias("_at"), F.lit(0).alias("_place")),
        F.struct((F.col(ts) + span).alias("_at"), F.lit(2).alias("_place"))))
    placed = points.select(key, F.col(ts).alias("_at"), F.lit(1).alias("_place"), *values)

    def stream(marks: DataFrame) -> DataFrame:
        return marks.select("*", ends).unionByName(placed, allowMissingColumns=True)

    run = running_totals(
        stream(probes), [key], "_at", "_place", values,
        summed=None if times is None else stream(times.select(key, ts)),
    ).where(F.col("_place") != 1)
    picks = []
    for v in values:
        picks.append(F.max(F.when(F.col("_place") == 0, F.col(v))).alias(f"lo_{v}"))
        picks.append(F.max(F.when(F.col("_place") == 2, F.col(v))).alias(f"hi_{v}"))
    return run.groupBy(*probe_id).agg(*[F.max(c).alias(c) for c in carried], *picks)
