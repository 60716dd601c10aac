"""Equi-joins that stay even when one key holds a large share of the left rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is split once it has more left rows than this; each part gets about as many.
HOT_ROWS = 1_000_000
# At most this many keys are split, those with the most rows.  Any other key then holds
# less than a 100,000th of the rows.
MAX_HOT_KEYS = 100_000
# NULL keys match nothing, so their rows can go anywhere.
NULL_PARTS = 4096

_PARTS, _SALT = "_parts", "_salt"


def split_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str,
               spread_by: Sequence[str], hot_rows: int = HOT_ROWS,
               counted: DataFrame | None = None) -> DataFrame:
    """``left.join(right, on, how)`` with hot keys of the left side cut into parts.

    Joins inner, left, left_semi and left_anti.  A first pass over the key columns
    finds the keys with more than ``hot_rows`` rows.  Left rows of such a key are
    dealt out over parts by a hash of ``spread_by`` (repeatable when a task is run
    again), and the right rows of that key are copied once per part.  The list of hot
    keys never exceeds MAX_HOT_KEYS entries and so is broadcast; other keys join as they
    are.  ``counted`` names a frame that is cheaper to count than ``left`` and has about
    as many rows per key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot split a {how} join")
    on = [on] if isinstance(on, str) else list(on)
    hot = ((left if counted is None else counted).groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
           .where(F.col("_rows") > hot_rows)
           .orderBy(F.col("_rows").desc(), *on).limit(MAX_HOT_KEYS)
           .select(*on, F.ceil(F.col("_rows") / hot_rows).cast("int").alias(_PARTS)))
    hot = F.broadcast(hot)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    deal = F.xxhash64(*spread_by)
    salted_left = left.join(hot, on, "left").withColumn(
        _SALT,
        F.when(no_key, F.pmod(deal, F.lit(NULL_PARTS)))
        .when(F.col(_PARTS).isNotNull(), F.pmod(deal, F.col(_PARTS)))
        .otherwise(F.lit(0)).cast("int")).drop(_PARTS)
    salted_right = right.join(hot, on, "left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_PARTS), F.lit(1)) - 1))
    ).drop(_PARTS)
    return salted_left.join(salted_right, [*on, _SALT], how).drop(_SALT)
