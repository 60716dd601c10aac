"""Operators over keyed tables: first-per-key, upserts, deletes, stable ids.

Parquet tables know no MERGE, so an upsert is a full outer join of two frames
that each hold one row per key.  Every reduction to one row per key runs partly
before the shuffle, so a key with very many copies never meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    The filter ``row_number = 1`` lets Spark put a WindowGroupLimit before the
    exchange: each map task sends at most one row per key.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(_RANK, F.row_number().over(window))
            .where(F.col(_RANK) == 1).drop(_RANK))


def dedup(df: DataFrame, keys: Sequence[str], serial: str) -> DataFrame:
    """Keep the row with the lowest serial of every key; NULL keys equal each other."""
    return first_per_key(df, keys, [F.col(serial).asc()])


def latest_by(df: DataFrame, keys: Sequence[str], ts: str, serial: str) -> DataFrame:
    """Latest row per key.  A NULL timestamp counts as the latest, ties go to the
    highest serial."""
    return first_per_key(df, keys, [F.col(ts).desc_nulls_first(), F.col(serial).desc()])


def _outer(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """Full outer join; source columns get the prefix ``s_``, keys are merged."""
    renamed = source.select(
        *[F.col(k) for k in keys],
        *[F.col(c).alias(f"s_{c}") for c in source.columns if c not in keys],
        F.lit(True).alias("s_present"))
    return target.join(renamed, list(keys), "full_outer"), F.col("s_present").isNotNull()


def upsert_replace(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Insert new keys, overwrite ``columns`` (default: all) of known keys.

    Both inputs must hold one row per key.
    """
    columns = [c for c in (columns or target.columns) if c not in keys]
    joined, present = _outer(target.withColumn("t_present", F.lit(True)), source, keys)
    new_row = F.col("t_present").isNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif f"s_{c}" not in joined.columns:
            out.append(F.col(c))
        else:
            take = present if c in columns else (present & new_row)
            out.append(F.when(take, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c))
    return joined.select(*out)


def last_non_null(df: DataFrame, key: str, order: Column | str, columns: Sequence[str]) -> DataFrame:
    """Per key and column the last value in ``order`` that is not NULL."""
    order = F.col(order) if isinstance(order, str) else order
    return df.groupBy(key).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns])


def upsert_coalesce(target: DataFrame, source: DataFrame, key: str,
                    order: Column | str) -> DataFrame:
    """Insert new keys; in known rows a new value replaces the old unless it is NULL.

    Several source rows per key apply in ``order``.
    """
    columns = [c for c in target.columns if c != key]
    newest = last_non_null(source.where(F.col(key).isNotNull()), key, order, columns)
    joined, _ = _outer(target, newest, [key])
    return joined.select(
        F.col(key), *[F.coalesce(F.col(f"s_{c}"), F.col(c)).alias(c) for c in columns])


def append_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  serial: str) -> DataFrame:
    """The rows of ``source`` that an insert ignoring conflicts would add."""
    return dedup(source, keys, serial).join(target.select(*keys), list(keys), "left_anti")


def delete_orphans(df: DataFrame, keep: DataFrame, key: str) -> DataFrame:
    """Only the rows whose key occurs in ``keep``; NULLs in ``keep`` match nothing.

    ``df`` must hold one row per key.
    """
    return df.join(keep.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")


def add_missing_keys(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Append a row, NULL but for the key, for every id that ``df`` lacks."""
    missing = (ids.select(key).where(F.col(key).isNotNull()).distinct()
               .join(df.select(key), key, "left_anti"))
    return df.unionByName(missing, allowMissingColumns=True)


def number_new_names(names: DataFrame, name: str, existing: DataFrame, id_col: str) -> DataFrame:
    """Give each new distinct name the next free id, the same on every run.

    Names are numbered in the order (first three digits of md5, name).  Each of the
    4096 groups is numbered by itself and then shifted by the size of the groups
    before it, so no task sorts all names.
    """
    fresh = (names.select(name).where(F.col(name).isNotNull()).distinct()
             .join(existing.select(name), name, "left_anti")
             .withColumn("_group", F.substring(F.md5(F.col(name)), 1, 3)))
    sizes = fresh.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(   # at most 4096 rows
        "_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    start = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).scalar()
    rank = F.row_number().over(Window.partitionBy("_group").orderBy(name))
    return (fresh.withColumn("_place", rank).join(F.broadcast(shifts), "_group")
            .select((start + F.col("_shift") + F.col("_place")).alias(id_col), F.col(name)))
