"""Connected components of links held in a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.session import scratch_dir

# Bits of a filter of wanted numbers (16 MB).
BITS = 1 << 27


def bitmap(keys: DataFrame, key: str) -> np.ndarray:
    """BITS bits, those of the keys set.  Its size is fixed; when full it lets every key through."""
    words = (keys.groupBy(F.expr(f"shiftright(pmod({key}, {BITS}), 6)").alias("word"))
             .agg(F.expr(f"bit_or(shiftleft(1L, cast(pmod({key}, 64) AS int)))").alias("bits"))).toArrow()
    out = np.zeros(BITS >> 6, dtype=np.int64)
    for batch in words.to_batches():
        out[batch.column("word").to_numpy()] = batch.column("bits").to_numpy()
    del words
    pa.default_memory_pool().release_unused()  # the driver holds the bitmap alone
    return out


def may_hold(bits: np.ndarray, keys: pa.Array) -> pa.Array:
    """Whether each key may be one of those of the bitmap; wanted keys always are."""
    key = keys.fill_null(0).to_numpy() % BITS
    return pa.array((bits[key >> 6] >> (key & 63)) & 1 == 1)


def only_wanted(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key may be wanted, without moving them: some others stay, no wanted one goes."""
    sent = rows.sparkSession.sparkContext.broadcast(bitmap(wanted, key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(may_hold(sent.value, batch.column(key)))

    return rows.mapInArrow(run, rows.schema)


def _saved(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every linked id the smallest id reachable from it.

    Large-star and small-star steps in turn: each replaces a node's links by links to its
    smallest neighbour, until every node points at its component's smallest id.  A step
    is two aggregations and a join; a node with very many links adds one row for each,
    which the join splits.  The links after every second step are written to the shared
    folder, so a lost executor repeats one round only.
    """
    spark = links.sparkSession
    root = scratch_dir(spark, "components")
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = _saved(edges, f"{root}/0")
    step, known = 0, edges.count()
    while True:
        step += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))).distinct()
        after = _saved(small, f"{root}/{step}")
        held = after.join(edges.withColumn("held", F.lit(1)), ["u", "v"], "left").agg(
            F.count(F.lit(1)).alias("size"), F.count("held").alias("overlap")).first()
        if held["size"] == held["overlap"] == known:
            break
        edges, known = after, held["size"]
    lowest = after.groupBy("u").agg(F.min("v").alias("component"))
    return (lowest.select(F.col("u").alias("id"), "component")
            .unionByName(lowest.select(F.col("component").alias("id"), "component").distinct()))
