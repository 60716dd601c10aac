"""The raw tables made of the given ones."""

from hashlib import md5
from uuid import UUID

import pytest
from pyspark.sql import functions as F

from checks import fixtures, registry


def test_a_uuid_is_worked_out_once_even_inside_a_condition(spark):
    texts = spark.createDataFrame([("o1",), ("",), ("ü}",), (None,)], "text string")
    made = texts.select("text", F.when(F.length("text") != 0, fixtures._uuid(F.col("text"))).alias("id"),
                        fixtures._uuid(F.col("text")).alias("always"))
    for row in made.collect():
        known = "" if row["text"] is None else str(UUID(md5(row["text"].encode()).hexdigest()))
        assert row["always"] == known
        assert row["id"] == (known if row["text"] else None)
    plan = made.select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1, plan


def test_spread_deals_the_same_rows_to_all_tasks(spark, tmp_path):
    rows = [(i % 40, i % 7 or None, "view") for i in range(400)]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string").coalesce(1).write.parquet(
        f"{tmp_path}/events.parquet")
    source = fixtures.Source(spark, str(tmp_path))
    plain = sorted(source.given("events").collect(), key=repr)
    source.spread("events")
    assert sorted(source.given("events").collect(), key=repr) == plain
    assert source.given("events").rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism


def test_run_counts_reads_the_events_of_files_made_once(spark, tmp_path, monkeypatch):
    seen = {}

    def star(spark, read_raw, base):
        seen.update({table: read_raw(table).inputFiles() for table in ("events", "campaign_events")})
        seen["base"] = base
        raise StopIteration

    frames = {table: lambda: spark.range(3).select(F.uuid().alias("id")) for table in ("events", "campaign_events")}
    monkeypatch.setattr(registry, "raw_tables", lambda spark, sf_dir, spread=(): frames)
    monkeypatch.setattr(registry, "raw_to_star", star)
    with pytest.raises(StopIteration):
        registry.QUERIES["d17_run_counts"](spark, str(tmp_path))
    for table in ("events", "campaign_events"):
        assert seen[table] and all(f"{seen['base']}/_raw/{table}/" in f for f in seen[table]), table
