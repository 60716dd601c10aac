import glob
import os
from datetime import date, timedelta
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow import schemas
from basketflow.session import scratch_dir
from basketflow.sources import sinks
from basketflow.sources.tables import has_data, read_table, run_sql_file

SCHEMA = T.StructType([T.StructField("id", T.LongType())])


def test_snapshots(spark, rows, tmp_path):
    base = str(tmp_path / "t")
    assert sinks.read_snapshot(spark, base, SCHEMA).count() == 0
    sinks.write_snapshot(spark.range(3), base)
    # read the current snapshot while writing the next
    sinks.write_snapshot(sinks.read_snapshot(spark, base, SCHEMA).where("id > 0"), base)
    assert rows(sinks.read_snapshot(spark, base, SCHEMA)) == [(1,), (2,)]
    sinks.write_snapshot(spark.range(5), base, commit=False)    # a failed write
    sinks.write_snapshot(sinks.read_snapshot(spark, base, SCHEMA), base)
    assert sinks.drop_old_snapshots(spark, base, keep=2) == 2
    assert rows(sinks.read_snapshot(spark, base, SCHEMA)) == [(1,), (2,)]


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    base = str(tmp_path / "t")
    sinks.write_snapshot(spark.range(3), base)
    path = sinks.write_snapshot(spark.range(9), base, commit=False)
    assert sinks.read_snapshot(spark, base, SCHEMA).count() == 3
    sinks.commit_snapshot(spark, path)
    assert sinks.read_snapshot(spark, base, SCHEMA).count() == 9
    with pytest.raises(ValueError):
        sinks.discard_snapshot(spark, path)
    path = sinks.write_snapshot(spark.range(1), base, commit=False)
    sinks.discard_snapshot(spark, path)
    assert sinks.read_snapshot(spark, base, SCHEMA).count() == 9


def geo_rows(spark):
    return spark.range(300).select(
        F.concat(F.lit("c"), F.col("id") % 5).alias("city"), F.lit("F").alias("country"),
        F.col("id").alias("total_users"), F.lit(1).cast("bigint").alias("total_orders"),
        F.lit(1.0).alias("total_revenue"), F.lit(1.0).alias("avg_order_value"),
        F.lit(0.5).alias("conversion_rate"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 60).cast("int")).alias("event_date"))


def test_mart_is_partitioned_by_month_and_sorted(spark, tmp_path):
    base = str(tmp_path)
    path = sinks.publish(geo_rows(spark), base, "geo_analysis").removeprefix("file:")
    assert sorted(os.path.basename(p) for p in glob.glob(f"{path}/yyyymm=*")) == [
        "yyyymm=202401", "yyyymm=202402"]
    for file in glob.glob(f"{path}/*/*.parquet"):
        table = pq.ParquetFile(file).read().to_pydict()
        keys = list(zip(table["country"], table["city"], table["event_date"]))
        assert keys == sorted(keys)
    january = sinks.months_between(sinks.read_mart(spark, base, "geo_analysis"), "event_date",
                                   date(2024, 1, 10), date(2024, 1, 20))
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in plan
    assert january.agg(F.min("event_date"), F.max("event_date")).first()[:] == (
        date(2024, 1, 10), date(2024, 1, 20))


def month_files(base, mart):
    return {os.path.relpath(f, base): (os.path.getmtime(f), os.path.getsize(f))
            for f in glob.glob(f"{base}/{mart}/snapshot=*/yyyymm=*/*.parquet")}


def long_geo_rows(spark, orders=1):
    """Rows of five months."""
    return geo_rows(spark).withColumns({
        "event_date": F.date_add(F.lit(date(2024, 1, 1)), (F.col("total_users") % 150).cast("int")),
        "total_orders": F.lit(orders).cast("bigint")})


def by_age(spark, base, cut):
    rows = sinks.read_mart(spark, base, "geo_analysis").groupBy((F.col("event_date") >= cut).alias("recent")).agg(
        F.min("total_orders"), F.max("total_orders"), F.count("*")).collect()
    return {tuple(r) for r in rows}


def test_only_the_touched_months_are_rewritten(spark, tmp_path):
    base, mart, as_of = str(tmp_path), "geo_analysis", date(2024, 5, 10)
    sinks.publish(long_geo_rows(spark), base, mart)
    before = month_files(base, mart)
    sinks.replace_months(long_geo_rows(spark, 5), base, mart, as_of, days=30)
    after = month_files(base, mart)
    cut = as_of - timedelta(days=30)
    assert by_age(spark, base, cut) == {(False, 1, 1, 200), (True, 5, 5, 100)}
    old = {f for f in before if "yyyymm=202404" not in f and "yyyymm=202405" not in f}
    assert old and all(after[f] == before[f] for f in old)
    assert len(after) == 5 and not os.path.exists(f"{base}/{mart}/_pending")
    sinks.replace_months(long_geo_rows(spark).limit(0), base, mart, as_of, days=30)
    assert by_age(spark, base, cut) == {(False, 1, 1, 200)}
    assert not any("yyyymm=202405" in f for f in month_files(base, mart))


def test_an_interrupted_reload_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    base, mart, as_of = str(tmp_path), "geo_analysis", date(2024, 5, 10)
    sinks.publish(long_geo_rows(spark), base, mart)
    finish = sinks.finish_months
    calls = []

    def stop_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        finish(*args)

    monkeypatch.setattr(sinks, "finish_months", stop_second)
    with pytest.raises(RuntimeError):
        sinks.replace_months(long_geo_rows(spark, 5), base, mart, as_of)
    monkeypatch.undo()
    assert by_age(spark, base, as_of - timedelta(days=30)) == {(False, 1, 1, 200), (True, 1, 1, 100)}
    sinks.replace_months(long_geo_rows(spark, 7), base, mart, date(2024, 5, 20), days=10)
    assert by_age(spark, base, date(2024, 5, 10)) == {(False, 1, 5, 260), (True, 7, 7, 40)}
    finish(spark, base, mart)


def test_compact_reduces_files(spark, rows, tmp_path):
    base = str(tmp_path / "t")
    sinks.write_snapshot(spark.range(100).repartition(20), base)
    path = sinks.compact(spark, base, SCHEMA, ["id"]).removeprefix("file:")
    assert len(glob.glob(f"{path}/*.parquet")) == 1
    assert len(rows(sinks.read_snapshot(spark, base, SCHEMA))) == 100


def test_compact_keeps_months(spark, tmp_path):
    base, mart = str(tmp_path), "geo_analysis"
    sinks.publish(geo_rows(spark), base, mart)
    before = sinks.read_mart(spark, base, mart).count()
    path = sinks.compact(spark, f"{base}/{mart}", sinks.mart_schema(mart), ["event_date"])
    assert glob.glob(f"{path.removeprefix('file:')}/{sinks.MONTH}=*/*.parquet")
    mart_rows = sinks.read_mart(spark, base, mart)
    assert mart_rows.count() == before
    plan = sinks.months_between(mart_rows, "event_date", date(2024, 1, 1), date(2024, 1, 31))
    assert "PartitionFilters: [isnotnull" in plan._jdf.queryExecution().toString()


def test_append_and_read_table(spark, tmp_path):
    sinks.append(spark.range(2), f"{tmp_path}/t")
    sinks.append(spark.range(2), f"{tmp_path}/t")
    df = read_table(spark, str(tmp_path), "t", SCHEMA)
    assert df.count() == 4 and has_data(df) and not has_data(df.limit(0))
    plan = df.where("id = 1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,1)" in plan


def test_run_sql_file(spark, tmp_path, rows):
    file = tmp_path / "q.sql"
    file.write_text("-- doubled\nSELECT id * :times AS x FROM {t} WHERE id > 0;\n")
    assert rows(run_sql_file(spark, file, {"times": 2}, t=spark.range(3))) == [(2,), (4,)]


def test_create_tables(spark, tmp_path):
    for layer, name in ((schemas.RAW, "raw_t"), (schemas.DDS, "dds_t"), (schemas.MART, "mart_t")):
        schemas.create_tables(spark, layer, name, f"{tmp_path}/{name}")
        for table, schema in layer.items():
            assert spark.table(f"{name}.{table}").schema == schema
        spark.sql(f"DROP DATABASE {name} CASCADE")
    assert (len(schemas.RAW), len(schemas.DDS), len(schemas.MART)) == (8, 12, 9)


def fake_session(master, **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)),
        sparkContext=SimpleNamespace(master=master))


def test_scratch_dir_follows_the_setting():
    shared = fake_session("spark://host", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch_dir(shared, "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError):
        scratch_dir(fake_session("spark://host"), "x")
    assert "/x-" in scratch_dir(fake_session("local[2]"), "x")
