"""Batches joined into bucketed states: any cut gives the tables of one run over all rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.plans import incremental
from basketflow.plans.incremental import STATES, Store, merge_batches
from basketflow.plans.pipeline import Star, raw_to_star
from basketflow.sources import sinks
from checks.fixtures import batches, raw_tables
from basketflow.streaming.router import SERIAL

SF_DIR = "/root/testdata/sf0.001"


def table(spark, base, name):
    return sorted(map(str, Store(spark, base, 8).read(name).collect()))


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("whole"))
    merge_batches(spark, batches(spark, SF_DIR, 1), base, 1, buckets=8)
    return base


def test_three_runs_equal_one(spark, whole, tmp_path):
    base = str(tmp_path)
    read = []

    def reader(name, after, upto):
        read.append((name, after, upto))
        return batches(spark, SF_DIR, 3)(name, after, upto)

    for upto in (1, 2, 3):
        read.clear()
        assert merge_batches(spark, reader, base, upto, buckets=8)
        assert {(a, b) for _, a, b in read} == {(upto - 1 if upto > 1 else -1, upto)}  # only its own batches
    assert merge_batches(spark, reader, base, 3, buckets=8) == {}
    for name in STATES:
        if name in ("categories", "products"):
            continue  # ids depend on the batch a name comes in
        assert table(spark, base, name) == table(spark, whole, name), name
    names = [Store(spark, b, 8).state("categories").select("category_name") for b in (base, whole)]
    assert sorted(map(str, names[0].collect())) == sorted(map(str, names[1].collect()))
    ids = Store(spark, base, 8).read("categories")
    assert ids.select("category_id").distinct().count() == ids.count()


def test_equals_the_batch_run(spark, whole, tmp_path):
    frames = raw_tables(spark, SF_DIR)
    raw_to_star(spark, lambda n: frames[n](), str(tmp_path))
    for name in STATES:
        want, got = Star(spark, str(tmp_path)).read(name), Store(spark, whole, 8).read(name)
        if name == "order_items":  # the id of a pair is its first serial here, its last in a first batch run
            want, got = want.drop("order_item_id"), got.drop("order_item_id")
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


def test_every_raw_row_is_taken_or_refused(spark, whole):
    frames = raw_tables(spark, SF_DIR)
    bad = {r["table"]: r["n"] for r in spark.read.parquet(f"{whole}/_refused").groupBy("table").agg(F.count("*").alias("n")).collect()}
    taken = {
        "orders": frames["orders"]().where("order_id is not null and order_ts is not null and try_cast(user_id as double) is not null").count(),
        "order_items": frames["order_items"]().where("order_id is not null and product_id is not null and price_usd is not null").count(),
        "campaign_events": frames["campaign_events"]().where("campaign_id is not null and try_cast(user_id as double) is not null").count(),
    }
    for name, n in taken.items():
        assert n + bad[name] == frames[name]().count(), name


def test_only_touched_buckets_are_written(spark, tmp_path):
    base = str(tmp_path)
    rows = [(k, str(k), f"n{k}", None, None, None, None) for k in range(200)]
    schema = schemas.RAW["user_profiles"]

    def reader(name, after, upto):
        if name != "user_profiles":
            return spark.createDataFrame([], schemas.RAW[name])
        return spark.createDataFrame(rows if upto == 1 else [(900, "7", "new", None, None, None, None)], schema)

    assert merge_batches(spark, reader, base, 1, buckets=8, tables=["users"]) == {"users": 8}
    files = {p for p in tmp_path.rglob("users/**/*.parquet")}
    assert merge_batches(spark, reader, base, 2, buckets=8, tables=["users"]) == {"users": 1}
    after = {p for p in tmp_path.rglob("users/**/*.parquet")}
    assert len({p.parent for p in files - after}) == 1 and len({p.parent for p in after - files}) == 1
    assert {r.user_id: r.name for r in Store(spark, base, 8).read("users").collect()} == {
        k: "new" if k == 7 else f"n{k}" for k in range(200)}


def test_rows_wait_for_their_parents(spark, tmp_path):
    base = str(tmp_path)

    def reader(name, after, upto):
        made = {("orders", 1): [(1, "o1", "5", "2024-01-01 00:00:00", "10.00", None)],
                ("order_items", 1): [(1, "o1", 3, 2, "5.00", None)],
                ("user_profiles", 3): [(1, "5", "late", None, None, None, None)]}.get((name, upto), [])
        text = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in made],
                                     ", ".join(f"{f.name} string" for f in schemas.RAW[name].fields))
        return text.select(*[F.col(f.name).cast(f.dataType) for f in schemas.RAW[name].fields])

    for upto, shown in ((1, 0), (2, 0), (3, 1)):
        merge_batches(spark, reader, base, upto, buckets=8, tables=["order_items"])
        assert Store(spark, base, 8).read("orders").count() == shown
        assert Store(spark, base, 8).read("order_items").count() == shown


@pytest.mark.parametrize("stop", ["before", "between", "after"])
def test_an_interrupted_run_counts_nothing_twice(spark, whole, tmp_path, monkeypatch, stop):
    base = str(tmp_path)
    reader = batches(spark, SF_DIR, 2)
    merge_batches(spark, reader, base, 1, buckets=8, tables=["sessions"])
    real = Store.put_in_place

    def broken(self, pending):
        if stop == "after":
            real(self, pending)
        elif stop == "between":  # buckets in place, not yet noted as consumed
            (self.spark.read.parquet(f"{pending}/sessions").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.base}/sessions"))
        raise RuntimeError("lost")

    monkeypatch.setattr(Store, "put_in_place", broken)
    with pytest.raises(RuntimeError):
        merge_batches(spark, reader, base, 2, buckets=8, tables=["sessions"])
    monkeypatch.setattr(Store, "put_in_place", real)
    merge_batches(spark, reader, base, 2, buckets=8, tables=["sessions"])
    assert table(spark, base, "sessions") == table(spark, whole, "sessions")


def test_committed_batch(spark, tmp_path):
    assert incremental.committed_batch(spark, str(tmp_path)) == -1
    (tmp_path / "commits").mkdir()
    for name in ("0", "1", "10", ".10.crc"):
        (tmp_path / "commits" / name).write_text("v1")
    assert incremental.committed_batch(spark, str(tmp_path)) == 10


def test_serials_of_all_raw_tables():
    assert set(SERIAL) >= set(schemas.RAW)


def test_new_buckets_are_moved_and_not_rewritten(spark, tmp_path):
    def files(path):
        return {f"{p.parent.name}/{p.name}" for p in path.rglob("*.parquet")}

    source, target = tmp_path / "new", tmp_path / "state"
    spark.range(6).selectExpr("id", "id % 3 AS bucket").write.partitionBy("bucket").parquet(str(target))
    spark.range(10, 14).selectExpr("id", "id % 2 + 1 AS bucket").write.partitionBy("bucket").parquet(str(source))
    moved = files(source)
    kept = {f for f in files(target) if f.startswith("bucket=0/")}
    for _ in range(2):
        sinks.move_partitions(spark, str(source), str(target))
        assert files(target) == kept | moved
        rows = {(r.id, r.bucket) for r in spark.read.parquet(str(target)).collect()}
        assert rows == {(0, 0), (3, 0), (10, 1), (12, 1), (11, 2), (13, 2)}


def test_a_first_run_keeps_a_row_per_key_and_moves_it(spark, tmp_path, monkeypatch):
    moved = []
    real = sinks.move_partitions
    monkeypatch.setattr(sinks, "move_partitions", lambda s, source, target: (moved.append(source), real(s, source, target)))
    frames = {"order_items": spark.createDataFrame(
        [(1, "o1", 5, 2, Decimal("1.00")), (2, "o1", 5, 3, Decimal("2.00"))],
        "raw_order_item_id bigint, order_id string, product_id int, quantity int, price_usd decimal(18,2)")}

    def read(table, after, upto):
        return frames[table] if table in frames else spark.createDataFrame([], schemas.RAW[table])

    base = str(tmp_path / "store")
    incremental.merge_batches(spark, read, base, 0, buckets=2, tables=["order_items"])
    row = spark.read.parquet(f"{base}/order_items").first()
    assert (row["order_item_id"], row["last"]["quantity"], row["known"]) == (1, 3, False)
    assert [p.rsplit("/", 1)[1] for p in moved] == ["order_items"]
