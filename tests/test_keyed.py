from pyspark.sql import functions as F

from basketflow.operators import keyed
from tests.conftest import plan_of


def test_dedup_keeps_lowest_serial_and_null_keys_are_equal(spark, rows):
    df = spark.createDataFrame(
        [(3, "a", 1), (1, "a", 2), (2, None, 3), (4, None, 4)], "id int, k string, v int")
    assert rows(keyed.dedup(df, ["k"], "id")) == [(1, "a", 2), (2, None, 3)]


def test_first_per_key_is_limited_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = plan_of(keyed.dedup(df, ["k"], "id"))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert "WindowGroupLimit" in plan


def test_latest_by_null_time_is_latest_then_serial(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "2024-01-01", "x"), ("a", 2, "2024-01-02", "y"), ("a", 3, "2024-01-02", "z"),
         ("b", 1, "2024-01-01", "x"), ("b", 2, None, "n")],
        "k string, id int, ts string, v string")
    assert rows(keyed.latest_by(df, ["k"], "ts", "id"), "k", "v") == [("a", "z"), ("b", "n")]


def test_upsert_replace_overwrites_with_null(spark, rows):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, w string")
    source = spark.createDataFrame([(2, None, "n"), (3, "c", None)], "id int, v string, w string")
    out = keyed.upsert_replace(target, source, ["id"])
    assert rows(out) == [(1, "a", "x"), (2, None, "n"), (3, "c", None)]
    # again: nothing changes
    assert rows(keyed.upsert_replace(out, source, ["id"])) == rows(out)


def test_upsert_replace_of_some_columns(spark, rows):
    target = spark.createDataFrame([(1, "a", "x")], "id int, v string, w string")
    source = spark.createDataFrame([(1, "b", "n"), (2, "c", "m")], "id int, v string, w string")
    assert rows(keyed.upsert_replace(target, source, ["id"], columns=["w"])) == [
        (1, "a", "n"), (2, "c", "m")]


def test_upsert_coalesce_takes_last_value_per_column(spark, rows):
    target = spark.createDataFrame([(1, "old", "o@x"), (2, "b", None)], "id int, name string, mail string")
    source = spark.createDataFrame(
        [(1, 1, "n1", None), (1, 2, None, "m2"), (1, 3, None, None), (3, 4, "c", None)],
        "id int, seq int, name string, mail string")
    out = keyed.upsert_coalesce(target, source, "id", "seq")
    assert rows(out) == [(1, "n1", "m2"), (2, "b", None), (3, "c", None)]
    assert rows(keyed.upsert_coalesce(out, source, "id", "seq")) == rows(out)


def test_delete_orphans_ignores_null_keys(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    keep = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows(keyed.delete_orphans(df, keep, "id")) == [(1,)]


def test_add_missing_keys(spark, rows):
    users = spark.createDataFrame([(1, "a")], "id int, name string")
    ids = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    assert rows(keyed.add_missing_keys(users, ids, "id")) == [(1, "a"), (2, None)]


def test_append_ignore(spark, rows):
    target = spark.createDataFrame([(1, 1)], "k int, id int")
    source = spark.createDataFrame([(1, 5), (2, 6), (2, 7)], "k int, id int")
    assert rows(keyed.append_ignore(target, source, ["k"], "id")) == [(2, 6)]


def test_number_new_names_is_stable_and_gapless(spark):
    old = spark.createDataFrame([(7, "n1")], "category_id bigint, name string")
    names = spark.createDataFrame([(f"n{i % 50}",) for i in range(200)] + [(None,)], "name string")
    out = {r["name"]: r["category_id"]
           for r in keyed.number_new_names(names, "name", old, "category_id").collect()}
    assert sorted(out.values()) == list(range(8, 57)) and "n1" not in out
    again = {r["name"]: r["category_id"] for r in keyed.number_new_names(
        names.repartition(7), "name", old, "category_id").collect()}
    assert again == out
    empty = spark.createDataFrame([], "category_id bigint, name string")
    first = keyed.number_new_names(names, "name", empty, "category_id")
    assert first.agg(F.min("category_id")).first()[0] == 1
