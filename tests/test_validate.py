from datetime import datetime

from pyspark.sql import functions as F

from basketflow.operators import validate as v

NOW = datetime(2024, 1, 1)
SCHEMA = "n int, user_id string, event_type string, timestamp string, quantity string, lat double"


def sample(spark):
    return spark.createDataFrame([
        (1, "7", "view_page", "2024-01-01", "3", 1.5),
        (2, "7.0", "view_page", "2024-01-01", None, float("nan")),
        (3, "x", "view_page", "2024-01-01", "1", None),
        (4, None, None, "later", "1", None),
        (5, "8", "view_page", "2024-01-01", "many", None),
        (6, "8", "view_page", "2024-01-01", "2.5", None),
    ], SCHEMA)


def test_valid_and_rejected_split_the_input(spark, rows):
    valid, rejected = v.validate(sample(spark), "event", keep=["n"])
    assert rows(valid, "n", "user_id", "timestamp", "quantity", "lat", "product_id") == [
        (1, 7, NOW, 3, 1.5, 0), (2, 7, NOW, 0, 0.0, 0)]
    assert rows(rejected, "n", "reasons") == [
        (3, ["user_id: not a valid id"]),
        (4, ["user_id: missing", "event_type: missing", "timestamp: not a valid timestamp"]),
        (5, ["quantity: not a valid int"]), (6, ["quantity: not a valid int"])]


def test_fields_outside_the_model_are_dropped(spark):
    df = sample(spark).withColumn("product_name", F.lit("x"))
    valid, rejected = v.validate(df, "event")
    assert "product_name" not in valid.columns and "product_name" in rejected.columns


def test_missing_required_column_rejects_all(spark):
    df = spark.createDataFrame([("7",)], "user_id string")
    valid, rejected = v.validate(df, "event")
    assert valid.count() == 0 and rejected.count() == 1


def test_every_model_accepts_an_empty_frame(spark):
    for model in v.MODELS:
        valid, rejected = v.validate(spark.createDataFrame([], SCHEMA), model)
        assert valid.count() == rejected.count() == 0


def test_not_null_if_looks_at_the_whole_batch(spark, rows):
    df = spark.createDataFrame([(1, "signup", None), (2, "view", None), (None, "view", "s")],
                               "u int, kind string, s string")
    flag = F.col("kind") == "signup"
    assert rows(v.not_null_if(df, flag, ["u"], ["u", "s"]), "u") == [(1,), (2,)]
    assert rows(v.not_null_if(df.where("kind = 'view'"), flag, ["u"], ["u", "s"]), "u") == []
    assert v.not_null_if(df.limit(0), flag, ["u"], ["u", "s"]).count() == 0


def test_check_passes_null_and_names_failures(spark, rows):
    df = spark.createDataFrame([(1, -1.0, "lost"), (2, None, None), (3, 5.0, "success")],
                               "id int, total_usd double, status string")
    ok, bad = v.check(df, "orders")
    assert rows(ok, "id") == [(2,), (3,)]
    assert rows(bad, "id", "failed_checks") == [(1, ["total_not_negative", "status_known"])]
    ok, bad = v.check(df, "products")
    assert ok.count() == 3 and bad.count() == 0


def test_fk_check_lets_null_pass(spark, rows):
    child = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 1)], "id int, k int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "pk int")
    ok, orphans = v.fk_check(child, parent, "k", ["id"], parent_key="pk", hot_rows=1)
    assert rows(ok, "id") == [(1,), (3,), (4,)]
    assert rows(orphans, "id") == [(2,)]


def test_not_null_and_allow(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, k string")
    assert rows(v.not_null(df, ["k"]), "id") == [(1,), (3,)]
    assert rows(v.allow(df, "k", ["a"]), "id") == [(1,)]
