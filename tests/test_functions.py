from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from basketflow import functions as fn


def one(spark, column, **values):
    """The value of a column over one row given as SQL literals."""
    row = spark.sql("SELECT " + ", ".join(f"{v} AS {k}" for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text,want", [
    ("'12'", 12), ("'12.0'", 12), ("'12.5'", None), ("'x12'", None), ("''", None), ("'NaN'", None),
    ("NULL", None), ("'-3'", -3), ("'1e400'", None), ("' 7 '", 7),
    ("'9007199254740993'", 9007199254740993), ("'9007199254740993.0'", 9007199254740993),
    ("'12d'", None), ("'12f'", None), ("'7D'", None), ("'0x1p3'", None), ("'1e5'", None), ("' +12 '", 12),
])
def test_try_id(spark, text, want):
    assert one(spark, fn.try_id("a"), a=f"CAST({text} AS STRING)") == want


@pytest.mark.parametrize("text,want", [
    ("'2024-01-02T03:04:05.5+00:00'", datetime(2024, 1, 2, 3, 4, 5, 500000)),
    ("'2024-01-02T03:04:05+02:00'", datetime(2024, 1, 2, 3, 4, 5)),
    ("'2024-01-02'", datetime(2024, 1, 2)), ("'soon'", None), ("NULL", None),
])
def test_try_ts(spark, text, want):
    assert one(spark, fn.try_ts("a"), a=f"CAST({text} AS STRING)") == want


@pytest.mark.parametrize("text,want", [
    ("' Male '", "male"), ("'FEMALE'", "female"), ("'other'", None), ("''", None), ("NULL", None)])
def test_normalize_gender(spark, text, want):
    assert one(spark, fn.normalize_gender("a"), a=f"CAST({text} AS STRING)") == want


@pytest.mark.parametrize("value,want", [
    ("5D", 5.0), ("-5D", 0.0), ("50D", 10.0), ("CAST(NULL AS DOUBLE)", None)])
def test_clip_keeps_null(spark, value, want):
    assert one(spark, fn.clip("a", 0.0, 10.0), a=value) == want


@pytest.mark.parametrize("value,want", [("2.5D", 3), ("2.4D", 2), ("-2.5D", -3)])
def test_round_to_int(spark, value, want):
    assert one(spark, fn.round_to_int("a"), a=value) == want


def test_safe_ratio(spark):
    ratio = fn.safe_ratio(F.col("a"), F.col("b"))
    assert one(spark, ratio, a="3", b="2") == 1.5
    assert one(spark, ratio, a="3", b="0") == 0.0
    assert one(spark, ratio, a="3", b="CAST(NULL AS INT)") == 0.0


def test_micros_and_days(spark):
    start, end = "TIMESTAMP_NTZ'2024-01-01 00:00:00'", "TIMESTAMP_NTZ'2024-01-01 00:00:01.000007'"
    assert one(spark, fn.micros_between("a", "b"), a=start, b=end) == 1_000_007
    assert one(spark, fn.day("a"), a=start) == date(2024, 1, 1)
    assert one(spark, fn.whole_seconds("a"), a=end) == datetime(2024, 1, 1, 0, 0, 1)


def test_nan_to_null(spark):
    assert one(spark, fn.nan_to_null("a"), a="CAST('NaN' AS DOUBLE)") is None
    assert one(spark, fn.nan_to_null("a"), a="1.5D") == 1.5


def test_is_uuid(spark):
    assert one(spark, fn.is_uuid("a"), a="'0cc175b9-c0f1-b6a8-31c3-99e269772661'")
    assert not one(spark, fn.is_uuid("a"), a="'bad-7'")
