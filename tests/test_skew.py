import pytest
from pyspark.sql import functions as F

from basketflow.operators.skew import split_join
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame(
        [(i, 1 if i % 3 else i % 7, None if i % 11 == 0 else "x") for i in range(200)],
        "id int, k int, j string")
    right = spark.createDataFrame(
        [(k, j, f"{k}{j}{n}") for k in range(5) for j in ("x", None) for n in range(2)],
        "k int, j string, v string")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("on", [["k"], ["k", "j"]])
@pytest.mark.parametrize("hot_rows", [1, 10, 1_000_000])
def test_equals_plain_join(sides, rows, how, on, hot_rows):
    left, right = sides
    left = left.select("id", *on)
    right = right.select(*on, "v")
    plain = left.join(right, on, how)
    split = split_join(left, right, on, how, ["id"], hot_rows)
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


def test_hot_key_is_dealt_over_many_parts(spark):
    left = spark.range(10_000).select(F.col("id"), F.lit(1).alias("k"))
    right = spark.createDataFrame([(1, "a")], "k int, v string")
    joined = split_join(left, right, "k", "left", ["id"], hot_rows=100)
    assert joined.count() == 10_000
    # the join key on both sides includes the part
    assert "_salt" in plan_of(joined).split("Join")[1]


def test_rejects_joins_it_cannot_split(sides):
    with pytest.raises(ValueError):
        split_join(*sides, "k", "full_outer", ["id"])
