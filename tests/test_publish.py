from datetime import date, datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.plans import publish
from basketflow.sources import sinks

DAILY = ("event_date date, total_revenue double, total_orders bigint, unique_customers bigint, "
         "avg_order_value double, conversion_rate double, new_users bigint, total_sessions bigint, "
         "successful_orders bigint")
D1, D2 = date(2024, 1, 5), date(2024, 2, 6)


def daily(spark, *rows):
    return spark.createDataFrame(list(rows), DAILY)


def test_clips_and_date_filter(spark):
    df = daily(spark, (D1, 20000.0, -1, 1, 10001.0, 1.5, 1, 1, 1),
               (D2, float("nan"), 2, 1, None, -0.5, 1, 1, 1), (None, 1.0, 1, 1, 1.0, 0.5, 1, 1, 1))
    seen = Observation()
    out = sorted(publish.publish_clean(df, "daily_business_summary", seen).collect())
    assert [r.event_date for r in out] == [D1, D2]
    assert (out[0].total_revenue, out[0].avg_order_value, out[0].conversion_rate,
            out[0].total_orders) == (10000.0, 10000.0, 1.0, 0)
    assert (out[1].total_revenue, out[1].avg_order_value, out[1].conversion_rate) == (None, None, 0.0)
    assert seen.get["rows"] == 3 and seen.get["total_revenue"] == 1
    assert seen.get["conversion_rate"] == 2 and seen.get["total_orders"] == 1


def test_quality_report(spark, rows):
    df = daily(spark, (D1, 20000.0, 1, 1, 1.0, 0.5, 1, 1, 1))
    assert ("total_revenue", 1) in rows(publish.quality_report(df))
    assert ("conversion_rate", 0) in rows(publish.quality_report(df))


@pytest.mark.parametrize("mart", list(schemas.MART))
def test_publish_is_idempotent_and_conforms(spark, rows, mart):
    fields = schemas.MART[mart].fields
    values = {"date": D1, "double": 5e6, "bigint": 3, "smallint": 1, "string": "x",
              "timestamp_ntz": datetime(2024, 1, 1, 2, 3, 4, 999999)}
    df = spark.createDataFrame([tuple(values[f.dataType.simpleString()] for f in fields)] * 2,
                               schemas.MART[mart])
    once = publish.publish_clean(df, mart)
    assert [(f.name, f.dataType) for f in once.schema] == [(f.name, f.dataType) for f in fields]
    assert rows(publish.publish_clean(once, mart)) == rows(once)


def test_unwanted_places_and_missing_strings(spark, rows):
    df = spark.createDataFrame(
        [("Paris", "France"), ("Unknown", "France"), (None, "France"), ("X", "Antarctica")],
        "city string, country string").withColumn("event_date", F.lit(D1))
    assert rows(publish.publish_clean(df, "geo_analysis"), "city", "total_orders") == [("Paris", 0)]


def test_repeated_session_rows_are_dropped(spark):
    row = ("s", 1, datetime(2024, 1, 1), datetime(2024, 1, 1, 1), "Paris", "France")
    df = spark.createDataFrame([row, row], "session_id string, user_id bigint, "
                               "start_time timestamp_ntz, end_time timestamp_ntz, city string, country string")
    assert publish.publish_clean(df, "session_analytics").count() == 1


def test_fraction_in_an_integer_column_fails(spark):
    df = spark.createDataFrame([(D1, 2.0)], "event_date date, total_orders double")
    assert publish.publish_clean(df, "daily_business_summary").first().total_orders == 2
    with pytest.raises(Exception, match="not whole"):
        publish.publish_clean(df.withColumn("total_orders", F.lit(2.5)),
                              "daily_business_summary").collect()


def test_renamed_column(spark):
    df = spark.createDataFrame([(D1, 1, 1, 1, 7)], "event_date date, active_users_count bigint, "
                               "returning_users bigint, new_users bigint, reactivated_users bigint")
    assert publish.publish_clean(df, "active_users_7d").first().churned_users == 7


def test_empty_result_keeps_the_mart_but_cleaned_away_empties_it(spark, tmp_path):
    base, mart = str(tmp_path), "daily_business_summary"
    good = daily(spark, (D1, 1.0, 1, 1, 1.0, 0.5, 1, 1, 1))
    assert publish.load_mart(good, base, mart) == 1
    assert publish.load_mart(good.limit(0), base, mart) is None
    assert sinks.read_mart(spark, base, mart).count() == 1
    no_date = daily(spark, (None, 1.0, 1, 1, 1.0, 0.5, 1, 1, 1))
    assert publish.load_mart(no_date, base, mart) == 0
    assert sinks.read_mart(spark, base, mart).count() == 0
