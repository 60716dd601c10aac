"""Dashboard and use-case queries over the marts."""

from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.operators.keyed import first_per_key
from basketflow.sources.tables import run_sql_file

SQL = Path(__file__).parent / "sql"


def _tile(name: str, mart: DataFrame, **args) -> DataFrame:
    return run_sql_file(mart.sparkSession, SQL / f"{name}.sql", args or None, mart=mart)


def sales_by_category(category_performance: DataFrame) -> DataFrame:
    return _tile("sales_by_category", category_performance)


def daily_revenue(daily_summary: DataFrame) -> DataFrame:
    return _tile("daily_revenue", daily_summary)


def active_users(active_users_7d: DataFrame) -> DataFrame:
    return _tile("active_users", active_users_7d)


def devices(device_analysis: DataFrame) -> DataFrame:
    return _tile("devices", device_analysis)


def recent_revenue(daily_summary: DataFrame, as_of: date) -> DataFrame:
    return _tile("recent_revenue", daily_summary, first_day=as_of - timedelta(days=6), last_day=as_of)


def recent_orders(daily_summary: DataFrame, as_of: date) -> DataFrame:
    return _tile("recent_orders", daily_summary, first_day=as_of - timedelta(days=6), last_day=as_of)


def top_countries(geo_analysis: DataFrame, as_of: date, n: int = 10) -> DataFrame:
    """Countries with the highest revenue of the last seven days."""
    recent = geo_analysis.where(F.col("event_date").between(as_of - timedelta(days=6), as_of))
    return (recent.groupBy("country").agg(
        F.sum(F.col("total_revenue").cast("decimal(38,2)")).cast("double").alias("total_revenue"))
        .orderBy(F.col("total_revenue").desc(), "country").limit(n))


def revenue_dynamics(daily_summary: DataFrame) -> DataFrame:
    """Per day: change against the day before and the sum of the last seven rows.

    One window over the daily mart, which has a row per calendar day.
    """
    days = Window.orderBy("event_date")
    revenue = F.col("total_revenue").cast("decimal(38,2)")
    return daily_summary.where(F.col("event_date").isNotNull()).select(
        "event_date", "total_revenue",
        (revenue - F.lag(revenue).over(days)).cast("double").alias("change"),
        F.sum(revenue).over(days.rowsBetween(-6, 0)).cast("double").alias("revenue_7_rows"))


def revenue_by_period(daily_summary: DataFrame, period: str = "week") -> DataFrame:
    start = F.to_date(F.date_trunc(period, "event_date"))
    return daily_summary.where(F.col("event_date").isNotNull()).groupBy(
        start.alias("period_start")).agg(
        F.sum(F.col("total_revenue").cast("decimal(38,2)")).cast("double").alias("total_revenue"))


def most_profitable(performance: DataFrame, keys: list[str], period: str = "week") -> DataFrame:
    """The product or category with the highest revenue of each period; ties go to the
    lowest key."""
    start = F.to_date(F.date_trunc(period, "event_date"))
    sums = performance.groupBy(start.alias("period_start"), *keys).agg(
        F.sum(F.col("total_revenue").cast("decimal(38,2)")).alias("revenue"))
    return first_per_key(sums, ["period_start"], [F.col("revenue").desc(), *keys]).select(
        "period_start", *keys, F.col("revenue").cast("double").alias("total_revenue"))


def weather_influence(events: DataFrame, bucket: int = 10) -> DataFrame:
    """Events, users and sessions per weather and band of ``bucket`` degrees."""
    band = (F.floor(F.col("weather_temp") / bucket) * bucket).cast("int").alias("temp_from")
    return events.where("weather_desc IS NOT NULL").groupBy("weather_desc", band).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("session_id").alias("n_sessions"))


def places_needing_attention(geo_analysis: DataFrame, below: float, n: int | None = None) -> DataFrame:
    """Places and days with visitors but a conversion under ``below``, most users first; the
    first ``n`` of them if given."""
    places = (geo_analysis.where((F.col("conversion_rate") < below) & (F.col("total_users") > 0))
            .orderBy(F.col("total_users").desc(), "conversion_rate", "country", "city", "event_date")
            .select("country", "city", "event_date", "total_users", "total_orders", "conversion_rate"))
    return places if n is None else places.limit(n)


def category_popularity(raw_events: DataFrame) -> DataFrame:
    """Events, buyers and purchases per product category, from the raw events."""
    return raw_events.where("product_category IS NOT NULL").groupBy("product_category").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("event_type") == "purchase").alias("n_purchases"))
