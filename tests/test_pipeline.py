"""Messages through the stream, the star and the marts, twice."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.plans import publish
from basketflow.plans.pipeline import Star, raw_to_star, star_to_marts
from basketflow.sources import sinks
from checks.fixtures import AS_OF, Raw

SF_DIR = "/root/testdata/sf0.001"


def raw_reader(spark):
    raw = Raw(spark, SF_DIR)
    frames = {
        "events": raw.events, "user_profiles": raw.profiles, "user_devices": raw.devices,
        "user_locations": raw.locations, "orders": raw.orders, "order_items": raw.items,
        "order_status_events": raw.statuses, "campaign_events": raw.campaign_events}
    return lambda name: frames[name]()


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("warehouse"))
    first = raw_to_star(spark, raw_reader(spark), f"{base}/star")
    tables = {t: sorted(map(str, Star(spark, f"{base}/star").read(t).collect())) for t in schemas.DDS}
    second = raw_to_star(spark, raw_reader(spark), f"{base}/star")
    published = star_to_marts(spark, f"{base}/star", f"{base}/marts", AS_OF)
    return base, first, second, tables, published


def test_second_run_changes_nothing(spark, runs):
    base, first, second, tables, _ = runs
    assert first == second
    for table, before in tables.items():
        after = sorted(map(str, Star(spark, f"{base}/star").read(table).collect()))
        assert after == before, table


def test_tables_are_filled_and_keys_unique(spark, runs):
    base, first, *_ = runs
    star = Star(spark, f"{base}/star")
    for table, keys in schemas.PRIMARY_KEY.items():
        if table == "order_status_events":
            continue    # declared, filled by no job
        df = star.read(table)
        assert first[table] == df.count() > 0, table
        assert df.select(*keys).distinct().count() == first[table], table
        assert df.schema == schemas.DDS[table]


def test_references_hold(spark, runs):
    star = Star(spark, f"{runs[0]}/star")
    for child, references in schemas.FOREIGN_KEYS.items():
        for column, parent, key in references:
            ids = star.read(parent).select(F.col(key).alias(column))
            broken = star.read(child).where(F.col(column).isNotNull()).join(ids, column, "left_anti")
            assert broken.count() == 0, (child, column)


def test_checks_hold_and_refused_rows_are_kept(spark, runs):
    base, first, *_ = runs
    star = Star(spark, f"{base}/star")
    for table, checks in schemas.CHECKS.items():
        for _, predicate in checks:
            assert star.read(table).where(f"NOT ({predicate})").count() == 0
    assert first["events rejected"] > 0 and first["order_items rejected"] > 0
    path = sinks.current_snapshot(spark, f"{base}/star/_rejected/order_items")
    assert "quantity_positive" in "".join(r.row for r in spark.read.parquet(path).collect())


def test_marts_are_published(spark, runs):
    base, *_, published = runs
    assert set(published) == set(schemas.MART)
    for mart, n_rows in published.items():
        df = sinks.read_mart(spark, f"{base}/marts", mart)
        assert df.count() == n_rows and n_rows > 0, mart


def test_the_report_has_what_was_clipped_and_dropped(spark, runs):
    base, first, second, _, published = runs
    report = {(r.table_name, r.rule): r.n_rows for r in publish.read_report(spark, f"{base}/marts").collect()}
    geo = {rule: n for (mart, rule), n in report.items() if mart == "geo_analysis"}
    assert geo["rows"] - geo["no date"] - geo["country unwanted"] - geo["city unwanted"] == published["geo_analysis"]
    assert report["session_analytics", "duplicates"] >= 0 and report["daily_business_summary", "total_revenue"] > 0
    star = publish.read_report(spark, f"{base}/star")
    assert star.select("as_of").distinct().count() == 2
    rejected = star.where("table_name = 'order_items' AND rule = 'rejected'").select("n_rows").distinct().collect()
    assert [r.n_rows for r in rejected] == [first["order_items rejected"]]


def test_reload_by_days_gives_the_same_marts(spark, rows, runs):
    base, *_, published = runs
    again = star_to_marts(spark, f"{base}/star", f"{base}/marts", AS_OF, reload_days=30)
    assert again == published


def test_empty_raw_tables(spark, tmp_path):
    base = str(tmp_path)
    empty = lambda name: spark.createDataFrame([], schemas.RAW[name])
    assert set(raw_to_star(spark, empty, f"{base}/star").values()) == {0}
    published = star_to_marts(spark, f"{base}/star", f"{base}/marts", datetime(2024, 1, 1))
    assert set(published.values()) == {None}
