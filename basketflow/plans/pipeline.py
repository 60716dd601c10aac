"""The two batch runs: raw tables to the star, and the star to the marts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.operators.keyed import add_missing_keys
from basketflow.operators.validate import check, fk_check
from basketflow.plans import dds, marts, publish
from basketflow.sources import sinks


class Star:
    """The current snapshots of the star under one folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self.counts: dict[str, int] = {}

    def read(self, table: str) -> DataFrame:
        return sinks.read_snapshot(self.spark, f"{self.base}/{table}", schemas.DDS[table])

    def write(self, table: str, df: DataFrame) -> None:
        """Write the next snapshot and note its row count, read from the file footers."""
        path = sinks.write_snapshot(dds.conform(df, table), f"{self.base}/{table}")
        self.counts[table] = self.spark.read.schema(schemas.DDS[table]).parquet(path).count()

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """Write an intermediate table and read it back; earlier runs' copies go."""
        path = sinks.write_snapshot(df, f"{self.base}/{name}")
        sinks.drop_old_snapshots(self.spark, f"{self.base}/{name}", keep=1)
        return self.spark.read.schema(df.schema).parquet(path)

    def tidy(self, keep: int) -> None:
        """Delete old snapshots of all tables."""
        for table in schemas.DDS:
            sinks.drop_old_snapshots(self.spark, f"{self.base}/{table}", keep)
            sinks.drop_old_snapshots(self.spark, f"{self.base}/_rejected/{table}", keep)

    def write_rejects(self, table: str, *frames: DataFrame) -> None:
        """Keep refused rows as JSON next to the tables, with the reasons they carry."""
        as_json = [f.select(F.to_json(F.struct("*")).alias("row")) for f in frames]
        out = as_json[0]
        for more in as_json[1:]:
            out = out.unionByName(more)
        path = sinks.write_snapshot(out, f"{self.base}/_rejected/{table}")
        self.counts[f"{table} rejected"] = self.spark.read.schema(out.schema).parquet(path).count()


def raw_to_star(spark: SparkSession, read_raw: Callable[[str], DataFrame], base: str,
                keep_snapshots: int = 2) -> dict[str, int]:
    """Run all raw-to-star jobs in dependency order; returns rows per table.

    A table is written before the jobs that look things up in it, so each job reads
    finished Parquet and not the plans of the jobs before.
    """
    star = Star(spark, base)
    events, profiles = read_raw("events"), read_raw("user_profiles")

    # Users first: everything else refers to them.  The users of the events are needed
    # three times and are found in one pass.
    seen = star.keep("_event_users", dds.event_users(events))
    users = dds.remove_unknown_users(star.read("users"), profiles, seen)
    users = dds.upsert_users(users, dds.build_users(profiles, seen))
    users = dds.add_event_users(users, seen)
    users = add_missing_keys(users, dds.numeric_ids(read_raw("user_locations")), "user_id")
    star.write("users", users)
    users = star.read("users")

    star.write("categories", dds.build_categories(events, star.read("categories")))
    star.write("products", dds.upsert_products(
        star.read("products"), dds.build_products(events, star.read("categories"))))

    # Every numeric user id of the events is in users by now; no reference can be broken.
    loaded, rejected = dds.load_events(events)
    star.write("events", loaded)
    star.write_rejects("events", rejected)
    sessions, conflicts = dds.own_sessions(star.keep("_user_sessions", dds.user_sessions(events)))
    star.write("sessions", dds.upsert_sessions(star.read("sessions"), sessions))
    star.write_rejects("sessions", conflicts)

    raw_orders, statuses = read_raw("orders"), read_raw("order_status_events")
    # Cleaned rows are split by several rules; they are written once and split from there.
    cleaned = star.keep("_clean_orders", dds.clean_orders(raw_orders, statuses))
    sound, failed = check(cleaned, "orders")
    sound, orphans = fk_check(sound, users, "user_id", ["order_id"])
    orders = dds.remove_unknown_orders(star.read("orders"), raw_orders)
    star.write("orders", dds.apply_status(dds.upsert_orders(orders, sound), statuses))
    star.write_rejects("orders", failed, orphans)

    cleaned = star.keep("_clean_items", dds.clean_items(read_raw("order_items")))
    sound, failed = check(cleaned, "order_items")
    sound, orphans = fk_check(sound, star.read("orders"), "order_id", ["product_id"])
    star.write("order_items", dds.upsert_items(star.read("order_items"), sound))
    star.write_rejects("order_items", failed, orphans)

    devices, rejected = dds.load_devices(read_raw("user_devices"))
    devices, orphans = fk_check(star.keep("_clean_devices", devices), users, "user_id", ["device_id"])
    star.write("user_devices", devices)
    star.write_rejects("user_devices", rejected, orphans)
    locations, _, rejected = dds.load_locations(read_raw("user_locations"), users)
    star.write("user_locations", locations)
    star.write_rejects("user_locations", rejected)

    raw_campaigns = read_raw("campaign_events")
    star.write("campaigns", dds.upsert_campaigns(
        star.read("campaigns"), dds.build_campaigns(raw_campaigns)))
    touches, orphans = fk_check(dds.load_campaign_events(raw_campaigns).where("user_id IS NOT NULL"),
                                users, "user_id", ["campaign_event_id"])
    star.write("campaign_events", touches)
    star.write_rejects("campaign_events", orphans)
    star.tidy(keep_snapshots)
    publish.append_report(spark, base, datetime.now(UTC).replace(tzinfo=None), [
        (name.removesuffix(" rejected"), "rejected" if name.endswith(" rejected") else "rows", n)
        for name, n in star.counts.items()])
    return star.counts


def star_to_marts(spark: SparkSession, star_base: str, mart_base: str, as_of: datetime,
                  keep_snapshots: int = 2, reload_days: int | None = None) -> dict[str, int | None]:
    """Compute and publish all marts; returns the rows of each, None where none came.

    With ``reload_days`` only that many days up to ``as_of`` are replaced in the marts that are kept by
    months (see ``publish.reload_mart``).  What was clipped, dropped and found twice goes to the
    report in ``mart_base``.  Old snapshots go, but for the newest ``keep_snapshots`` of each mart.
    """
    read = Star(spark, star_base).read
    sessions, orders, events = read("sessions"), read("orders"), read("events")
    items, products, categories = read("order_items"), read("products"), read("categories")
    devices, locations, users = read("user_devices"), read("user_locations"), read("users")

    # What several marts aggregate first is written once.
    shared = Star(spark, f"{mart_base}/_shared")
    days = shared.keep("session_days", marts.session_days(sessions))
    lines = shared.keep("order_lines", marts.order_lines(items, orders))
    results = {
        "daily_business_summary": marts.daily_business_summary(sessions, orders, days),
        "product_performance": marts.product_performance(items, orders, products, categories, lines),
        "category_performance": marts.category_performance(
            items, orders, products, categories, lines),
        "user_engagement": marts.user_engagement(users, sessions, events, orders, as_of),
        "active_users_7d": marts.active_users_7d(sessions, days),
        "session_analytics": marts.session_analytics(sessions, events, devices, locations),
        "campaign_performance": marts.campaign_performance(
            read("campaigns"), read("campaign_events"), sessions, orders, user_days=days),
        "geo_analysis": marts.geo_analysis(sessions, locations, orders, days),
        "device_analysis": marts.device_analysis(
            devices, users, sessions, orders, items, user_days=days),
    }
    counts: dict[str, int | None] = {}
    report: list[tuple[str, str, int]] = []
    for mart, df in results.items():
        observed = publish.Observed()
        if reload_days is None:
            counts[mart] = publish.load_mart(df, mart_base, mart, observed)
        else:
            counts[mart] = publish.reload_mart(df, mart_base, mart, as_of.date(), reload_days, observed)
        report += [(mart, rule, n) for rule, n in observed.rows()]
        sinks.drop_old_snapshots(spark, f"{mart_base}/{mart}", keep_snapshots)
    publish.append_report(spark, mart_base, as_of, report)
    return counts
