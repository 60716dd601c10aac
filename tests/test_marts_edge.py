"""Marts on random small tables with busy keys, NULLs, ties and repeated rows.

The expected rows come from the plain joins in ``checks.mart_oracles``; ``hot_rows=3``
makes nearly every key a hot one that is split.
"""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import duckdb
import pytest

from basketflow.plans import marts
from checks.compare import _rows
from checks.fixtures import AS_OF
from checks.mart_oracles import MARTS

SCHEMAS = {
    "users": "user_id bigint",
    "sessions": "session_id string, user_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, event_count int",
    "ev": "event_id bigint, session_id string, event_type string, order_id string",
    "ord": "order_id bigint, user_id bigint, order_ts timestamp_ntz, total_usd decimal(18,2), status string",
    "items": "order_id bigint, product_id bigint, quantity int, price_usd decimal(18,2)",
    "categories": "category_id bigint, category_name string",
    "products": "product_id bigint, product_name string, category_id bigint",
    "devices": "user_id bigint, device_type string, os string, browser string",
    "locations": "user_id bigint, city string, country string",
    "campaigns": "campaign_id string, campaign_name string",
    "camp_ev": "user_id bigint, campaign_id string, cost decimal(18,2), generated_at timestamp_ntz",
}


def random_tables(seed: int) -> dict[str, list[tuple]]:
    rng = random.Random(seed)

    def user(known=8):
        return 1 if rng.random() < 0.4 else rng.randint(1, known)   # user 1 is busy

    def at(days=30, null=0.1):
        if rng.random() < null:
            return None
        # Whole hours make ties between touches, orders and span ends.
        return datetime(2024, 1, 1) + timedelta(hours=rng.randint(0, days * 4) * 6)

    def money(low=0, high=900):
        return Decimal(rng.randint(low * 100, high * 100)) / 100

    sessions = [(f"s{i}", user(10), at(), at(), rng.randint(1, 9)) for i in range(40)]
    ord_ = [(i, user(10), at(40, 0), None if rng.random() < 0.1 else money(),
             rng.choice(["success", "success", "pending", None])) for i in range(60)]
    items = [(0 if rng.random() < 0.3 else rng.randint(0, 65), rng.randint(1, 6), rng.randint(1, 30),
              money()) for _ in range(150)]
    return {
        "users": [(u,) for u in range(1, 9)],
        "sessions": sessions,
        "ev": [(i, rng.choice(["s0", "s1", f"s{rng.randint(0, 45)}", None]),
                rng.choice(["view_page", "purchase", "signup", None]),
                rng.choice(["a", "b", None])) for i in range(200)],
        "ord": ord_, "items": items,
        "categories": [(1, "A"), (2, "B")],
        "products": [(p, f"P{p}", rng.choice([1, 2, None])) for p in range(1, 6)],
        # Repeated and partly NULL descriptions.
        "devices": [(user(), rng.choice(["mobile", None]), "iOS", rng.choice(["Safari", "Unknown", None]))
                    for _ in range(14)],
        "locations": [(user(), rng.choice(["X", "Y", None]), rng.choice(["C", None])) for _ in range(14)],
        "campaigns": [(f"c{i}", f"C{i}") for i in range(3)],
        "camp_ev": [(None if rng.random() < 0.05 else user(10), f"c{rng.randint(0, 3)}",
                     None if rng.random() < 0.1 else money(), at(30, 0.05)) for _ in range(60)],
    }


def builds(t):
    return {
        "m1_daily_business_summary": lambda: marts.daily_business_summary(t["sessions"], t["ord"]),
        "m2_product_performance": lambda: marts.product_performance(
            t["items"], t["ord"], t["products"], t["categories"]),
        "m3_category_performance": lambda: marts.category_performance(
            t["items"], t["ord"], t["products"], t["categories"], hot_rows=3),
        "m4_user_engagement": lambda: marts.user_engagement(
            t["users"], t["sessions"], t["ev"], t["ord"], AS_OF),
        "m4_user_engagement_safe": lambda: marts.user_engagement(
            t["users"], t["sessions"], t["ev"], t["ord"], AS_OF, fanout_safe=True),
        "m5_active_users_7d": lambda: marts.active_users_7d(t["sessions"]),
        "m6_session_analytics": lambda: marts.session_analytics(
            t["sessions"], t["ev"], t["devices"], t["locations"], hot_rows=3),
        "m7_campaign_performance": lambda: marts.campaign_performance(
            t["campaigns"], t["camp_ev"], t["sessions"], t["ord"], hot_rows=3),
        "m7_campaign_performance_safe": lambda: marts.campaign_performance(
            t["campaigns"], t["camp_ev"], t["sessions"], t["ord"], fanout_safe=True, hot_rows=3),
        "m8_geo_analysis": lambda: marts.geo_analysis(t["sessions"], t["locations"], t["ord"]),
        "m9_device_analysis": lambda: marts.device_analysis(
            t["devices"], t["users"], t["sessions"], t["ord"], t["items"]),
        "m9_device_analysis_safe": lambda: marts.device_analysis(
            t["devices"], t["users"], t["sessions"], t["ord"], t["items"], fanout_safe=True),
    }


@pytest.fixture(scope="module", params=[11, 12, 13])
def tables(request, spark):
    data = random_tables(request.param)
    con = duckdb.connect()
    frames = {}
    for name, schema in SCHEMAS.items():
        frames[name] = spark.createDataFrame(data[name], schema)
        types = (schema.replace("timestamp_ntz", "timestamp").replace("string", "varchar")
                 .replace(" int,", " integer,"))
        con.execute(f"CREATE TABLE {name} ({types})")
        if data[name]:
            marks = ", ".join("?" * len(data[name][0]))
            con.executemany(f"INSERT INTO {name} VALUES ({marks})", data[name])
    return frames, con


@pytest.mark.parametrize("mart", list(builds({})))
def test_equals_plain_joins(tables, mart):
    frames, con = tables
    df = builds(frames)[mart]()
    names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(MARTS[mart])
    want_names, want = _rows([d[0] for d in result.description], result.fetchall())
    assert names == want_names
    assert got == want


@pytest.mark.parametrize("mart", list(builds({})))
def test_empty_tables(spark, mart):
    frames = {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}
    assert builds(frames)[mart]().collect() == []
