"""Table schemas, keys and checks of the three layers (raw, star, marts).

All lists here are fixed values, facts of the data model: column names, types, keys,
checks, sort orders, event types.  Ids that a database would number itself are BIGINT.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = "decimal(18,2)"

_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "smallint": T.ShortType(),
    "double": T.DoubleType(), "string": T.StringType(), "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(18,2)": T.DecimalType(18, 2), "decimal(5,2)": T.DecimalType(5, 2),
    "decimal(18,6)": T.DecimalType(18, 6), "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _struct(spec: str) -> T.StructType:
    """A schema from 'name type, name type'; needs no session."""
    pairs = (column.split() for column in spec.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# --- raw layer: append-only landing, ids as text ------------------------------
RAW = {
    "events": _struct(
        "event_id bigint, user_id string, session_id string, event_type string, "
        "product_id int, product_name string, product_category string, "
        "order_id string, quantity int, city string, country string, lat double, lon double, "
        f"cost_usd {MONEY}, cost_eur {MONEY}, cost_rub {MONEY}, "
        "weather_temp decimal(5,2), weather_desc string, timestamp timestamp_ntz"),
    "user_profiles": _struct(
        "user_profile_id bigint, user_id string, name string, email string, "
        "birth_date date, gender string, received_at timestamp_ntz"),
    "user_devices": _struct(
        "user_device_id bigint, user_id string, device_type string, os string, "
        "browser string, received_at timestamp_ntz"),
    "user_locations": _struct(
        "user_location_id bigint, user_id string, city string, country string, "
        "lat double, lon double, received_at timestamp_ntz"),
    "orders": _struct(
        "raw_order_id bigint, order_id string, user_id string, order_ts timestamp_ntz, "
        f"total_usd {MONEY}, received_at timestamp_ntz"),
    "order_items": _struct(
        "raw_order_item_id bigint, order_id string, product_id int, quantity int, "
        f"price_usd {MONEY}, received_at timestamp_ntz"),
    "campaign_events": _struct(
        "campaign_event_id bigint, user_id string, campaign_id string, campaign_name string, "
        f"channel string, action string, cost {MONEY}, generated_at timestamp_ntz, "
        "received_at timestamp_ntz"),
    "order_status_events": _struct(
        "event_id bigint, order_id string, status string, generated_at timestamp_ntz"),
}

# --- star layer ---------------------------------------------------------------
DDS = {
    "users": _struct(
        "user_id bigint, name string, email string, birth_date date, gender string, "
        "city string, country string"),
    "events": _struct(
        "event_id bigint, user_id bigint, event_type string, timestamp timestamp_ntz, "
        "session_id string, product_id bigint, product_name string, product_category string, "
        f"order_id string, quantity int, cost_usd {MONEY}, cost_eur {MONEY}, cost_rub {MONEY}, "
        f"weather_temp {MONEY}, weather_desc string, city string, country string, "
        "lat double, lon double"),
    "orders": _struct(
        f"order_id string, user_id bigint, order_ts timestamp_ntz, total_usd {MONEY}, "
        "status string"),
    "order_items": _struct(
        "order_item_id bigint, order_id string, product_id int, quantity int, "
        f"price_usd {MONEY}"),
    "categories": _struct("category_id bigint, category_name string"),
    "products": _struct("product_id int, product_name string, category_id bigint"),
    "sessions": _struct(
        "session_id string, user_id bigint, start_ts timestamp_ntz, end_ts timestamp_ntz, "
        "event_count int"),
    "user_devices": _struct(
        "device_id bigint, user_id bigint, device_type string, os string, browser string"),
    "user_locations": _struct(
        "location_id bigint, user_id bigint, city string, country string, lat double, lon double"),
    "campaigns": _struct("campaign_id string, campaign_name string, channel string"),
    "campaign_events": _struct(
        f"campaign_event_id bigint, user_id bigint, campaign_id string, action string, "
        f"cost {MONEY}, generated_at timestamp_ntz"),
    "order_status_events": _struct(
        "event_id bigint, order_id string, status string, generated_at timestamp_ntz"),
}

# --- dimensions of the enrichment stage -----------------------------------------
DIMENSIONS = {
    "rates": _struct("day date, currency string, rate decimal(18,6)"),
    "places": _struct("city string, country string, p_lat double, p_lon double"),
    "tree": _struct("level int, cube bigint, parent bigint, leaf boolean, x double, y double, z double"),
    "weather": _struct("lat double, lon double, observed_at timestamp_ntz, temp double, "
                       "weather string, day date"),
    # a version: the folders it is made of
    "versions": _struct("rates string, places string, tree string, weather array<string>"),
}

# --- marts --------------------------------------------------------------------
MART = {
    "daily_business_summary": _struct(
        "event_date date, total_revenue double, total_orders bigint, unique_customers bigint, "
        "avg_order_value double, conversion_rate double, new_users bigint, "
        "total_sessions bigint, successful_orders bigint"),
    "product_performance": _struct(
        "product_id bigint, product_name string, category_name string, total_quantity bigint, "
        "total_revenue double, avg_price double, orders_count bigint, unique_customers bigint, "
        "event_date date"),
    "category_performance": _struct(
        "category_name string, total_quantity bigint, total_revenue double, orders_count bigint, "
        "unique_customers bigint, avg_order_value double, event_date date"),
    "user_engagement": _struct(
        "user_id bigint, sessions_count bigint, total_events bigint, "
        "avg_session_duration_seconds double, avg_pages_per_session double, "
        "first_session_date date, last_session_date date, total_orders bigint, "
        "total_revenue double, days_since_last_activity bigint"),
    "active_users_7d": _struct(
        "event_date date, active_users_count bigint, returning_users bigint, new_users bigint, "
        "churned_users bigint"),
    "session_analytics": _struct(
        "session_id string, user_id bigint, start_time timestamp_ntz, end_time timestamp_ntz, "
        "duration_seconds bigint, events_count bigint, page_views_count bigint, "
        "orders_count bigint, conversion_flag smallint, device_type string, browser string, "
        "os string, city string, country string"),
    "campaign_performance": _struct(
        "campaign_id string, campaign_name string, start_date date, end_date date, "
        "total_sessions bigint, total_orders bigint, total_revenue double, unique_users bigint, "
        "conversion_rate double, avg_order_value double, cost double, roi double"),
    "geo_analysis": _struct(
        "city string, country string, total_users bigint, total_orders bigint, "
        "total_revenue double, avg_order_value double, conversion_rate double, event_date date"),
    "device_analysis": _struct(
        "device_type string, os string, browser string, total_users bigint, "
        "total_sessions bigint, total_orders bigint, total_revenue double, "
        "avg_session_duration double, conversion_rate double, event_date date"),
}

# Date column that partitions a mart by month; marts not listed are unpartitioned.
MART_MONTH_COLUMN = {
    "daily_business_summary": "event_date",
    "product_performance": "event_date",
    "category_performance": "event_date",
    "active_users_7d": "event_date",
    "geo_analysis": "event_date",
    "device_analysis": "event_date",
}

# Sort order inside the files of a mart.
MART_SORT = {
    "daily_business_summary": ["event_date"],
    "product_performance": ["category_name", "product_id", "event_date"],
    "category_performance": ["category_name", "event_date"],
    "user_engagement": ["user_id"],
    "active_users_7d": ["event_date"],
    "session_analytics": ["start_time", "user_id"],
    "campaign_performance": ["campaign_id", "start_date"],
    "geo_analysis": ["country", "city", "event_date"],
    "device_analysis": ["device_type", "os", "browser", "event_date"],
}

# Date field that must be present in a published row.  The campaign mart has none.
MART_DATE_FIELD = {
    **{name: "event_date" for name in MART},
    "user_engagement": "last_session_date",
    "session_analytics": "start_time",
}

PRIMARY_KEY = {
    "users": ["user_id"], "events": ["event_id"], "orders": ["order_id"],
    "order_items": ["order_id", "product_id"], "categories": ["category_name"],
    "products": ["product_id"], "sessions": ["session_id"], "user_devices": ["device_id"],
    "user_locations": ["location_id"], "campaigns": ["campaign_id"],
    "campaign_events": ["campaign_event_id"], "order_status_events": ["event_id"],
}

# child table -> [(column, parent table, parent column)]
FOREIGN_KEYS = {
    "events": [("user_id", "users", "user_id")],
    "orders": [("user_id", "users", "user_id")],
    "order_items": [("order_id", "orders", "order_id")],
    "products": [("category_id", "categories", "category_id")],
    "sessions": [("user_id", "users", "user_id")],
    "user_devices": [("user_id", "users", "user_id")],
    "user_locations": [("user_id", "users", "user_id")],
    "campaign_events": [("user_id", "users", "user_id"),
                        ("campaign_id", "campaigns", "campaign_id")],
    "order_status_events": [("order_id", "orders", "order_id")],
}

ORDER_STATUSES = ["pending", "success", "failed", "cancelled"]
_STATUS_CHECK = ("status_known", "status IN ('pending', 'success', 'failed', 'cancelled')")

# table -> [(name, SQL predicate)]; a predicate that is NULL passes, as in SQL.
CHECKS = {
    "users": [("gender_known", "gender IN ('male', 'female')")],
    "orders": [("total_not_negative", "total_usd >= 0"), _STATUS_CHECK],
    "order_items": [("quantity_positive", "quantity > 0"),
                    ("price_not_negative", "price_usd >= 0")],
    "order_status_events": [_STATUS_CHECK],
}

# Event types that enter the star.
ALLOWED_EVENT_TYPES = [
    "session_start", "session_end", "purchase", "payment_success", "payment_failed",
    "signup", "churn", "view_product", "add_to_cart", "view_page",
]
# Event types that do not make an unknown user count as active.
LIFECYCLE_ONLY = ["session_start", "session_end", "signup"]


def create_tables(spark, layer: dict[str, T.StructType], database: str, location: str) -> None:
    """Declare every table of a layer as an external Parquet table."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in layer.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) "
                  f"USING parquet LOCATION '{location}/{name}'")
