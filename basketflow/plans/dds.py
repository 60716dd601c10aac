"""Raw tables to the star: one function per job, DataFrame in, DataFrame out.

Each job takes the current snapshot of its target where it needs one and returns the
next snapshot; ``plans.pipeline`` writes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.functions import is_uuid, normalize_gender, try_id, try_ts
from basketflow.operators.keyed import (
    add_missing_keys, dedup, delete_orphans, first_per_key, latest_by, number_new_names,
    upsert_coalesce, upsert_replace,
)
from basketflow.operators.skew import HOT_ROWS, split_join
from basketflow.operators.validate import allow, not_null, not_null_if, validate

# The cost of a campaign event that came without one, by action.
DEFAULT_ACTION_COST = {"view": "0.10", "click": "0.30", "purchase": "1.00"}
OTHER_ACTION_COST = "0.05"


def numeric_ids(df: DataFrame) -> DataFrame:
    """Distinct numeric user ids of a raw table."""
    return df.select(try_id("user_id").alias("user_id")).where("user_id IS NOT NULL").distinct()


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns and types of a star table; columns the frame lacks are NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.DDS[table].fields])


# --- users --------------------------------------------------------------------
def event_users(events: DataFrame) -> DataFrame:
    """The numeric user ids of the raw events; ``active`` marks the users who did something
    other than opening a session, ending it or signing up."""
    acts = F.coalesce(~F.col("event_type").isin(schemas.LIFECYCLE_ONLY), F.lit(False))
    return (events.select(try_id("user_id").alias("user_id"), acts.alias("acts"))
            .where("user_id IS NOT NULL").groupBy("user_id").agg(F.bool_or("acts").alias("active")))


def build_users(profiles: DataFrame, seen: DataFrame) -> DataFrame:
    """Profile rows with a numeric id, and a bare row per active user without a profile.

    ``seen`` is the result of ``event_users``.

    ``user_profile_id`` orders the rows of one user; it is NULL in the bare rows.
    """
    known = (profiles.withColumns({"user_id": try_id("user_id"),
                                   "gender": normalize_gender("gender")})
             .where("user_id IS NOT NULL")
             .select("user_profile_id", "user_id", "name", "email", "birth_date", "gender",
                     F.lit(None).cast("string").alias("city"),
                     F.lit(None).cast("string").alias("country")))
    bare = seen.where("active").select("user_id").join(
        numeric_ids(profiles), "user_id", "left_anti")
    return known.unionByName(bare, allowMissingColumns=True)


def remove_unknown_users(users: DataFrame, profiles: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop users that have neither a profile nor an active event."""
    keep = numeric_ids(profiles).union(seen.where("active").select("user_id"))
    return delete_orphans(users, keep, "user_id")


def upsert_users(users: DataFrame, built: DataFrame) -> DataFrame:
    order = F.coalesce("user_profile_id", F.lit(-1))
    return upsert_coalesce(users, built, "user_id", order)


def add_event_users(users: DataFrame, seen: DataFrame) -> DataFrame:
    """Add a bare row for every user seen in any event."""
    return add_missing_keys(users, seen, "user_id")


# --- events -------------------------------------------------------------------
def typed_events(raw: DataFrame) -> DataFrame:
    """Allowed event types only, with the timestamp parsed."""
    return allow(raw.withColumn("timestamp", try_ts("timestamp")), "event_type",
                 schemas.ALLOWED_EVENT_TYPES)


def load_events(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, rejected): allow-list, validation, dedup, then the batch's null rule.

    Product name and category are no fields of the model and stay in the raw layer.
    """
    typed = typed_events(raw)
    valid, rejected = validate(typed, "event", keep=["event_id"])
    unique = dedup(valid, ["user_id", "event_type", "timestamp"], "event_id")
    sessionless = F.col("event_type").isin("signup", "churn")
    kept = not_null_if(unique, sessionless, ["user_id"], ["user_id", "session_id"],
                       batch=typed.select("event_type"))
    return kept, rejected


# --- orders -------------------------------------------------------------------
def latest_status(statuses: DataFrame) -> DataFrame:
    return latest_by(statuses.where("order_id IS NOT NULL"), ["order_id"], "generated_at",
                     "event_id").select("order_id", "status")


def orders_with_status(orders: DataFrame, statuses: DataFrame,
                       hot_rows: int = HOT_ROWS) -> DataFrame:
    """Distinct raw orders with their latest status, 'pending' where none came."""
    columns = ["user_id", "order_ts", "total_usd"]
    known = orders.where("order_id IS NOT NULL")
    joined = split_join(known.select("order_id", *columns).distinct(), latest_status(statuses),
                        "order_id", "left", columns, hot_rows, counted=known)
    return joined.withColumn("status", F.coalesce("status", F.lit("pending")))


def remove_unknown_orders(orders: DataFrame, raw_orders: DataFrame) -> DataFrame:
    return delete_orphans(orders, raw_orders, "order_id")


def clean_orders(raw_orders: DataFrame, statuses: DataFrame) -> DataFrame:
    """One complete row per order, from its last raw row; a missing total is 0."""
    usable = not_null(raw_orders.withColumn("user_id", try_id("user_id")),
                      ["order_id", "user_id", "order_ts"])
    newest = first_per_key(usable, ["order_id"], [F.col("raw_order_id").desc()])
    return newest.join(latest_status(statuses), "order_id", "left").select(
        "order_id", "user_id", "order_ts",
        F.coalesce("total_usd", F.lit(0).cast(schemas.MONEY)).alias("total_usd"),
        F.coalesce("status", F.lit("pending")).alias("status"))


def upsert_orders(orders: DataFrame, cleaned: DataFrame) -> DataFrame:
    return upsert_replace(orders, cleaned, ["order_id"])


def clean_items(raw_items: DataFrame) -> DataFrame:
    """One row per (order, product), from its last raw row; a missing quantity is 1."""
    usable = not_null(raw_items, ["order_id", "product_id", "price_usd"])
    newest = first_per_key(usable, ["order_id", "product_id"], [F.col("raw_order_item_id").desc()])
    return newest.select(
        F.col("raw_order_item_id").alias("order_item_id"), "order_id", "product_id",
        F.coalesce("quantity", F.lit(1)).alias("quantity"), "price_usd")


def upsert_items(items: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Known (order, product) pairs keep their id and take the new quantity and price."""
    return upsert_replace(items, cleaned, ["order_id", "product_id"],
                          columns=["quantity", "price_usd"])


def apply_status(orders: DataFrame, statuses: DataFrame) -> DataFrame:
    """Set the status of orders that are open, or that failed or were cancelled.

    An open order takes its latest status event, any other order its latest failed or
    cancelled one.
    """
    recency = F.struct(F.col("generated_at").isNull(), F.col("generated_at"), F.col("event_id"))
    stopped = F.col("status").isin("failed", "cancelled")
    per_order = statuses.groupBy("order_id").agg(
        F.max_by("status", recency).alias("any_status"),
        F.max_by(F.when(stopped, F.col("status")), F.when(stopped, recency)).alias("stop_status"),
        F.lit(True).alias("seen"))
    still_open = F.col("status").isNull() | (F.col("status") == "pending")
    status = (F.when(still_open & F.col("seen"), F.col("any_status"))
              .when(~still_open, F.coalesce("stop_status", "status"))
              .otherwise(F.col("status")))
    return (orders.join(per_order, "order_id", "left").withColumn("status", status)
            .select(*orders.columns))


# --- devices and locations ----------------------------------------------------
def load_devices(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(devices, rejected), one row per user and device description."""
    valid, rejected = validate(raw, "user_device", keep=["user_device_id"])
    unique = dedup(valid, ["user_id", "device_type", "os", "browser"], "user_device_id")
    return unique.withColumnRenamed("user_device_id", "device_id"), rejected


def load_locations(raw: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(locations, users with the missing ones added, rejected)."""
    valid, rejected = validate(raw, "user_location", keep=["user_location_id"])
    unique = dedup(valid, ["user_id", "city", "country"], "user_location_id")
    return (unique.withColumnRenamed("user_location_id", "location_id"),
            add_missing_keys(users, numeric_ids(raw), "user_id"), rejected)


# --- sessions -----------------------------------------------------------------
SESSION_COLUMNS = ["session_id", "user_id", "start_ts", "end_ts", "event_count"]


def user_sessions(raw_events: DataFrame, require_uuid: bool = True) -> DataFrame:
    """Per session id and user: first start, last end, events, and the earliest event."""
    events = raw_events.withColumn("user_id", try_id("user_id")).where(
        "session_id IS NOT NULL AND user_id IS NOT NULL")
    if require_uuid:
        events = events.where(is_uuid("session_id"))
    at, kind = F.col("timestamp"), F.col("event_type")
    return events.groupBy("session_id", "user_id").agg(
        F.min(F.when(kind == "session_start", at)).alias("start_ts"),
        F.max(F.when(kind == "session_end", at)).alias("end_ts"),
        F.count(F.lit(1)).cast("int").alias("event_count"),
        F.min(at).alias("first_ts"))


def own_sessions(grouped: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sessions, conflicts) of ``user_sessions``.

    A session id used by several users stays with the user of its earliest event; the
    other users' rows are the conflicts.
    """
    owned = first_per_key(grouped, ["session_id"], ["first_ts", "user_id"])
    others = grouped.join(owned.select("session_id", "user_id"), ["session_id", "user_id"], "left_anti")
    return owned.select(*SESSION_COLUMNS), others.select(*SESSION_COLUMNS)


def build_sessions(raw_events: DataFrame, users: DataFrame, require_uuid: bool = True,
                   hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(sessions, conflicts) of known users, over all raw events."""
    ids = raw_events.select(try_id("user_id").alias("user_id"))
    known = split_join(user_sessions(raw_events, require_uuid), users.select("user_id").distinct(),
                       "user_id", "left_semi", ["session_id"], hot_rows, counted=ids)
    return own_sessions(known)


def upsert_sessions(sessions: DataFrame, built: DataFrame) -> DataFrame:
    """Known sessions keep their user and take the new times and count."""
    return upsert_replace(sessions, built, ["session_id"],
                          columns=["start_ts", "end_ts", "event_count"])


# --- catalogue ----------------------------------------------------------------
def build_categories(raw_events: DataFrame, existing: DataFrame) -> DataFrame:
    """Existing categories and the new names, numbered on from the highest id."""
    names = raw_events.select(F.col("product_category").alias("category_name"))
    fresh = number_new_names(names, "category_name", existing, "category_id")
    return existing.unionByName(fresh)


def build_products(raw_events: DataFrame, categories: DataFrame) -> DataFrame:
    """Products of the events; one whose category is not a known category is left out."""
    described = raw_events.where("product_id IS NOT NULL").groupBy("product_id").agg(
        F.coalesce(F.max("product_name"), F.lit("Unknown Product")).alias("product_name"),
        F.coalesce(F.max("product_category"), F.lit("Unknown")).alias("category_name"))
    return described.join(categories, "category_name").select(
        "product_id", "product_name", "category_id")


def upsert_products(products: DataFrame, built: DataFrame) -> DataFrame:
    return upsert_replace(products, built, ["product_id"])


# --- campaigns ----------------------------------------------------------------
def build_campaigns(raw: DataFrame) -> DataFrame:
    """Latest name and channel of each campaign."""
    return latest_by(raw.where("campaign_id IS NOT NULL"), ["campaign_id"], "generated_at",
                     "campaign_event_id").select("campaign_id", "campaign_name", "channel")


def upsert_campaigns(campaigns: DataFrame, built: DataFrame) -> DataFrame:
    return upsert_replace(campaigns, built, ["campaign_id"])


def imputed_cost(cost: Column, action: Column) -> Column:
    """The cost, or the default for the action where it is missing."""
    default = F.lit(OTHER_ACTION_COST)
    for name, value in DEFAULT_ACTION_COST.items():
        default = F.when(action == name, F.lit(value)).otherwise(default)
    return F.coalesce(cost, default.cast(schemas.MONEY))


def load_campaign_events(raw: DataFrame) -> DataFrame:
    return raw.where("campaign_id IS NOT NULL").select(
        "campaign_event_id", try_id("user_id").alias("user_id"), "campaign_id", "action",
        imputed_cost(F.col("cost"), F.col("action")).alias("cost"), "generated_at")
