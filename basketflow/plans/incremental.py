"""Raw tables to the star by landed batches.

Every star table has a state: a row per key that can be added to, kept in hash buckets.  A run
reads the raw rows of the batches that no run has read yet, reduces them to state rows, and joins
these into the buckets they fall into; other buckets are neither read nor written.  The columns
of a state are minima, maxima and sums, so batches may come in any order and cut, and the
tables equal those of one run over all rows:

* a row of several raw rows takes the values of the highest serial (of users: each value the last
  one that was given), a deduplicated row those of the lowest;
* an (order, product) pair has the serial of its first raw row as id;
* a session id used by several users belongs to the user of its earliest event;
* events without a session are hidden from the first sign-up or churn event on, as the null rule of
  the batch says, with all batches so far as the batch;
* a row whose parent is unknown waits in its bucket and shows up when the parent comes.

A run first writes the new buckets to a pending folder and marks it complete, then puts
them in place, then notes the batches as consumed.  A run that finds a complete pending folder
puts it in place again before anything else, so an interruption at any point loses and counts
nothing twice.  Raw rows that no table takes are kept as JSON with a reason, per run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow import schemas
from basketflow.functions import is_uuid, normalize_gender, try_id
from basketflow.operators.keyed import first_per_key, number_new_names
from basketflow.operators.validate import check, validate
from basketflow.plans import dds
from basketflow.sources import sinks

BUCKETS = 256

# (table, after, upto) -> raw rows of the batches after < batch <= upto
ReadBatches = Callable[[str, int, int], DataFrame]


@dataclass(frozen=True)
class State:
    """Key columns, the column whose hash gives the bucket, and how each other column is combined."""

    keys: tuple[str, ...]
    bucket: str
    combine: dict[str, Callable[[str], Column]]
    parent: tuple[str, str] | None = None  # (table, column of the state that refers to it)


_USER_VALUES = ("name", "email", "birth_date", "gender")
STATES: dict[str, State] = {
    "users": State(("user_id",), "user_id", {c: F.max for c in _USER_VALUES}),
    "categories": State(("category_name",), "category_name", {"category_id": F.min}),
    "products": State(("product_id",), "product_id", {"product_name": F.max, "category_name": F.max}),
    "events": State(("user_id", "event_type", "timestamp"), "user_id", {"first": F.min}),
    "sessions": State(("session_id", "user_id"), "session_id",
                      {"start_ts": F.min, "end_ts": F.max, "event_count": F.sum, "first_ts": F.min}),
    "orders": State(("order_id",), "order_id", {"last": F.max, "latest": F.max, "stopped": F.max}, ("users", "last.user_id")),
    # by order, so that an order and its items change in the same bucket number
    "order_items": State(("order_id", "product_id"), "order_id", {"last": F.max, "order_item_id": F.min}, ("orders", "order_id")),
    "user_devices": State(("user_id", "device_type", "os", "browser"), "user_id", {"device_id": F.min}, ("users", "user_id")),
    "user_locations": State(("user_id", "city", "country"), "user_id", {"first": F.min}),
    "campaigns": State(("campaign_id",), "campaign_id", {"last": F.max}),
    "campaign_events": State(("campaign_event_id", "user_id"), "user_id", {"first": F.min}, ("users", "user_id")),
}
NEEDS = {"orders": ("users",), "order_items": ("users", "orders"), "user_devices": ("users",),
         "campaign_events": ("users",), "products": ("categories",)}


# --- raw rows to state rows -----------------------------------------------------
def _given(column: str, order: Column) -> Column:
    """The value with its order, NULL where there is no value."""
    return F.when(F.col(column).isNotNull(), F.struct(order.alias("at"), F.col(column).alias("value"))).alias(column)


def _users(raw: Callable[[str], DataFrame]) -> DataFrame:
    profiles = raw("user_profiles").withColumns({"user_id": try_id("user_id"), "gender": normalize_gender("gender")})
    known = profiles.select("user_id", *[_given(c, F.col("user_profile_id")) for c in _USER_VALUES])
    seen = dds.numeric_ids(raw("events")).union(dds.numeric_ids(raw("user_locations")))
    return known.where("user_id IS NOT NULL").unionByName(seen, allowMissingColumns=True)


def _products(raw: Callable[[str], DataFrame]) -> DataFrame:
    return raw("events").where("product_id IS NOT NULL").select(
        "product_id", "product_name", F.col("product_category").alias("category_name"))


def _events(raw: Callable[[str], DataFrame]) -> DataFrame:
    valid, _ = validate(dds.typed_events(raw("events")), "event", keep=["event_id"])
    star = dds.conform(valid, "events")
    rest = [c for c in star.columns if c not in STATES["events"].keys]
    return star.select(*STATES["events"].keys, F.struct(*rest).alias("first"))


def _sessions(raw: Callable[[str], DataFrame]) -> DataFrame:
    return dds.user_sessions(raw("events")).withColumn("event_count", F.col("event_count").cast("bigint"))


def _orders(raw: Callable[[str], DataFrame]) -> DataFrame:
    rows = raw("orders").withColumn("user_id", try_id("user_id")).where(
        "order_id IS NOT NULL AND user_id IS NOT NULL AND order_ts IS NOT NULL")
    told = F.struct(F.col("generated_at").isNull().alias("none"), "generated_at", "event_id", "status")
    statuses = raw("order_status_events").where("order_id IS NOT NULL").select(
        "order_id", told.alias("latest"), F.when(F.col("status").isin("failed", "cancelled"), told).alias("stopped"))
    return rows.select("order_id", F.struct("raw_order_id", "user_id", "order_ts", "total_usd").alias("last")).unionByName(
        statuses, allowMissingColumns=True)


def _items(raw: Callable[[str], DataFrame]) -> DataFrame:
    rows = raw("order_items").where("order_id IS NOT NULL AND product_id IS NOT NULL AND price_usd IS NOT NULL")
    return rows.select("order_id", "product_id", F.struct("raw_order_item_id", "quantity", "price_usd").alias("last"),
                       F.col("raw_order_item_id").alias("order_item_id"))


def _devices(raw: Callable[[str], DataFrame]) -> DataFrame:
    valid, _ = validate(raw("user_devices"), "user_device", keep=["user_device_id"])
    return valid.select("user_id", "device_type", "os", "browser", F.col("user_device_id").alias("device_id"))


def _locations(raw: Callable[[str], DataFrame]) -> DataFrame:
    valid, _ = validate(raw("user_locations"), "user_location", keep=["user_location_id"])
    return valid.select("user_id", "city", "country",
                        F.struct(F.col("user_location_id").alias("location_id"), "lat", "lon").alias("first"))


def _campaigns(raw: Callable[[str], DataFrame]) -> DataFrame:
    return raw("campaign_events").where("campaign_id IS NOT NULL").select("campaign_id", F.struct(
        F.col("generated_at").isNull().alias("none"), "generated_at", "campaign_event_id", "campaign_name", "channel").alias("last"))


def _campaign_events(raw: Callable[[str], DataFrame]) -> DataFrame:
    rows = dds.load_campaign_events(raw("campaign_events")).where("user_id IS NOT NULL")
    return rows.select("campaign_event_id", "user_id", F.struct("campaign_id", "action", "cost", "generated_at").alias("first"))


DELTAS: dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]] = {
    "users": _users, "products": _products, "events": _events, "sessions": _sessions, "orders": _orders,
    "order_items": _items, "user_devices": _devices, "user_locations": _locations, "campaigns": _campaigns,
    "campaign_events": _campaign_events,
}


def refused(table: str, raw: Callable[[str], DataFrame]) -> DataFrame | None:
    """(reason, row): raw rows that the table does not take, and never will."""
    def because(df: DataFrame, reason: Column) -> DataFrame:
        return df.select(reason.alias("reason"), F.to_json(F.struct("*")).alias("row")).where("reason IS NOT NULL")

    def missing(df: DataFrame, *columns: str) -> DataFrame:
        reasons = [F.when(F.col(c).isNull(), F.lit(f"{c}: missing")) for c in columns]
        return because(df, F.nullif(F.concat_ws("; ", *reasons), F.lit("")))

    def invalid(df: DataFrame, model: str) -> DataFrame:
        bad = validate(df, model)[1]
        return bad.select(F.array_join("reasons", "; ").alias("reason"), F.to_json(F.struct("*")).alias("row"))

    if table == "events":
        rows = raw("events")
        known = F.coalesce(F.col("event_type").isin(schemas.ALLOWED_EVENT_TYPES), F.lit(False))
        return because(rows, F.when(~known, F.lit("event_type: not allowed"))).unionByName(invalid(dds.typed_events(rows), "event"))
    if table == "sessions":
        rows = raw("events").withColumn("number", try_id("user_id"))
        return because(rows, F.when(F.col("number").isNull(), "user_id: not a number").when(
            F.col("session_id").isNull(), "session_id: missing").when(~is_uuid("session_id"), "session_id: not a uuid"))
    if table == "orders":
        return missing(raw("orders").withColumn("user_id", try_id("user_id")), "order_id", "user_id", "order_ts")
    if table == "order_items":
        return missing(raw("order_items"), "order_id", "product_id", "price_usd")
    if table == "users":
        return missing(raw("user_profiles").withColumn("user_id", try_id("user_id")), "user_id")
    if table == "campaign_events":
        return missing(raw("campaign_events").withColumn("user_id", try_id("user_id")), "campaign_id", "user_id")
    if table == "user_devices":
        return invalid(raw("user_devices"), "user_device")
    if table == "user_locations":
        return invalid(raw("user_locations"), "user_location")
    return None


# --- state rows to star rows ----------------------------------------------------
def _order_rows(state: DataFrame) -> DataFrame:
    latest = F.coalesce("latest.status", F.lit("pending"))
    status = (F.when(F.col("latest").isNotNull() & (latest == "pending"), F.col("latest.status"))
              .when(latest != "pending", F.coalesce("stopped.status", latest)).otherwise(latest))
    rows = state.where("last IS NOT NULL AND known").select(
        "bucket", "order_id", "last.user_id", "last.order_ts",
        F.coalesce("last.total_usd", F.lit(0).cast(schemas.MONEY)).alias("total_usd"), status.alias("status"))
    return check(rows, "orders")[0]


def _item_rows(state: DataFrame) -> DataFrame:
    rows = state.where("known").select("order_item_id", "order_id", "product_id",
                                       F.coalesce("last.quantity", F.lit(1)).alias("quantity"), "last.price_usd")
    return check(rows, "order_items")[0]


class Store:
    """The states under one folder, and which batches they hold."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS):
        self.spark, self.base, self.buckets = spark, base.rstrip("/"), buckets

    def _exists(self, path: str) -> bool:
        return sinks.exists(self.spark, path)

    def bucket(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.buckets)).cast("int")

    # consumed batches: one row, kept as snapshots like any table
    _CONSUMED = "upto bigint, sessionless boolean"

    def consumed(self) -> tuple[int, bool]:
        """The last batch that is in the states, and whether a sign-up or churn event was seen."""
        row = sinks.read_snapshot(self.spark, f"{self.base}/_consumed", T.StructType.fromDDL(self._CONSUMED)).first()
        return (row["upto"], row["sessionless"]) if row else (-1, False)

    def holds(self, table: str) -> bool:
        """Whether a run has written the state of a table."""
        return self._exists(f"{self.base}/{table}")

    def state(self, table: str, schema: T.StructType | None = None, only: list[int] | None = None) -> DataFrame:
        """The state rows of a table, of some buckets only if these are named."""
        path = f"{self.base}/{table}"
        if not self._exists(path):
            if schema is None:
                raise FileNotFoundError(path)
            return self.spark.createDataFrame([], schema)
        rows = (self.spark.read if schema is None else self.spark.read.schema(schema)).parquet(path)
        return rows if only is None else rows.where(F.col("bucket").isin(only) if only else F.lit(False))

    def read(self, table: str) -> DataFrame:
        """A star table; without rows if no batch had any."""
        if not self._exists(f"{self.base}/{table}"):
            return self.spark.createDataFrame([], schemas.DDS[table])
        state = self.state(table)
        if table == "users":
            rows = state.select("user_id", *[F.col(f"{c}.value").alias(c) for c in _USER_VALUES])
        elif table == "products":
            named = state.select("product_id", F.coalesce("product_name", F.lit("Unknown Product")).alias("product_name"),
                                 F.coalesce("category_name", F.lit("Unknown")).alias("category_name"))
            rows = named.join(self.state("categories").drop("bucket"), "category_name")
        elif table == "events":
            rows = state.select("user_id", "event_type", "timestamp", "first.*")
            if not self.consumed()[1]:
                rows = rows.where("session_id IS NOT NULL")
        elif table == "sessions":
            rows = first_per_key(state, ["session_id"], ["first_ts", "user_id"])
        elif table == "orders":
            rows = _order_rows(state)
        elif table == "order_items":
            rows = _item_rows(state)
        elif table == "campaigns":
            rows = state.select("campaign_id", "last.campaign_name", "last.channel")
        else:
            rows = state.where("known") if STATES[table].parent else state
            rows = rows.select("*", "first.*") if "first" in rows.columns else rows
        return dds.conform(rows, table)

    # --- a run ---
    def put_in_place(self, pending: str) -> None:
        """Replace the buckets that the complete pending folder holds; may be repeated."""
        for table in STATES:
            if self._exists(f"{pending}/{table}"):
                sinks.move_partitions(self.spark, f"{pending}/{table}", f"{self.base}/{table}")
        done = self.spark.read.schema(self._CONSUMED).parquet(f"{pending}/_consumed")
        if self.consumed()[0] < done.first()["upto"]:
            sinks.write_snapshot(done, f"{self.base}/_consumed")
        sinks.drop_old_snapshots(self.spark, f"{self.base}/_consumed", keep=1)

    def recover(self) -> None:
        """Finish an interrupted run, or forget what it had not completed."""
        fs, folder = sinks._path(self.spark, f"{self.base}/_pending")
        if self._exists(f"{self.base}/_pending/_SUCCESS"):
            self.put_in_place(f"{self.base}/_pending")
        fs.delete(folder, True)


def _numbers(buckets: DataFrame) -> set[int]:
    """Bucket numbers; there are never more than BUCKETS."""
    return {r["bucket"] for r in buckets.select("bucket").distinct().collect()}


def merge_batches(spark: SparkSession, read: ReadBatches, base: str, upto: int, buckets: int = BUCKETS,
                  tables: list[str] | None = None) -> dict[str, int]:
    """Add the batches up to ``upto`` that are not in the states yet; returns the buckets written per table.

    ``tables`` restricts a store to these and the tables they refer to.
    """
    store = Store(spark, base, buckets)
    store.recover()
    after, sessionless = store.consumed()
    if after >= upto:
        return {}
    chosen = set(tables or STATES)
    chosen |= {n for t in chosen for n in NEEDS.get(t, ())}
    pending = f"{store.base}/_pending"
    written: dict[str, int] = {}
    changed: dict[str, set[int]] = {}  # buckets (of the parent's key) in which rows became or ceased to be parents

    def raw(table: str) -> DataFrame:
        return read(table, after, upto)

    def now(table: str, schema: T.StructType) -> DataFrame:
        """The state after this run."""
        old = store.state(table, schema)
        if not touched_of[table]:
            return old
        new = spark.read.schema(schema).parquet(f"{pending}/{table}")
        return new.unionByName(old.where(~F.col("bucket").isin(touched_of[table])))

    schemas_of: dict[str, T.StructType] = {}
    touched_of: dict[str, list[int]] = {}
    for table, how in STATES.items():
        if table not in chosen:
            continue
        if table == "categories":
            names = raw("events").select(F.col("product_category").alias("category_name"))
            plain = T.StructType.fromDDL("category_id bigint, category_name string, bucket int")
            delta = number_new_names(names, "category_name", store.state(table, plain), "category_id")
        else:
            delta = DELTAS[table](raw)
        combined = [f(c).alias(c) for c, f in how.combine.items()]
        delta = delta.groupBy(*how.keys).agg(*combined).withColumn("bucket", store.bucket(how.bucket))
        schema = delta.schema if how.parent is None else T.StructType([*delta.schema.fields, T.StructField("known", T.BooleanType())])
        schemas_of[table] = schema
        delta.write.option("compression", "zstd").parquet(f"{pending}/_delta/{table}")
        delta = spark.read.schema(delta.schema).parquet(f"{pending}/_delta/{table}")
        touched = _numbers(delta)
        if how.parent:
            parent, column = how.parent
            if column == how.bucket:
                # of these, the buckets that hold rows
                touched |= _numbers(store.state(table, schema, sorted(changed[parent])))
            elif changed[parent]:
                # rows that wait for a parent: found by their mark, without reading the others
                came = spark.read.parquet(f"{pending}/_new/{parent}")
                waiting = store.state(table, schema).where("NOT known").select("bucket", F.col(column).alias("key"))
                touched |= _numbers(waiting.join(came, "key", "left_semi"))
        only = touched_of[table] = sorted(touched)
        old = store.state(table, schema, only)
        first = not store.holds(table)
        # the first delta has a row per key already
        merged = delta if first else old.drop("known").unionByName(delta).groupBy("bucket", *how.keys).agg(*combined)
        if how.parent:
            parent, column = how.parent
            ids = now(parent, schemas_of[parent])
            ids = _order_rows(ids).select("order_id") if parent == "orders" else ids.select(STATES[parent].keys[0])
            ids = ids.select(F.col(ids.columns[0]).alias("parent_id"), F.lit(True).alias("known"))
            key = merged.withColumn("parent_id", F.col(column))
            merged = key.join(ids, "parent_id", "left").drop("parent_id").withColumn("known", F.coalesce("known", F.lit(False)))
        written[table] = len(only)
        today = spark.createDataFrame([], schema)
        if only:
            # few files for a bucket, many for one that a hot key fills
            merged.select(*schema.names).hint("rebalance", "bucket").write.option("compression", "zstd").partitionBy("bucket").parquet(f"{pending}/{table}")
            today = spark.read.schema(schema).parquet(f"{pending}/{table}")
        if table in ("users", "orders"):
            before = old
            if table == "orders":
                before, today = _order_rows(before), _order_rows(today)
            id_ = how.keys[0]
            fresh = today.select("bucket", F.col(id_).alias("key"))
            if not first:
                both = before.select("bucket", F.col(id_).alias("key")).unionByName(fresh)
                # a key that is there before and after occurs twice
                fresh = both.groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("bucket", "key")
            fresh.write.parquet(f"{pending}/_new/{table}")
            changed[table] = _numbers(spark.read.parquet(f"{pending}/_new/{table}"))
        if (bad := refused(table, raw)) is not None:
            bad.write.mode("overwrite").parquet(f"{store.base}/_refused/table={table}/upto={upto}")
    if "events" in chosen:
        flag = F.coalesce(F.bool_or(F.col("event_type").isin("signup", "churn")), F.lit(False)).alias("flag")
        sessionless = bool(sessionless or dds.typed_events(raw("events")).agg(flag).first()["flag"])
    spark.createDataFrame([(upto, sessionless)], Store._CONSUMED).write.parquet(f"{pending}/_consumed")
    sinks.commit_snapshot(spark, pending)
    store.recover()
    return written


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that the ingest stream has committed, -1 if none."""
    fs, folder = sinks._path(spark, f"{checkpoint}/commits")
    if not fs.exists(folder):
        return -1
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return max([int(n) for n in names if n.isdigit()], default=-1)
