"""Star and raw tables derived from the given test tables.

``Star`` and ``Raw`` read the Parquet tables of one scale-factor folder and map them
to the tables the jobs expect.  ``STAR_SQL`` and ``RAW_SQL`` in ``checks.prelude``
state the same mapping for the checking database.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.streaming.router import SERIAL

AS_OF = datetime(2024, 1, 31)
MONEY = "decimal(18,2)"


def _pick(index: Column, *names: str | None) -> Column:
    """names[index] for an index expression already in range."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))


def _moved(key: Column, stays: Column | str) -> Column:
    """The key, or one that no row of another table has."""
    return F.when(F.expr(stays) if isinstance(stays, str) else stays, key).otherwise(key + 10_000_000)


class Source:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        """A given table; its files are listed and its schema read once."""
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def spread(self, name: str) -> None:
        """Deal a given table's rows to all tasks, however few row groups its file has."""
        rows = self.given(name)
        self._read[name] = rows.repartition(2 * self.spark.sparkContext.defaultParallelism, *rows.columns)

    def event_users(self) -> Column:
        """How many user ids the events use (ids run from 0)."""
        return self.given("events").agg(F.max("user_id") + 1).scalar()


class Star(Source):
    """Clean star tables."""

    def events(self) -> DataFrame:
        kind = F.col("event_type")
        return self.given("events").select(
            "event_id", "user_id",
            F.when(kind == "click", "session_start").when(kind == "error", "session_end")
            .when(kind == "view", "view_page").otherwise(kind).alias("event_type"),
            F.col("ts").alias("timestamp"),
            F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))
            .alias("session_id"),
            F.when(kind == "purchase",
                   F.concat(F.lit("o"), (F.col("event_id") % 500).cast("string"))).alias("order_id"),
            F.col("value").cast(MONEY).alias("cost_usd"))

    def users(self) -> DataFrame:
        return self.given("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))

    def sessions(self) -> DataFrame:
        at = F.col("timestamp")
        kind = F.col("event_type")
        return self.events().groupBy("session_id", "user_id").agg(
            F.min(F.when(kind == "session_start", at)).alias("start_ts"),
            F.max(F.when(kind == "session_end", at)).alias("end_ts"),
            F.count(F.lit(1)).cast("int").alias("event_count"))

    def orders(self) -> DataFrame:
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        shift = F.make_dt_interval(secs=((key * 7919) % 2592000).cast("decimal(18,6)"))
        return self.given("orders").select(
            key.alias("order_id"),
            (F.col("o_custkey") % self.event_users()).alias("user_id"),
            (F.lit("2024-01-01").cast("timestamp_ntz") + shift).alias("order_ts"),
            F.col("o_totalprice").cast(MONEY).alias("total_usd"),
            F.when(status == "F", "success").when(status == "O", "pending")
            .when(key % 10 == 0, "cancelled").otherwise("failed").alias("status"))

    def order_items(self) -> DataFrame:
        part = self.given("part").select("p_partkey", "p_retailprice")
        lines = self.given("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("p_retailprice").cast(MONEY).alias("price_usd"))

    def categories(self) -> DataFrame:
        from pyspark.sql import Window
        return self.given("part").select(F.col("p_type").alias("category_name")).distinct().select(
            F.row_number().over(Window.orderBy("category_name")).cast("bigint").alias("category_id"),
            "category_name")

    def products(self) -> DataFrame:
        part = self.given("part")
        named = part.join(self.categories(), F.col("p_type") == F.col("category_name"))
        return named.select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.when(F.col("p_partkey") % 20 != 0, F.col("category_id")).alias("category_id"))

    def user_devices(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.given("customer").select(
            _moved(key, "c_acctbal >= 0").alias("user_id"),
            _pick(key % 3, "mobile", "desktop", "tablet").alias("device_type"),
            _pick(key % 5, "iOS", "Android", "Windows", "Linux", "MacOS").alias("os"),
            _pick(key % 4, "Chrome", "Firefox", "Safari", "Edge").alias("browser"))

    def user_locations(self) -> DataFrame:
        places = self.given("nation").join(
            self.given("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        key = F.col("c_custkey")
        return self.given("customer").join(
            places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            _moved(key, "c_mktsegment <> 'HOUSEHOLD'").alias("user_id"),
            F.when(key % 14 == 3, "Unknown").otherwise(F.col("n_name")).alias("city"),
            F.when(key % 17 == 5, "Antarctica").otherwise(F.col("r_name")).alias("country"))

    def campaigns(self) -> DataFrame:
        return self.given("region").select(
            F.concat(F.lit("camp"), (F.col("r_regionkey") + 1).cast("string")).alias("campaign_id"),
            F.col("r_name").alias("campaign_name"))

    def campaign_events(self) -> DataFrame:
        key, kind = F.col("event_id"), F.col("event_type")
        imputed = (F.when(kind == "view", F.lit("0.10")).when(kind == "click", F.lit("0.30"))
                   .when(kind == "purchase", F.lit("1.00")).otherwise(F.lit("0.05")))
        return self.given("events").select(
            key.alias("campaign_event_id"), "user_id",
            F.concat(F.lit("camp"), (key % 5 + 1).cast("string")).alias("campaign_id"),
            kind.alias("action"),
            F.when(key % 7 == 0, imputed.cast(MONEY)).otherwise(F.col("value").cast(MONEY))
            .alias("cost"),
            F.col("ts").alias("generated_at"))


def _uuid(text: Column) -> Column:
    """A uuid made of the md5 of a text; empty where the text is NULL."""
    out = F.md5(text)  # named once in the whole expression: inside a condition Spark works out every mention
    for hyphen in (9, 14, 19, 24):
        out = F.overlay(out, F.lit("-"), hyphen, 0)
    return F.coalesce(out, F.lit(""))


def _hash_id(*parts: Column) -> Column:
    """A bigint from the first 15 hex digits of the md5 of some columns."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _dirty_id(key: Column, user: Column) -> Column:
    """User ids as text, some missing, some not numeric, some written as 12.0."""
    text = user.cast("string")
    return (F.when(key % 101 == 0, F.lit(None)).when(key % 13 == 0, F.concat(F.lit("x"), text))
            .when(key % 17 == 0, F.concat(text, F.lit(".0"))).otherwise(text))


DUPLICATE_ID_SHIFT = 10_000_000_000


class Raw(Source):
    """Raw tables with the faults the jobs must cope with."""

    def _twice(self, df: DataFrame, serial: str, **changes: Column) -> DataFrame:
        """Repeat the rows marked ``again`` under a higher serial, with some changes."""
        repeat = df.where("again").withColumns(
            {serial: F.col(serial) + DUPLICATE_ID_SHIFT, **changes})
        return df.unionByName(repeat).drop("again")

    def events(self) -> DataFrame:
        key, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
        owner = F.when(key % 29 == 0, user + 2).otherwise(user)
        shopping = kind.isin("view", "purchase") & (key % 5 != 0)
        product = F.when(shopping, key % 200 + 1)
        placed = key % 19 != 0
        rows = self.given("events").select(
            "event_id", _dirty_id(key, user).alias("user_id"),
            F.when(key % 23 == 0, F.lit(None))
            .when(key % 37 == 0, F.concat(F.lit("bad-"), user.cast("string")))
            .otherwise(_uuid(F.concat_ws("-", owner.cast("string"), F.to_date("ts").cast("string"))))
            .alias("session_id"),
            F.when(key % 97 == 0, F.lit(None)).when(key % 31 == 0, "search")
            .when(kind == "click", "session_start").when(kind == "error", "session_end")
            .when((kind == "view") & (key % 3 == 0), "view_page")
            .when(kind == "view", "view_product").otherwise(kind).alias("event_type"),
            product.cast("int").alias("product_id"),
            F.when(shopping & (key % 4 != 0), F.concat(
                F.lit("Item "), product.cast("string"),
                F.when(key % 8 == 1, " new").otherwise(""))).alias("product_name"),
            F.when(shopping & (product % 10 != 7),
                   F.concat(F.lit("cat"), (product % 10).cast("string"))).alias("product_category"),
            F.when(kind == "purchase", _uuid(F.concat(F.lit("o"), (key % 500).cast("string"))))
            .alias("order_id"),
            F.when(kind == "purchase", key % 5).cast("int").alias("quantity"),
            F.when(placed, F.concat(F.lit("City "), (user % 25).cast("string"))).alias("city"),
            F.when(placed, F.concat(F.lit("Country "), (user % 5).cast("string"))).alias("country"),
            F.when(placed, (key * 37 % 18000).cast("double") / 100 - 90).alias("lat"),
            F.when(placed, (key * 61 % 36000).cast("double") / 100 - 180).alias("lon"),
            F.col("value").cast(MONEY).alias("cost_usd"),
            F.lit(None).cast(MONEY).alias("cost_eur"), F.lit(None).cast(MONEY).alias("cost_rub"),
            F.when(placed, ((key % 400).cast("double") / 10 - 10).cast("decimal(5,2)"))
            .alias("weather_temp"),
            F.when(placed, _pick(key % 4, "clear sky", "light rain", "snow", "mist"))
            .alias("weather_desc"),
            F.col("ts").alias("timestamp"), (F.col("value") > 20).alias("again"))
        return self._twice(rows, "event_id")

    def profiles(self) -> DataFrame:
        key = F.col("c_custkey")
        user = _moved(key, "c_mktsegment <> 'BUILDING'")
        rows = self.given("customer").select(
            (key * 2).alias("user_profile_id"), _dirty_id(key, user).alias("user_id"),
            F.col("c_name").alias("name"),
            F.when(key % 5 != 1, F.concat(F.lit("c"), key.cast("string"), F.lit("@shop.example")))
            .alias("email"),
            F.date_add(F.lit("1970-01-01").cast("date"), (key % 15000).cast("int"))
            .alias("birth_date"),
            _pick(key % 5, " Male ", "female", "other", None, "FEMALE").alias("gender"),
            (F.col("c_acctbal") > 5000).alias("again"))
        return self._twice(rows, "user_profile_id", name=F.lit(None).cast("string"),
                           email=F.concat(F.lit("new."), F.col("email")),
                           gender=F.lit(None).cast("string"))

    def devices(self) -> DataFrame:
        key = F.col("c_custkey")
        rows = self.given("customer").select(
            key.alias("user_device_id"), _dirty_id(key, key % 700).alias("user_id"),
            _pick(key % 3, "mobile", "desktop", None).alias("device_type"),
            _pick(key % 5, "iOS", "Android", "Windows", "Linux", "MacOS").alias("os"),
            _pick(key % 4, "Chrome", "Firefox", "Safari", "Edge").alias("browser"),
            (F.col("c_mktsegment") == "BUILDING").alias("again"))
        return self._twice(rows, "user_device_id")

    def locations(self) -> DataFrame:
        key = F.col("c_custkey")
        places = self.given("nation").join(
            self.given("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        rows = self.given("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            key.alias("user_location_id"), _dirty_id(key, key % 900).alias("user_id"),
            F.col("n_name").alias("city"), F.col("r_name").alias("country"),
            F.when(key % 12 != 0, (key * 37 % 18000).cast("double") / 100 - 90).alias("lat"),
            F.when(key % 12 != 0, (key * 61 % 36000).cast("double") / 100 - 180).alias("lon"),
            (F.col("c_mktsegment") == "MACHINERY").alias("again"))
        return self._twice(rows, "user_location_id")

    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        shift = F.make_dt_interval(secs=((key * 7919) % 2592000).cast("decimal(18,6)"))
        rows = self.given("orders").select(
            key.alias("raw_order_id"),
            F.when(key % 103 != 0, _uuid(F.concat(F.lit("o"), key.cast("string")))).alias("order_id"),
            _dirty_id(key, F.col("o_custkey") % self.event_users()).alias("user_id"),
            F.when(key % 107 != 0,
                   F.lit("2024-01-01").cast("timestamp_ntz") + shift).alias("order_ts"),
            F.when(key % 21 != 0, F.col("o_totalprice").cast(MONEY)).alias("total_usd"),
            (F.col("o_orderpriority") == "1-URGENT").alias("again"))
        return self._twice(rows, "raw_order_id",
                           total_usd=(F.col("total_usd") + 1).cast(MONEY))

    def items(self) -> DataFrame:
        key, line = F.col("l_orderkey"), F.col("l_linenumber")
        part = self.given("part").select("p_partkey", "p_retailprice")
        return self.given("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            _hash_id(key, F.col("l_partkey"), line, F.col("l_suppkey"), F.to_date("l_shipdate"))
            .alias("raw_order_item_id"),
            F.when(key % 103 != 0, _uuid(F.concat(F.lit("o"), key.cast("string")))).alias("order_id"),
            F.when(F.col("l_partkey") % 41 != 0, F.col("l_partkey")).cast("int").alias("product_id"),
            F.when(line != 5, F.col("l_quantity").cast("int") - 1).alias("quantity"),
            F.when(F.col("l_partkey") % 43 != 0, F.col("p_retailprice").cast(MONEY))
            .alias("price_usd"))

    def statuses(self) -> DataFrame:
        key, line, back = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_returnflag")
        return self.given("lineitem").select(
            _hash_id(key, F.col("l_partkey"), line, F.col("l_suppkey"), F.to_date("l_shipdate"))
            .alias("event_id"),
            _uuid(F.concat(F.lit("o"), key.cast("string"))).alias("order_id"),
            F.when(back == "A", "success").when(back == "N", "pending").otherwise("cancelled")
            .alias("status"),
            F.when(line != 4, F.col("l_shipdate")).alias("generated_at"))

    def campaign_events(self) -> DataFrame:
        key = F.col("event_id")
        regions = self.given("region").select(
            F.col("r_regionkey").cast("bigint").alias("r_regionkey"), "r_name")
        rows = self.given("events").withColumn("slot", key % 5).join(
            regions, F.col("slot") == F.col("r_regionkey"))
        return rows.select(
            key.alias("campaign_event_id"), _dirty_id(key, F.col("user_id")).alias("user_id"),
            F.when(key % 33 != 0, F.concat(F.lit("camp"), (F.col("slot") + 1).cast("string")))
            .alias("campaign_id"),
            F.concat("r_name", F.when(key % 2 == 0, " sale").otherwise("")).alias("campaign_name"),
            _pick(key % 3, "email", "social", "search").alias("channel"),
            F.col("event_type").alias("action"),
            F.when(key % 7 != 0, F.col("value").cast(MONEY)).alias("cost"),
            F.when(key % 9 != 0, F.col("ts")).alias("generated_at"))

    # Star snapshots as an earlier run could have left them.
    def old_users(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.given("customer").select(
            _moved(key, "c_acctbal < 6000").alias("user_id"), F.concat(F.lit("old "), "c_name").alias("name"),
            F.lit("old@shop.example").alias("email"), F.lit(None).cast("date").alias("birth_date"),
            F.when(key % 4 == 0, "male").alias("gender"),
            F.when(key % 6 == 0, "Oldtown").alias("city"),
            F.lit(None).cast("string").alias("country"))

    def old_orders(self) -> DataFrame:
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        gone = (F.col("o_orderpriority") == "2-HIGH") | (F.col("o_orderdate") >= "1999-01-01")
        return self.given("orders").select(
            _uuid(F.concat(F.when(gone, "gone").otherwise("o"),
                           key.cast("string")))
            .alias("order_id"),
            F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("order_ts"),
            F.lit(1).cast(MONEY).alias("total_usd"),
            F.when(status == "F", "success").when(status == "O", "pending").alias("status"))

    def old_items(self) -> DataFrame:
        """The known pairs with other ids and prices; dear products have an id of their own."""
        known = self.items().where("order_id IS NOT NULL AND product_id IS NOT NULL")
        known = known.withColumn("product_id", _moved(F.col("product_id"), "price_usd < 1000"))
        return known.groupBy("order_id", "product_id").agg(
            F.min("raw_order_item_id").alias("order_item_id")).select(
            "order_item_id", "order_id", "product_id", F.lit(9).alias("quantity"),
            F.lit("0.99").cast(MONEY).alias("price_usd"))

    def old_categories(self) -> DataFrame:
        """Two categories known from before."""
        return self.given("region").where(F.col("r_regionkey") < 2).select(
            (F.col("r_regionkey") + 5).cast("bigint").alias("category_id"),
            F.concat(F.lit("cat"), (F.col("r_regionkey") + 3).cast("string")).alias("category_name"))


def raw_tables(spark: SparkSession, sf_dir: str, spread: Sequence[str] = ()) -> dict[str, Callable[[], DataFrame]]:
    """The raw tables by the names the runs use; the given tables in ``spread`` are dealt to all tasks first."""
    raw = Raw(spark, sf_dir)
    for name in spread:
        raw.spread(name)
    return {"events": raw.events, "user_profiles": raw.profiles, "user_devices": raw.devices,
            "user_locations": raw.locations, "orders": raw.orders, "order_items": raw.items,
            "order_status_events": raw.statuses, "campaign_events": raw.campaign_events}


def batches(spark: SparkSession, sf_dir: str, number: int) -> Callable[[str, int, int], DataFrame]:
    """A reader of the raw tables as if they had landed in ``number`` batches, dealt by a hash of the serial."""
    frames = raw_tables(spark, sf_dir)

    def read(table: str, after: int, upto: int) -> DataFrame:
        batch = F.pmod(F.xxhash64(SERIAL[table]), F.lit(number)) + 1
        return frames[table]().where((batch > after) & (batch <= upto))

    return read
