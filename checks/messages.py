"""JSON messages made of the given tables, as a batch or as a stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import MONEY, _pick


def _iso(ts: str) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def _json(keep_nulls: bool = False, **fields: Column) -> Column:
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), options)


def _event_messages(events: DataFrame) -> DataFrame:
    key, kind = F.col("event_id"), F.col("event_type")
    session = F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))
    who = {"user_id": F.col("user_id"), "timestamp": _iso("ts")}
    activity = {**who, "session_id": session, "product_id": key % 200 + 1,
                "quantity": key % 5 + 1, "cost_usd": F.col("value").cast(MONEY),
                "lat": (key * 37 % 18000).cast("double") / 100 - 90, "search_text": F.lit("x")}
    typed = F.lit("event")
    return events.select(
        F.when(key % 50 == 0, F.concat(F.lit('{"type": "event", "user_id": '), key.cast("string")))
        .when(key % 51 == 0, _json(type=typed, **{**activity, "quantity": F.lit("many")}))
        .when(key % 53 == 0, _json(type=typed, user_id=F.col("user_id")))
        .when(kind == "click", _json(type=F.lit("session_start"), session_id=session, **who))
        .when(kind == "error", _json(type=F.lit("session_end"), session_id=session,
                                     event_type=F.lit("ignored"), **who))
        .when(kind == "signup", _json(type=F.lit("signup"), **who))
        .when(kind == "purchase", _json(event_type=F.lit("purchase"), **activity))
        .when(key % 7 == 0, _json(True, type=F.lit(None).cast("string"),
                                  event_type=F.lit("view_page"), **activity))
        .otherwise(_json(type=typed, event_type=F.lit("view_page"), **activity)).alias("value"))


def _of(df: DataFrame, kind: str, **fields: Column) -> DataFrame:
    return df.select(_json(type=F.lit(kind), **fields).alias("value"))


def messages(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """One message per profile, device, place, order, item, status, campaign touch, event."""
    def given(name: str) -> DataFrame:
        path = f"{sf_dir}/{name}.parquet"
        batch = spark.read.parquet(path)
        if not stream:
            return batch
        # As a glob pattern: a stream's plain path must be a folder.
        return spark.readStream.schema(batch.schema).parquet(f"{sf_dir}/{{{name}.parquet}}")

    customer, orders, lines, events = map(given, ["customer", "orders", "lineitem", "events"])
    c, o, line = F.col("c_custkey"), F.col("o_orderkey"), F.col("l_orderkey")
    order_of_line = F.concat(F.lit("o"), line.cast("string"))
    back = F.col("l_returnflag")
    return reduce(DataFrame.unionByName, [
        _of(customer, "user_profile", user_id=c, name=F.col("c_name"),
            birth_date=F.date_add(F.lit("1970-01-01").cast("date"), (c % 15000).cast("int"))
            .cast("string"), gender=_pick(c % 3, "male", "female", "other"),
            loyalty=F.lit("unknown field")),
        _of(customer, "user_device", user_id=c, device_type=_pick(c % 3, "mobile", "desktop", None),
            os=F.lit("iOS"), browser=_pick(c % 2, "Chrome", "Safari")),
        _of(customer, "user_location", user_id=c, city=F.concat(F.lit("City "), c.cast("string")),
            country=F.lit("Country"), lat=(c % 180).cast("double") - 90.5, lon=F.lit(12.25),
            weather_temp=F.lit(3)),
        _of(orders, "order", order_id=F.concat(F.lit("o"), o.cast("string")),
            user_id=F.col("o_custkey"), order_ts=_iso("o_orderdate"),
            total_usd=F.col("o_totalprice").cast(MONEY), campaign_id=F.lit("camp1")),
        _of(lines, "order_item", order_id=order_of_line, product_id=F.col("l_partkey"),
            quantity=F.col("l_quantity").cast("int"),
            price_usd=F.col("l_extendedprice").cast(MONEY)),
        _of(lines, "order_status", order_id=F.when(line % 97 != 0, order_of_line),
            status=F.when(back == "A", "success").when(back == "N", "pending")
            .when(F.col("l_linenumber") == 6, "lost").otherwise("cancelled"),
            generated_at=_iso("l_shipdate")),
        _of(events, "campaign_event", user_id=F.col("user_id"),
            campaign_id=F.lit("camp1"), campaign_name=F.lit("Summer"), channel=F.lit("email"),
            action=F.col("event_type"), cost=F.col("value").cast(MONEY), generated_at=_iso("ts")),
        _event_messages(events),
    ])
