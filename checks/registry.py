"""Every registered query with its checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.functions import nan_to_null, normalize_gender, try_id, try_ts
from basketflow.operators.enrich import (
    convert_currency, convert_currency_as_of, geo_lookup, weather_lookup,
)
from basketflow.operators.keyed import append_ignore, dedup
from basketflow.operators.validate import allow, check, fk_check, not_null, not_null_if, validate
from basketflow.plans import dashboards, dds, enrichment, incremental, marts, publish
from basketflow.plans.pipeline import raw_to_star
from basketflow.session import scratch_dir
from basketflow.sources import sinks
from basketflow.sources.tables import read_table
from basketflow.streaming import ingest, live, router
from checks.fixtures import AS_OF, Raw, Source, Star, batches, raw_tables
from checks.mart_oracles import MARTS
from checks.message_oracles import MESSAGE_TABLES, ROUTING
from checks.messages import messages
from checks.prelude import with_tables
from checks.publish_oracles import (
    DASHBOARDS, ENRICH_TABLES, ENRICHED, MART_TABLES, PUBLISHED, QUALITY,
)
from checks.raw_oracles import DDS, INCREMENTAL, LIVE, RAW_TABLES, RUN_COUNTS, VALIDATION

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def star(name: str, build: Callable[[Star], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(Star(spark, sf_dir))


MART_BUILDERS: dict[str, Callable[[Star], DataFrame]] = {
    "daily_business_summary": lambda s: marts.daily_business_summary(s.sessions(), s.orders()),
    "product_performance": lambda s: marts.product_performance(
        s.order_items(), s.orders(), s.products(), s.categories()),
    "category_performance": lambda s: marts.category_performance(
        s.order_items(), s.orders(), s.products(), s.categories()),
    "user_engagement": lambda s: marts.user_engagement(
        s.users(), s.sessions(), s.events(), s.orders(), AS_OF),
    "active_users_7d": lambda s: marts.active_users_7d(s.sessions()),
    "session_analytics": lambda s: marts.session_analytics(
        s.sessions(), s.events(), s.user_devices(), s.user_locations()),
    "campaign_performance": lambda s: marts.campaign_performance(
        s.campaigns(), s.campaign_events(), s.sessions(), s.orders()),
    "geo_analysis": lambda s: marts.geo_analysis(s.sessions(), s.user_locations(), s.orders()),
    "device_analysis": lambda s: marts.device_analysis(
        s.user_devices(), s.users(), s.sessions(), s.orders(), s.order_items()),
}
for number, (mart, build) in enumerate(MART_BUILDERS.items(), start=1):
    star(f"m{number}_{mart}", build)

star("m4_user_engagement_safe", lambda s: marts.user_engagement(
    s.users(), s.sessions(), s.events(), s.orders(), AS_OF, fanout_safe=True))
star("m7_campaign_performance_safe", lambda s: marts.campaign_performance(
    s.campaigns(), s.campaign_events(), s.sessions(), s.orders(), fanout_safe=True))
star("m9_device_analysis_safe", lambda s: marts.device_analysis(
    s.user_devices(), s.users(), s.sessions(), s.orders(), s.order_items(), fanout_safe=True))

ORACLES.update({name: with_tables(sql) for name, sql in MARTS.items()})


# --- raw to star --------------------------------------------------------------
def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the type the checking SQL returns."""
    return df.select(*[
        F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
        for c, t in df.dtypes])


def raw(name: str, build: Callable[[Raw], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: plain(build(Raw(spark, sf_dir)))


raw("d1_users", lambda r: dds.build_users(r.profiles(), dds.event_users(r.events())))
raw("d2_delete_orphans", lambda r: dds.remove_unknown_users(
    r.old_users(), r.profiles(), dds.event_users(r.events())))
raw("d3_upsert_users", lambda r: dds.upsert_users(
    r.old_users(), dds.build_users(r.profiles(), dds.event_users(r.events()))))
raw("d4_orders_latest_status", lambda r: dds.orders_with_status(r.orders(), r.statuses()))
raw("d5_orders_cleanup", lambda r: dds.remove_unknown_orders(r.old_orders(), r.orders()))
raw("d6_upsert_orders", lambda r: dds.upsert_orders(
    r.old_orders(), dds.clean_orders(r.orders(), r.statuses())))
raw("d7_upsert_items", lambda r: dds.upsert_items(
    r.old_items(), dds.clean_items(r.items())))
raw("d8_devices", lambda r: dds.load_devices(r.devices())[0])
raw("d9_locations", lambda r: dds.load_locations(r.locations(), r.old_users())[0])
raw("d9_location_users", lambda r: dds.load_locations(r.locations(), r.old_users())[1])
raw("d10_missing_users", lambda r: dds.add_event_users(
    r.old_users(), dds.event_users(r.events())))
raw("d11_sessions", lambda r: dds.build_sessions(r.events(), r.old_users())[0])
raw("d11_session_conflicts", lambda r: dds.build_sessions(r.events(), r.old_users())[1])
raw("d12_categories", lambda r: dds.build_categories(r.events(), r.old_categories()))
raw("d13_products", lambda r: dds.build_products(
    r.events(), dds.build_categories(r.events(), r.old_categories())))
raw("d14_campaigns", lambda r: dds.build_campaigns(r.campaign_events()))
raw("d15_campaign_costs", lambda r: dds.load_campaign_events(r.campaign_events()))
raw("d16_apply_status", lambda r: dds.apply_status(r.old_orders(), r.statuses()))


def _row_counts(r: Raw) -> DataFrame:
    built = {
        "events": dds.load_events(r.events())[0],
        "orders": dds.clean_orders(r.orders(), r.statuses()),
        "order_items": dds.clean_items(r.items()),
        "sessions": dds.build_sessions(r.events(), r.old_users())[0],
    }
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
              for name, df in built.items()]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


raw("d17_row_counts", _row_counts)


# --- validation ---------------------------------------------------------------
def _valid_events(r: Raw) -> DataFrame:
    return validate(dds.typed_events(r.events()), "event", keep=["event_id"])[0]


def _unique_events(r: Raw) -> DataFrame:
    return dedup(_valid_events(r), ["user_id", "event_type", "timestamp"], "event_id")


def _text_timestamps(r: Raw) -> DataFrame:
    key = F.col("event_id")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    return r.given("events").select(
        key, F.when(key % 6 == 0, F.lit(None)).when(key % 6 == 3, "soon").otherwise(iso).alias("text"))


def _without_signup(r: Raw) -> DataFrame:
    batch = allow(r.events(), "event_type", schemas.ALLOWED_EVENT_TYPES).where(
        ~F.col("event_type").isin("signup", "churn"))
    kept = not_null_if(batch, F.col("event_type").isin("signup", "churn"),
                       ["user_id"], ["user_id", "session_id"])
    return kept.select("event_id", "event_type", "session_id")


def _event_ids(r: Raw) -> DataFrame:
    return r.events().select("event_id", try_id("user_id").alias("user_id"))


raw("v1_validate_events", _valid_events)
raw("v1_rejected_events", lambda r: validate(
    dds.typed_events(r.events()), "event")[1].select(
    "event_id", "user_id", F.array_join("reasons", ", ").alias("reasons")))
raw("v2_default_zero", lambda r: validate(
    r.locations(), "user_location", keep=["user_location_id"])[0])
raw("v3_dedup", _unique_events)
raw("v4_not_null", lambda r: not_null(
    r.events().select("event_id", "user_id", "session_id"), ["user_id", "session_id"]))
raw("v5_batch_not_null", lambda r: dds.load_events(r.events())[0])
raw("v5_batch_without_signup", _without_signup)
raw("v6_allow_list", lambda r: allow(
    r.events(), "event_type", schemas.ALLOWED_EVENT_TYPES).select("event_id", "event_type"))
raw("v7_parse_timestamp", lambda r: _text_timestamps(r).select(
    "event_id", try_ts("text").alias("parsed")))
raw("v8_numeric_id", _event_ids)
raw("v9_gender", lambda r: r.profiles().select(
    "user_profile_id", normalize_gender("gender").alias("gender")))
raw("v10_checks", lambda r: check(
    r.items().select("raw_order_item_id", "quantity", "price_usd"), "order_items")[1]
    .withColumn("failed_checks", F.array_join("failed_checks", ", ")))
raw("v10_passed", lambda r: check(r.items(), "order_items")[0].select("raw_order_item_id", "quantity"))
raw("v11_fk_ok", lambda r: fk_check(_event_ids(r), r.old_users(), "user_id", ["event_id"])[0])
raw("v11_fk_orphans", lambda r: fk_check(_event_ids(r), r.old_users(), "user_id", ["event_id"])[1])
raw("v13_nan_to_null", lambda r: r.given("events").select(
    "event_id", nan_to_null(F.when(F.col("event_id") % 11 == 0, F.lit(float("nan")))
                            .otherwise(F.col("value"))).alias("value")))
raw("v14_integers", lambda r: _valid_events(r).select("event_id", "product_id", "quantity"))



# --- the star by batches --------------------------------------------------------
def _merged(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """A star table after two runs, each over the batches that had landed since the one before."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base, read = scratch_dir(spark, "incremental"), batches(spark, sf_dir, 2)
        for upto in (1, 2):
            incremental.merge_batches(spark, read, base, upto, buckets=8, tables=[table])
        store = incremental.Store(spark, base, 8)
        if table == "products":  # ids of categories depend on the batch that brings a name
            return store.read(table).join(store.read("categories"), "category_id").drop("category_id")
        return plain(store.read(table))
    return run


for _name in INCREMENTAL:
    QUERIES[_name] = _merged(_name.removeprefix("inc_"))

ORACLES.update({name: with_tables(sql, RAW_TABLES) for name, sql in {**DDS, **VALIDATION, **INCREMENTAL, **RUN_COUNTS, **LIVE}.items()})


# --- publishing ---------------------------------------------------------------
for number, (mart, build) in enumerate(MART_BUILDERS.items(), start=1):
    star(f"pub_m{number}_{mart}",
         lambda s, mart=mart, build=build: publish.publish_clean(build(s), mart))


def _mart(s: Source, name: str) -> DataFrame:
    return MART_BUILDERS[name](s)


def _odd_numbers(s: Source) -> DataFrame:
    """Numbers beyond every limit, and some NaN."""
    key = F.col("event_id")
    return s.given("events").select(
        "event_id",
        F.when(key % 11 == 0, F.lit(float("nan"))).otherwise(F.col("value") * 100)
        .alias("total_revenue"),
        (F.col("value") - 10).alias("conversion_rate"),
        (key - 500).cast("double").alias("roi"),
        (F.col("user_id") - 50).alias("total_orders"))


def _published_geo(s: Source) -> tuple[str, str]:
    """Publish the geo mart into a scratch folder; returns the folder and the mart's name."""
    base, mart = scratch_dir(s.spark, "marts"), "geo_analysis"
    sinks.publish(publish.publish_clean(_mart(s, mart), mart), base, mart)
    return base, mart


def _read_back(s: Source) -> DataFrame:
    base, mart = _published_geo(s)
    return sinks.read_mart(s.spark, base, mart).select(*schemas.MART[mart].names)


def _compacted(s: Source) -> DataFrame:
    base, mart = _published_geo(s)
    sinks.compact(s.spark, f"{base}/{mart}", sinks.mart_schema(mart), schemas.MART_SORT[mart])
    return sinks.read_mart(s.spark, base, mart).select(*schemas.MART[mart].names)


def _months(s: Source) -> DataFrame:
    base, mart = _published_geo(s)
    year = sinks.months_between(sinks.read_mart(s.spark, base, mart), "event_date",
                                date(2024, 1, 1), date(2024, 12, 31))
    return year.groupBy(sinks.MONTH).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("total_orders").alias("total_orders"))


def _replaced(s: Source) -> DataFrame:
    days = _mart(s, "active_users_7d").select("event_date")
    return sinks.replace_recent(days.withColumn("version", F.lit("old")),
                                days.withColumn("version", F.lit("new")),
                                "event_date", AS_OF.date(), days=10)


star("q1_q5_clip_limits", lambda s: publish.clip_limits(publish.without_nan(_odd_numbers(s))))
star("q6_dq_report", lambda s: publish.quality_report(_mart(s, "daily_business_summary")))
star("s8_publish", _read_back)
star("s9_replace_recent", _replaced)
star("s10_compact", _compacted)
star("s12_month_partitions", _months)



def _as_published(s: Source) -> DataFrame:
    """Columns of a mart under other types, and most columns missing."""
    return s.given("events").select(
        F.col("ts").alias("event_date"), F.col("event_id").cast("double").alias("total_orders"),
        F.col("value").alias("total_revenue"))


def _after_empty_load(s: Source) -> DataFrame:
    """Load a mart, then load an empty result over it."""
    base, mart = scratch_dir(s.spark, "marts"), "active_users_7d"
    days = _mart(s, mart)
    publish.load_mart(days, base, mart)
    publish.load_mart(days.where(F.col("event_date") < "1990-01-01"), base, mart)
    return sinks.read_mart(s.spark, base, mart).select(*schemas.MART[mart].names)


def _appended_twice(s: Source) -> DataFrame:
    """Append campaigns in two runs; the second adds only what is new."""
    path = f"{scratch_dir(s.spark, 'append')}/campaigns"
    some, all_ = s.campaigns().where("campaign_id < 'camp4'"), s.campaigns()
    sinks.append(some, path)
    sinks.append(append_ignore(some, all_, ["campaign_id"], "campaign_name"), path)
    return s.spark.read.schema(all_.schema).parquet(path)


def _run_report(s: Source) -> DataFrame:
    """The report of a run that loads rows beyond every limit, repeated and unwanted ones."""
    key, user, base = F.col("event_id"), F.col("user_id"), scratch_dir(s.spark, "report")
    odd = s.given("events").join(_odd_numbers(s), "event_id").withColumn(
        "event_date", F.when(key % 13 != 0, F.to_date("ts")))
    loads = {
        "daily_business_summary": odd.select(
            "event_date", "total_revenue", "conversion_rate", "total_orders",
            (F.col("value") * 150).alias("avg_order_value"), (key % 7 - 1).alias("total_sessions"),
            (key % 5 - 1).alias("successful_orders")),
        "product_performance": odd.select(
            key.alias("product_id"), "event_date", (key % 3 - 1).alias("total_quantity"),
            (key % 4 - 1).alias("orders_count")),
        "campaign_performance": odd.select(
            F.col("event_type").alias("campaign_id"), "roi",
            F.col("event_date").alias("start_date"), F.col("event_date").alias("end_date")),
        "session_analytics": odd.select(
            F.col("event_type").alias("session_id"), "user_id", F.date_trunc("day", "ts").alias("start_time"),
            F.lit(None).cast("timestamp_ntz").alias("end_time"),
            F.element_at(F.array(*map(F.lit, ["Rome", "Unknown", "Oslo"])), (user % 3 + 1).cast("int")).alias("city"),
            F.when(user % 4 != 1, F.when(user % 4 == 2, "Antarctica").otherwise("Italy")).alias("country")),
    }
    counts = []
    for mart, df in loads.items():
        observed = publish.Observed()
        publish.load_mart(df, base, mart, observed)
        counts += [(mart, rule, n) for rule, n in observed.rows()]
    publish.append_report(s.spark, base, AS_OF, counts)
    return publish.read_report(s.spark, base).drop("as_of")


def _star_report(r: Raw) -> DataFrame:
    """Rows per star table, as a run over all raw tables has counted them."""
    base = scratch_dir(r.spark, "star")
    frames = raw_tables(r.spark, r.sf_dir, spread=["events"])

    def read(table: str) -> DataFrame:
        """Tables that many jobs read are made once and read from files, as landed ones are."""
        rows = frames[table]()
        if table not in ("events", "campaign_events"):
            return rows
        rows.write.parquet(f"{base}/_raw/{table}")
        return r.spark.read.schema(rows.schema).parquet(f"{base}/_raw/{table}")

    raw_to_star(r.spark, read, base)
    report = publish.read_report(r.spark, base).where("rule = 'rows'")
    return report.select("table_name", "n_rows")


def _reloaded(s: Source) -> DataFrame:
    """A mart of many months, then its last 30 days replaced; rows of each age."""
    base, mart = scratch_dir(s.spark, "reload"), "active_users_7d"
    days = s.given("orders").groupBy(F.to_date("o_orderdate").alias("event_date")).agg(
        F.count(F.lit(1)).alias("active_users_count"))
    last = days.agg(F.max("event_date")).first()[0]
    publish.reload_mart(days, base, mart, last)
    publish.reload_mart(days.withColumn("new_users", F.lit(1).cast("bigint")), base, mart, last)
    return sinks.read_mart(s.spark, base, mart).select(*schemas.MART[mart].names)


star("q6_run_report", _run_report)
raw("d17_run_counts", _star_report)
star("s9_reload_months", _reloaded)
raw("q0_drop_duplicates", lambda r: r.events().drop("event_id").dropDuplicates())
star("q7_require_date", lambda s: publish.require_date(
    s.sessions().select("session_id", F.col("start_ts").alias("last_session_date")),
    "last_session_date"))
raw("q8_fill_strings", lambda r: publish.fill_strings(r.devices()))
star("q9_country_filter", lambda s: publish.drop_unwanted(s.user_locations(), "country"))
star("q10_city_filter", lambda s: publish.drop_unwanted(s.user_locations(), "city"))
star("q11_q14_conform", lambda s: publish.conform(_as_published(s), "daily_business_summary"))
star("q12_dates", lambda s: publish.conform(
    s.sessions().select("session_id", "user_id", F.col("start_ts").alias("start_time"),
                        F.col("end_ts").alias("end_time")), "session_analytics")
     .select("session_id", "user_id", "start_time", "end_time", "city"))
star("q13_empty_load", _after_empty_load)
star("s4_projected_scan", lambda s: read_table(s.spark, s.sf_dir, "events.parquet").select(
    "event_id", "user_id").where("event_type = 'purchase' AND value > 10"))
star("s7_append", _appended_twice)

# --- dashboards ---------------------------------------------------------------
_LAST_DAY = AS_OF.date()
star("b1_sales_by_category", lambda s: dashboards.sales_by_category(_mart(s, "category_performance")))
star("b2_daily_revenue", lambda s: dashboards.daily_revenue(_mart(s, "daily_business_summary")))
star("b3_active_users", lambda s: dashboards.active_users(_mart(s, "active_users_7d")))
star("b4_devices", lambda s: dashboards.devices(_mart(s, "device_analysis")))
star("b5_revenue_7_days", lambda s: dashboards.recent_revenue(
    _mart(s, "daily_business_summary"), _LAST_DAY))
star("b6_orders_7_days", lambda s: dashboards.recent_orders(
    _mart(s, "daily_business_summary"), _LAST_DAY))
star("b7_top_countries", lambda s: dashboards.top_countries(_mart(s, "geo_analysis"), _LAST_DAY, 3))
star("b8_revenue_dynamics", lambda s: dashboards.revenue_dynamics(_mart(s, "daily_business_summary")))
star("b9_revenue_by_period", lambda s: dashboards.revenue_by_period(
    _mart(s, "daily_business_summary")))
star("b9_top_product", lambda s: dashboards.most_profitable(
    _mart(s, "product_performance"), ["product_id"]))
star("b9_top_category", lambda s: dashboards.most_profitable(
    _mart(s, "category_performance"), ["category_name"]))
raw("b10_weather_influence", lambda r: dashboards.weather_influence(r.events()))
star("b11_low_conversion", lambda s: dashboards.places_needing_attention(_mart(s, "geo_analysis"), 0.5))
raw("b12_category_popularity", lambda r: dashboards.category_popularity(r.events()))


# --- enrichment ---------------------------------------------------------------
def _rates(s: Source) -> DataFrame:
    rate = F.when(F.col("currency") == "EUR", F.lit("0.92").cast("decimal(18,6)")).otherwise(
        (F.col("n") + 80).cast("decimal(18,6)"))
    return s.given("region").agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.explode(F.array(F.lit("EUR"), F.lit("RUB"))).alias("currency")).select(
        "currency", rate.alias("rate"))


def _daily_rates(s: Source) -> DataFrame:
    days = s.given("events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    eur = (F.lit(0.8) + (F.col("n") % 40).cast("double") / 100).cast("decimal(18,4)")
    rub = F.when(F.dayofweek("day").isin(2, 4), (F.col("n") % 30 + 80).cast("decimal(18,4)"))
    pair = F.array(F.struct(F.lit("EUR").alias("currency"), eur.alias("rate")),
                   F.struct(F.lit("RUB").alias("currency"), rub.alias("rate")))
    return days.where(F.dayofweek("day").between(2, 6)).select("day", F.inline(pair))


def _places(s: Source) -> DataFrame:
    key = F.col("n_nationkey")
    places = s.given("nation").join(s.given("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return places.select(
        F.when(F.col("r_name") == "ASIA", F.concat(F.lit("Sea of "), "n_name")).otherwise(F.col("n_name"))
        .alias("city"), F.col("r_name").alias("country"),
        (key.cast("double") * 7.01 - 84.77).alias("lat"),
        (key.cast("double") * 53.17 % 360 - 180).alias("lon"))


def _weather(s: Source) -> DataFrame:
    zone = (F.col("event_id") % 5).cast("double")
    return s.given("events").select(
        (zone * 30 - 80).alias("lat"), (zone * 30 - 170).alias("lon"),
        F.col("ts").alias("observed_at"), F.col("value").cast("decimal(18,2)").alias("temp"),
        F.col("event_type").alias("weather"))


_COSTS = ["event_id", "cost_eur", "cost_rub"]
raw("e1_currency", lambda r: convert_currency(r.events(), _rates(r)).select(*_COSTS))
raw("e1_currency_missing_rate", lambda r: convert_currency(
    r.events(), _rates(r).where("currency = 'EUR'")).select(*_COSTS))
raw("e1_currency_as_of", lambda r: convert_currency_as_of(
    r.events(), _daily_rates(r), "timestamp").select(*_COSTS))
raw("e2_geo", lambda r: geo_lookup(r.events(), _places(r), ["event_id"]).select(
    "event_id", "city", "country"))
raw("e3_weather", lambda r: weather_lookup(
    r.events(), _weather(r), "timestamp", ["event_id"], cell=30).select(
    "event_id", "weather_temp", "weather_desc"))


def _bare_events(r: Raw) -> DataFrame:
    """The raw events; every other one comes without place and weather."""
    told = F.col("event_id") % 2 == 1
    return r.events().withColumns({
        c: F.when(told, F.col(c)) for c in ("city", "country", "weather_temp", "weather_desc")})


def _dimensions(r: Raw) -> enrichment.DimensionStore:
    """Two versions of the dimensions; the second brings the weather of later hours."""
    store = enrichment.DimensionStore(r.spark, scratch_dir(r.spark, "dimensions"))
    early = F.col("observed_at") < "2024-01-11"
    store.publish(_daily_rates(r), _places(r), _weather(r).where(early))
    store.publish(more_weather=_weather(r).where(~early))
    return store


def _enriched(r: Raw) -> DataFrame:
    store = _dimensions(r)
    return enrichment.enrich_events(_bare_events(r), store.read(store.current()), cell=30)


def _stream_enriched(r: Raw) -> DataFrame:
    """The events as JSON lines through the stream, each batch enriched as it lands."""
    base = scratch_dir(r.spark, "enriched")
    lines = _bare_events(r).drop("event_id").withColumn("type", F.lit("event"))
    lines.select(F.to_json(F.struct("*"), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}).alias("value")).write.text(f"{base}/in")
    stage = enrichment.Enrichment(r.spark, f"{base}/raw", f"{base}/enriched", _dimensions(r), cell=30)
    stream = ingest.read_events_stream(r.spark, f"{base}/in", "text", batch_size=64)
    ingest.start_ingest(stream, f"{base}/raw", f"{base}/checkpoint", then=stage.run).awaitTermination()
    upto = incremental.committed_batch(r.spark, f"{base}/checkpoint")
    return stage.reader(upto)("events").drop("event_id")


raw("e4_enriched_events", _enriched)
raw("e4_stream_enriched", _stream_enriched)
raw("e4_weather_influence", lambda r: dashboards.weather_influence(_enriched(r)))


# --- routing ------------------------------------------------------------------
def routed(name: str, build: Callable[[DataFrame], DataFrame], only: str | None = None) -> None:
    """A query over all messages as parsed wide rows, or on the rows of one table alone."""
    QUERIES[name] = lambda spark, sf_dir: plain(build(
        router.parse_messages(messages(spark, sf_dir), only)))


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Run the ingest stream over all messages; returns the folder it wrote."""
    base = scratch_dir(spark, "landed")
    ingest.start_ingest(messages(spark, sf_dir, stream=True), f"{base}/raw",
                        f"{base}/checkpoint").awaitTermination()
    return f"{base}/raw"


def _stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = ingest.read_raw(spark, _landed(spark, sf_dir), "events")
    return plain(events.drop("event_id"))


for table in schemas.RAW:
    routed(f"t4_raw_{table}", lambda wide, table=table: router.table_of(wide, table), only=table)
routed("t1_route_counts", router.route_counts)
routed("t3_event_types", lambda wide: router.table_of(wide, "events").groupBy("event_type").agg(
    F.count(F.lit(1)).alias("n_rows")), only="events")
routed("t8_quarantine", lambda wide: router.table_of(wide, router.QUARANTINE).groupBy("reason").agg(
    F.count(F.lit(1)).alias("n_rows")), only=router.QUARANTINE)
QUERIES["t1_route_stream"] = lambda spark, sf_dir: router.route_counts(
    ingest.read_landed(spark, _landed(spark, sf_dir)))
QUERIES["t7_stream_events"] = _stream_events


def _live(spark: SparkSession, rows: Callable[[Callable[[str, DataFrame], DataFrame]], DataFrame]) -> DataFrame:
    """Drain a stream made of written tables; ``rows`` gets a function that writes a table and streams it."""
    base = scratch_dir(spark, "live")

    def streamed(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.readStream.schema(df.schema).parquet(f"{base}/{name}")

    live.start_append(rows(streamed), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out")


raw("live_v3_unique", lambda r: _live(r.spark, lambda streamed: live.unique_events(
    streamed("events", _valid_events(r)))).select(*live.EVENT_KEY))
star("live_m7_pairs", lambda s: _live(s.spark, lambda streamed: live.attributed_orders(
    streamed("touches", s.campaign_events()), streamed("orders", s.orders())))
     .select("campaign_event_id", "campaign_id", "order_id"))
raw("t9_append_ignore", lambda r: append_ignore(
    r.given("customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("user_id")),
    r.given("customer").select(F.col("c_custkey").cast("string").alias("user_id"), "c_custkey"),
    ["user_id"], "c_custkey").select("user_id"))

ORACLES.update({name: with_tables(sql, {**RAW_TABLES, **MART_TABLES})
                for name, sql in {**PUBLISHED, **DASHBOARDS, **QUALITY}.items()})
ORACLES.update({name: with_tables(sql, {**RAW_TABLES, **ENRICH_TABLES})
                for name, sql in ENRICHED.items()})
ORACLES.update({name: with_tables(sql, MESSAGE_TABLES) for name, sql in ROUTING.items()})
