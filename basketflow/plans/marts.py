"""The nine marts: star tables in, one aggregate table out.

Several marts are defined by joins that repeat rows (every event of a user next to
every order of the user).  The results here equal those joins row for row, but each
child table is first reduced per key and the counts are multiplied afterwards, so
nothing is blown up and no key keeps more rows than it has days.  ``fanout_safe=True``
counts each child once instead.

Relied on: ``session_id`` and ``order_id`` are unique in their tables, and an order and
a session belong to one user.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.functions import day, flag, micros_between, round_to_int, safe_ratio
from basketflow.operators.skew import HOT_ROWS, MAX_HOT_KEYS, split_join
from basketflow.operators.timeline import neighbours, totals_in_span

# The attribution span, the largest line value that counts as revenue.
ATTRIBUTION = "interval 14 days"
LINE_VALUE_LIMIT = 10000


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def _one(c: str) -> Column:
    """Rows a left join contributes: the number of matches, or one unmatched row."""
    return F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(1))


def _as_double(c: str) -> Column:
    return F.col(c).cast("double")


def _cents(c: str) -> Column:
    """Money as whole cents: exact like the decimal, but sums stay plain longs."""
    return (F.col(c) * 100).cast("bigint")


def _money(cents: Column) -> Column:
    return cents.cast("double") / 100


def _successful_orders(orders: DataFrame) -> DataFrame:
    return orders.where("status = 'success'")


def session_days(sessions: DataFrame) -> DataFrame:
    """Sessions per user and day of their start, the grain five marts build on.

    A run of several marts writes this once and passes it to each of them.
    """
    return (sessions.groupBy("user_id", day("start_ts").alias("event_date"))
            .agg(F.count("session_id").alias("n_sessions")))


def daily_business_summary(sessions: DataFrame, orders: DataFrame,
                           user_days: DataFrame | None = None) -> DataFrame:
    """M1, per day of sessions (days with orders only do not appear)."""
    if user_days is None:
        by_day = (sessions.groupBy(day("start_ts").alias("event_date"))
                  .agg(F.count("session_id").alias("total_sessions")))
    else:
        by_day = user_days.groupBy("event_date").agg(F.sum("n_sessions").alias("total_sessions"))
    won = F.expr("status = 'success'")
    order_user_days = orders.groupBy("user_id", day("order_ts").alias("order_day")).agg(
        F.count("order_id").alias("n_orders"),
        F.count(F.when(won, F.col("order_id"))).alias("n_won"),
        F.sum(F.when(won, F.col("total_usd")).otherwise(0)).alias("revenue"),
        F.bool_or(won).alias("any_won"))
    first_won = F.min(F.when(F.col("any_won"), F.col("order_day"))).over(
        Window.partitionBy("user_id"))
    order_days = (
        order_user_days.withColumn("first_won", first_won).groupBy("order_day").agg(
            F.sum("revenue").alias("revenue"),
            F.sum("n_orders").alias("n_orders"),
            F.count("user_id").alias("n_users"),
            F.sum("n_won").alias("n_won"),
            F.count(F.when(F.col("order_day") == F.col("first_won"), F.col("user_id")))
            .alias("n_new")))
    return (
        by_day.join(order_days, by_day.event_date == order_days.order_day, "left")
        .select(
            "event_date",
            _zero("revenue").cast("double").alias("total_revenue"),
            _zero("n_orders").alias("total_orders"),
            _zero("n_users").alias("unique_customers"),
            safe_ratio(_zero("revenue"), _zero("n_won")).alias("avg_order_value"),
            safe_ratio(_zero("n_won"), F.col("total_sessions")).alias("conversion_rate"),
            _zero("n_new").alias("new_users"),
            "total_sessions",
            _zero("n_won").alias("successful_orders"))
        .orderBy("event_date"))


def order_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of successful orders, one row per (order, product).

    A run of several marts writes this once and passes it to each of them.
    """
    limit = LINE_VALUE_LIMIT * 100
    priced = items.select("order_id", "product_id", "quantity", _cents("price_usd").alias("price"))
    value = F.col("price") * F.col("quantity")
    lines = priced.groupBy("order_id", "product_id").agg(
        F.sum("quantity").alias("quantity"),
        F.sum(value).alias("value"),
        F.sum(F.when(value <= limit, value).otherwise(0)).alias("counted_value"),
        F.sum("price").alias("price_sum"),
        F.count("price").alias("price_count"))
    won = _successful_orders(orders).select(
        "order_id", "user_id", day("order_ts").alias("event_date"))
    return lines.join(won, "order_id")


def product_performance(items: DataFrame, orders: DataFrame, products: DataFrame,
                        categories: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """M2, per product and day; products without a category are left out.

    The names are joined after the aggregation, on rows already at product-day grain.
    """
    lines = order_lines(items, orders) if lines is None else lines
    per_user = lines.groupBy("product_id", "event_date", "user_id").agg(
        F.sum("quantity").alias("quantity"), F.sum("value").alias("value"),
        F.sum("price_sum").alias("price_sum"), F.sum("price_count").alias("price_count"),
        F.count("order_id").alias("n_orders"))
    facts = per_user.groupBy("product_id", "event_date").agg(
        F.sum("quantity").alias("total_quantity"), F.sum("value").alias("value"),
        F.sum("price_sum").alias("price_sum"), F.sum("price_count").alias("price_count"),
        F.sum("n_orders").alias("orders_count"), F.count("user_id").alias("unique_customers"))
    names = products.join(categories, "category_id")
    return facts.join(names, "product_id").select(
        "product_id", "product_name", "category_name", "total_quantity",
        _money(F.col("value")).alias("total_revenue"),
        F.try_divide(_money(F.col("price_sum")), F.col("price_count")).alias("avg_price"),
        "orders_count", "unique_customers", "event_date")


def category_performance(items: DataFrame, orders: DataFrame, products: DataFrame,
                         categories: DataFrame, lines: DataFrame | None = None,
                         hot_rows: int = HOT_ROWS) -> DataFrame:
    """M3, per category and day; lines worth more than the limit add no revenue."""
    names = products.join(categories, "category_id", "left").select("product_id", "category_name")
    counted = items if lines is None else lines
    lines = order_lines(items, orders) if lines is None else lines
    named = split_join(lines, names, "product_id", "left", spread_by=["order_id"],
                       hot_rows=hot_rows, counted=counted)
    per_order = named.groupBy("category_name", "event_date", "user_id", "order_id").agg(
        F.sum("quantity").alias("quantity"), F.sum("counted_value").alias("value"))
    per_user = per_order.groupBy("category_name", "event_date", "user_id").agg(
        F.sum("quantity").alias("quantity"), F.sum("value").alias("value"),
        F.count("order_id").alias("n_orders"))
    return per_user.groupBy("category_name", "event_date").agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum("value").alias("value"),
        F.sum("n_orders").alias("orders_count"),
        F.count("user_id").alias("unique_customers"),
    ).select(
        "category_name", "total_quantity", _money(F.col("value")).alias("total_revenue"),
        "orders_count", "unique_customers",
        safe_ratio(_money(F.col("value")), F.col("orders_count")).alias("avg_order_value"),
        "event_date")


def user_engagement(users: DataFrame, sessions: DataFrame, events: DataFrame, orders: DataFrame,
                    as_of: datetime, fanout_safe: bool = False) -> DataFrame:
    """M4, per user.

    As defined, every event row is repeated for each successful order of the user and
    every order for each session-event row; the mean duration is weighted by events.
    """
    # Wide integers: one user may hold a large share of all sessions.
    wide = "decimal(38,0)"
    events_per_session = (events.where(F.col("session_id").isNotNull())
                          .groupBy("session_id").agg(F.count("event_id").alias("n_events")))
    rows = F.lit(1) if fanout_safe else _one("n_events")
    length = micros_between("start_ts", "end_ts")
    per_user = (
        sessions.join(events_per_session, "session_id", "left").groupBy("user_id").agg(
            F.count("session_id").alias("n_sessions"),
            F.sum(_zero("n_events")).alias("n_events"),
            F.sum(rows).alias("n_rows"),
            F.sum(length.cast("decimal(20,0)") * rows.cast("decimal(18,0)")).alias("micros"),
            F.sum(F.when(length.isNotNull(), rows)).alias("timed_rows"),
            F.min(day("start_ts")).alias("first_session_date"),
            F.max("start_ts").alias("last_start")))
    bought = _successful_orders(orders).groupBy("user_id").agg(
        F.count("order_id").alias("n_orders"), F.sum("total_usd").alias("spent"))
    times_orders = F.lit(1) if fanout_safe else _one("n_orders")
    times_rows = F.lit(1) if fanout_safe else _one("n_rows")
    # a wide product: one that no long can hold is NULL, not the end of the mart
    n_events = _zero("n_events").cast("decimal(19,0)") * times_orders.cast("decimal(19,0)")
    return (
        users.where(F.col("user_id").isNotNull()).select("user_id")
        .join(per_user, "user_id", "left").join(bought, "user_id", "left")
        .select(
            "user_id",
            _zero("n_sessions").alias("sessions_count"),
            n_events.try_cast("bigint").alias("total_events"),
            (F.try_divide(_as_double("micros"), F.col("timed_rows")) / 1e6)
            .alias("avg_session_duration_seconds"),
            safe_ratio(n_events, _zero("n_sessions"))
            .alias("avg_pages_per_session"),
            "first_session_date",
            day("last_start").alias("last_session_date"),
            _zero("n_orders").alias("total_orders"),
            (_zero("spent") * times_rows.cast(wide)).cast("double").alias("total_revenue"),
            F.timestamp_diff("DAY", F.col("last_start"), F.lit(as_of.isoformat()).cast("timestamp_ntz"))
            .alias("days_since_last_activity")))


def active_users_7d(sessions: DataFrame, user_days: DataFrame | None = None) -> DataFrame:
    """M5, per day: active, returning, new, and users not seen in the six days before.

    A user's first day also counts as not seen before.
    """
    seen = session_days(sessions) if user_days is None else user_days
    seen = seen.where("event_date IS NOT NULL AND user_id IS NOT NULL").select("event_date", "user_id")
    before = F.lag("event_date").over(Window.partitionBy("user_id").orderBy("event_date"))
    return (
        seen.withColumn("before", before).groupBy("event_date").agg(
            F.count(F.lit(1)).alias("active_users_count"),
            F.count("before").alias("returning_users"),
            F.count_if(F.col("before").isNull()).alias("new_users"),
            F.count_if(F.col("before").isNull()
                       | (F.col("before") < F.date_sub("event_date", 6)))
            .alias("reactivated_users"))
        .orderBy("event_date"))


def _device_groups(devices: DataFrame) -> DataFrame:
    return (devices.groupBy("user_id", "device_type", "os", "browser")
            .agg(F.count(F.lit(1)).alias("n_devices")))


def session_analytics(sessions: DataFrame, events: DataFrame, devices: DataFrame,
                      locations: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """M6, per finished session and each device and place of its user."""
    activity = (
        events.where("session_id IS NOT NULL AND event_type IN ('view_page', 'purchase')")
        .groupBy("session_id").agg(
            F.count_if(F.col("event_type") == "view_page").alias("n_views"),
            F.count_distinct(F.when(F.col("event_type") == "purchase", F.col("order_id")))
            .alias("n_orders")))
    finished = sessions.where("start_ts IS NOT NULL AND end_ts IS NOT NULL")
    places = locations.groupBy("user_id", "city", "country").agg(
        F.count(F.lit(1)).alias("n_places"))
    rows = finished.join(activity, "session_id", "left")
    rows = split_join(rows, _device_groups(devices), "user_id", "left", ["session_id"], hot_rows,
                      counted=finished)
    rows = split_join(rows, places, "user_id", "left", ["session_id"], hot_rows,
                      counted=finished)
    seconds = round_to_int(micros_between("start_ts", "end_ts") / F.lit(1e6))

    def known(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("Unknown")).alias(c)

    return rows.select(
        "session_id", "user_id",
        F.col("start_ts").alias("start_time"), F.col("end_ts").alias("end_time"),
        F.greatest(seconds, F.lit(0)).alias("duration_seconds"),
        F.col("event_count").alias("events_count"),
        (_zero("n_views") * _one("n_devices") * _one("n_places")).alias("page_views_count"),
        _zero("n_orders").alias("orders_count"),
        flag(F.col("n_orders") > 0).alias("conversion_flag"),
        known("device_type"), known("browser"), known("os"), known("city"), known("country"))


def _touches_on_lines(campaign_events: DataFrame, won: DataFrame, visits: DataFrame) -> DataFrame:
    """Touches with the running totals of orders around them, their neighbours and same-day sessions.

    Touches, orders and session days of a user lie on one line, so all rows move once, by user; what
    follows are aggregations and windows inside the user.  ``visits`` may have a day several times.
    """
    rows = campaign_events.select(
        "user_id", "campaign_id", F.col("generated_at").alias("at"), F.lit(1).alias("n_touches"), "cost"
    ).unionByName(won.where("order_ts IS NOT NULL").select(
        "user_id", F.col("order_ts").alias("at"),
        F.when(F.col("order_id").isNotNull(), 1).otherwise(0).alias("n"), _cents("total_usd").alias("amount")),
        allowMissingColumns=True,
    ).unionByName(visits.where("event_date IS NOT NULL").select(
        "user_id", F.col("event_date").cast("timestamp_ntz").alias("at"), "n_sessions"), allowMissingColumns=True)
    sums = ["n_touches", "cost", "n", "amount", "n_sessions"]
    line = rows.where("user_id IS NOT NULL").repartition("user_id").groupBy("user_id", "campaign_id", "at").agg(
        *[F.sum(c).alias(c) for c in sums])

    def total(v: str, end: str) -> Column:
        frame = f"ORDER BY at RANGE BETWEEN UNBOUNDED PRECEDING AND {end}"
        return F.coalesce(F.expr(f"sum({v}) OVER (PARTITION BY user_id {frame})"), F.lit(0))

    touches = Window.partitionBy("user_id", "campaign_id").orderBy("at")
    span, before, after = F.expr(ATTRIBUTION), F.lag("at").over(touches), F.lead("at").over(touches)
    return line.withColumns({
        **{f"lo_{v}": total(v, "INTERVAL 1 MICROSECOND PRECEDING") for v in ("n", "amount")},
        **{f"hi_{v}": total(v, f"{ATTRIBUTION} FOLLOWING") for v in ("n", "amount")},
    }).withColumns({
        "starts": before.isNull() | (F.col("at") > before + span),
        "ends": after.isNull() | (after > F.col("at") + span),
        "touch_day": day("at"),
    }).withColumn("n_sessions", F.sum("n_sessions").over(Window.partitionBy("user_id", "touch_day"))).where(
        "campaign_id IS NOT NULL").drop("n", "amount").withColumnRenamed("at", "generated_at")


def _touches_in_hours(campaign_events: DataFrame, won: DataFrame, visits: DataFrame, hot_rows: int) -> DataFrame:
    """The same for users with very many rows: their lines are cut into hours."""
    who_when = ["campaign_id", "user_id", "generated_at"]
    touches = campaign_events.groupBy(*who_when).agg(
        F.count(F.lit(1)).alias("n_touches"), F.sum("cost").alias("cost"))
    sales = (won.where("order_ts IS NOT NULL AND user_id IS NOT NULL")
             .groupBy("user_id", F.col("order_ts").alias("generated_at"))
             .agg(F.count("order_id").alias("n"),
                  F.sum(_cents("total_usd")).alias("amount")))
    span = F.expr(ATTRIBUTION)
    has_place = "user_id IS NOT NULL AND generated_at IS NOT NULL"
    times = campaign_events.where(has_place)
    placed = neighbours(touches.where(has_place), ["campaign_id", "user_id"], "generated_at", times)
    placed = placed.withColumns({
        "starts": F.col("prev_ts").isNull() | (F.col("generated_at") > F.col("prev_ts") + span),
        "ends": F.col("next_ts").isNull() | (F.col("next_ts") > F.col("generated_at") + span),
    }).drop("prev_ts", "next_ts")
    measured = totals_in_span(
        placed, sales, "user_id", "generated_at", who_when, span, ["n", "amount"], times
    ).unionByName(touches.where("user_id IS NULL OR generated_at IS NULL"),
                  allowMissingColumns=True)
    visits = (visits.where("event_date IS NOT NULL AND user_id IS NOT NULL")
              .groupBy("user_id", F.col("event_date").alias("touch_day")).agg(F.sum("n_sessions").alias("n_sessions")))
    touch_day = day("generated_at").alias("touch_day")
    return split_join(
        measured.withColumn("touch_day", touch_day), visits, ["user_id", "touch_day"], "left",
        ["campaign_id", "generated_at"], hot_rows, counted=campaign_events.select("user_id", touch_day))


def campaign_performance(campaigns: DataFrame, campaign_events: DataFrame, sessions: DataFrame,
                         orders: DataFrame, fanout_safe: bool = False,
                         user_days: DataFrame | None = None,
                         hot_rows: int = HOT_ROWS) -> DataFrame:
    """M7, per campaign: same-day sessions and orders within 14 days of a touch.

    As defined, revenue and cost of a touch are repeated for its same-day sessions and,
    for cost, for its orders.  Orders are counted once per campaign: touches whose 14-day
    spans overlap form a chain, and the orders of a chain are the running total at its
    end less the one before its start.
    """
    campaign_events = campaign_events.where(F.col("campaign_id").isNotNull())
    nobody = campaign_events.where("user_id IS NULL")
    facts = (campaign_events.where("user_id IS NOT NULL"), _successful_orders(orders), user_days if user_days is not None
             else sessions.select("user_id", day("start_ts").alias("event_date"),
                                  F.col("session_id").isNotNull().cast("bigint").alias("n_sessions")))
    # Users with so many rows that one task should not sort them; at most MAX_HOT_KEYS.
    rows = reduce(DataFrame.unionByName, [f.select("user_id") for f in facts[:2]])
    busy = (rows.where("user_id IS NOT NULL").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > hot_rows).orderBy(F.col("n").desc(), "user_id").limit(MAX_HOT_KEYS).select("user_id"))
    found = busy.collect()
    if found:
        hot = F.broadcast(campaigns.sparkSession.createDataFrame(found, busy.schema))
        others, theirs = ([f.join(hot, "user_id", how) for f in facts] for how in ("left_anti", "left_semi"))
        measured = _touches_on_lines(*others).unionByName(_touches_in_hours(*theirs, hot_rows))
    else:
        measured = _touches_on_lines(*facts)

    def per_chain(v: str) -> Column:
        return (F.when(F.col("ends"), F.col(f"hi_{v}")).otherwise(0)
                - F.when(F.col("starts"), F.col(f"lo_{v}")).otherwise(0))

    # One row per campaign, user and day: sessions of a day count once per campaign.
    in_span = F.col("hi_n") - F.col("lo_n")
    repeated = _one("n_sessions").cast("decimal(18,0)")
    if fanout_safe:
        cents, cost = per_chain("amount").cast("decimal(20,0)"), F.col("cost")
    else:
        cents = ((F.col("hi_amount") - F.col("lo_amount")).cast("decimal(20,0)")
                 * (F.col("n_touches") * _one("n_sessions")).cast("decimal(18,0)"))
        cost = (F.col("cost") * repeated
                * F.greatest(F.coalesce(in_span, F.lit(0)), F.lit(1)).cast("decimal(18,0)"))
    per_day = measured.groupBy("campaign_id", "user_id", "touch_day").agg(
        F.max(_zero("n_sessions")).alias("n_sessions"),
        F.sum(per_chain("n")).alias("n_orders"),
        F.sum(cents).alias("revenue"),
        F.sum(cost).alias("cost"))
    per_user = per_day.groupBy("campaign_id", "user_id").agg(
        F.min("touch_day").alias("start_date"), F.max("touch_day").alias("end_date"),
        F.sum("n_sessions").alias("n_sessions"), F.sum("n_orders").alias("n_orders"),
        F.sum("revenue").alias("revenue"), F.sum("cost").alias("cost"))
    touch_day = day("generated_at")
    per_user = per_user.unionByName(nobody.select(
        "campaign_id", "user_id", touch_day.alias("start_date"), touch_day.alias("end_date"),
        F.lit(0).alias("n_sessions"), F.lit(0).alias("n_orders"), "cost"), allowMissingColumns=True)
    facts = per_user.groupBy("campaign_id").agg(
        F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
        F.sum("n_sessions").alias("total_sessions"),
        F.coalesce(F.sum("n_orders"), F.lit(0)).alias("total_orders"),
        (F.coalesce(F.sum("revenue"), F.lit(0)) * F.lit(Decimal("0.01"))).alias("revenue"),
        F.count("user_id").alias("unique_users"), F.sum("cost").alias("cost"))
    profit = F.col("revenue") - F.col("cost")
    return facts.join(campaigns.select("campaign_id", "campaign_name"), "campaign_id").select(
        "campaign_id", "campaign_name", "start_date", "end_date", "total_sessions", "total_orders",
        _as_double("revenue").alias("total_revenue"), "unique_users",
        safe_ratio(F.col("total_orders"), F.col("total_sessions")).alias("conversion_rate"),
        safe_ratio(F.col("revenue"), F.col("total_orders")).alias("avg_order_value"),
        _as_double("cost").alias("cost"),
        safe_ratio(profit, F.col("cost")).alias("roi"))


def geo_analysis(sessions: DataFrame, locations: DataFrame, orders: DataFrame,
                 user_days: DataFrame | None = None) -> DataFrame:
    """M8, per city, country and day; revenue repeats per session and place of the user."""
    visits = session_days(sessions) if user_days is None else user_days
    sales = (_successful_orders(orders)
             .groupBy("user_id", day("order_ts").alias("event_date"))
             .agg(F.count("order_id").alias("n_orders"), F.sum("total_usd").alias("amount")))
    unknown = F.lit("Unknown")
    places = locations.groupBy(
        "user_id", F.coalesce("city", unknown).alias("city"),
        F.coalesce("country", unknown).alias("country")).agg(F.count(F.lit(1)).alias("n_places"))
    repeats = (F.col("n_sessions") * _one("n_places")).cast("decimal(18,0)")
    facts = (
        visits.where(F.col("event_date").isNotNull())
        .join(sales, ["user_id", "event_date"], "left")
        .join(places, "user_id", "left")
        .groupBy(F.coalesce("city", unknown).alias("city"),
                 F.coalesce("country", unknown).alias("country"), "event_date")
        .agg(F.count("user_id").alias("total_users"),
             F.sum(_zero("n_orders")).alias("total_orders"),
             F.sum(F.col("amount") * repeats).alias("revenue"),
             F.sum("n_sessions").alias("n_sessions")))
    return facts.select(
        "city", "country", "total_users", "total_orders",
        _zero("revenue").cast("double").alias("total_revenue"),
        safe_ratio(_zero("revenue"), F.col("total_orders")).alias("avg_order_value"),
        safe_ratio(F.col("total_orders"), F.col("n_sessions")).alias("conversion_rate"),
        "event_date")


def device_analysis(devices: DataFrame, users: DataFrame, sessions: DataFrame, orders: DataFrame,
                    items: DataFrame, fanout_safe: bool = False,
                    user_days: DataFrame | None = None) -> DataFrame:
    """M9, per device, os, browser and day of sessions; orders are not tied to the day.

    As defined, a user's revenue repeats for each session of the day and device row.
    """
    order_value = items.select("order_id", (_cents("price_usd") * F.col("quantity")).alias("value"))
    order_value = order_value.groupBy("order_id").agg(F.sum("value").alias("value"))
    bought = (orders.select("order_id", "user_id").join(order_value, "order_id", "left")
              .groupBy("user_id").agg(F.count("order_id").alias("n_orders"),
                                      F.sum("value").alias("value")))
    visits = session_days(sessions) if user_days is None else user_days
    repeats = F.lit(1) if fanout_safe else F.col("n_devices") * _one("n_sessions")
    return (
        _device_groups(devices).join(users.select("user_id"), "user_id", "left_semi")
        .join(bought, "user_id", "left").join(visits, "user_id", "left")
        .groupBy("device_type", "os", "browser", "event_date").agg(
            F.count("user_id").alias("total_users"),
            F.sum(_zero("n_sessions")).alias("total_sessions"),
            F.sum(_zero("n_orders")).alias("total_orders"),
            _money(F.coalesce(F.sum(F.col("value").cast("decimal(20,0)")
                                    * repeats.cast("decimal(18,0)")), F.lit(0)))
            .alias("total_revenue"))
        .select("device_type", "os", "browser", "total_users", "total_sessions", "total_orders",
                "total_revenue", "event_date"))
