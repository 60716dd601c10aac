"""Published marts, dashboards and sinks as SQL for DuckDB, built on the mart queries."""

from __future__ import annotations

from checks.mart_oracles import MARTS

# mart -> (key in MARTS, columns, date field)
_PUBLISHED = {
    "daily_business_summary": ("m1_daily_business_summary", "event_date"),
    "product_performance": ("m2_product_performance", "event_date"),
    "category_performance": ("m3_category_performance", "event_date"),
    "user_engagement": ("m4_user_engagement", "last_session_date"),
    "active_users_7d": ("m5_active_users_7d", "event_date"),
    "session_analytics": ("m6_session_analytics", "start_time"),
    "campaign_performance": ("m7_campaign_performance", None),
    "geo_analysis": ("m8_geo_analysis", "event_date"),
    "device_analysis": ("m9_device_analysis", "event_date"),
}
_REPLACED = {
    "daily_business_summary": {"total_revenue": "hi", "avg_order_value": "hi", "conversion_rate": "unit"},
    "product_performance": {"total_revenue": "hi"},
    "category_performance": {"total_revenue": "hi", "avg_order_value": "hi", "category_name": "text"},
    "user_engagement": {"total_revenue": "hi"},
    "active_users_7d": {},
    "session_analytics": {"start_time": "second", "end_time": "second"},
    "campaign_performance": {"total_revenue": "hi", "avg_order_value": "hi",
                             "conversion_rate": "unit", "roi": "roi"},
    "geo_analysis": {"total_revenue": "hi", "avg_order_value": "hi", "conversion_rate": "unit"},
    "device_analysis": {"total_revenue": "hi"},
}
_RULES = {
    "hi": "CASE WHEN {c} > 10000 THEN 10000 ELSE {c} END",
    "unit": "CASE WHEN {c} < 0 THEN 0 WHEN {c} > 1 THEN 1 ELSE {c} END",
    "roi": "CASE WHEN {c} > 100 THEN 100 WHEN {c} < -100 THEN -100 ELSE {c} END",
    "text": "coalesce({c}, '')",
    "second": "CAST(date_trunc('second', {c}) AS TIMESTAMP)",
}


def _published(mart: str) -> str:
    _, date_field = _PUBLISHED[mart]
    replaced = ", ".join(f"{_RULES[rule].format(c=c)} AS {c}" for c, rule in _REPLACED[mart].items())
    star = f"* REPLACE ({replaced})" if replaced else "*"
    extra = ", CAST(0 AS DOUBLE) AS avg_session_duration, CAST(0 AS DOUBLE) AS conversion_rate" \
        if mart == "device_analysis" else ""
    if mart == "active_users_7d":
        star = "* RENAME (reactivated_users AS churned_users)"
    where = [f"{date_field} IS NOT NULL"] if date_field else []
    if mart in ("session_analytics", "geo_analysis"):
        where += [f"{c} NOT IN ('Unknown', 'Antarctica', '')" for c in ("city", "country")]
    filters = f" WHERE {' AND '.join(where)}" if where else ""
    distinct = "DISTINCT " if mart == "session_analytics" else ""
    return f"SELECT {distinct}{star}{extra} FROM q_{mart}{filters}"


MART_TABLES = {f"q_{mart}": MARTS[key] for mart, (key, _) in _PUBLISHED.items()}
PUBLISHED = {f"pub_m{n}_{mart}": _published(mart) for n, mart in enumerate(_PUBLISHED, start=1)}

DASHBOARDS = {
    "b1_sales_by_category": """
        SELECT category_name,
               CAST(sum(CAST(total_revenue AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue,
               CAST(sum(total_quantity) AS BIGINT) AS total_quantity
        FROM q_category_performance GROUP BY category_name""",
    "b2_daily_revenue": "SELECT event_date, total_revenue FROM q_daily_business_summary",
    "b3_active_users": """
        SELECT event_date, active_users_count, new_users, returning_users FROM q_active_users_7d""",
    "b4_devices": """
        SELECT device_type, CAST(sum(total_sessions) AS BIGINT) AS total_sessions,
               CAST(sum(total_orders) AS BIGINT) AS total_orders,
               CAST(sum(CAST(total_revenue AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue
        FROM q_device_analysis GROUP BY device_type""",
    "b5_revenue_7_days": """
        SELECT CAST(sum(total_usd) AS DOUBLE) AS total_revenue FROM ord
        WHERE status = 'success' AND order_ts >= TIMESTAMP '2024-01-25'
          AND CAST(order_ts AS DATE) IN (SELECT CAST(start_ts AS DATE) FROM sessions)""",
    "b6_orders_7_days": """
        SELECT count(*) AS total_orders FROM ord
        WHERE order_ts >= TIMESTAMP '2024-01-25'
          AND CAST(order_ts AS DATE) IN (SELECT CAST(start_ts AS DATE) FROM sessions)""",
    "b7_top_countries": """
        SELECT country, CAST(sum(CAST(total_revenue AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue
        FROM q_geo_analysis WHERE event_date >= DATE '2024-01-25'
        GROUP BY country ORDER BY total_revenue DESC, country LIMIT 3""",
    "b8_revenue_dynamics": """
        SELECT event_date, total_revenue,
               CAST(money - lag(money) OVER (ORDER BY event_date) AS DOUBLE) AS change,
               CAST(sum(money) OVER (ORDER BY event_date ROWS 6 PRECEDING) AS DOUBLE) AS revenue_7_rows
        FROM (SELECT event_date, total_revenue, CAST(total_revenue AS DECIMAL(36,2)) AS money
              FROM q_daily_business_summary WHERE event_date IS NOT NULL)""",
    "b9_revenue_by_period": """
        SELECT CAST(date_trunc('week', event_date) AS DATE) AS period_start,
               CAST(sum(CAST(total_revenue AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue
        FROM q_daily_business_summary WHERE event_date IS NOT NULL GROUP BY 1""",
    "b9_top_product": """
        SELECT period_start, product_id, CAST(revenue AS DOUBLE) AS total_revenue
        FROM (SELECT CAST(date_trunc('week', event_date) AS DATE) AS period_start, product_id,
                     sum(CAST(total_revenue AS DECIMAL(38,2))) AS revenue
              FROM q_product_performance GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY period_start ORDER BY revenue DESC, product_id) = 1""",
    "b9_top_category": """
        SELECT period_start, category_name, CAST(revenue AS DOUBLE) AS total_revenue
        FROM (SELECT CAST(date_trunc('week', event_date) AS DATE) AS period_start, category_name,
                     sum(CAST(total_revenue AS DECIMAL(38,2))) AS revenue
              FROM q_category_performance GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY period_start
                                   ORDER BY revenue DESC, category_name NULLS FIRST) = 1""",
    "b10_weather_influence": """
        SELECT weather_desc, CAST(floor(CAST(weather_temp AS DOUBLE) / 10) * 10 AS INTEGER) AS temp_from,
               count(*) AS n_events, count(DISTINCT user_id) AS n_users,
               count(DISTINCT session_id) AS n_sessions
        FROM r_ev WHERE weather_desc IS NOT NULL GROUP BY 1, 2""",
    "b11_low_conversion": """
        SELECT country, city, event_date, total_users, total_orders, conversion_rate
        FROM q_geo_analysis WHERE conversion_rate < 0.5 AND total_users > 0
        ORDER BY total_users DESC, conversion_rate, country, city, event_date""",
    "b12_category_popularity": """
        SELECT product_category, count(*) AS n_events,
               count(*) FILTER (event_type = 'purchase') AS n_purchases
        FROM r_ev WHERE product_category IS NOT NULL GROUP BY product_category""",
}

QUALITY = {
    "q0_drop_duplicates": """
        SELECT DISTINCT * EXCLUDE (event_id, cost_usd, weather_temp),
               CAST(cost_usd AS DOUBLE) AS cost_usd, CAST(NULL AS DOUBLE) AS cost_eur,
               CAST(NULL AS DOUBLE) AS cost_rub, CAST(weather_temp AS DOUBLE) AS weather_temp
        FROM r_ev""",
    "q7_require_date": """
        SELECT session_id, CAST(start_ts AS DATE) AS last_session_date
        FROM sessions WHERE start_ts IS NOT NULL""",
    "q8_fill_strings": """
        SELECT user_device_id, coalesce(user_id, '') AS user_id,
               coalesce(device_type, '') AS device_type, os, browser FROM r_dev""",
    "q9_country_filter": "SELECT * FROM locations WHERE country <> 'Antarctica'",
    "q10_city_filter": "SELECT * FROM locations WHERE city <> 'Unknown'",
    "q11_q14_conform": """
        SELECT CAST(ts AS DATE) AS event_date, value AS total_revenue, event_id AS total_orders,
               0::BIGINT AS unique_customers, 0::DOUBLE AS avg_order_value,
               0::DOUBLE AS conversion_rate, 0::BIGINT AS new_users, 0::BIGINT AS total_sessions,
               0::BIGINT AS successful_orders
        FROM events""",
    "q12_dates": """
        SELECT session_id, user_id, CAST(date_trunc('second', start_ts) AS TIMESTAMP) AS start_time,
               CAST(date_trunc('second', end_ts) AS TIMESTAMP) AS end_time, '' AS city
        FROM sessions""",
    "q13_empty_load": PUBLISHED["pub_m5_active_users_7d"],
    "s4_projected_scan": """
        SELECT event_id, user_id FROM events WHERE event_type = 'purchase' AND value > 10""",
    "s7_append": "SELECT campaign_id, campaign_name FROM campaigns",
    "s8_publish": PUBLISHED["pub_m8_geo_analysis"],
    "s10_compact": PUBLISHED["pub_m8_geo_analysis"],
    "q6_dq_report": """
        SELECT 'total_revenue' AS rule, count(*) FILTER (total_revenue > 10000) AS n_rows
        FROM q_daily_business_summary
        UNION ALL SELECT 'conversion_rate', count(*) FILTER (conversion_rate > 1)
        FROM q_daily_business_summary
        UNION ALL SELECT 'avg_order_value', count(*) FILTER (avg_order_value > 10000)
        FROM q_daily_business_summary
        UNION ALL SELECT 'total_orders', 0 UNION ALL SELECT 'total_sessions', 0
        UNION ALL SELECT 'successful_orders', 0""",
    "q1_q5_clip_limits": """
        SELECT event_id,
               CASE WHEN event_id % 11 = 0 THEN NULL WHEN value * 100 > 10000 THEN 10000
                    ELSE value * 100 END AS total_revenue,
               CASE WHEN value - 10 < 0 THEN 0 WHEN value - 10 > 1 THEN 1
                    ELSE value - 10 END AS conversion_rate,
               CASE WHEN event_id - 500 > 100 THEN 100.0 WHEN event_id - 500 < -100 THEN -100.0
                    ELSE CAST(event_id - 500 AS DOUBLE) END AS roi,
               CASE WHEN user_id - 50 < 0 THEN 0 ELSE user_id - 50 END AS total_orders
        FROM events""",
    "s9_replace_recent": """
        SELECT event_date, 'old' AS version FROM q_active_users_7d WHERE event_date < DATE '2024-01-21'
        UNION ALL
        SELECT event_date, 'new' FROM q_active_users_7d WHERE event_date >= DATE '2024-01-21'""",
    "s12_month_partitions": """
        SELECT CAST(strftime(event_date, '%Y%m') AS INTEGER) AS yyyymm, count(*) AS n_rows,
               CAST(sum(total_orders) AS BIGINT) AS total_orders
        FROM q_geo_analysis
        WHERE city NOT IN ('Unknown', 'Antarctica', '') AND country NOT IN ('Unknown', 'Antarctica', '')
        GROUP BY 1""",
}

_ODD = """(SELECT *, CASE WHEN event_id % 11 <> 0 THEN value * 100 END AS revenue FROM events)"""
_VISITS = """(SELECT DISTINCT event_type, user_id, CAST(ts AS DATE) AS day, user_id % 3 = 1 AS nowhere,
                     user_id % 4 IN (1, 2) AS no_country FROM events)"""
_RUN = [
    (_ODD, "daily_business_summary", {
        "rows": "true", "duplicates": "false", "total_revenue": "revenue > 10000",
        "conversion_rate": "value < 10 OR value > 11", "avg_order_value": "value * 150 > 10000",
        "total_orders": "user_id < 50", "total_sessions": "event_id % 7 = 0",
        "successful_orders": "event_id % 5 = 0", "no date": "event_id % 13 = 0"}),
    (_ODD, "product_performance", {
        "rows": "true", "duplicates": "false", "total_quantity": "event_id % 3 = 0",
        "orders_count": "event_id % 4 = 0", "no date": "event_id % 13 = 0"}),
    (_ODD, "campaign_performance", {
        "rows": "true", "duplicates": "false", "roi": "event_id < 400 OR event_id > 600"}),
    (_VISITS, "session_analytics", {
        "no date": "false", "country unwanted": "no_country", "city unwanted": "nowhere AND NOT no_country"}),
    ("events", "session_analytics", {"rows": "true"}),
]
QUALITY["q6_run_report"] = " UNION ALL ".join([
    *[f"SELECT '{mart}' AS table_name, '{rule}' AS rule, count(*) FILTER ({test}) AS n_rows FROM {source}"
      for source, mart, rules in _RUN for rule, test in rules.items()],
    f"SELECT 'session_analytics', 'duplicates', (SELECT count(*) FROM events) - (SELECT count(*) FROM {_VISITS})"])
QUALITY["s9_reload_months"] = """
    SELECT CAST(o_orderdate AS DATE) AS event_date, count(*) AS active_users_count,
           CAST(0 AS BIGINT) AS returning_users, CAST(0 AS BIGINT) AS churned_users,
           CAST(CAST(o_orderdate AS DATE) >= (SELECT CAST(max(o_orderdate) AS DATE) - 30 FROM orders) AS BIGINT) AS new_users
    FROM orders GROUP BY CAST(o_orderdate AS DATE)"""

_PLACES = """
    SELECT n_name AS city, r_name AS country, CAST(n_nationkey AS DOUBLE) * 7.01 - 84.77 AS lat,
           CAST(n_nationkey AS DOUBLE) * 53.17 % 360 - 180 AS lon
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'"""
ENRICH_TABLES = {
    "places": _PLACES,
    "spots": "SELECT event_id, lat, lon FROM r_ev WHERE lat IS NOT NULL AND lon IS NOT NULL",
    "near": """
        SELECT event_id, city, country,
               row_number() OVER (PARTITION BY event_id ORDER BY
                   power(sin(radians(p.lat - s.lat) / 2), 2)
                   + cos(radians(s.lat)) * cos(radians(p.lat)) * power(sin(radians(p.lon - s.lon) / 2), 2)
               ) AS place
        FROM spots s CROSS JOIN places p""",
    "rate_days": """
        SELECT CAST(ts AS DATE) AS day,
               CAST(0.8 + count(*) % 40 / 100.0 AS DECIMAL(18,4)) AS eur,
               CASE WHEN dayofweek(CAST(ts AS DATE)) IN (1, 3)
                    THEN CAST(80 + count(*) % 30 AS DECIMAL(18,4)) END AS rub
        FROM events WHERE dayofweek(CAST(ts AS DATE)) BETWEEN 1 AND 5 GROUP BY CAST(ts AS DATE)""",
    "sky": """
        SELECT DISTINCT ON (date_trunc('hour', ts), event_id % 5) event_id % 5 AS zone,
               date_trunc('hour', ts) AS hour, CAST(value AS DECIMAL(18,2)) AS temp, event_type AS weather
        FROM events ORDER BY ts, CAST(value AS DECIMAL(18,2)), event_type""",
    "bare": """
        SELECT * REPLACE (CASE WHEN event_id % 2 = 1 THEN city END AS city,
                          CASE WHEN event_id % 2 = 1 THEN country END AS country,
                          CASE WHEN event_id % 2 = 1 THEN weather_temp END AS weather_temp,
                          CASE WHEN event_id % 2 = 1 THEN weather_desc END AS weather_desc)
        FROM r_ev""",
    "rated": """
        SELECT DISTINCT ON (d.day) d.day, e.eur,
               (SELECT arg_max(r.rub, r.day) FROM rate_days r WHERE r.rub IS NOT NULL AND r.day <= d.day) AS rub
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) d JOIN rate_days e ON e.day <= d.day
        ORDER BY d.day, e.day DESC""",
    "rich": """
        SELECT b.* REPLACE (
                   coalesce(b.city, n.city, 'Unknown') AS city,
                   CASE WHEN b.city IS NULL THEN n.country ELSE b.country END AS country,
                   CAST(b.cost_usd AS DOUBLE) AS cost_usd,
                   CAST(CASE WHEN b.weather_desc IS NULL THEN sky.temp ELSE b.weather_temp END AS DOUBLE)
                       AS weather_temp,
                   coalesce(b.weather_desc, sky.weather) AS weather_desc),
               CAST(round(b.cost_usd * rated.eur, 2) AS DOUBLE) AS cost_eur,
               CAST(round(b.cost_usd * rated.rub, 2) AS DOUBLE) AS cost_rub
        FROM bare b
        LEFT JOIN near n ON n.event_id = b.event_id AND n.place = 1
        LEFT JOIN rated ON rated.day = CAST(b."timestamp" AS DATE)
        LEFT JOIN sky ON sky.hour = date_trunc('hour', b."timestamp") AND b.lat IS NOT NULL
              AND floor((b.lat + 90) / 30) = sky.zone AND floor((b.lon + 180) / 30) = sky.zone""",
}
ENRICHED = {
    "e1_currency": """
        SELECT event_id,
               CAST(round(cost_usd * CAST(0.92 AS DECIMAL(18,6)), 2) AS DOUBLE) AS cost_eur,
               CAST(round(cost_usd * (SELECT CAST(80 + count(*) AS DECIMAL(18,6)) FROM region), 2)
                    AS DOUBLE) AS cost_rub
        FROM r_ev""",
    "e1_currency_missing_rate": """
        SELECT event_id,
               CAST(round(cost_usd * CAST(0.92 AS DECIMAL(18,6)), 2) AS DOUBLE) AS cost_eur,
               CAST(NULL AS DOUBLE) AS cost_rub
        FROM r_ev""",
    "e1_currency_as_of": """
        SELECT event_id,
               CAST(round(cost_usd * (SELECT eur FROM rate_days
                    WHERE rate_days.day <= CAST(r_ev."timestamp" AS DATE) ORDER BY rate_days.day DESC
                    LIMIT 1), 2) AS DOUBLE) AS cost_eur,
               CAST(round(cost_usd * (SELECT rub FROM rate_days
                    WHERE rate_days.day <= CAST(r_ev."timestamp" AS DATE) AND rub IS NOT NULL
                    ORDER BY rate_days.day DESC LIMIT 1), 2) AS DOUBLE) AS cost_rub
        FROM r_ev""",
    "e2_geo": """
        SELECT s.event_id, coalesce(n.city, 'Unknown') AS city, n.country
        FROM r_ev s LEFT JOIN near n ON n.event_id = s.event_id AND n.place = 1""",
    "e3_weather": """
        SELECT e.event_id, CAST(sky.temp AS DOUBLE) AS weather_temp, sky.weather AS weather_desc
        FROM r_ev e LEFT JOIN sky
          ON sky.hour = date_trunc('hour', e."timestamp")
         AND e.lat >= sky.zone * 30 - 90 AND e.lat < sky.zone * 30 - 60
         AND e.lon >= -180 AND e.lon < 180
         AND floor((e.lon + 180) / 30) = sky.zone""",
    "e4_enriched_events": "SELECT * FROM rich",
    "e4_stream_enriched": "SELECT * EXCLUDE (event_id) FROM rich",
    "e4_weather_influence": """
        SELECT weather_desc, CAST(floor(weather_temp / 10) * 10 AS INTEGER) AS temp_from,
               count(*) AS n_events, count(DISTINCT user_id) AS n_users, count(DISTINCT session_id) AS n_sessions
        FROM rich WHERE weather_desc IS NOT NULL GROUP BY 1, 2""",
}
