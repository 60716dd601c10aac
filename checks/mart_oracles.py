"""The marts for DuckDB, each written from the meaning of its columns.

Facts are counted per row by subqueries, kept as sets per user and day, or unioned; how
often a definition repeats a fact is a weight.
"""

MARTS: dict[str, str] = {}

MARTS["m1_daily_business_summary"] = """
WITH facts AS (
    SELECT CAST(start_ts AS DATE) AS event_date, 1 AS visit, NULL AS buyer, false AS won, 0 AS paid, false AS newly
    FROM sessions
    UNION ALL
    SELECT CAST(order_ts AS DATE), 0, user_id, status = 'success', total_usd,
           CAST(order_ts AS DATE) = CAST(min(order_ts) FILTER (status = 'success') OVER (PARTITION BY user_id) AS DATE)
    FROM ord),
days AS (
    SELECT event_date, CAST(sum(visit) AS BIGINT) AS visits, count(*) FILTER (visit = 0) AS bought,
           count(*) FILTER (won) AS won, CAST(sum(paid) FILTER (won) AS DOUBLE) AS paid,
           len(list_distinct(list(buyer))) AS buyers, len(list_distinct(list(buyer) FILTER (newly))) AS newcomers
    FROM facts GROUP BY event_date HAVING sum(visit) > 0)
SELECT event_date, coalesce(paid, 0) AS total_revenue, bought AS total_orders, coalesce(buyers, 0) AS unique_customers,
       coalesce(paid / nullif(won, 0), 0) AS avg_order_value, CAST(won AS DOUBLE) / visits AS conversion_rate,
       coalesce(newcomers, 0) AS new_users, visits AS total_sessions, won AS successful_orders
FROM days
"""

MARTS["m2_product_performance"] = """
WITH baskets AS (
    SELECT product_id, event_date, order_id, user_id, sum(quantity) AS pieces, sum(price_usd * quantity) AS worth,
           sum(price_usd) AS prices, count(price_usd) AS priced
    FROM (SELECT *, (SELECT {'day': CAST(order_ts AS DATE), 'who': user_id} FROM ord
                     WHERE ord.order_id = items.order_id AND status = 'success') AS sale FROM items)
    CROSS JOIN LATERAL (SELECT sale.day AS event_date, sale.who AS user_id)
    WHERE sale IS NOT NULL GROUP BY ALL),
named AS (
    SELECT product_id, product_name,
           (SELECT category_name FROM categories WHERE categories.category_id = products.category_id) AS category_name
    FROM products WHERE category_id IS NOT NULL)
SELECT product_id, any_value(product_name) AS product_name, any_value(category_name) AS category_name,
       CAST(sum(pieces) AS BIGINT) AS total_quantity, CAST(sum(worth) AS DOUBLE) AS total_revenue,
       CAST(sum(prices) AS DOUBLE) / nullif(sum(priced), 0) AS avg_price, count(*) AS orders_count,
       len(list_distinct(list(user_id))) AS unique_customers, event_date
FROM baskets SEMI JOIN named USING (product_id) JOIN named USING (product_id)
GROUP BY product_id, event_date
"""

MARTS["m3_category_performance"] = """
WITH sold AS (
    SELECT (SELECT category_name FROM products NATURAL JOIN categories
            WHERE products.product_id = items.product_id) AS category_name,
           order_id, quantity, price_usd * quantity AS worth
    FROM items),
baskets AS (
    SELECT category_name, order_id, sum(quantity) AS pieces,
           coalesce(sum(worth) FILTER (worth <= 10000), 0) AS counted
    FROM sold GROUP BY ALL),
dated AS (
    SELECT baskets.*, user_id, CAST(order_ts AS DATE) AS event_date
    FROM ord NATURAL JOIN baskets WHERE status = 'success')
SELECT category_name, CAST(sum(pieces) AS BIGINT) AS total_quantity, CAST(sum(counted) AS DOUBLE) AS total_revenue,
       count(*) AS orders_count, len(list_distinct(list(user_id))) AS unique_customers,
       CAST(sum(counted) AS DOUBLE) / count(*) AS avg_order_value, event_date
FROM dated GROUP BY category_name, event_date
"""

MARTS["m4_user_engagement"] = """
WITH seen AS (
    SELECT user_id, start_ts, date_diff('microsecond', start_ts, end_ts) AS micros,
           (SELECT count(*) FROM ev WHERE ev.session_id = sessions.session_id) AS acts
    FROM sessions),
habits AS (
    SELECT user_id, count(*) AS visits, CAST(sum(acts) AS BIGINT) AS acts,
           sum(greatest(acts, 1)) AS weight, min(start_ts) AS first_start, max(start_ts) AS last_start,
           CAST(sum(micros * greatest(acts, 1)) AS DOUBLE) / sum(greatest(acts, 1)) FILTER (micros IS NOT NULL) AS mean_micros
    FROM seen GROUP BY user_id),
purse AS (
    SELECT user_id, count(*) AS bought, sum(total_usd) AS paid FROM ord WHERE status = 'success' GROUP BY user_id)
SELECT user_id, coalesce(visits, 0) AS sessions_count,
       coalesce(acts, 0) * coalesce(bought, 1) AS total_events,
       mean_micros / 1e6 AS avg_session_duration_seconds,
       coalesce(CAST(acts * coalesce(bought, 1) AS DOUBLE) / visits, 0) AS avg_pages_per_session,
       CAST(first_start AS DATE) AS first_session_date, CAST(last_start AS DATE) AS last_session_date,
       coalesce(bought, 0) AS total_orders,
       CAST(coalesce(paid * coalesce(CAST(weight AS BIGINT), 1), 0) AS DOUBLE) AS total_revenue,
       date_sub('day', last_start, TIMESTAMP '2024-01-31') AS days_since_last_activity
FROM users LEFT JOIN habits USING (user_id) LEFT JOIN purse USING (user_id)
"""

MARTS["m4_user_engagement_safe"] = """
WITH per_session AS (
    SELECT se.user_id, se.session_id, se.start_ts, se.end_ts, count(ev.event_id) AS n_events
    FROM sessions se LEFT JOIN ev ON ev.session_id = se.session_id GROUP BY ALL),
visits AS (
    SELECT user_id, count(*) AS n_sessions, CAST(sum(n_events) AS BIGINT) AS n_events,
           CAST(sum(date_diff('microsecond', start_ts, end_ts)) AS DOUBLE)
               / count(date_diff('microsecond', start_ts, end_ts)) / 1e6 AS mean_length,
           min(start_ts) AS first_start, max(start_ts) AS last_start
    FROM per_session GROUP BY user_id),
buys AS (
    SELECT user_id, count(*) AS n_orders, sum(total_usd) AS spent
    FROM ord WHERE status = 'success' GROUP BY user_id)
SELECT us.user_id, coalesce(n_sessions, 0) AS sessions_count,
       coalesce(n_events, 0) AS total_events,
       mean_length AS avg_session_duration_seconds,
       CASE WHEN n_sessions > 0 THEN CAST(n_events AS DOUBLE) / n_sessions ELSE 0 END
           AS avg_pages_per_session,
       CAST(first_start AS DATE) AS first_session_date,
       CAST(last_start AS DATE) AS last_session_date,
       coalesce(n_orders, 0) AS total_orders,
       CAST(coalesce(spent, 0) AS DOUBLE) AS total_revenue,
       date_sub('day', last_start, TIMESTAMP '2024-01-31') AS days_since_last_activity
FROM users us LEFT JOIN visits USING (user_id) LEFT JOIN buys USING (user_id)
"""

MARTS["m5_active_users_7d"] = """
WITH calendars AS (
    SELECT list_sort(list(DISTINCT CAST(start_ts AS DATE))) AS days
    FROM sessions WHERE start_ts IS NOT NULL GROUP BY user_id),
spread AS (
    SELECT days[i] AS event_date, CASE WHEN i > 1 THEN days[i - 1] END AS day_before
    FROM (SELECT days, unnest(range(1, len(days) + 1)) AS i FROM calendars))
SELECT event_date, count(*) AS active_users_count, count(day_before) AS returning_users,
       count(*) - count(day_before) AS new_users,
       count(*) FILTER (coalesce(event_date - day_before > 6, true)) AS reactivated_users
FROM spread GROUP BY event_date
"""

MARTS["m6_session_analytics"] = """
WITH kit AS (SELECT user_id, device_type, browser, os, count(*) AS copies FROM devices GROUP BY ALL),
spot AS (SELECT user_id, city, country, count(*) AS copies FROM locations GROUP BY ALL),
finished AS (
    SELECT *, coalesce(acts.views, 0) AS views, len(coalesce(acts.bought, [])) AS bought
    FROM (SELECT *, (SELECT {'views': count(*) FILTER (event_type = 'view_page'),
                             'bought': list(DISTINCT order_id) FILTER (event_type = 'purchase' AND order_id IS NOT NULL)}
                     FROM ev WHERE ev.session_id = sessions.session_id) AS acts
          FROM sessions WHERE start_ts + (end_ts - start_ts) IS NOT NULL))
SELECT session_id, user_id, start_ts AS start_time, end_ts AS end_time,
       greatest(CAST(round(date_diff('microsecond', start_ts, end_ts) / 1e6) AS INTEGER), 0) AS duration_seconds,
       event_count AS events_count,
       views * coalesce(kit.copies, 1) * coalesce(spot.copies, 1) AS page_views_count,
       bought AS orders_count, CAST(bought > 0 AS INTEGER) AS conversion_flag,
       ifnull(device_type, 'Unknown') AS device_type, ifnull(browser, 'Unknown') AS browser, ifnull(os, 'Unknown') AS os,
       ifnull(city, 'Unknown') AS city, ifnull(country, 'Unknown') AS country
FROM finished LEFT JOIN kit USING (user_id) LEFT JOIN spot USING (user_id)
"""

MARTS["m7_campaign_performance"] = """
WITH visits AS (
    SELECT user_id, CAST(start_ts AS DATE) AS day, list(session_id) AS ids FROM sessions GROUP BY ALL),
touch AS MATERIALIZED (SELECT row_number() OVER () AS number, * FROM camp_ev),
purchases AS (
    SELECT number, list(order_id) AS ids, sum(total_usd) AS paid
    FROM touch ce JOIN ord ON ord.user_id = ce.user_id AND status = 'success'
        AND order_ts - generated_at BETWEEN INTERVAL 0 DAY AND INTERVAL 14 DAY
    GROUP BY number),
touches AS (
    SELECT ce.*, coalesce(visits.ids, []) AS visit_ids, coalesce(purchases.ids, []) AS order_ids, paid
    FROM touch ce LEFT JOIN purchases USING (number)
    LEFT JOIN visits ON visits.user_id = ce.user_id AND visits.day = CAST(generated_at AS DATE)),
facts AS (
    SELECT campaign_id, CAST(min(generated_at) AS DATE) AS start_date, CAST(max(generated_at) AS DATE) AS end_date,
           len(list_distinct(flatten(list(visit_ids)))) AS total_sessions,
           len(list_distinct(flatten(list(order_ids)))) AS total_orders, len(list_distinct(list(user_id))) AS unique_users,
           coalesce(sum(paid * greatest(len(visit_ids), 1)), 0) AS earned,
           sum(cost * greatest(len(visit_ids), 1) * greatest(len(order_ids), 1)) AS spent
    FROM touches GROUP BY campaign_id)
SELECT campaign_id, campaign_name, start_date, end_date, total_sessions, total_orders,
       CAST(earned AS DOUBLE) AS total_revenue, unique_users,
       coalesce(CAST(total_orders AS DOUBLE) / nullif(total_sessions, 0), 0) AS conversion_rate,
       coalesce(CAST(earned AS DOUBLE) / nullif(total_orders, 0), 0) AS avg_order_value, CAST(spent AS DOUBLE) AS cost,
       coalesce(CAST(earned - spent AS DOUBLE) / CAST(nullif(spent, 0) AS DOUBLE), 0) AS roi
FROM facts JOIN campaigns USING (campaign_id)
"""

MARTS["m7_campaign_performance_safe"] = """
WITH cost AS (
    SELECT campaign_id, CAST(min(generated_at) AS DATE) AS start_date,
           CAST(max(generated_at) AS DATE) AS end_date,
           count(DISTINCT user_id) AS unique_users, sum(cost) AS spend
    FROM camp_ev GROUP BY campaign_id),
visits AS (
    SELECT ce.campaign_id, count(DISTINCT se.session_id) AS n_sessions
    FROM camp_ev ce JOIN sessions se ON se.user_id = ce.user_id
         AND CAST(se.start_ts AS DATE) = CAST(ce.generated_at AS DATE)
    GROUP BY ce.campaign_id),
bought AS (
    SELECT DISTINCT ce.campaign_id, od.order_id, od.total_usd
    FROM camp_ev ce JOIN ord od ON od.user_id = ce.user_id AND od.status = 'success'
         AND od.order_ts BETWEEN ce.generated_at AND ce.generated_at + INTERVAL 14 DAY),
buys AS (SELECT campaign_id, count(*) AS n_orders, sum(total_usd) AS amount
         FROM bought GROUP BY campaign_id),
totals AS (
    SELECT campaigns.campaign_id, campaign_name, start_date, end_date, unique_users, spend,
           coalesce(n_sessions, 0) AS total_sessions, coalesce(n_orders, 0) AS total_orders,
           coalesce(amount, 0) AS revenue
    FROM campaigns JOIN cost USING (campaign_id)
    LEFT JOIN visits USING (campaign_id) LEFT JOIN buys USING (campaign_id))
SELECT campaign_id, campaign_name, start_date, end_date, total_sessions, total_orders,
       CAST(revenue AS DOUBLE) AS total_revenue, unique_users,
       CASE WHEN total_sessions > 0 THEN CAST(total_orders AS DOUBLE) / total_sessions ELSE 0 END
           AS conversion_rate,
       CASE WHEN total_orders > 0 THEN CAST(revenue AS DOUBLE) / total_orders ELSE 0 END
           AS avg_order_value,
       CAST(spend AS DOUBLE) AS cost,
       CASE WHEN spend > 0 THEN CAST(revenue - spend AS DOUBLE) / CAST(spend AS DOUBLE) ELSE 0 END
           AS roi
FROM totals
"""

MARTS["m8_geo_analysis"] = """
WITH placed AS (
    SELECT coalesce(lo.city, 'Unknown') AS city, coalesce(lo.country, 'Unknown') AS country,
           CAST(se.start_ts AS DATE) AS event_date,
           se.user_id, se.session_id, od.order_id, od.total_usd
    FROM sessions se
    LEFT JOIN locations lo ON lo.user_id = se.user_id
    LEFT JOIN ord od ON od.user_id = se.user_id AND od.status = 'success'
         AND CAST(od.order_ts AS DATE) = CAST(se.start_ts AS DATE)
    WHERE se.start_ts IS NOT NULL),
totals AS (
    SELECT city, country, event_date, count(DISTINCT user_id) AS total_users,
           count(DISTINCT order_id) AS total_orders, count(DISTINCT session_id) AS n_sessions,
           CAST(coalesce(sum(total_usd), 0) AS DOUBLE) AS revenue
    FROM placed GROUP BY city, country, event_date)
SELECT city, country, total_users, total_orders, revenue AS total_revenue,
       CASE WHEN total_orders > 0 THEN revenue / total_orders ELSE 0 END AS avg_order_value,
       CASE WHEN n_sessions > 0 THEN CAST(total_orders AS DOUBLE) / n_sessions ELSE 0 END
           AS conversion_rate,
       event_date
FROM totals
"""

MARTS["m9_device_analysis"] = """
WITH kit AS (
    SELECT user_id, device_type, os, browser, count(*) AS copies
    FROM devices SEMI JOIN users USING (user_id) GROUP BY ALL),
calendar AS (SELECT user_id, CAST(start_ts AS DATE) AS event_date, count(*) AS visits FROM sessions GROUP BY ALL),
purse AS (
    SELECT user_id, count(*) AS bought, sum(worth) AS worth
    FROM (SELECT user_id, (SELECT sum(price_usd * quantity) FROM items WHERE items.order_id = ord.order_id) AS worth
          FROM ord)
    GROUP BY user_id)
SELECT device_type, os, browser, count(*) AS total_users, CAST(coalesce(sum(visits), 0) AS BIGINT) AS total_sessions,
       CAST(coalesce(sum(bought), 0) AS BIGINT) AS total_orders,
       CAST(coalesce(sum(worth * copies * coalesce(visits, 1)), 0) AS DOUBLE) AS total_revenue, event_date
FROM kit LEFT JOIN calendar USING (user_id) LEFT JOIN purse USING (user_id)
GROUP BY device_type, os, browser, event_date
"""

MARTS["m9_device_analysis_safe"] = """
WITH bought AS (
    SELECT od.user_id, count(DISTINCT od.order_id) AS n_orders,
           sum(it.price_usd * it.quantity) AS amount
    FROM ord od LEFT JOIN items it ON it.order_id = od.order_id GROUP BY od.user_id),
visits AS (
    SELECT user_id, CAST(start_ts AS DATE) AS event_date, count(*) AS n_sessions
    FROM sessions GROUP BY ALL)
SELECT device_type, os, browser, count(*) AS total_users,
       CAST(coalesce(sum(n_sessions), 0) AS BIGINT) AS total_sessions,
       CAST(coalesce(sum(n_orders), 0) AS BIGINT) AS total_orders,
       CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total_revenue, event_date
FROM (SELECT DISTINCT user_id, device_type, os, browser FROM devices)
JOIN users USING (user_id)
LEFT JOIN visits USING (user_id) LEFT JOIN bought USING (user_id)
GROUP BY ALL
"""
