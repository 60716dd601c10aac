"""Raw tables and star jobs as SQL for DuckDB."""

from __future__ import annotations

from checks.prelude import moved


def _dirty(key: str, user: str) -> str:
    return (f"CASE WHEN {key} % 101 = 0 THEN NULL WHEN {key} % 13 = 0 THEN 'x' || ({user}) "
            f"WHEN {key} % 17 = 0 THEN ({user}) || '.0' ELSE CAST({user} AS VARCHAR) END")


def _uuid(text: str) -> str:
    return f"CAST(CAST(md5({text}) AS UUID) AS VARCHAR)"


def _id(column: str) -> str:
    """A text id as a number, NULL where it is not a whole number."""
    number = f"TRY_CAST({column} AS DOUBLE)"
    return f"CASE WHEN {number} = floor({number}) THEN TRY_CAST({number} AS BIGINT) END"


_LINE_ID = ("CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_partkey, l_linenumber, l_suppkey, "
            "CAST(l_shipdate AS DATE))), 1, 15) AS BIGINT)")


def _twice(base: str, serial: str, changes: str = "") -> str:
    replaced = f"{serial} + 10000000000 AS {serial}{', ' + changes if changes else ''}"
    return (f"WITH base AS ({base}) SELECT * EXCLUDE (again) FROM base UNION ALL "
            f"SELECT * EXCLUDE (again) REPLACE ({replaced}) FROM base WHERE again")


RAW_TABLES = {
    "r_ev": _twice(f"""
        SELECT event_id, {_dirty('event_id', 'user_id')} AS user_id,
               CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 37 = 0 THEN 'bad-' || user_id
                    ELSE {_uuid("(user_id + 2 * CAST(event_id % 29 = 0 AS BIGINT)) || '-' || CAST(ts AS DATE)")}
               END AS session_id,
               CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'search'
                    WHEN event_type = 'click' THEN 'session_start'
                    WHEN event_type = 'error' THEN 'session_end'
                    WHEN event_type = 'view' AND event_id % 3 = 0 THEN 'view_page'
                    WHEN event_type = 'view' THEN 'view_product' ELSE event_type END AS event_type,
               CASE WHEN shopping THEN CAST(event_id % 200 + 1 AS INTEGER) END AS product_id,
               CASE WHEN shopping AND event_id % 4 <> 0 THEN 'Item ' || (event_id % 200 + 1)
                    || CASE WHEN event_id % 8 = 1 THEN ' new' ELSE '' END END AS product_name,
               CASE WHEN shopping AND (event_id % 200 + 1) % 10 <> 7
                    THEN 'cat' || ((event_id % 200 + 1) % 10) END AS product_category,
               CASE WHEN event_type = 'purchase' THEN {_uuid("'o' || (event_id % 500)")} END AS order_id,
               CASE WHEN event_type = 'purchase' THEN CAST(event_id % 5 AS INTEGER) END AS quantity,
               CASE WHEN event_id % 19 <> 0 THEN 'City ' || (user_id % 25) END AS city,
               CASE WHEN event_id % 19 <> 0 THEN 'Country ' || (user_id % 5) END AS country,
               CASE WHEN event_id % 19 <> 0
                    THEN CAST(event_id * 37 % 18000 AS DOUBLE) / 100 - 90 END AS lat,
               CASE WHEN event_id % 19 <> 0
                    THEN CAST(event_id * 61 % 36000 AS DOUBLE) / 100 - 180 END AS lon,
               CAST(value AS DECIMAL(18,2)) AS cost_usd,
               CASE WHEN event_id % 19 <> 0
                    THEN CAST(CAST(event_id % 400 AS DOUBLE) / 10 - 10 AS DECIMAL(5,2)) END AS weather_temp,
               CASE WHEN event_id % 19 <> 0
                    THEN ['clear sky', 'light rain', 'snow', 'mist'][event_id % 4 + 1] END AS weather_desc,
               ts AS "timestamp", value > 20 AS again
        FROM (SELECT *, event_type IN ('view', 'purchase') AND event_id % 5 <> 0 AS shopping
              FROM events)""", "event_id"),
    "r_prof": _twice(f"""
        SELECT c_custkey * 2 AS user_profile_id, {_dirty('c_custkey', moved('c_custkey', "c_mktsegment <> 'BUILDING'"))} AS user_id,
               c_name AS name,
               CASE WHEN c_custkey % 5 <> 1 THEN 'c' || c_custkey || '@shop.example' END AS email,
               CAST(DATE '1970-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS DATE) AS birth_date,
               [' Male ', 'female', 'other', NULL, 'FEMALE'][c_custkey % 5 + 1] AS gender,
               c_acctbal > 5000 AS again
        FROM customer""", "user_profile_id",
        "CAST(NULL AS VARCHAR) AS name, 'new.' || email AS email, CAST(NULL AS VARCHAR) AS gender"),
    "r_dev": _twice(f"""
        SELECT c_custkey AS user_device_id, {_dirty('c_custkey', 'c_custkey % 700')} AS user_id,
               ['mobile', 'desktop', NULL][c_custkey % 3 + 1] AS device_type,
               ['iOS', 'Android', 'Windows', 'Linux', 'MacOS'][c_custkey % 5 + 1] AS os,
               ['Chrome', 'Firefox', 'Safari', 'Edge'][c_custkey % 4 + 1] AS browser,
               c_mktsegment = 'BUILDING' AS again
        FROM customer""", "user_device_id"),
    "r_loc": _twice(f"""
        SELECT c_custkey AS user_location_id, {_dirty('c_custkey', 'c_custkey % 900')} AS user_id,
               n_name AS city, r_name AS country,
               CASE WHEN c_custkey % 12 <> 0
                    THEN CAST(c_custkey * 37 % 18000 AS DOUBLE) / 100 - 90 END AS lat,
               CASE WHEN c_custkey % 12 <> 0
                    THEN CAST(c_custkey * 61 % 36000 AS DOUBLE) / 100 - 180 END AS lon,
               c_mktsegment = 'MACHINERY' AS again
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""", "user_location_id"),
    "r_ord": _twice(f"""
        SELECT o_orderkey AS raw_order_id,
               CASE WHEN o_orderkey % 103 <> 0 THEN {_uuid("'o' || o_orderkey")} END AS order_id,
               {_dirty('o_orderkey', 'o_custkey % (SELECT n FROM nu)')} AS user_id,
               CASE WHEN o_orderkey % 107 <> 0 THEN
                    TIMESTAMP '2024-01-01' + to_seconds(o_orderkey * 7919 % 2592000) END AS order_ts,
               CASE WHEN o_orderkey % 21 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS total_usd,
               o_orderpriority = '1-URGENT' AS again
        FROM orders""", "raw_order_id", "CAST(total_usd + 1 AS DECIMAL(18,2)) AS total_usd"),
    "r_it": f"""
        SELECT {_LINE_ID} AS raw_order_item_id,
               CASE WHEN l_orderkey % 103 <> 0 THEN {_uuid("'o' || l_orderkey")} END AS order_id,
               CASE WHEN l_partkey % 41 <> 0 THEN CAST(l_partkey AS INTEGER) END AS product_id,
               CASE WHEN l_linenumber <> 5 THEN CAST(l_quantity AS INTEGER) - 1 END AS quantity,
               CASE WHEN l_partkey % 43 <> 0 THEN CAST(p_retailprice AS DECIMAL(18,2)) END AS price_usd
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "r_st": f"""
        SELECT {_LINE_ID} AS event_id, {_uuid("'o' || l_orderkey")} AS order_id,
               CASE l_returnflag WHEN 'A' THEN 'success' WHEN 'N' THEN 'pending'
                                 ELSE 'cancelled' END AS status,
               CASE WHEN l_linenumber <> 4 THEN l_shipdate END AS generated_at
        FROM lineitem""",
    "r_camp": f"""
        SELECT event_id AS campaign_event_id, {_dirty('event_id', 'user_id')} AS user_id,
               CASE WHEN event_id % 33 <> 0 THEN 'camp' || (event_id % 5 + 1) END AS campaign_id,
               r_name || CASE WHEN event_id % 2 = 0 THEN ' sale' ELSE '' END AS campaign_name,
               ['email', 'social', 'search'][event_id % 3 + 1] AS channel, event_type AS action,
               CASE WHEN event_id % 7 <> 0 THEN CAST(value AS DECIMAL(18,2)) END AS cost,
               CASE WHEN event_id % 9 <> 0 THEN ts END AS generated_at
        FROM events JOIN region ON event_id % 5 = r_regionkey""",
    "old_users": f"""
        SELECT {moved('c_custkey', 'c_acctbal < 6000')} AS user_id, 'old ' || c_name AS name, 'old@shop.example' AS email,
               CAST(NULL AS DATE) AS birth_date, CASE WHEN c_custkey % 4 = 0 THEN 'male' END AS gender,
               CASE WHEN c_custkey % 6 = 0 THEN 'Oldtown' END AS city, CAST(NULL AS VARCHAR) AS country
        FROM customer""",
    "old_orders": f"""
        SELECT {_uuid("CASE WHEN o_orderpriority = '2-HIGH' OR o_orderdate >= DATE '1999-01-01' THEN 'gone' ELSE 'o' END || o_orderkey")} AS order_id,
               o_custkey AS user_id, o_orderdate AS order_ts,
               CAST(1 AS DECIMAL(18,2)) AS total_usd,
               CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'pending' END AS status
        FROM orders""",
    "old_items": f"""
        SELECT min(raw_order_item_id) AS order_item_id, order_id,
               {moved('product_id', 'price_usd < 1000')} AS product_id, 9 AS quantity,
               CAST(0.99 AS DECIMAL(18,2)) AS price_usd
        FROM r_it WHERE order_id IS NOT NULL AND product_id IS NOT NULL GROUP BY ALL""",
    "old_categories": """
        SELECT CAST(r_regionkey + 5 AS BIGINT) AS category_id, 'cat' || (r_regionkey + 3) AS category_name
        FROM region WHERE r_regionkey < 2""",
    # numeric ids
    "prof_ids": f"SELECT DISTINCT {_id('user_id')} AS user_id FROM r_prof",
    "active_ids": f"""
        SELECT DISTINCT {_id('user_id')} AS user_id FROM r_ev
        WHERE event_type NOT IN ('session_start', 'session_end', 'signup')""",
    "event_ids": f"SELECT DISTINCT {_id('user_id')} AS user_id FROM r_ev",
    "built_users": f"""
        SELECT user_profile_id, {_id('user_id')} AS user_id, name, email, birth_date,
               CASE WHEN lower(trim(gender)) IN ('male', 'female') THEN lower(trim(gender)) END AS gender,
               CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS country
        FROM r_prof WHERE {_id('user_id')} IS NOT NULL
        UNION ALL
        SELECT NULL, user_id, NULL, NULL, NULL, NULL, NULL, NULL FROM active_ids
        WHERE user_id IS NOT NULL
          AND user_id NOT IN (SELECT user_id FROM prof_ids WHERE user_id IS NOT NULL)""",
    "new_status": """
        SELECT order_id, max({'untimed': generated_at IS NULL, 'at': generated_at, 'id': event_id, 'status': status}).status AS status
        FROM r_st GROUP BY order_id""",
    "allowed_ev": """
        SELECT * FROM r_ev WHERE event_type IN (
            'session_start', 'session_end', 'purchase', 'payment_success', 'payment_failed',
            'signup', 'churn', 'view_product', 'add_to_cart', 'view_page')""",
    "valid_ev": f"""
        SELECT event_id, {_id('user_id')} AS user_id, event_type, "timestamp", session_id,
               CAST(coalesce(product_id, 0) AS BIGINT) AS product_id, order_id,
               coalesce(quantity, 0) AS quantity, CAST(coalesce(cost_usd, 0) AS DOUBLE) AS cost_usd,
               0.0::DOUBLE AS cost_eur, 0.0::DOUBLE AS cost_rub,
               CAST(coalesce(weather_temp, 0) AS DOUBLE) AS weather_temp, weather_desc, city, country,
               coalesce(lat, 0) AS lat, coalesce(lon, 0) AS lon
        FROM allowed_ev WHERE {_id('user_id')} IS NOT NULL""",
    "unique_ev": """
        SELECT * FROM valid_ev
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type, "timestamp" ORDER BY event_id) = 1""",
    "grouped_sessions": f"""
        SELECT session_id, {_id('user_id')} AS user_id,
               min("timestamp") FILTER (event_type = 'session_start') AS start_ts,
               max("timestamp") FILTER (event_type = 'session_end') AS end_ts,
               CAST(count(*) AS INTEGER) AS event_count, min("timestamp") AS first_ts
        FROM r_ev
        WHERE {_id('user_id')} IS NOT NULL
          AND regexp_full_match(session_id, '[0-9a-f]{{8}}-([0-9a-f]{{4}}-){{3}}[0-9a-f]{{12}}')
          AND {_id('user_id')} IN (SELECT user_id FROM old_users)
        GROUP BY 1, 2""",
    "owned_sessions": """
        SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY first_ts, user_id) AS place
        FROM grouped_sessions""",
    "all_categories": """
        SELECT category_id, category_name FROM old_categories
        UNION ALL
        SELECT (SELECT max(category_id) FROM old_categories)
                   + row_number() OVER (ORDER BY substr(md5(name), 1, 3), name), name
        FROM (SELECT DISTINCT product_category AS name FROM r_ev)
        WHERE name IS NOT NULL AND name NOT IN (SELECT category_name FROM old_categories)""",
    "new_orders": f"""
        SELECT od.order_id, {_id('od.user_id')} AS user_id, od.order_ts,
               coalesce(od.total_usd, 0) AS total_usd, coalesce(ns.status, 'pending') AS status
        FROM (SELECT * FROM r_ord
              WHERE order_id IS NOT NULL AND order_ts IS NOT NULL AND {_id('user_id')} IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY raw_order_id DESC) = 1) od
        LEFT JOIN new_status ns ON ns.order_id = od.order_id""",
    "new_items": """
        SELECT raw_order_item_id AS order_item_id, order_id, product_id,
               coalesce(quantity, 1) AS quantity, price_usd
        FROM r_it
        WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND price_usd IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY order_id, product_id
                                   ORDER BY raw_order_item_id DESC) = 1""",
}

DDS: dict[str, str] = {}

DDS["d1_users"] = "SELECT * FROM built_users"

_KEPT = """(SELECT user_id FROM prof_ids WHERE user_id IS NOT NULL
            UNION SELECT user_id FROM active_ids WHERE user_id IS NOT NULL)"""
DDS["d2_delete_orphans"] = f"SELECT * FROM old_users WHERE user_id IN {_KEPT}"


def _last(column: str) -> str:
    return (f"arg_max({column}, coalesce(user_profile_id, -1)) "
            f"FILTER ({column} IS NOT NULL) AS {column}")


_USER_COLUMNS = ["name", "email", "birth_date", "gender", "city", "country"]
DDS["d3_upsert_users"] = f"""
WITH newest AS (
    SELECT user_id, {', '.join(_last(c) for c in _USER_COLUMNS)} FROM built_users GROUP BY user_id)
SELECT coalesce(old.user_id, newest.user_id) AS user_id,
       {', '.join(f'coalesce(newest.{c}, old.{c}) AS {c}' for c in _USER_COLUMNS)}
FROM old_users old FULL JOIN newest ON old.user_id = newest.user_id
"""

DDS["d4_orders_latest_status"] = """
SELECT DISTINCT od.order_id, od.user_id, od.order_ts, CAST(od.total_usd AS DOUBLE) AS total_usd,
       coalesce(ns.status, 'pending') AS status
FROM r_ord od LEFT JOIN new_status ns ON ns.order_id = od.order_id
WHERE od.order_id IS NOT NULL
"""

DDS["d5_orders_cleanup"] = """
SELECT order_id, user_id, order_ts, CAST(total_usd AS DOUBLE) AS total_usd, status
FROM old_orders
WHERE order_id IN (SELECT order_id FROM r_ord WHERE order_id IS NOT NULL)
"""

DDS["d6_upsert_orders"] = """
SELECT order_id, user_id, order_ts, CAST(total_usd AS DOUBLE) AS total_usd, status FROM new_orders
UNION ALL
SELECT order_id, user_id, order_ts, CAST(total_usd AS DOUBLE), status FROM old_orders
WHERE order_id NOT IN (SELECT order_id FROM new_orders)
"""

DDS["d7_upsert_items"] = """
SELECT coalesce(o.order_item_id, n.order_item_id) AS order_item_id,
       order_id, product_id, coalesce(n.quantity, o.quantity) AS quantity,
       CAST(coalesce(n.price_usd, o.price_usd) AS DOUBLE) AS price_usd
FROM old_items o FULL JOIN new_items n USING (order_id, product_id)
"""

DDS["d8_devices"] = f"""
SELECT DISTINCT ON (2, 3, 4, 5) user_device_id AS device_id, {_id('user_id')} AS user_id,
       device_type, os, browser
FROM r_dev WHERE {_id('user_id')} IS NOT NULL ORDER BY user_device_id
"""

DDS["d9_locations"] = f"""
SELECT user_location_id AS location_id, {_id('user_id')} AS user_id, city, country,
       coalesce(lat, 0) AS lat, coalesce(lon, 0) AS lon
FROM r_loc WHERE {_id('user_id')} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {_id('user_id')}, city, country
                           ORDER BY user_location_id) = 1
"""

DDS["d9_location_users"] = f"""
SELECT user_id, name, email, birth_date, gender, city, country FROM old_users
UNION ALL
SELECT DISTINCT {_id('user_id')}, NULL, NULL, CAST(NULL AS DATE), NULL, NULL, NULL FROM r_loc
WHERE {_id('user_id')} IS NOT NULL AND {_id('user_id')} NOT IN (SELECT user_id FROM old_users)
"""

DDS["d10_missing_users"] = """
SELECT user_id, name, email, birth_date, gender, city, country FROM old_users
UNION ALL
SELECT user_id, NULL, NULL, CAST(NULL AS DATE), NULL, NULL, NULL FROM event_ids
WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM old_users)
"""

DDS["d11_sessions"] = """
SELECT session_id, user_id, start_ts, end_ts, event_count FROM owned_sessions WHERE place = 1
"""
DDS["d11_session_conflicts"] = """
SELECT session_id, user_id, start_ts, end_ts, event_count FROM owned_sessions WHERE place > 1
"""

DDS["d12_categories"] = "SELECT category_id, category_name FROM all_categories"

DDS["d13_products"] = """
SELECT product_id, product_name, category_id
FROM (SELECT product_id, coalesce(max(product_name), 'Unknown Product') AS product_name,
             coalesce(max(product_category), 'Unknown') AS category_name
      FROM r_ev WHERE product_id IS NOT NULL GROUP BY product_id)
JOIN all_categories USING (category_name)
"""

DDS["d14_campaigns"] = """
SELECT campaign_id, last.name AS campaign_name, last.channel AS channel
FROM (SELECT campaign_id, max({'untimed': generated_at IS NULL, 'at': generated_at, 'id': campaign_event_id,
                               'name': campaign_name, 'channel': channel}) AS last
      FROM r_camp GROUP BY campaign_id HAVING campaign_id IS NOT NULL)
"""

DDS["d15_campaign_costs"] = f"""
SELECT campaign_event_id, {_id('user_id')} AS user_id, campaign_id, action,
       CAST(coalesce(cost, usual, 0.05) AS DOUBLE) AS cost, generated_at
FROM r_camp LEFT JOIN (VALUES ('view', 0.10), ('click', 0.30), ('purchase', 1.00)) AS fee(action, usual) USING (action)
WHERE campaign_id IS NOT NULL
"""

DDS["d16_apply_status"] = """
WITH matching AS (
    SELECT o.order_id, r.status AS new_status,
           row_number() OVER (PARTITION BY o.order_id
                              ORDER BY r.generated_at DESC NULLS FIRST, r.event_id DESC) AS place
    FROM old_orders o JOIN r_st r ON r.order_id = o.order_id
    WHERE o.status IS NULL OR o.status = 'pending' OR r.status IN ('failed', 'cancelled'))
SELECT o.order_id, o.user_id, o.order_ts, CAST(o.total_usd AS DOUBLE) AS total_usd,
       CASE WHEN m.order_id IS NULL THEN o.status ELSE m.new_status END AS status
FROM old_orders o LEFT JOIN matching m ON m.order_id = o.order_id AND m.place = 1
"""

DDS["d17_row_counts"] = """
SELECT 'events' AS table_name, (SELECT count(*) FROM unique_ev) AS n_rows
UNION ALL SELECT 'orders', (SELECT count(*) FROM new_orders)
UNION ALL SELECT 'order_items', (SELECT count(*) FROM new_items)
UNION ALL SELECT 'sessions', (SELECT count(*) FROM owned_sessions WHERE place = 1)
"""

# --- validation ---------------------------------------------------------------
VALIDATION: dict[str, str] = {}

VALIDATION["v1_validate_events"] = "SELECT * FROM valid_ev"
VALIDATION["v1_rejected_events"] = """
SELECT event_id, user_id, CASE WHEN user_id IS NULL THEN 'user_id: missing'
                               ELSE 'user_id: not a valid id' END AS reasons
FROM allowed_ev WHERE event_id NOT IN (SELECT event_id FROM valid_ev)
"""
VALIDATION["v2_default_zero"] = f"""
SELECT user_location_id, {_id('user_id')} AS user_id, city, country,
       coalesce(lat, 0) AS lat, coalesce(lon, 0) AS lon
FROM r_loc WHERE {_id('user_id')} IS NOT NULL
"""
VALIDATION["v3_dedup"] = "SELECT * FROM unique_ev"
VALIDATION["v4_not_null"] = """
SELECT event_id, user_id, session_id FROM r_ev WHERE user_id IS NOT NULL AND session_id IS NOT NULL
"""
VALIDATION["v5_batch_not_null"] = """
SELECT * FROM unique_ev
WHERE session_id IS NOT NULL
   OR EXISTS (SELECT 1 FROM allowed_ev WHERE event_type IN ('signup', 'churn'))
"""
VALIDATION["v5_batch_without_signup"] = """
SELECT event_id, event_type, session_id FROM allowed_ev
WHERE event_type NOT IN ('signup', 'churn') AND user_id IS NOT NULL AND session_id IS NOT NULL
"""
VALIDATION["v6_allow_list"] = "SELECT event_id, event_type FROM allowed_ev"
VALIDATION["v7_parse_timestamp"] = """
SELECT event_id, CASE WHEN event_id % 6 NOT IN (0, 3) THEN ts END AS parsed FROM events
"""
VALIDATION["v8_numeric_id"] = f"SELECT event_id, {_id('user_id')} AS user_id FROM r_ev"
VALIDATION["v9_gender"] = """
SELECT user_profile_id, CASE lower(trim(gender)) WHEN 'male' THEN 'male'
                        WHEN 'female' THEN 'female' END AS gender FROM r_prof
"""
VALIDATION["v10_checks"] = """
SELECT raw_order_item_id, quantity, CAST(price_usd AS DOUBLE) AS price_usd,
       'quantity_positive' AS failed_checks
FROM r_it WHERE quantity <= 0
"""
VALIDATION["v10_passed"] = "SELECT raw_order_item_id, quantity FROM r_it WHERE quantity > 0 OR quantity IS NULL"
VALIDATION["v11_fk_ok"] = f"""
SELECT event_id, {_id('user_id')} AS user_id FROM r_ev
WHERE {_id('user_id')} IS NULL OR {_id('user_id')} IN (SELECT user_id FROM old_users)
"""
VALIDATION["v11_fk_orphans"] = f"""
SELECT event_id, {_id('user_id')} AS user_id FROM r_ev
WHERE {_id('user_id')} IS NOT NULL AND {_id('user_id')} NOT IN (SELECT user_id FROM old_users)
"""
VALIDATION["v13_nan_to_null"] = """
SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN value END AS value FROM events
"""
VALIDATION["v14_integers"] = """
SELECT event_id, CAST(coalesce(product_id, 0) AS BIGINT) AS product_id, quantity FROM valid_ev
"""


# --- the star by batches ----------------------------------------------------------
INCREMENTAL: dict[str, str] = {}


def _newest(column: str) -> str:
    return f"(max({{'at': user_profile_id, 'v': {column}}}) FILTER ({column} IS NOT NULL)).v AS {column}"


INCREMENTAL["inc_users"] = f"""
SELECT user_id, name, email, birth_date, gender, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS country
FROM any_ids LEFT JOIN (
    SELECT user_id, {', '.join(_newest(c) for c in ('name', 'email', 'birth_date', 'gender'))}
    FROM built_users WHERE user_profile_id IS NOT NULL GROUP BY user_id) USING (user_id)
"""
INCREMENTAL["inc_events"] = """
SELECT event_id, user_id, event_type, "timestamp", session_id, product_id, CAST(NULL AS VARCHAR) AS product_name,
       CAST(NULL AS VARCHAR) AS product_category, order_id, quantity, cost_usd, cost_eur, cost_rub, weather_temp,
       weather_desc, city, country, lat, lon
FROM unique_ev
WHERE session_id IS NOT NULL OR 0 < (SELECT count(*) FROM allowed_ev WHERE event_type IN ('signup', 'churn'))
"""
INCREMENTAL["inc_sessions"] = f"""
SELECT session_id, owner.user_id AS user_id, owner.start_ts AS start_ts, owner.end_ts AS end_ts, owner.n AS event_count
FROM (
    SELECT session_id, min({{'first': first_ts, 'user_id': user_id, 'start_ts': start_ts, 'end_ts': end_ts, 'n': n}}) AS owner
    FROM (SELECT session_id, {_id('user_id')} AS user_id, min("timestamp") AS first_ts, CAST(count(*) AS INTEGER) AS n,
                 min("timestamp") FILTER (event_type = 'session_start') AS start_ts,
                 max("timestamp") FILTER (event_type = 'session_end') AS end_ts
          FROM r_ev WHERE {_id('user_id')} IS NOT NULL AND TRY_CAST(session_id AS UUID) IS NOT NULL GROUP BY 1, 2)
    GROUP BY session_id)
"""
INCREMENTAL["inc_orders"] = "SELECT order_id, user_id, order_ts, CAST(total_usd AS DOUBLE) AS total_usd, status FROM star_orders"
INCREMENTAL["inc_order_items"] = """
SELECT order_item_id, order_id, product_id, coalesce(last.quantity, 1) AS quantity, CAST(last.price AS DOUBLE) AS price_usd
FROM (SELECT order_id, product_id, min(raw_order_item_id) AS order_item_id,
             max({'id': raw_order_item_id, 'quantity': quantity, 'price': price_usd}) AS last
      FROM r_it WHERE price_usd IS NOT NULL AND product_id IS NOT NULL GROUP BY order_id, product_id)
SEMI JOIN star_orders USING (order_id)
WHERE coalesce(last.quantity, 1) > 0 AND last.price >= 0
"""
INCREMENTAL["inc_products"] = """
SELECT product_id, coalesce(max(product_name), 'Unknown Product') AS product_name, max(product_category) AS category_name
FROM r_ev GROUP BY product_id HAVING product_id IS NOT NULL AND max(product_category) IS NOT NULL
"""
INCREMENTAL["inc_campaigns"] = DDS["d14_campaigns"]
INCREMENTAL["inc_campaign_events"] = f"SELECT * FROM ({DDS['d15_campaign_costs']}) SEMI JOIN any_ids USING (user_id)"
INCREMENTAL["inc_user_devices"] = f"SELECT * FROM ({DDS['d8_devices']}) SEMI JOIN any_ids USING (user_id)"
INCREMENTAL["inc_user_locations"] = DDS["d9_locations"]

RAW_TABLES["any_ids"] = f"""
    SELECT {_id('user_id')} AS user_id FROM r_prof WHERE {_id('user_id')} IS NOT NULL
    UNION SELECT {_id('user_id')} FROM r_ev WHERE {_id('user_id')} IS NOT NULL
    UNION SELECT {_id('user_id')} FROM r_loc WHERE {_id('user_id')} IS NOT NULL"""
RAW_TABLES["star_orders"] = """
    SELECT order_id, user_id, order_ts, total_usd,
           CASE WHEN status = 'pending' THEN status ELSE coalesce(halt, status) END AS status
    FROM new_orders LEFT JOIN (
        SELECT order_id, max({'untimed': generated_at IS NULL, 'at': generated_at, 'id': event_id, 'status': status}).status AS halt
        FROM r_st WHERE status IN ('failed', 'cancelled') GROUP BY order_id) USING (order_id)
    SEMI JOIN any_ids USING (user_id)
    WHERE total_usd >= 0"""

RUN_COUNTS = {"d17_run_counts": " UNION ALL ".join([
    *[f"SELECT '{name.removeprefix('inc_')}' AS table_name, count(*) AS n_rows FROM ({sql})"
      for name, sql in INCREMENTAL.items()],
    "SELECT 'categories', count(DISTINCT product_category) FROM r_ev"])}

LIVE = {
    "live_v3_unique": 'SELECT user_id, event_type, "timestamp" FROM unique_ev',
    "live_m7_pairs": """
        SELECT campaign_event_id, campaign_id, order_id FROM camp_ev JOIN ord USING (user_id)
        WHERE status = 'success' AND order_ts - generated_at BETWEEN INTERVAL 0 DAY AND INTERVAL 14 DAY""",
}
