"""What the messages of ``checks.messages`` must become, as SQL for DuckDB."""

_NO = "CAST(NULL AS VARCHAR)"

MESSAGE_TABLES = {
    "m_events": f"""
        SELECT CAST(user_id AS VARCHAR) AS user_id,
               CASE WHEN event_type <> 'signup' THEN user_id || '-' || CAST(ts AS DATE) END AS session_id,
               CASE event_type WHEN 'click' THEN 'session_start' WHEN 'error' THEN 'session_end'
                               WHEN 'view' THEN 'view_page' ELSE event_type END AS event_type,
               CASE WHEN act THEN CAST(event_id % 200 + 1 AS INTEGER) END AS product_id,
               {_NO} AS product_name, {_NO} AS product_category, {_NO} AS order_id,
               CASE WHEN act THEN CAST(event_id % 5 + 1 AS INTEGER) END AS quantity,
               {_NO} AS city, {_NO} AS country,
               CASE WHEN act THEN CAST(event_id * 37 % 18000 AS DOUBLE) / 100 - 90 END AS lat,
               CAST(NULL AS DOUBLE) AS lon,
               CASE WHEN act THEN CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) END AS cost_usd,
               CAST(NULL AS DOUBLE) AS cost_eur, CAST(NULL AS DOUBLE) AS cost_rub,
               CAST(NULL AS DOUBLE) AS weather_temp, {_NO} AS weather_desc, ts AS "timestamp"
        FROM (SELECT *, event_type IN ('purchase', 'view') AS act FROM events)
        WHERE event_id % 50 <> 0 AND event_id % 51 <> 0 AND event_id % 53 <> 0""",
    "m_user_profiles": f"""
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name, {_NO} AS email,
               CAST(DATE '1970-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS DATE) AS birth_date,
               ['male', 'female', 'other'][c_custkey % 3 + 1] AS gender
        FROM customer""",
    "m_user_devices": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id,
               ['mobile', 'desktop', NULL][c_custkey % 3 + 1] AS device_type,
               'iOS' AS os, ['Chrome', 'Safari'][c_custkey % 2 + 1] AS browser FROM customer""",
    "m_user_locations": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, 'City ' || c_custkey AS city,
               'Country' AS country, CAST(c_custkey % 180 AS DOUBLE) - 90.5 AS lat,
               CAST(12.25 AS DOUBLE) AS lon FROM customer""",
    "m_orders": """
        SELECT 'o' || o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
               o_orderdate AS order_ts, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total_usd
        FROM orders""",
    "m_order_items": """
        SELECT 'o' || l_orderkey AS order_id, CAST(l_partkey AS INTEGER) AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price_usd FROM lineitem""",
    "m_campaign_events": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, 'camp1' AS campaign_id,
               'Summer' AS campaign_name, 'email' AS channel, event_type AS action,
               CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS cost, ts AS generated_at
        FROM events""",
    "m_lines": """
        SELECT 'o' || l_orderkey AS order_id,
               CASE WHEN l_returnflag = 'A' THEN 'success' WHEN l_returnflag = 'N' THEN 'pending'
                    WHEN l_linenumber = 6 THEN 'lost' ELSE 'cancelled' END AS status,
               l_shipdate AS generated_at, l_orderkey % 97 = 0 AS anonymous
        FROM lineitem""",
    "m_order_status_events": """
        SELECT order_id, status, generated_at FROM m_lines
        WHERE NOT anonymous AND status <> 'lost'""",
    "m_reasons": """
        SELECT CASE WHEN event_id % 50 = 0 THEN 'not a JSON object'
                    WHEN event_id % 51 = 0 THEN 'quantity: not a int'
                    ELSE 'timestamp: missing' END AS reason
        FROM events WHERE event_id % 50 = 0 OR event_id % 51 = 0 OR event_id % 53 = 0
        UNION ALL
        SELECT CASE WHEN anonymous THEN 'order_id: missing' ELSE 'status: unknown' END
        FROM m_lines WHERE anonymous OR status = 'lost'""",
}

TABLE_NAMES = ["events", "user_profiles", "user_devices", "user_locations", "orders",
               "order_items", "campaign_events", "order_status_events"]

ROUTING: dict[str, str] = {f"t4_raw_{name}": f"SELECT * FROM m_{name}" for name in TABLE_NAMES}
ROUTING["t1_route_counts"] = "\nUNION ALL\n".join(
    [f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM m_{name}" for name in TABLE_NAMES]
    + ["SELECT 'quarantine', count(*) FROM m_reasons"])
ROUTING["t1_route_stream"] = ROUTING["t1_route_counts"]
ROUTING["t7_stream_events"] = ROUTING["t4_raw_events"]
ROUTING["t8_quarantine"] = "SELECT reason, count(*) AS n_rows FROM m_reasons GROUP BY reason"
ROUTING["t3_event_types"] = "SELECT event_type, count(*) AS n_rows FROM m_events GROUP BY event_type"
ROUTING["t9_append_ignore"] = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer WHERE c_mktsegment = 'BUILDING'
"""
