"""The mapping of ``checks.fixtures`` as common table expressions for DuckDB.

``with_tables(sql)`` puts the tables a query names in front of it.
"""

from __future__ import annotations

import re


def moved(key: str, stays: str) -> str:
    """The key, or one that no row of another table has."""
    return f"CASE WHEN {stays} THEN {key} ELSE {key} + 10000000 END"


TABLES: dict[str, str] = {
    "nu": "SELECT max(user_id) + 1 AS n FROM events",
    "ev": """
        SELECT event_id, user_id,
               CASE event_type WHEN 'click' THEN 'session_start' WHEN 'error' THEN 'session_end'
                               WHEN 'view' THEN 'view_page' ELSE event_type END AS event_type,
               ts AS "timestamp",
               user_id || '-' || CAST(ts AS DATE) AS session_id,
               CASE WHEN event_type = 'purchase' THEN 'o' || (event_id % 500) END AS order_id,
               CAST(value AS DECIMAL(18,2)) AS cost_usd
        FROM events""",
    "users": "SELECT c_custkey AS user_id, c_name AS name FROM customer",
    "sessions": """
        SELECT session_id, user_id,
               min("timestamp") FILTER (event_type = 'session_start') AS start_ts,
               max("timestamp") FILTER (event_type = 'session_end') AS end_ts,
               CAST(count(*) AS INTEGER) AS event_count
        FROM ev GROUP BY ALL""",
    "ord": """
        SELECT o_orderkey AS order_id, o_custkey % (SELECT n FROM nu) AS user_id,
               TIMESTAMP '2024-01-01' + to_seconds(o_orderkey * 7919 % 2592000) AS order_ts,
               CAST(o_totalprice AS DECIMAL(18,2)) AS total_usd,
               CASE WHEN o_orderstatus = 'F' THEN 'success' WHEN o_orderstatus = 'O' THEN 'pending'
                    WHEN o_orderkey % 10 = 0 THEN 'cancelled' ELSE 'failed' END AS status
        FROM orders""",
    "items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(p_retailprice AS DECIMAL(18,2)) AS price_usd
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "categories": """
        SELECT row_number() OVER (ORDER BY p_type) AS category_id, p_type AS category_name
        FROM (SELECT DISTINCT p_type FROM part)""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               CASE WHEN p_partkey % 20 <> 0 THEN category_id END AS category_id
        FROM part JOIN categories ON p_type = category_name""",
    "devices": f"""
        SELECT {moved('c_custkey', 'c_acctbal >= 0')} AS user_id,
               ['mobile', 'desktop', 'tablet'][c_custkey % 3 + 1] AS device_type,
               ['iOS', 'Android', 'Windows', 'Linux', 'MacOS'][c_custkey % 5 + 1] AS os,
               ['Chrome', 'Firefox', 'Safari', 'Edge'][c_custkey % 4 + 1] AS browser
        FROM customer""",
    "locations": f"""
        SELECT {moved('c_custkey', "c_mktsegment <> 'HOUSEHOLD'")} AS user_id,
               CASE WHEN c_custkey % 14 = 3 THEN 'Unknown' ELSE n_name END AS city,
               CASE WHEN c_custkey % 17 = 5 THEN 'Antarctica' ELSE r_name END AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "campaigns": "SELECT 'camp' || (r_regionkey + 1) AS campaign_id, r_name AS campaign_name FROM region",
    "camp_ev": """
        SELECT event_id AS campaign_event_id, user_id, 'camp' || (event_id % 5 + 1) AS campaign_id,
               event_type AS action,
               CASE WHEN event_id % 7 <> 0 THEN CAST(value AS DECIMAL(18,2))
                    WHEN event_type = 'view' THEN 0.10 WHEN event_type = 'click' THEN 0.30
                    WHEN event_type = 'purchase' THEN 1.00 ELSE 0.05 END AS cost,
               ts AS generated_at
        FROM events""",
}


def with_tables(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the tables it uses, directly or through other tables."""
    tables = {**TABLES, **(extra or {})}
    order = list(tables)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in order:
            if name not in needed and re.search(rf"(?<![.\w]){name}\b", text):
                needed.add(name)
                visit(tables[name])

    visit(sql)
    ctes = ",\n".join(f"{name} AS ({tables[name]})" for name in order if name in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}" if ctes else body
    return f"WITH {ctes}\n{body}" if ctes else body
