-- Sessions, orders and revenue by kind of device.
SELECT device_type,
       sum(total_sessions) AS total_sessions,
       sum(total_orders) AS total_orders,
       CAST(sum(CAST(total_revenue AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue
FROM {mart}
GROUP BY device_type
