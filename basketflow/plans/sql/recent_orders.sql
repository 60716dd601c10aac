-- Orders of the last seven days.
SELECT sum(total_orders) AS total_orders
FROM {mart}
WHERE event_date BETWEEN :first_day AND :last_day
