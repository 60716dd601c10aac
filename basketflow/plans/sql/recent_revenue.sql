-- Revenue of the last seven days.
SELECT CAST(sum(CAST(total_revenue AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue
FROM {mart}
WHERE event_date BETWEEN :first_day AND :last_day
