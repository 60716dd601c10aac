-- Sales by category.
SELECT category_name,
       CAST(sum(CAST(total_revenue AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue,
       sum(total_quantity) AS total_quantity
FROM {mart}
GROUP BY category_name
