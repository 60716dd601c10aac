-- Daily revenue.
SELECT event_date, total_revenue FROM {mart} ORDER BY event_date
