-- Active users per day.
SELECT event_date, active_users_count, new_users, returning_users FROM {mart} ORDER BY event_date
