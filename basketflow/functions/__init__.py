from basketflow.functions.columns import (  # noqa: F401
    clip, day, flag, is_uuid, micros_between, nan_to_null, normalize_gender,
    round_to_int, safe_ratio, try_date, try_id, try_ts, whole_seconds,
)
