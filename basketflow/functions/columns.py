"""Column expressions shared by the jobs.  All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UUID_PATTERN = "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(c: Column | str) -> Column:
    return F.to_date(_col(c))


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Whole microseconds from start to end, a bigint, so sums stay exact."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def whole_seconds(c: Column | str) -> Column:
    return F.date_trunc("second", _col(c)).cast("timestamp_ntz")


def round_to_int(c: Column | str) -> Column:
    """A cast to int that rounds; a bare Spark cast cuts the fraction off."""
    return F.round(_col(c)).cast("int")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, 0 where the denominator is not positive."""
    top, bottom = numerator.cast("double"), denominator.cast("double")
    return F.when(bottom > 0, F.try_divide(top, bottom)).otherwise(F.lit(0.0))


def clip(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Bound a number.  NULL stays NULL, which least/greatest would not keep."""
    c = _col(c)
    out = c
    if low is not None:
        out = F.when(c < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(c > high, F.lit(high)).otherwise(out)
    return out


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def try_id(c: Column | str) -> Column:
    """A text id as bigint: '12', ' +12' and '12.0' parse; 'x12', '12.5', '12d', '1e5' and
    '0x1p3' are NULL, and so are numbers beyond 64 bits."""
    return F.regexp_extract(_col(c), r"^\s*([+-]?[0-9]+)(\.0*)?\s*$", 1).try_cast("bigint")


def try_ts(c: Column | str) -> Column:
    """A timestamp without zone; an offset in the text is dropped, garbage is NULL."""
    return _col(c).try_cast("timestamp_ntz")


def try_date(c: Column | str) -> Column:
    return _col(c).try_cast("date")


def normalize_gender(c: Column | str) -> Column:
    tidy = F.lower(F.trim(_col(c)))
    return F.when(tidy.isin("male", "female"), tidy)


def is_uuid(c: Column | str) -> Column:
    return _col(c).rlike(UUID_PATTERN)
