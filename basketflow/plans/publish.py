"""Cleaning a mart on its way out: dedup, clips, date and place filters, types."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow import schemas
from basketflow.functions import clip, day, nan_to_null, whole_seconds
from basketflow.sources import sinks
from basketflow.sources.tables import has_data

# Bounds of each clipped column (lowest, highest), unwanted place names.
LIMITS: dict[str, tuple[float | None, float | None]] = {
    "total_revenue": (None, 10000),
    "conversion_rate": (0, 1),
    "roi": (-100, 100),
    "avg_order_value": (None, 10000),
    "total_quantity": (0, None),
    "orders_count": (0, None),
    "total_orders": (0, None),
    "total_sessions": (0, None),
    "successful_orders": (0, None),
}
UNWANTED_PLACES = ["Unknown", "Antarctica", ""]
# Names under which a mart's query returns a column that its table calls otherwise.
RENAMED = {"active_users_7d": {"reactivated_users": "churned_users"}}
# Marts whose rows carry all their grouping keys and so cannot repeat.
DISTINCT_BY_GRAIN = set(schemas.MART) - {"session_analytics"}


def _limited(df: DataFrame) -> dict[str, tuple[float | None, float | None]]:
    return {c: bounds for c, bounds in LIMITS.items() if c in df.columns}


def _outside(column: str, bounds: tuple[float | None, float | None]) -> Column:
    low, high = bounds
    c = F.col(column)
    below = c < low if low is not None else F.lit(False)
    above = c > high if high is not None else F.lit(False)
    return F.coalesce(below | above, F.lit(False))


def without_nan(df: DataFrame) -> DataFrame:
    """NaN exceeds every number, so it must go before any bound is tested."""
    doubles = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: nan_to_null(c) for c in doubles}) if doubles else df


def clip_limits(df: DataFrame) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns({
        c: clip(c, *bounds).cast(types[c]) for c, bounds in _limited(df).items()})


def quality_counts(df: DataFrame) -> list[Column]:
    """One count per rule of the rows it would change."""
    return [F.count_if(_outside(c, bounds)).alias(c) for c, bounds in _limited(df).items()]


def quality_report(df: DataFrame) -> DataFrame:
    """Rows (rule, n_rows): how many rows each clip rule touches."""
    rules = list(_limited(df))
    counted = without_nan(df).agg(*quality_counts(df))
    pairs = F.array(*[F.struct(F.lit(c).alias("rule"), F.col(c).alias("n_rows")) for c in rules])
    return counted.select(F.inline(pairs))


def require_date(df: DataFrame, date_field: str) -> DataFrame:
    """Drop rows without the date; a date-only field loses its time."""
    if date_field not in df.columns:
        return df
    kept = df.where(F.col(date_field).isNotNull())
    is_date = date_field.endswith("_date")
    return kept.withColumn(date_field, day(date_field)) if is_date else kept


def fill_strings(df: DataFrame) -> DataFrame:
    strings = [c for c, t in df.dtypes if t == "string"]
    return df.na.fill("", subset=strings) if strings else df


def drop_unwanted(df: DataFrame, column: str) -> DataFrame:
    return df.where(~F.col(column).isin(UNWANTED_PLACES)) if column in df.columns else df


def _whole(c: str, target: str) -> Column:
    """A whole number of another type as an integer; a fraction fails the load."""
    fits = F.col(c).isNull() | (F.col(c) == F.floor(c))
    return F.when(fits, F.col(c).cast(target)).otherwise(
        F.raise_error(F.concat(F.lit(f"{c} is not whole: "), F.col(c).cast("string"))).cast(target))


def conform(df: DataFrame, mart: str) -> DataFrame:
    """The mart table's columns and types; columns the query lacks get 0 or ''."""
    types = dict(df.dtypes)
    out = []
    for field in schemas.MART[mart].fields:
        name, target = field.name, field.dataType.simpleString()
        if name not in types:
            value = F.lit("" if target == "string" else 0).cast(target)
        elif target in ("bigint", "smallint") and types[name].startswith(("double", "decimal")):
            value = _whole(name, target)
        elif target == "date":
            value = day(name)
        elif target == "timestamp_ntz":
            value = whole_seconds(name)
        else:
            value = F.col(name).cast(target)
        out.append(value.alias(name))
    return df.select(*out)


def _drops(df: DataFrame, date_field: str) -> list[Column]:
    """Rows that each filter drops: those without a date, of an unwanted country, of an unwanted city."""
    tests = [("no date", date_field, F.col(date_field).isNull())] + [
        (f"{c} unwanted", c, F.coalesce(F.col(c), F.lit("")).isin(UNWANTED_PLACES)) for c in ("country", "city")]
    stays, counts = F.lit(True), []
    for rule, column, drops in tests:
        if column in df.columns:
            counts.append(F.count_if(stays & drops).alias(rule))
            stays = stays & ~drops
    return counts


def _counts(observation: Observation) -> dict[str, int]:
    """The counts of a write that has ended; none for an empty table, whose plan Spark cuts away, counts included."""
    try:
        return dict(observation.get)
    except Py4JJavaError:
        return {}


class Observed:
    """Counts of one load, gathered while its result is written.

    Counts come from the tasks of that write: a stage that runs again after an executor is lost may count
    again.  ``quality_report`` counts by a query of its own.
    """

    def __init__(self) -> None:
        self.given, self.cleaned = Observation(), Observation()

    def rows(self) -> list[tuple[str, int]]:
        """(rule, rows): rows given, duplicates, rows each rule clips, rows each filter drops."""
        given, cleaned = _counts(self.given).get("rows", 0), _counts(self.cleaned)
        return [("rows", given), ("duplicates", given - cleaned.pop("rows", 0)), *cleaned.items()]


def publish_clean(df: DataFrame, mart: str, observation: Observation | None = None,
                  given: Observation | None = None) -> DataFrame:
    """All cleaning steps in order.

    While the result is written, ``observation`` receives the counts per rule and ``given`` the rows
    before duplicates go.
    """
    df = without_nan(df.withColumnsRenamed(RENAMED.get(mart, {})))
    n_rows = F.count(F.lit(1)).alias("rows")
    if given is not None:
        df = df.observe(given, n_rows)
    if mart not in DISTINCT_BY_GRAIN:
        df = df.dropDuplicates()
    date_field = schemas.MART_DATE_FIELD[mart]
    if observation is not None:
        df = df.observe(observation, n_rows, *quality_counts(df), *_drops(df, date_field))
    df = require_date(clip_limits(df), date_field)
    df = fill_strings(df)
    df = drop_unwanted(drop_unwanted(df, "country"), "city")
    return conform(df, mart)


def _observed_clean(df: DataFrame, mart: str, observed: Observed | None) -> DataFrame:
    if observed is None:
        return publish_clean(df, mart)
    return publish_clean(df, mart, observed.cleaned, observed.given)


def load_mart(df: DataFrame, base: str, mart: str, observed: Observed | None = None) -> int | None:
    """Publish a mart's query result; returns its rows, None if the mart was left as it is.

    That is the case for an empty result; one that becomes empty only by cleaning does
    empty the mart.  The new snapshot becomes current after its rows have been counted,
    which reads file footers only.
    """
    spark = df.sparkSession
    path = sinks.publish(_observed_clean(df, mart, observed), base, mart, commit=False)
    n_rows = spark.read.schema(sinks.mart_schema(mart)).parquet(path).count()
    if n_rows == 0 and not has_data(df):
        sinks.discard_snapshot(spark, path)
        return None
    sinks.commit_snapshot(spark, path)
    return n_rows


def reload_mart(df: DataFrame, base: str, mart: str, as_of: date, days: int = 30,
                observed: Observed | None = None) -> int | None:
    """Replace the last ``days`` days of a mart by the query's result; older rows stay.

    A mart by months rewrites only the months of these days, in files of an even size; other
    months' files stay as they are.  An empty result still empties these days.  Marts without
    months, and marts that were never written, are loaded whole.  Returns the rows of the mart.
    """
    if mart not in schemas.MART_MONTH_COLUMN or sinks.current_snapshot(df.sparkSession, f"{base}/{mart}") is None:
        return load_mart(df, base, mart, observed)
    sinks.replace_months(_observed_clean(df, mart, observed), base, mart, as_of, days)
    return sinks.read_mart(df.sparkSession, base, mart).count()


REPORT = T.StructType([
    T.StructField("as_of", T.TimestampNTZType()), T.StructField("table_name", T.StringType()),
    T.StructField("rule", T.StringType()), T.StructField("n_rows", T.LongType())])


def append_report(spark: SparkSession, base: str, as_of: datetime,
                  counts: Iterable[tuple[str, str, int]]) -> None:
    """Add the counts (table, rule, rows) of one run to the report next to its tables."""
    rows = [(as_of, *count) for count in counts]
    sinks.append(spark.createDataFrame(rows, REPORT).coalesce(1), f"{base}/_report")


def read_report(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(REPORT).parquet(f"{base}/_report")
