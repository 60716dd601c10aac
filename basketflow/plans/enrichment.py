"""Enrichment as a stage: landed events get their currencies, places and weather before the star.

The rates, places and weather are kept in versions.  A version is one row that names the written
tables it is made of; it never changes, and a new one shares what did not change with the one before.

Each landed batch is enriched with one version: the one that was current when the batch was first
tried.  That choice is written down before any row is read, so a batch that runs again, at
any later time, gives the same rows.  The stage runs inside the ingest stream
(``start_ingest(..., then=stage.run)``) or over all batches that have landed (``run_landed``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow import schemas
from basketflow.functions import day
from basketflow.operators.enrich import (
    CURRENCIES, convert_currency_as_of, geo_lookup, land_places, place_tree, weather_lookup,
)
from basketflow.operators.skew import HOT_ROWS
from basketflow.sources import sinks
from basketflow.streaming import ingest
from basketflow.streaming.router import SERIAL

# Tables whose rows have a place; events have prices and weather too.
ENRICHED = ("events", "user_locations")

_TABLES = schemas.DIMENSIONS
# The version that a batch is enriched with.
_PIN = T.StructType([T.StructField("version", T.StringType())])


@dataclass(frozen=True)
class Dimensions:
    """The tables of one version."""

    rates: DataFrame
    places: DataFrame
    tree: DataFrame
    weather: DataFrame


class DimensionStore:
    """Versions of the dimensions under one folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def current(self) -> str:
        """The newest version; it is named by the folder of its row."""
        version = sinks.current_snapshot(self.spark, f"{self.base}/versions")
        if version is None:
            raise LookupError(f"no version of the dimensions in {self.base}")
        return version

    def _parts(self, version: str) -> dict:
        return self.spark.read.schema(_TABLES["versions"]).parquet(version).first().asDict()

    def publish(self, rates: DataFrame | None = None, places: DataFrame | None = None,
                weather: DataFrame | None = None, more_weather: DataFrame | None = None) -> str:
        """Make the next version; what is not given stays as in the version before.

        ``rates`` has (day, currency, rate), ``places`` (city, country, lat, lon), ``weather``
        (lat, lon, observed_at, temp, weather).  ``more_weather`` adds observations to those
        that are there.  The first version needs all three tables.
        """
        version = sinks.current_snapshot(self.spark, f"{self.base}/versions")
        parts = self._parts(version) if version else {}
        if not parts and (rates is None or places is None or weather is None):
            raise ValueError("the first version needs rates, places and weather")

        def written(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> str:
            columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in _TABLES[name].fields]
            return sinks.write_snapshot(df.select(*columns), f"{self.base}/{name}", by)

        def observed(df: DataFrame) -> str:
            by_day = df.withColumn("day", day("observed_at")).hint("rebalance", "day")
            return written(by_day, "weather", ("day",))

        if rates is not None:
            parts["rates"] = written(rates, "rates")
        if places is not None:
            parts["places"] = written(land_places(places), "places")
            land = self.spark.read.schema(_TABLES["places"]).parquet(parts["places"])
            parts["tree"] = written(place_tree(land), "tree")
        if weather is not None:
            parts["weather"] = [observed(weather)]
        if more_weather is not None:
            parts["weather"] = [*parts["weather"], observed(more_weather)]
        row = self.spark.createDataFrame([tuple(parts[c] for c in _TABLES["versions"].names)], _TABLES["versions"])
        sinks.write_snapshot(row, f"{self.base}/versions")
        return self.current()

    def read(self, version: str) -> Dimensions:
        parts = self._parts(version)

        def table(name: str, path: str) -> DataFrame:
            return self.spark.read.schema(_TABLES[name]).parquet(path)

        weather = reduce(DataFrame.unionByName, [table("weather", path) for path in parts["weather"]])
        return Dimensions(*[table(name, parts[name]) for name in ("rates", "places", "tree")], weather)


# --- the joins ------------------------------------------------------------------
def _or_found(given: str, found: str, told_by: str) -> Column:
    """The value that the message brought, if it told any of the group; else the looked-up one."""
    return F.when(F.col(told_by).isNotNull(), F.col(given)).otherwise(F.col(found))


def enrich_places(df: DataFrame, dims: Dimensions, serial: str, hot_rows: int = HOT_ROWS,
                  counted: DataFrame | None = None) -> DataFrame:
    """City and country of rows that came without a city."""
    told = df.withColumnsRenamed({"city": "_city", "country": "_country"})
    found = geo_lookup(told, dims.places, [serial], hot_rows, counted, dims.tree)
    country = _or_found("_country", "country", "_city")
    return found.withColumns({"country": country, "city": F.coalesce("_city", "city")}).drop("_city", "_country")


def enrich_events(events: DataFrame, dims: Dimensions, cell: float = 0.5,
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Prices in other currencies, place and weather of each event; what a message brought stays.

    A city and its country count as one value, so do temperature and description.  A
    price without a rate up to its day, and an event without an observation in its cell and
    hour, stay NULL; an event without coordinates is in the city 'Unknown'.  Events have unique ids.
    """
    costs = {f"cost_{c.lower()}": f"_cost_{c.lower()}" for c in CURRENCIES}
    rows = convert_currency_as_of(events.withColumnsRenamed(costs), dims.rates, "timestamp")
    rows = rows.withColumns({c: F.coalesce(told, c) for c, told in costs.items()}).drop(*costs.values())
    rows = enrich_places(rows, dims, "event_id", hot_rows, counted=events)
    # Only the days between the first and the last event are read.
    span = events.agg(F.min(day("timestamp")).alias("first"), F.max(day("timestamp")).alias("last")).first()
    weather = dims.weather.where(F.col("day").between(F.lit(span["first"]), F.lit(span["last"])))
    told = F.coalesce(F.col("weather_desc"), F.col("weather_temp").cast("string")).alias("_told")
    rows = rows.select("*", told).withColumnsRenamed({"weather_temp": "_temp", "weather_desc": "_desc"})
    rows = weather_lookup(rows, weather, "timestamp", ["event_id"], cell, hot_rows, events)
    rows = rows.withColumn("weather_temp", F.col("weather_temp").cast("decimal(18,2)").try_cast("decimal(5,2)"))
    return rows.withColumns({
        "weather_temp": _or_found("_temp", "weather_temp", "_told"),
        "weather_desc": _or_found("_desc", "weather_desc", "_told")}).select(*events.columns)


# --- the stage ------------------------------------------------------------------
class Enrichment:
    """Landed batches of ``raw`` enriched into ``base``, each with one version of the dimensions."""

    def __init__(self, spark: SparkSession, raw: str, base: str, dimensions: DimensionStore,
                 cell: float = 0.5, hot_rows: int = HOT_ROWS):
        self.spark, self.raw, self.base = spark, raw, base.rstrip("/")
        self.dimensions, self.cell, self.hot_rows = dimensions, cell, hot_rows

    def version_of(self, batch_id: int) -> str:
        """The version a batch is enriched with; chosen once."""
        path = f"{self.base}/_versions/batch_id={batch_id}"
        pinned = sinks.read_snapshot(self.spark, path, _PIN).first()
        if pinned is None:
            sinks.write_snapshot(self.spark.createDataFrame([(self.dimensions.current(),)], _PIN), path)
            pinned = sinks.read_snapshot(self.spark, path, _PIN).first()
        return pinned["version"]

    def run(self, batch_id: int) -> None:
        """Enrich one landed batch; a batch that runs again replaces its own rows."""
        dims = self.dimensions.read(self.version_of(batch_id))
        for table in ENRICHED:
            rows = ingest.read_raw(self.spark, self.raw, table, batch_id, batch_id)
            out = (enrich_events(rows, dims, self.cell, self.hot_rows) if table == "events"
                   else enrich_places(rows, dims, SERIAL[table], self.hot_rows, rows).select(*rows.columns))
            out.write.mode("overwrite").parquet(f"{self.base}/{table}/batch_id={batch_id}")

    def run_landed(self, upto: int) -> list[int]:
        """Enrich all landed batches up to one that have not been; returns their numbers."""
        landed = ingest.landed_batches(self.spark, self.raw)
        todo = [b for b in landed if b <= upto and not sinks.is_complete(
            self.spark, f"{self.base}/{ENRICHED[-1]}/batch_id={b}")]
        for batch_id in todo:
            self.run(batch_id)
        return todo

    def read_batches(self, table: str, after: int, upto: int) -> DataFrame:
        """Raw rows of the batches after < batch <= upto, for ``merge_batches``."""
        if table not in ENRICHED:
            return ingest.read_raw(self.spark, self.raw, table, after + 1, upto)
        schema = T.StructType([*schemas.RAW[table].fields, T.StructField("batch_id", T.LongType())])
        path = f"{self.base}/{table}"
        if not sinks.exists(self.spark, path):
            return self.spark.createDataFrame([], schemas.RAW[table])
        rows = self.spark.read.schema(schema).parquet(path)
        return rows.where((F.col("batch_id") > after) & (F.col("batch_id") <= upto)).drop("batch_id")

    def reader(self, upto: int) -> Callable[[str], DataFrame]:
        """A reader of whole raw tables up to a batch, for ``raw_to_star``."""
        return lambda table: self.read_batches(table, -1, upto)
