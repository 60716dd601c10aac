"""The enrichment stage: fixed versions per batch, repeats, and its way into the star."""

import json
import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.plans import incremental
from basketflow.plans.enrichment import DimensionStore, Enrichment, enrich_events
from basketflow.streaming import ingest

RATES = [(date(2024, 1, 1), "EUR", 0.5), (date(2024, 1, 3), "EUR", 0.25), (date(2024, 1, 2), "RUB", 80.0)]
PLACES = [("Oslo", "Norway", 60.0, 10.0), ("North Sea", None, 56.0, 3.0), ("Rome", "Italy", 42.0, 12.5)]
WEATHER = [(60.2, 10.2, datetime(2024, 1, 2, 5, 10), 3.0, "snow"), (60.3, 10.3, datetime(2024, 1, 2, 5, 5), -4.5, "mist")]


def dimensions(spark, base, rates=RATES, places=PLACES, weather=WEATHER):
    store = DimensionStore(spark, f"{base}/dimensions")
    store.publish(spark.createDataFrame(rates, "day date, currency string, rate double"),
                  spark.createDataFrame(places, "city string, country string, lat double, lon double"),
                  spark.createDataFrame(weather, "lat double, lon double, observed_at timestamp_ntz, temp double, weather string"))
    return store


def events(spark, *given):
    rows = [{**dict.fromkeys(schemas.RAW["events"].names), "event_id": n, **row} for n, row in enumerate(given)]
    return spark.createDataFrame(rows, schemas.RAW["events"])


HERE = {"lat": 60.1, "lon": 10.1, "timestamp": datetime(2024, 1, 2, 5, 59), "cost_usd": Decimal("10.00")}
NAMES = ["city", "country", "cost_eur", "cost_rub", "weather_temp", "weather_desc"]


def test_found_and_given_values(spark, tmp_path):
    store = dimensions(spark, tmp_path)
    out = enrich_events(events(
        spark, HERE, {**HERE, "city": "Bergen"}, {**HERE, "weather_desc": "hail"}, {**HERE, "cost_eur": Decimal("9.99")},
        {**HERE, "lat": 55.0, "lon": 3.0, "timestamp": datetime(2024, 1, 3, 5)}, {**HERE, "lat": None},
        {**HERE, "timestamp": datetime(2023, 12, 31)}, {"lat": 42.0, "lon": 12.5}), store.read(store.current()))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.RAW["events"]]
    oslo, mist = ("Oslo", "Norway"), (Decimal("-4.50"), "mist")
    eur, rub = Decimal("5.00"), Decimal("800.00")
    assert [tuple(r) for r in out.orderBy("event_id").select(*NAMES).collect()] == [
        (*oslo, eur, rub, *mist), ("Bergen", None, eur, rub, *mist), (*oslo, eur, rub, None, "hail"),
        (*oslo, Decimal("9.99"), rub, *mist), (*oslo, Decimal("2.50"), rub, None, None),
        ("Unknown", None, eur, rub, None, None), (*oslo, None, None, None, None),
        ("Rome", "Italy", None, None, None, None)]


def test_hot_coordinates_are_split_without_loss(spark, rows, tmp_path):
    store = dimensions(spark, tmp_path)
    many = events(spark, *[{**HERE, "lat": 60.1 if n % 3 else 42.0} for n in range(60)])
    dims = store.read(store.current())
    assert rows(enrich_events(many, dims, hot_rows=5)) == rows(enrich_events(many, dims))


@pytest.mark.parametrize("empty", ["events", "rates", "places", "weather"])
def test_empty_tables(spark, tmp_path, empty):
    store = dimensions(spark, tmp_path, **({} if empty == "events" else {empty: []}))
    given = events(spark) if empty == "events" else events(spark, HERE)
    got = enrich_events(given, store.read(store.current())).select(*NAMES).collect()
    assert len(got) == (0 if empty == "events" else 1)
    if empty == "places":
        assert got[0].city == "Unknown"


def test_versions_share_what_did_not_change(spark, tmp_path):
    store = DimensionStore(spark, f"{tmp_path}/dimensions")
    with pytest.raises(LookupError):
        store.current()
    with pytest.raises(ValueError):
        store.publish(rates=spark.createDataFrame(RATES, "day date, currency string, rate double"))
    first = dimensions(spark, tmp_path).current()
    later = [(42.1, 12.6, datetime(2024, 1, 5), 20.0, "sun")]
    second = store.publish(more_weather=spark.createDataFrame(
        later, "lat double, lon double, observed_at timestamp_ntz, temp double, weather string"))
    assert first != second == store.current()
    assert (store.read(first).weather.count(), store.read(second).weather.count()) == (2, 3)
    assert store.read(first).places.inputFiles() == store.read(second).places.inputFiles()


def message(**fields):
    return json.dumps({"type": "event", "event_type": "view_page", "user_id": 7, "session_id": "00000000-0000-0000-0000-000000000001",
                       "timestamp": "2024-01-02T05:30:00+00:00", "lat": 60.1, "lon": 10.1, **fields})


def write_lines(path, name, texts):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/.{name}", "w", encoding="utf-8") as out:
        out.write("\n".join(texts) + "\n")
    os.rename(f"{path}/.{name}", f"{path}/{name}")


def drain(spark, base, stage):
    stream = ingest.read_events_stream(spark, f"{base}/in", "text", batch_size=1)
    ingest.start_ingest(stream, f"{base}/raw", f"{base}/checkpoint", then=stage.run if stage else None).awaitTermination()


def test_a_batch_keeps_its_version(spark, rows, tmp_path):
    base = str(tmp_path)
    store = dimensions(spark, base)
    stage = Enrichment(spark, f"{base}/raw", f"{base}/enriched", store)
    write_lines(f"{base}/in", "a.json", [message(quantity=n) for n in range(3)] + [
        json.dumps({"type": "user_location", "user_id": 7, "lat": 42.0, "lon": 12.5})])
    drain(spark, base, stage)
    first = rows(stage.reader(0)("events"))
    assert {r.city for r in stage.reader(0)("events").collect()} == {"Oslo"}
    assert [(r.city, r.country) for r in stage.reader(0)("user_locations").collect()] == [("Rome", "Italy")]
    store.publish(places=spark.createDataFrame([("Lund", "Sweden", 55.7, 13.2)], "city string, country string, lat double, lon double"))
    # the commit of the batch was lost: it runs again, with the version it had
    for name in ("0", ".0.crc"):
        if os.path.exists(f"{base}/checkpoint/commits/{name}"):
            os.remove(f"{base}/checkpoint/commits/{name}")
    write_lines(f"{base}/in", "b.json", [message()])
    drain(spark, base, stage)
    assert rows(stage.read_batches("events", -1, 0)) == first
    assert [r.city for r in stage.read_batches("events", 0, 1).collect()] == ["Lund"]
    assert rows(stage.reader(1)("events").drop("event_id")) == rows(
        stage.reader(0)("events").union(stage.read_batches("events", 0, 1)).drop("event_id"))


def test_landed_batches_are_enriched_once_and_reach_the_star(spark, tmp_path):
    base = str(tmp_path)
    stage = Enrichment(spark, f"{base}/raw", f"{base}/enriched", dimensions(spark, base))
    write_lines(f"{base}/in", "a.json", [message()])
    write_lines(f"{base}/in", "b.json", [message(event_type="purchase", lat=42.0, lon=12.0)])
    drain(spark, base, None)
    assert stage.run_landed(0) == [0]
    incremental.merge_batches(spark, stage.read_batches, f"{base}/star", 0, buckets=4)
    assert stage.run_landed(1) == [1] and stage.run_landed(1) == []
    incremental.merge_batches(spark, stage.read_batches, f"{base}/star", 1, buckets=4)
    star = incremental.Store(spark, f"{base}/star", 4).read("events")
    got = {(r.event_type, r.city, r.weather_desc) for r in star.collect()}
    assert got == {("view_page", "Oslo", "mist"), ("purchase", "Rome", None)}
    assert star.where(F.col("country").isNull()).count() == 0
