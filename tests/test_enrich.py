"""Places: the nearest of all, whatever the grid."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketflow.operators import enrich
from basketflow.operators.enrich import geo_lookup

PLACES = "city string, country string, lat double, lon double"
POINTS = "id long, lat double, lon double, city string, country string"


def km(lat1, lon1, lat2, lon2):
    a, b, c, d = map(math.radians, (lat1, lon1, lat2, lon2))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(h, 1)))


@pytest.mark.parametrize("leaf,hot_rows", [(32, 1_000_000), (1, 5), (4, 1_000_000)])
def test_nearest_of_all_places(spark, leaf, hot_rows, monkeypatch):
    monkeypatch.setattr(enrich, "LEAF", leaf)
    rng = random.Random(5)
    places = [(f"p{i}", "c", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(40)]
    places += [("far", "c", 45.9, 10.9), ("near", "c", 45.01, 9.45), ("polar", "c", 89.5, -170.0),
               ("Black Sea", "c", 45.01, 10.01), (None, "c", 45.01, 10.01), ("nowhere", "c", None, 1.0)]
    points = [(45.01, 10.01), (89.9, 10.0), (80.0, 10.01), (-90.0, 0.0), (0.0, 179.99), (0.0, -180.0), (12.0, 180.0)]
    points += [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)] + [(45.01, 10.01)] * 20
    rows = [(i, a, b, "x", "x") for i, (a, b) in enumerate(points)] + [(-1, None, 3.0, "x", "x")]
    found = geo_lookup(spark.createDataFrame(rows, POINTS), spark.createDataFrame(places, PLACES),
                       ["id"], hot_rows)
    land = [p for p in places if p[0] not in ("Black Sea", None, "nowhere")]
    want = {i: min(land, key=lambda p: km(a, b, p[2], p[3]))[0] for i, (a, b) in enumerate(points)}
    assert {r.id: r.city for r in found.collect()} == want | {-1: "Unknown"}
    assert want[0] == "near"


def test_no_places(spark):
    found = geo_lookup(spark.createDataFrame([(1, 1.0, 1.0, "x", "x")], POINTS),
                       spark.createDataFrame([], PLACES), ["id"])
    assert [(r.city, r.country) for r in found.collect()] == [("Unknown", None)]


def test_far_points_meet_few_of_very_many_places(spark):
    """Two thousand points in the sea and a coast of 60,000 places, a third of them in one town."""
    places = spark.range(60_000).selectExpr(
        "concat('p', id) as city", "'c' as country",
        "case when id % 3 = 0 then 45 + id * 1e-7 else (id * 37 % 9000) / 150.0 - 30 end as lat",
        "case when id % 3 = 0 then 10 + id * 1e-7 else 20 + (id * 61 % 7000) / 1000.0 end as lon")
    points = spark.range(2000).selectExpr("id", "(id * 13 % 1000) / 10.0 - 50 as lat", "-20 - (id * 7 % 900) / 20.0 as lon",
                                          "'x' as city", "'x' as country")
    land = places.withColumnsRenamed({"lat": "p_lat", "lon": "p_lon"})
    tree = enrich.place_tree(land).cache()
    axes = enrich._on_globe("lat", "lon")
    asked = points.select(F.lit(enrich.COARSEST).alias("q_level"), enrich._cube(axes, enrich.COARSEST).alias("q_cube")).distinct()
    near = enrich._leaves_near(asked, tree)
    assert near.count() / asked.count() < 0.02 * tree.where("leaf").count()
    found = {r.id: r.city for r in geo_lookup(points, places, ["id"]).collect()}
    land = [(r.p_lat, r.p_lon, r.city) for r in land.collect()]
    lat, lon = np.radians([p[0] for p in land]), np.radians([p[1] for p in land])
    for r in points.where("id % 40 = 0").collect():
        a, b = math.radians(r.lat), math.radians(r.lon)
        h = np.sin((lat - a) / 2) ** 2 + math.cos(a) * np.cos(lat) * np.sin((lon - b) / 2) ** 2
        assert h[[p[2] for p in land].index(found[r.id])] <= h.min() * (1 + 1e-9)
