"""Enrichment of events by joins: currency rates, places, weather."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.functions import day
from basketflow.operators.skew import HOT_ROWS, split_join
from basketflow.session import scratch_dir

# Words that mark a place name as water (case counts), target currencies.
WATER_WORDS = ["Ocean", "Sea", "Gulf", "Bay"]
CURRENCIES = ["EUR", "RUB"]
EARTH_RADIUS_KM = 6371.0


def _converted(price: str, rate: Column) -> Column:
    return F.round(F.col(price) * rate, 2).cast("decimal(18,2)")


def convert_currency(df: DataFrame, rates: DataFrame, price: str = "cost_usd") -> DataFrame:
    """Add ``cost_eur`` and ``cost_rub`` at the rates (currency, rate); no rate, no value.

    Each rate is one value and is read by a scalar subquery.
    """
    def rate(currency: str) -> Column:
        return rates.where(F.col("currency") == currency).agg(F.max("rate")).scalar()

    return df.withColumns({f"cost_{c.lower()}": _converted(price, rate(c)) for c in CURRENCIES})


def convert_currency_as_of(df: DataFrame, rates: DataFrame, ts: str,
                           price: str = "cost_usd") -> DataFrame:
    """The same with daily rates (day, currency, rate): the last rate up to the row's day.

    The rates are first carried forward to every day that occurs, so the join is by
    equal days.  The joined table has a row per calendar day and is safe to broadcast:
    all days of the years 1 to 9999 are 3.7 million rows.
    """
    wide = rates.groupBy("day").agg(*[
        F.max(F.when(F.col("currency") == c, F.col("rate"))).alias(c) for c in CURRENCIES])
    needed = df.select(day(ts).alias("day")).where("day IS NOT NULL").distinct()
    up_to_day = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    by_day = needed.join(wide, "day", "full_outer").select(
        F.col("day").alias("_day"),
        *[F.last(c, ignorenulls=True).over(up_to_day).alias(f"_{c}") for c in CURRENCIES])
    joined = df.join(F.broadcast(by_day), day(ts) == F.col("_day"), "left")
    return joined.withColumns({
        f"cost_{c.lower()}": _converted(price, F.col(f"_{c}")) for c in CURRENCIES
    }).drop("_day", *[f"_{c}" for c in CURRENCIES])


# --- places -------------------------------------------------------------------
# Places lie in a tree of cubes around the globe: a cube with more than LEAF places is cut into
# 4 x 4 x 4, down to DEEPEST (about 3 km).  Cubes know no poles and no date line.
LEAF, DEEPEST = 32, 6
# Points are looked up together by cubes of this level (about 50 km), or finer ones where places are dense; where
# the whole tree is shallow, by cubes one level below it.
COARSEST = 4
# Added to squared distances (of the unit globe), more than the error of the arithmetic.
_SLACK = 1e-12


def haversine_km(lat1: str | Column, lon1: str | Column, lat2: str | Column, lon2: str | Column) -> Column:
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.sin((phi2 - phi1) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    h = half_lat * half_lat + F.cos(phi1) * F.cos(phi2) * half_lon * half_lon
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _on_globe(lat: str, lon: str) -> list[Column]:
    """x, y, z on the unit globe."""
    around = F.cos(F.radians(lat))
    return [around * F.cos(F.radians(lon)), around * F.sin(F.radians(lon)), F.sin(F.radians(lat))]


def _cube(axes: Sequence[Column], level: int) -> Column:
    """The cube of a level that holds a point: 13 bits for each axis."""
    sides = 4 ** level
    parts = [F.least(F.floor((v + 1) * (sides / 2)).cast("bigint"), F.lit(sides - 1)) for v in axes]
    return F.shiftleft(parts[0], 26) + F.shiftleft(parts[1], 13) + parts[2]


def _centre(cube: str, level: Column) -> tuple[list[Column], Column]:
    """The middle of a cube, and half its side."""
    half = F.pow(F.lit(4.0), -level)
    index = [F.shiftright(cube, 26), F.shiftright(cube, 13).bitwiseAND(8191), F.col(cube).bitwiseAND(8191)]
    return [(i * 2 + 1) * half - 1 for i in index], half


def place_tree(places: DataFrame) -> DataFrame:
    """(level, cube, parent, leaf, x, y, z): the cubes with places, each with one of its places.

    ``places`` has p_lat and p_lon.
    """
    axes = _on_globe("p_lat", "p_lon")
    levels = F.inline(F.array(*[
        F.struct(F.lit(level).alias("level"), _cube(axes, level).alias("cube"),
                 (_cube(axes, level - 1) if level > 1 else F.lit(0).cast("bigint")).alias("parent"))
        for level in range(1, DEEPEST + 1)]))
    cubes = (places.select(levels, F.struct(*[v.alias(n) for v, n in zip(axes, "xyz")]).alias("some"))
             .groupBy("level", "cube", "parent").agg(F.count(F.lit(1)).alias("n"), F.min("some").alias("some")))
    cut = cubes.where(F.col("n") > LEAF).select((F.col("level") + 1).alias("level"), F.col("cube").alias("parent"))
    inside = cubes.join(cut, ["level", "parent"], "left_semi").unionByName(cubes.where("level = 1"))
    leaf = (F.col("n") <= LEAF) | (F.col("level") == DEEPEST)
    return inside.select("level", "cube", "parent", leaf.alias("leaf"), "some.*")


def _leaves_near(asked: DataFrame, tree: DataFrame, deepest: int = DEEPEST) -> DataFrame:
    """(q_level, q_cube, level, cube): the leaves that hold the nearest place of any point of a cube.

    Down the tree, level by level: a cube stays while it could hold a place nearer than the
    farthest that the nearest known place can be from a point of the asked cube.
    """
    (qx, qy, qz), half = _centre("q_cube", F.col("q_level"))
    open_ = asked.select("q_level", "q_cube", qx.alias("qx"), qy.alias("qy"), qz.alias("qz"), half.alias("q_half"),
                         F.lit(0).cast("bigint").alias("cube"), F.lit(False).alias("leaf"),
                         F.lit(0).alias("level"))
    by_cube = Window.partitionBy("q_level", "q_cube")
    for level in range(1, deepest + 1):
        below = tree.where(F.col("level") == level).select(
            F.col("parent").alias("cube"), F.col("cube").alias("next"), F.col("leaf").alias("next_leaf"), "x", "y", "z")
        kept = open_.columns
        # leaves of higher levels pass through; the tree has no cube below them
        opened = open_.join(below, ["cube"], "left") if level == 1 else open_.join(
            below, (open_["cube"] == below["cube"]) & ~open_["leaf"], "left").drop(below["cube"])
        went = F.col("next").isNotNull()
        opened = opened.withColumns({
            "cube": F.coalesce("next", "cube"), "level": F.when(went, F.lit(level)).otherwise(F.col("level")),
            "leaf": F.coalesce("next_leaf", "leaf")})
        (cx, cy, cz), side = _centre("cube", F.col("level"))
        gaps = [F.greatest(F.abs(F.col(q) - c) - F.col("q_half") - side, F.lit(0.0)) for q, c in zip(("qx", "qy", "qz"), (cx, cy, cz))]
        reach = [F.abs(F.col(q) - F.col(p)) + F.col("q_half") for q, p in zip(("qx", "qy", "qz"), "xyz")]
        far = F.when(went, sum((r * r for r in reach), F.lit(0.0)))
        if "far" in kept:
            far = F.least(far, F.col("far"))
        opened = opened.withColumns({"near": sum((g * g for g in gaps), F.lit(0.0)), "far": far})
        opened = opened.withColumn("far", F.min("far").over(by_cube)).where(F.col("near") <= F.col("far") + _SLACK)
        open_ = opened.select(*kept, *([] if "far" in kept else ["far"]))
    return open_.select("q_level", "q_cube", "level", "cube")


def nearest_places(points: DataFrame, places: DataFrame, hot_rows: int = HOT_ROWS,
                   tree: DataFrame | None = None) -> DataFrame:
    """(lat, lon, city, country) of the nearest place of each distinct point.

    ``points`` has lat and lon, ``places`` city, country, p_lat and p_lon, one place for each
    coordinate.  A point meets only the places of the few leaves that can hold the nearest one.
    ``tree`` is the written ``place_tree`` of the places; without it one is written to a scratch
    folder.  Places that fill one leaf at most need none.
    """
    spark = points.sparkSession
    some = places.select("p_lat", "p_lon", "city", "country").limit(LEAF + 1).collect()
    if not some:
        return points.select("lat", "lon", F.lit(None).cast("string").alias("city"), F.lit(None).cast("string").alias("country"))
    if len(some) <= LEAF:
        few = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in p.asDict().items()]) for p in some])
        ranked = F.transform(few, lambda p: F.struct(
            haversine_km(F.col("lat"), F.col("lon"), p["p_lat"], p["p_lon"]).alias("km"),
            p["city"].alias("city"), p["country"].alias("country")))
        return points.withColumn("near", F.array_min(ranked)).select("lat", "lon", "near.city", "near.country")
    if tree is None:
        path = f"{scratch_dir(spark, 'places')}/tree"
        place_tree(places).write.parquet(path)
        tree = spark.read.parquet(path)
    deepest = tree.agg(F.max("level")).first()[0] or 1
    coarsest = min(COARSEST, deepest + 1)
    axes = _on_globe("lat", "lon")
    placed = points.withColumns({f"c{level}": _cube(axes, level) for level in range(coarsest, max(deepest, coarsest) + 1)})
    depth = F.lit(coarsest)
    dense = tree.where(~F.col("leaf"))
    for level in range(coarsest, deepest):
        cut = dense.where(F.col("level") == level).select(F.col("cube").alias(f"c{level}"), F.lit(level + 1).alias(f"d{level}"))
        placed = placed.join(cut, f"c{level}", "left")
        depth = F.coalesce(F.col(f"d{level}"), depth)
    cube = F.when(depth == coarsest, F.col(f"c{coarsest}"))
    for level in range(coarsest + 1, deepest + 1):
        cube = cube.when(depth == level, F.col(f"c{level}"))
    placed = placed.select("lat", "lon", depth.alias("q_level"), cube.alias("q_cube"))
    near = _leaves_near(placed.select("q_level", "q_cube").distinct(), tree, deepest)
    of_places = _on_globe("p_lat", "p_lon")
    keyed = places.select("city", "country", "p_lat", "p_lon", F.inline(F.array(*[
        F.struct(F.lit(level).alias("level"), _cube(of_places, level).alias("cube")) for level in range(1, deepest + 1)])))
    candidates = near.join(keyed, ["level", "cube"]).drop("level", "cube")
    km = haversine_km("lat", "lon", "p_lat", "p_lon")
    return (split_join(placed, candidates, ["q_level", "q_cube"], "inner", ["lat", "lon"], hot_rows)
            .groupBy("lat", "lon").agg(F.min(F.struct(km.alias("km"), "city", "country")).alias("near"))
            .select("lat", "lon", "near.city", "near.country"))


def land_places(places: DataFrame) -> DataFrame:
    """(city, country, p_lat, p_lon): one place for each coordinate, seas left out."""
    water = "|".join(WATER_WORDS)
    return (places.where(F.col("city").isNotNull() & ~F.col("city").rlike(water))
            .where("lat IS NOT NULL AND lon IS NOT NULL")
            .groupBy(F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
            .agg(F.min(F.struct("city", "country")).alias("first"))
            .select("first.city", "first.country", "p_lat", "p_lon"))


def geo_lookup(df: DataFrame, places: DataFrame, spread_by: Sequence[str], hot_rows: int = HOT_ROWS,
               counted: DataFrame | None = None, tree: DataFrame | None = None) -> DataFrame:
    """Set city and country of each row to the nearest place, seas left out.

    Rows without coordinates, and all rows if there are no places, get the city 'Unknown'
    and the country NULL.  Of equally near places the first by name counts.

    Distinct coordinates are looked up once, then joined back; busy coordinates are split.
    ``spread_by`` tells rows with equal coordinates apart.  ``counted`` names a frame with the
    same coordinates that is cheaper to read.  With a written ``tree`` the places are
    those of ``land_places``.
    """
    land = land_places(places) if tree is None else places
    given = df.drop("city", "country")
    asked = (given if counted is None else counted).select("lat", "lon")
    points = asked.where("lat IS NOT NULL AND lon IS NOT NULL").distinct()
    found = split_join(given, nearest_places(points, land, hot_rows, tree), ["lat", "lon"], "left", spread_by,
                       hot_rows, asked)
    return found.withColumn("city", F.coalesce("city", F.lit("Unknown")))


# the grid of the weather observations
def _cell_row(lat: str, cell: float) -> Column:
    return F.floor((F.col(lat) + 90) / cell).cast("int")


def _cell_column(lon: str, cell: float) -> Column:
    return F.pmod(F.floor((F.col(lon) + 180) / cell), F.lit(ceil(360 / cell))).cast("int")


# --- weather ------------------------------------------------------------------
def weather_lookup(df: DataFrame, weather: DataFrame, ts: str, spread_by: Sequence[str],
                   cell: float = 0.5, hot_rows: int = HOT_ROWS,
                   counted: DataFrame | None = None) -> DataFrame:
    """Add temperature and description observed in the row's grid cell and hour, else NULL.

    ``weather`` has (lat, lon, observed_at, temp, weather); the first observation of an
    hour counts.  ``counted`` names a frame with the same places and times that is cheaper
    to read.
    """
    keys = ["_row", "_col", "_hour"]

    def keyed(frame: DataFrame, at: str) -> DataFrame:
        return frame.withColumns({"_row": _cell_row("lat", cell), "_col": _cell_column("lon", cell),
                                  "_hour": F.date_trunc("hour", F.col(at))})

    first = (keyed(weather, "observed_at").groupBy(*keys)
             .agg(F.min(F.struct("observed_at", "temp", "weather")).alias("seen"))
             .select(*keys, F.col("seen.temp").alias("weather_temp"),
                     F.col("seen.weather").alias("weather_desc")))
    given = keyed(df.drop("weather_temp", "weather_desc"), ts)
    asked = None if counted is None else keyed(counted, ts).select(*keys)
    return split_join(given, first, keys, "left", spread_by, hot_rows, asked).drop(*keys)
