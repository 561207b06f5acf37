"""Spatial joins as equi-joins on grid cells, with exact distances after them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.geo import cell, haversine_m, polygon_distance_km
from plinth.operators.dedup import spread, top_k


def _cells(low: Column, high: Column, size: float) -> Column:
    return F.explode(F.sequence(cell(low, size), cell(high, size)))


def within(points: DataFrame, sites: DataFrame, metres: float, site_columns: list[str], max_latitude: float = 70.0) -> DataFrame:
    """Pairs of a point and a site at most ``metres`` apart, with ``distance`` in metres.

    points have lat and lon; sites too, and ``site_columns``. Sites are copied to the cells around them, so every join
    is on equal cells, whichever side is large. Columns of the two must not clash.
    """
    size = max(metres / 111_000 * 1.01, 1e-4)
    wide = size / math.cos(math.radians(max_latitude))
    s = sites.select(*site_columns, F.col("lat").alias("__lat"), F.col("lon").alias("__lon"))
    s = s.withColumn("__y", _cells(F.col("__lat") - size, F.col("__lat") + size, size)).withColumn("__x", _cells(F.col("__lon") - wide, F.col("__lon") + wide, wide))
    p = points.withColumn("__y", cell(F.col("lat"), size)).withColumn("__x", cell(F.col("lon"), wide))
    pairs = p.join(s, ["__y", "__x"]).withColumn("distance", haversine_m(F.col("lat"), F.col("lon"), F.col("__lat"), F.col("__lon")))
    return pairs.where(F.col("distance") <= metres).drop("__y", "__x", "__lat", "__lon")


#: Levels of the grid in ``_closest``, each of half the size: from the whole reach to a few metres. Cells are wider than high by so much.
_LEVELS, _WIDER = 10, 1.6


def _closest(points: DataFrame, sites: DataFrame, keys: list[str], most: int, metres: float, certain: float = 90.0) -> DataFrame:
    """Pairs of a point and its sites that may be among the ``most`` closest within ``metres``, with ``distance``: all that are, and few others.

    points: ``keys``, lat, lon, a place once; sites: ``keys``, __lat, __lon, others. The smallest cell around a point that
    holds enough sites says how far these are at most, and only cells within that are looked at, so pairs grow with the
    points, however close sites lie. A metre is added, so rounding to metres leaves no tie out. ``certain``: larger cells,
    in degrees, don't count as enough.
    """
    sizes = F.array(*[F.lit(max(metres / 111_000 * 1.01, 1e-4) / 2**k) for k in range(_LEVELS)])
    size = F.get(sizes, F.col("__level"))
    levels = F.explode(F.sequence(F.lit(0), F.lit(_LEVELS - 1))).alias("__level")

    def y(c: Column) -> Column:
        return F.floor(c / size).cast("long")

    def x(c: Column) -> Column:
        return F.floor(c / (size * _WIDER)).cast("long")

    cells = [*keys, "__level", "__y", "__x"]
    tiled = sites.select("*", levels).withColumn("__y", y(F.col("__lat"))).withColumn("__x", x(F.col("__lon")))
    full = tiled.groupBy(*cells).agg(F.count("*").alias("__n")).where((F.col("__n") >= most) & (size * _WIDER <= certain)).drop("__n")
    own = points.select(*keys, "lat", "lon", levels).withColumn("__y", y(F.col("lat"))).withColumn("__x", x(F.col("lon")))
    found = own.join(full, cells, "left_semi").groupBy(*keys, "lat", "lon").agg(F.max("__level").alias("__level"))
    at = spread(points.select(*keys, "lat", "lon").join(found, [*keys, "lat", "lon"], "left"), "lat", "__level")
    # No site of a cell is farther than its height and its width, taken where it is widest.
    wide = F.cos(F.radians(F.greatest(F.lit(0.0), F.abs("lat") - size)))
    reach = F.least(F.lit(float(metres)), F.hypot(size, size * _WIDER * wide) * 111_320 * 1.01) + 1
    at = at.withColumn("__reach", F.when(F.col("__level").isNull(), metres + 1.0).otherwise(reach)).withColumn("__level", F.coalesce("__level", F.lit(0)))
    up = F.col("__reach") / 111_000
    across = F.least(F.lit(360.0), up / F.greatest(F.lit(0.001), F.cos(F.radians(F.least(F.lit(90.0), F.abs("lat") + up)))))
    around = at.withColumn("__y", F.explode(F.sequence(y(F.col("lat") - up), y(F.col("lat") + up)))).withColumn("__x", F.explode(F.sequence(x(F.col("lon") - across), x(F.col("lon") + across))))
    away = around.join(tiled, cells).withColumn("distance", haversine_m(F.col("lat"), F.col("lon"), F.col("__lat"), F.col("__lon")))
    return away.where((F.col("distance") <= F.col("__reach")) & (F.col("distance") <= metres)).drop("__level", "__y", "__x", "__reach")


def nearest(points: DataFrame, sites: DataFrame, point_id: str, block: str, order: str, site_columns: list[str], metres: float = 150.0, grid: float = 0.01, ring: int = 2) -> DataFrame:
    """The nearest site of each point, at most ``metres`` away; among sites of the point's block if it has any, else of the cells around it.

    Adds the site's columns, ``distance`` in whole metres and ``blocked`` (by block or by grid); points without a site
    are left out. Ties go to the least ``order``. A point whose block has sites takes none from elsewhere, however near.
    Points of one place and block are looked up once; of sites in one place only the first by ``order`` counts.
    """
    s = sites.select(F.struct(*site_columns).alias("__site"), F.coalesce(F.col(block), F.lit("")).alias("__block"), F.col(order).alias("__order"), F.col("lat").alias("__lat"), F.col("lon").alias("__lon")).where("__lat is not null and __lon is not null")
    p = points.withColumn("__block", F.coalesce(F.col(block), F.lit("")))
    places = p.select("__block", "lat", "lon").distinct()
    blocks = sites.select(F.col(block).alias("__block")).where("__block <> ''").distinct()
    inside, alone = places.join(blocks, "__block", "left_semi"), places.join(blocks, "__block", "left_anti")
    by_block = _closest(inside, top_k(s, ["__block", "__lat", "__lon"], [F.col("__order")], 1), ["__block"], 1, metres)
    anywhere = top_k(s.drop("__block"), ["__lat", "__lon"], [F.col("__order")], 1)
    by_grid = _closest(alone.select("lat", "lon").distinct(), anywhere, [], 1, metres, grid * ring / 2)
    for one, other in (("lat", "__lat"), ("lon", "__lon")):
        by_grid = by_grid.where(F.abs(cell(F.col(one), grid) - cell(F.col(other), grid)) <= ring)
    by_grid = top_k(by_grid, ["lat", "lon"], [F.col("distance"), F.col("__order")], 1).join(alone, ["lat", "lon"])
    by_block = top_k(by_block, ["__block", "lat", "lon"], [F.col("distance"), F.col("__order")], 1)
    both = by_block.withColumn("blocked", F.lit(True)).unionByName(by_grid.withColumn("blocked", F.lit(False)))
    best = p.join(both.drop("__lat", "__lon"), ["__block", "lat", "lon"])
    best = top_k(best, [point_id], [F.col("distance"), F.col("__order")], 1)
    return best.select(*points.columns, "__site.*", F.round("distance").cast("long").alias("distance"), "blocked")


def nearest_listed(points: DataFrame, sites: DataFrame, point_id: str, name: str, rating: str, metres: float = 4000.0, most: int = 5, ratings: tuple[str, ...] = ("Outstanding", "Good"), order: str | None = None) -> DataFrame:
    """(point_id, nearest, best): the ``most`` nearest sites as structs by whole metres, and the best rated one of these: the nearest of the first rating that occurs, else the nearest rated at all.

    Ties go by ``order``, a column of the sites (their place in the source), or else by name. Only the nearest of a
    point are gathered, however many are within reach; points of one place are looked up once.
    """
    own = [name, rating] if order in (None, name, rating) else [name, rating, order]
    places = points.select("lat", "lon").distinct()
    few = top_k(sites.select(*own, F.col("lat").alias("__lat"), F.col("lon").alias("__lon")).where("__lat is not null and __lon is not null"), ["__lat", "__lon"], [F.col(c) for c in dict.fromkeys([order or name, name, rating])], most)
    pairs = _closest(places, few, [], most, metres).withColumn("metres", F.round("distance").cast("long"))
    entry = F.struct("metres", F.col(order or name).alias("order"), F.col(name).alias("name"), F.col(rating).alias("rating"))
    near = top_k(pairs.select("lat", "lon", entry.alias("__entry")), ["lat", "lon"], [F.col("__entry")], most)
    listed = near.groupBy("lat", "lon").agg(F.array_sort(F.collect_list("__entry")).alias("nearest"))
    # Rows of one point_id are one point, which may be in several places.
    gathered = points.select(point_id, "lat", "lon").join(listed, ["lat", "lon"]).groupBy(point_id).agg(F.flatten(F.collect_list("nearest")).alias("nearest"))
    listed = gathered.withColumn("nearest", F.slice(F.array_sort("nearest"), 1, most))
    every = listed.withColumn("nearest", F.transform("nearest", lambda s: F.struct(s["metres"].alias("metres"), s["name"].alias("name"), s["rating"].alias("rating"))))

    def first_of(wanted: str) -> Column:
        return F.get(F.filter("nearest", lambda s: F.coalesce(F.lower(s["rating"]).contains(wanted.lower()), F.lit(False))), 0)

    picks = [first_of(r) for r in ratings]
    best = F.coalesce(*picks, F.get(F.filter("nearest", lambda s: F.coalesce(s["rating"], F.lit("")) != ""), 0))
    return every.select(point_id, "nearest", best.alias("best"))


def polygon_alerts(points: DataFrame, alerts: DataFrame, point_id: str, km: float = 5.0) -> DataFrame:
    """(point_id, alert_id, severity, distance_km): polygons at most ``km`` away, 0 inside.

    points: lat, lon; alerts: alert_id, severity, polygons array<struct<outer, holes>>. Bounding boxes, widened by the
    distance, are cut into cells for an equi-join; exact distances follow. Null severity sorts last, as 9.
    """
    size = max(km / 100.0, 0.02)
    poly = alerts.select("alert_id", F.coalesce("severity", F.lit(9)).alias("severity"), F.explode("polygons").alias("p")).where(F.size("p.outer") >= 4)
    lats, lons = F.transform("p.outer", lambda q: q["lat"]), F.transform("p.outer", lambda q: q["lon"])
    south, north = F.array_min(lats) - km / 110.574, F.array_max(lats) + km / 110.574
    reach = km / (111.320 * F.greatest(F.lit(0.01), F.cos(F.radians(F.greatest(F.abs(south), F.abs(north))))))
    boxed = poly.withColumn("__s", south).withColumn("__n", north).withColumn("__w", F.array_min(lons) - reach).withColumn("__e", F.array_max(lons) + reach)
    tiled = boxed.withColumn("__y", _cells(F.col("__s"), F.col("__n"), size)).withColumn("__x", _cells(F.col("__w"), F.col("__e"), size))
    p = points.select(point_id, "lat", "lon").withColumn("__y", cell(F.col("lat"), size)).withColumn("__x", cell(F.col("lon"), size))
    near = p.join(tiled, ["__y", "__x"]).where("lat between __s and __n and lon between __w and __e")
    away = near.withColumn("d", polygon_distance_km(F.col("lat"), F.col("lon"), F.col("p.outer"), F.col("p.holes"))).where(F.col("d") <= km)
    return away.groupBy(point_id, "alert_id").agg(F.min("severity").alias("severity"), F.min("d").alias("distance_km"))


def in_square_then_circle(points: DataFrame, sites: DataFrame, point_id: str, metres: float = 1200.0) -> DataFrame:
    """(point_id, in_square, in_circle, outside): counts of a square prefilter and of the exact radius after it.

    Places are counted first, points and sites alike, so pairs grow with the different places."""
    places, counted = [df.where("lat is not null and lon is not null").groupBy("lat", "lon").agg(F.count("*").alias("__n")) for df in (points, sites)]
    pairs = within(spread(places.select("lat", "lon"), "lat"), counted, metres * 1.5, ["__n", F.col("lat").alias("slat"), F.col("lon").alias("slon")])  # type: ignore[list-item]
    dy = metres / 111_320
    dx = F.lit(metres) / (111_320 * F.greatest(F.lit(0.2), F.cos(F.radians("lat"))))
    square = pairs.where((F.abs(F.col("slat") - F.col("lat")) <= dy) & (F.abs(F.col("slon") - F.col("lon")) <= dx))

    def total(c: Column, n: str) -> Column:
        return F.coalesce(F.sum(F.when(c, F.col(n))), F.lit(0))

    near = F.col("distance") <= metres
    by_place = square.groupBy("lat", "lon").agg(F.sum("__n").alias("in_square"), total(near, "__n").alias("in_circle"), total(~near, "__n").alias("outside"))
    both = points.select(point_id, "lat", "lon").join(by_place, ["lat", "lon"])
    return both.groupBy(point_id).agg(*[F.sum(c).alias(c) for c in ("in_square", "in_circle", "outside")])
