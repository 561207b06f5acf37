"""Spatial joins over suppliers and customers at synthetic coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions import geo
from plinth.operators import planning, spatial
from plinth.plans.registry import LAT, LON, located, query, table


def _points(name: str, key: str, cols: str) -> str:
    return f"SELECT {cols}, CAST({LAT.format(k=key)} AS DOUBLE) AS lat, CAST({LON.format(k=key)} AS DOUBLE) AS lon FROM {name}"


def _haversine(a: str, b: str) -> str:
    return f"(2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2)))))"


_CUSTOMERS = _points("customer", "c_custkey", "c_custkey AS id, 'B' || (c_custkey % 200) AS block")
_SUPPLIERS = _points("supplier", "s_suppkey", "s_suppkey AS site, s_name AS name, CASE CAST(s_suppkey % 4 AS INTEGER) WHEN 0 THEN 'Good' WHEN 1 THEN 'Outstanding' WHEN 2 THEN 'Requires improvement' ELSE '' END AS rating, 'B' || (s_suppkey % 300) AS block")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return located(table(spark, sf_dir, "customer"), "c_custkey").select(k.alias("id"), F.concat(F.lit("B"), (k % 200).cast("string")).alias("block"), "lat", "lon")


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rating = F.when(k % 4 == 0, "Good").when(k % 4 == 1, "Outstanding").when(k % 4 == 2, "Requires improvement").otherwise("")
    return located(table(spark, sf_dir, "supplier"), "s_suppkey").select(k.alias("site"), F.col("s_name").alias("name"), rating.alias("rating"), F.concat(F.lit("B"), (k % 300).cast("string")).alias("block"), "lat", "lon")


@query(f"""
WITH c AS ({_CUSTOMERS}), s AS ({_SUPPLIERS}),
b AS (SELECT c.id, s.site, {_haversine("c", "s")} AS d, true AS blocked FROM c JOIN s USING (block)),
g AS (SELECT c.id, s.site, {_haversine("c", "s")} AS d, false AS blocked FROM c JOIN s ON abs(floor(c.lat / 0.01) - floor(s.lat / 0.01)) <= 2 AND abs(floor(c.lon / 0.01) - floor(s.lon / 0.01)) <= 2 WHERE c.block NOT IN (SELECT block FROM s)),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, site) AS pos FROM (SELECT * FROM b UNION ALL SELECT * FROM g))
SELECT id, site, CAST(round(d) AS BIGINT) AS distance, blocked FROM r WHERE pos = 1 AND d <= 4000""")
def nearest_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spatial.nearest(_customers(spark, sf_dir), _suppliers(spark, sf_dir), "id", "block", "site", ["site"], metres=4000)
    return out.select("id", "site", "distance", "blocked")


@query(f"""
WITH c AS ({_CUSTOMERS}), s AS ({_SUPPLIERS}),
p AS (SELECT c.id, CAST(round({_haversine("c", "s")}) AS BIGINT) AS m, site, name, rating FROM c JOIN s ON {_haversine("c", "s")} <= 4000),
k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY m, site) AS pos, CASE WHEN rating LIKE 'Outstanding%' THEN 0 WHEN rating LIKE 'Good%' THEN 1 WHEN rating <> '' THEN 2 END AS tier FROM p)
SELECT id, string_agg(name || ':' || m, ' ' ORDER BY pos) AS nearest, arg_min(name, tier * 1000000 + pos) FILTER (WHERE tier IS NOT NULL) AS best FROM k WHERE pos <= 5 GROUP BY id""")
def radius_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spatial.nearest_listed(_customers(spark, sf_dir), _suppliers(spark, sf_dir), "id", "name", "rating", 4000, order="site")
    shown = F.array_join(F.transform("nearest", lambda s: F.concat(s["name"], F.lit(":"), s["metres"].cast("string"))), " ")
    return out.select("id", shown.alias("nearest"), F.col("best.name").alias("best"))


@query(f"""
WITH c AS ({_CUSTOMERS}), s AS (SELECT site, lat AS slat, lon AS slon FROM ({_SUPPLIERS})),
p AS (SELECT id, {_haversine("c", "c2")} AS d FROM (SELECT * FROM c) c JOIN (SELECT slat AS lat, slon AS lon FROM s) c2 ON abs(c2.lat - c.lat) <= 1200 / 111320.0 AND abs(c2.lon - c.lon) <= 1200 / (111320 * greatest(0.2, cos(radians(c.lat)))))
SELECT id, count(*) AS in_square, count(*) FILTER (WHERE d <= 1200) AS in_circle, count(*) FILTER (WHERE d > 1200) AS outside FROM p GROUP BY 1""")
def square_then_circle(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = _suppliers(spark, sf_dir).withColumnRenamed("site", "site_id")
    return spatial.in_square_then_circle(_customers(spark, sf_dir), sites, "id", 1200)


#: (alert, severity, outer ring, hole): squares with a square hole.
_ALERTS = [("a1", 1, (-0.40, 51.30, 0.10), (-0.37, 51.33, 0.03)), ("a2", 3, (-0.80, 51.10, 0.05), None), ("a3", 2, (-0.10, 51.45, 0.08), None)]


def _ring(x: float, y: float, size: float) -> list[tuple[float, float]]:
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]


def _segments(ring: list[tuple[float, float]]) -> list[tuple[float, float, float, float]]:
    return [(*a, *b) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]


_SEGMENTS = ", ".join(f"('{a}', {sev}, {r}, {s[0]!r}, {s[1]!r}, {s[2]!r}, {s[3]!r})" for a, sev, outer, hole in _ALERTS for r, ring in enumerate([outer, hole]) if ring for s in _segments(_ring(*ring)))


@query(f"""
WITH c AS ({_CUSTOMERS}), seg(alert_id, severity, ring, ax, ay, bx, by_) AS (VALUES {_SEGMENTS}),
x AS (SELECT id, alert_id, severity, ring, (ax - lon) * 111.320 * greatest(0.01, cos(radians(lat))) AS sx, (ay - lat) * 110.574 AS sy, (bx - ax) * 111.320 * greatest(0.01, cos(radians(lat))) AS dx, (by_ - ay) * 110.574 AS dy,
  CASE WHEN (ay > lat) <> (by_ > lat) AND lon < ax + (lat - ay) * (bx - ax) / (by_ - ay) THEN 1 ELSE 0 END AS crossed FROM c CROSS JOIN seg),
y AS (SELECT *, CASE WHEN dx * dx + dy * dy <= 0 THEN 0 ELSE greatest(0, least(1, -(sx * dx + sy * dy) / (dx * dx + dy * dy))) END AS t FROM x),
r AS (SELECT id, alert_id, severity, ring, sum(crossed) % 2 AS inside, min(sqrt(pow(sx + t * dx, 2) + pow(sy + t * dy, 2))) AS d FROM y GROUP BY ALL),
a AS (SELECT id, alert_id, severity, CASE WHEN max(CASE WHEN ring = 0 THEN inside END) = 1 AND coalesce(max(CASE WHEN ring = 1 THEN inside END), 0) = 0 THEN 0 ELSE min(d) END AS d FROM r GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY severity, d, alert_id) AS pos, count(*) OVER (PARTITION BY id) AS n FROM a WHERE d <= 5)
SELECT id, n AS alerts, severity, CAST(round(d, 3) AS DOUBLE) AS nearest_km, n || CASE WHEN n = 1 THEN ' active alert within 5km' ELSE ' active alerts within 5km' END AS status FROM k WHERE pos = 1""")
def polygon_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import json

    rows = [(a, sev, json.dumps({"type": "Polygon", "coordinates": [_ring(*r) for r in (outer, hole) if r]})) for a, sev, outer, hole in _ALERTS]
    alerts = spark.createDataFrame(rows, "alert_id string, severity int, shape string").withColumn("polygons", geo.geojson_polygons("shape"))
    near = spatial.polygon_alerts(_customers(spark, sf_dir), alerts, "id", 5.0)
    return planning.flood_summary(near, "id", 5.0)


@query(f"""
WITH s AS ({_SUPPLIERS})
SELECT site, 'POLYGON((' || w || ' ' || so || ',' || e || ' ' || so || ',' || e || ' ' || n || ',' || w || ' ' || n || ',' || w || ' ' || so || '))' AS square,
  CASE WHEN m < 950 THEN CAST(round_even(m / 10, 0) AS BIGINT) * 10 || 'm' ELSE printf('%.1f', m / 1000) || 'km' END AS away, 'c. ' || greatest(1, CAST(round_even(m * 1.25 / 80, 0) AS BIGINT)) || ' min' AS walk
FROM (SELECT site, printf('%.7f', lon - 1200 / (111320 * greatest(0.2, cos(radians(lat))))) AS w, printf('%.7f', lon + 1200 / (111320 * greatest(0.2, cos(radians(lat))))) AS e,
  printf('%.7f', lat - 1200 / 111320.0) AS so, printf('%.7f', lat + 1200 / 111320.0) AS n, CAST(site * 37 + 3.3 AS DOUBLE) AS m FROM s)""")
def wkt_and_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = (F.col("site") * 37 + 3.3).cast("double")
    return _suppliers(spark, sf_dir).select("site", geo.wkt_square(F.col("lat"), F.col("lon"), 1200.0).alias("square"), geo.distance_text(m).alias("away"), geo.walk_text(m).alias("walk"))


@query()
def grid_to_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """National grid metres around the suppliers' keys, as degrees."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k.alias("site"), geo.bng_to_wgs84((480000 + k * 37 % 60000).cast("double"), (130000 + k * 91 % 50000).cast("double")).alias("p")).select("site", F.round("p.lat", 6).alias("lat"), F.round("p.lon", 6).alias("lon"))


