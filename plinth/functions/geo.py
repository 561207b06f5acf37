"""Distances, grids, well-known text and polygons as expressions over doubles and arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.functions.text import text

EARTH_M = 6_371_000.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.least(F.lit(1.0), half)))


def valid_point(lat: Column, lon: Column) -> Column:
    """struct<lat, lon> if both are finite numbers, else null."""
    ok = (F.abs(lat) <= 90) & (F.abs(lon) <= 180) & ~F.isnan(lat) & ~F.isnan(lon)
    return F.when(F.coalesce(ok, F.lit(False)), F.struct(lat.alias("lat"), lon.alias("lon")))


def cell(c: Column, size: float = 0.01) -> Column:
    return F.floor(c / size).cast("long")


def wkt_point(c: Column | str) -> Column:
    pattern = r"(?i)POINT\s*\(\s*(-?[0-9.]+)\s+(-?[0-9.]+)\s*\)"
    lon, lat = F.regexp_extract(text(c), pattern, 1).try_cast("double"), F.regexp_extract(text(c), pattern, 2).try_cast("double")
    return valid_point(lat, lon)


def box(lat: Column, lon: Column, metres: float) -> tuple[Column, Column, Column, Column]:
    """(west, south, east, north) of a square around a point."""
    dy = F.lit(metres / 111_320)
    dx = F.lit(float(metres)) / (111_320 * F.greatest(F.lit(0.2), F.cos(F.radians(lat))))
    return lon - dx, lat - dy, lon + dx, lat + dy


def wkt_square(lat: Column, lon: Column, metres: float) -> Column:
    west, south, east, north = box(lat, lon, metres)
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    return F.concat(F.lit("POLYGON(("), F.concat_ws(",", *[F.format_string("%.7f %.7f", x, y) for x, y in corners]), F.lit("))"))


def distance_text(m: Column) -> Column:
    """'940m' below 950 metres (to the nearest ten), then '1.2km'; '' for null. Exact ties of the kilometre form go up."""
    near = F.concat(F.bround(m / 10).cast("long") * 10, F.lit("m"))
    return F.when(m.isNull(), "").when(m < 950, near).otherwise(F.format_string("%.1fkm", m / 1000))


def walk_text(m: Column) -> Column:
    return F.when(m.isNull(), "").otherwise(F.concat(F.lit("c. "), F.greatest(F.lit(1), F.bround(m * 1.25 / 80).cast("long")).cast("string"), F.lit(" min")))


def _segments(ring: Column) -> Column:
    """Pairs of neighbouring points, the last with the first; ring: array<struct<lon, lat>>."""
    turned = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, turned, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def in_ring(lat: Column, lon: Column, ring: Column) -> Column:
    """Even-odd rule: how many edges a ray to the east crosses."""

    def crosses(s: Column) -> Column:
        a, b = s["a"], s["b"]
        at = a["lon"] + (lat - a["lat"]) * (b["lon"] - a["lon"]) / F.nullif(b["lat"] - a["lat"], F.lit(0.0))
        return ((a["lat"] > lat) != (b["lat"] > lat)) & (lon < at)

    return F.size(F.filter(_segments(ring), crosses)) % 2 == 1


def ring_distance_km(lat: Column, lon: Column, ring: Column) -> Column:
    """Least distance to the ring's edges on the local plane."""
    kx, ky = 111.320 * F.greatest(F.lit(0.01), F.cos(F.radians(lat))), 110.574

    def away(s: Column) -> Column:
        ax, ay = (s["a"]["lon"] - lon) * kx, (s["a"]["lat"] - lat) * ky
        dx, dy = (s["b"]["lon"] - s["a"]["lon"]) * kx, (s["b"]["lat"] - s["a"]["lat"]) * ky
        length = dx * dx + dy * dy
        t = F.when(length <= 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(ax * dx + ay * dy) / length)))
        return F.sqrt(F.pow(ax + t * dx, 2) + F.pow(ay + t * dy, 2))

    return F.array_min(F.transform(_segments(ring), away))


def polygon_distance_km(lat: Column, lon: Column, outer: Column, holes: Column) -> Column:
    """0 inside the outer ring and no hole, else the distance to the nearest edge of any ring. A polygon without outer ring has none."""
    inside = in_ring(lat, lon, outer) & ~F.exists(holes, lambda h: in_ring(lat, lon, h))
    edges = F.array_min(F.concat(F.array(ring_distance_km(lat, lon, outer)), F.transform(holes, lambda h: ring_distance_km(lat, lon, h))))
    return F.when(F.coalesce(F.size(outer), F.lit(0)) < 4, F.lit(None).cast("double")).otherwise(F.when(inside, 0.0).otherwise(edges))


def geojson_polygons(c: Column | str) -> Column:
    """array<struct<outer, holes>> of a GeoJSON Polygon or MultiPolygon text. Rings of fewer than 4 points are dropped, and with an outer ring its polygon."""
    raw = F.col(c) if isinstance(c, str) else c
    kind = F.get_json_object(raw, "$.type")
    coordinates = F.get_json_object(raw, "$.coordinates")
    many = F.when(kind == "MultiPolygon", F.from_json(coordinates, "array<array<array<array<double>>>>")).when(kind == "Polygon", F.array(F.from_json(coordinates, "array<array<array<double>>>")))

    def ring(r: Column) -> Column:
        return F.transform(F.filter(r, lambda p: F.size(p) >= 2), lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")))

    made = F.transform(many, lambda poly: F.struct(ring(poly[0]).alias("outer"), F.filter(F.transform(F.slice(poly, 2, F.greatest(F.size(poly) - 1, F.lit(0))), ring), lambda h: F.size(h) >= 4).alias("holes")))
    return F.coalesce(F.filter(made, lambda p: F.size(p["outer"]) >= 4), F.array().cast("array<struct<outer:array<struct<lon:double,lat:double>>,holes:array<array<struct<lon:double,lat:double>>>>>"))


def _grid_to_wgs84(e: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """British National Grid metres to WGS84 degrees: inverse transverse Mercator on Airy 1830, then a Helmert shift (about 5 m)."""
    a, b, f0 = 6377563.396, 6356256.909, 0.9996012717
    lat0, lon0, n0, e0 = np.radians(49), np.radians(-2), -100000.0, 400000.0
    e2, k = 1 - b * b / (a * a), (a - b) / (a + b)

    def arc(phi: np.ndarray) -> np.ndarray:
        d, s = phi - lat0, phi + lat0
        return b * f0 * ((1 + k + 1.25 * k**2 + 1.25 * k**3) * d - (3 * k + 3 * k**2 + 21 / 8 * k**3) * np.sin(d) * np.cos(s) + (15 / 8 * (k**2 + k**3)) * np.sin(2 * d) * np.cos(2 * s) - 35 / 24 * k**3 * np.sin(3 * d) * np.cos(3 * s))

    phi = np.full(e.shape, lat0)
    for _ in range(8):
        phi = phi + (n - n0 - arc(phi)) / (a * f0)
    s2 = np.sin(phi) ** 2
    nu, rho = a * f0 / np.sqrt(1 - e2 * s2), a * f0 * (1 - e2) / (1 - e2 * s2) ** 1.5
    eta, t, sec, x = nu / rho - 1, np.tan(phi), 1 / np.cos(phi), e - e0
    lat = phi - t / (2 * rho * nu) * x**2 + t / (24 * rho * nu**3) * (5 + 3 * t**2 + eta - 9 * t**2 * eta) * x**4 - t / (720 * rho * nu**5) * (61 + 90 * t**2 + 45 * t**4) * x**6
    lon = lon0 + sec / nu * x - sec / (6 * nu**3) * (nu / rho + 2 * t**2) * x**3 + sec / (120 * nu**5) * (5 + 28 * t**2 + 24 * t**4) * x**5
    v = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    x1, y1, z1 = v * np.cos(lat) * np.cos(lon), v * np.cos(lat) * np.sin(lon), v * (1 - e2) * np.sin(lat)
    rx, ry, rz = (np.radians(s / 3600) for s in (0.1502, 0.2470, 0.8421))
    scale = 1 - 20.4894e-6
    x2 = 446.448 + scale * x1 - rz * y1 + ry * z1
    y2 = -125.157 + rz * x1 + scale * y1 - rx * z1
    z2 = 542.060 - ry * x1 + rx * y1 + scale * z1
    wa, we2 = 6378137.0, 0.00669437999014
    p = np.hypot(x2, y2)
    out = np.arctan2(z2, p * (1 - we2))
    for _ in range(6):
        w = wa / np.sqrt(1 - we2 * np.sin(out) ** 2)
        out = np.arctan2(z2 + we2 * w * np.sin(out), p)
    return np.degrees(out), np.degrees(np.arctan2(y2, x2))


@F.pandas_udf(T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]))
def bng_to_wgs84(easting: pd.Series, northing: pd.Series) -> pd.DataFrame:
    lat, lon = _grid_to_wgs84(easting.to_numpy(float), northing.to_numpy(float))
    return pd.DataFrame({"lat": lat, "lon": lon})
