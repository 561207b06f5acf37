"""Enrichment steps around the joins: dimensions, landed sources, corrections and repair of older rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.geo import bng_to_wgs84, haversine_m
from plinth.functions.records import place_kind
from plinth.functions.text import clean, lenient_number, postcode
from plinth.operators.dedup import first_wins, top_k
from plinth.operators.planning import POSITIVE, SILENT
from plinth.sources.feeds import alias_columns

CONTEXT = ("environment_agency", "geocode", "historic_england", "latitude", "longitude", "ofsted", "planning", "planning_constraints", "uprn")


def clear_context(df: DataFrame, fields: tuple[str, ...] = CONTEXT) -> DataFrame:
    return df.drop(*fields)


def in_list(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose normalised postcode is in the (one-column) list."""
    keys = wanted.select(postcode(wanted[wanted.columns[0]]).alias("__wanted")).where("__wanted <> ''").distinct()
    return df.join(keys, postcode(df[column]) == keys["__wanted"], "left_semi")


def geocoded(df: DataFrame, dimension: DataFrame, code: str = "postcode") -> DataFrame:
    """Fills latitude and longitude from (postcode, latitude, longitude) where a row lacks either; adds coordinate_source."""
    dim = first_wins(dimension.select(postcode("postcode").alias("__code"), F.col("latitude").alias("__lat"), F.col("longitude").alias("__lon")), ["__code"], [F.col("__lat"), F.col("__lon")])
    both = df.join(dim, postcode(df[code]) == dim["__code"], "left")
    own = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    found = F.col("__lat").isNotNull() & F.col("__lon").isNotNull()
    source = F.when(own, "row").when(found, "postcode")
    kept = [c for c in df.columns if c not in ("latitude", "longitude", "coordinate_source")]
    return both.select(*kept, F.when(own, F.col("latitude")).when(found, F.round("__lat", 7)).alias("latitude"), F.when(own, F.col("longitude")).when(found, F.round("__lon", 7)).alias("longitude"), source.alias("coordinate_source"))


def corrected(df: DataFrame, corrections: DataFrame, keys: list[str]) -> DataFrame:
    """Sets the columns of a corrections table (keys and new values) on rows that equal it in all keys."""
    new = [c for c in corrections.columns if c not in keys]
    fix = corrections.dropDuplicates(keys).select(*keys, *[F.col(c).alias(f"__{c}") for c in new])
    both = df.join(fix, keys, "left")
    return both.select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in new else F.col(c) for c in df.columns])


def nearby_places(elements: DataFrame, key: str, lat: Column, lon: Column, most: int = 6, stations: int = 1) -> DataFrame:
    """(key, name, kind, metres): named places around a point, each (name, kind) once, the nearest amenities and stations.

    elements: key, ordinal, tags map, place_lat, place_lon. The first element of a (name, kind) wins.
    """
    rows = elements.withColumn("name", clean(F.try_element_at("tags", F.lit("name")))).where("name <> '' and place_lat is not null and place_lon is not null").withColumn("kind", place_kind(F.col("tags")))
    once = first_wins(rows.withColumn("__name", F.lower("name")), [key, "__name", "kind"], [F.col("ordinal")])
    near = once.withColumn("metres", F.round(haversine_m(lat, lon, F.col("place_lat"), F.col("place_lon"))).cast("long")).withColumn("station", F.col("kind") == "station")
    order = [F.col("metres"), F.col("ordinal")]
    return top_k(near.where("station"), [key], order, stations).unionByName(top_k(near.where("not station"), [key], order, most)).select(key, "name", "kind", "metres")


SCHOOL = {
    "name": ["EstablishmentName", "SchoolName", "Name"], "status": ["EstablishmentStatus (name)", "EstablishmentStatus", "Status"], "postcode": ["Postcode", "SchoolPostcode"],
    "lat": ["Latitude", "Lat"], "lon": ["Longitude", "Lon", "Long"], "easting": ["Easting", "X_COORDINATE", "X"], "northing": ["Northing", "Y_COORDINATE", "Y"],
    "phase": ["PhaseOfEducation (name)", "PhaseOfEducation", "Phase"], "rating": ["OfstedRating", "OverallEffectiveness", "LatestOfstedOverallEffectiveness"], "urn": ["URN"],
}
UPRN = {"uprn": ["UPRN"], "lat": SCHOOL["lat"], "lon": SCHOOL["lon"], "easting": SCHOOL["easting"], "northing": SCHOOL["northing"], "postcode": ["Postcode", "PostcodeLocator"]}


def _located(df: DataFrame) -> DataFrame:
    """lat and lon as numbers, from the national grid where they're missing."""
    for c in ("lat", "lon", "easting", "northing"):
        df = df.withColumn(c, lenient_number(c))
    need = (F.col("lat").isNull() | F.col("lon").isNull()) & F.col("easting").isNotNull() & F.col("northing").isNotNull()
    grid = bng_to_wgs84(F.coalesce("easting", F.lit(0.0)), F.coalesce("northing", F.lit(0.0)))
    return df.withColumn("__g", F.when(need, grid)).withColumn("lat", F.coalesce(F.when(~need, F.col("lat")), F.col("__g.lat"))).withColumn("lon", F.coalesce(F.when(~need, F.col("lon")), F.col("__g.lon"))).drop("__g")


def schools(raw: DataFrame, dimension: DataFrame | None = None) -> DataFrame:
    """Open schools with a place: their own coordinates, else the grid's, else their postcode's; others are dropped."""
    df = _located(alias_columns(raw, SCHOOL)).where("name is not null").where(F.col("status").isNull() | F.lower("status").contains("open"))
    if dimension is not None:
        df = geocoded(df.withColumnsRenamed({"lat": "latitude", "lon": "longitude"}), dimension).withColumnsRenamed({"latitude": "lat", "longitude": "lon"}).drop("coordinate_source")
    return df.where("lat is not null and lon is not null").drop("status", "easting", "northing")


def uprns(raw: DataFrame, bounds: tuple[float, float, float, float], grid: tuple[float, float, float, float]) -> DataFrame:
    """(uprn, lat, lon, postcode) within bounds (south, west, north, east); grid bounds (west, south, east, north) come before the conversion."""
    df = alias_columns(raw, UPRN).where("uprn is not null")
    e, n = lenient_number("easting"), lenient_number("northing")
    own = lenient_number("lat").isNotNull() & lenient_number("lon").isNotNull()
    df = _located(df.where(own | (e.between(grid[0], grid[2]) & n.between(grid[1], grid[3]))))
    return df.where(F.col("lat").between(bounds[0], bounds[2]) & F.col("lon").between(bounds[1], bounds[3])).select("uprn", "lat", "lon", postcode("postcode").alias("postcode"))


def repaired_planning(context: Column, truthful: Column) -> Column:
    """A planning context of the older form: kept if truthful; with applications observed, without them unknown, its claims dropped."""
    some = F.coalesce(F.size(context["applications"]), F.lit(0)) > 0
    observed = context.withField("coverage_status", F.lit("observed")).withField("coverage_mode", F.lit(POSITIVE)).withField("count", F.size(context["applications"])).withField("latest", F.coalesce(context["applications"][0]["description"], context["applications"][0]["reference"]))
    silent = context.withField("coverage_status", F.lit("unknown")).withField("coverage_mode", F.lit(SILENT)).withField("count", F.lit(None).cast("int")).withField("latest", F.lit(None).cast("string"))
    return F.when(context.isNull() | truthful, context).when(some, observed).otherwise(silent)


def repaired_lookup(status: Column, count: Column, updated: Column, cached: Column) -> Column:
    """struct<lookup_status, constraint_count, updated_at> of a cached look-up of the older form; null if it was neither matched nor no_match."""
    state = F.lower(clean(status))
    number = F.when(state == "no_match", 0).otherwise(F.greatest(F.lit(1), F.coalesce(F.floor(count).cast("int"), F.lit(1))))
    return F.when(state.isin("matched", "no_match"), F.struct(F.lit("successful").alias("lookup_status"), number.cast("int").alias("constraint_count"), F.coalesce(F.nullif(clean(updated), F.lit("")), clean(cached)).alias("updated_at")))
