"""Fields and labels of certificates, places, planning applications and ledger items, whatever their spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plinth.functions.geo import valid_point
from plinth.functions.text import clean, lenient_number, postcode, text


def _spelt(flat: Column, *names: str) -> Column:
    """The first filled value of a map<string, string> under any of the names, compared as letters and digits."""
    entries = F.filter(F.map_entries(flat), lambda e: F.trim(F.coalesce(e["value"], F.lit(""))) != "")

    def one(name: str) -> Column:
        hit = F.filter(entries, lambda e: F.regexp_replace(F.lower(e["key"]), "[^a-z0-9]", "") == name)
        return F.get(hit, 0)["value"]

    return F.coalesce(*[one(n) for n in names])


def certificate_fields(flat: Column, address_keys: tuple[str, ...] = ("addressline1", "addressline2", "addressline3", "address", "posttown")) -> Column:
    """struct<number, postcode, registered, rating, address> of a flattened certificate; '' where a field is missing.

    The address joins its lines, each once (case aside).
    """
    lines = F.filter(F.array(*[clean(F.coalesce(_spelt(flat, k), F.lit(""))) for k in address_keys]), lambda x: x != "")
    once = F.filter(lines, lambda x, i: ~F.exists(F.slice(lines, 1, i), lambda y: F.upper(y) == F.upper(x)))
    return F.struct(
        clean(_spelt(flat, "certificatenumber", "lmkkey")).alias("number"),
        clean(_spelt(flat, "postcode")).alias("postcode"),
        F.substring(clean(_spelt(flat, "registrationdate", "lodgementdate", "lodgementdatetime")), 1, 10).alias("registered"),
        F.upper(clean(_spelt(flat, "currentenergyefficiencyband", "currentenergyrating", "currentenergyefficiency"))).alias("rating"),
        F.array_join(once, ", ").alias("address"),
    )


def debug_keys(flat: Column, most: int = 16) -> Column:
    """Names of filled fields that tell of area, certificate, address or postcode, for a report of what a source holds."""
    filled = F.map_filter(flat, lambda k, v: F.coalesce(F.trim(v), F.lit("")) != "")
    return F.slice(F.filter(F.array_sort(F.map_keys(filled)), lambda k: F.regexp_replace(F.lower(k), "[^a-z0-9]", "").rlike("floorarea|totalfloor|certificate|address|postcode")), 1, most)


def epc_facts(area_sqm: Column, price: Column) -> Column:
    """struct<sqm, sqft, per_sqft>: square metres to one decimal, whole square feet and pounds a square foot; ties to even."""
    sqft = F.bround(area_sqm * 10.76391041671).cast("long")
    return F.when(sqft > 0, F.struct(F.bround(area_sqm, 1).alias("sqm"), sqft.alias("sqft"), F.bround(price / sqft).cast("long").alias("per_sqft")))


def place_kind(tags: Column) -> Column:
    """station, the amenity, the shop, or place, from a map of tags."""
    tag = lambda k: clean(F.try_element_at(tags, F.lit(k)))
    words = lambda k: F.nullif(F.replace(tag(k), F.lit("_"), F.lit(" ")), F.lit(""))
    return F.when((tag("railway") == "station") | (tag("public_transport") == "station"), "station").otherwise(F.coalesce(words("amenity"), words("shop"), F.lit("place")))


def application_label(name: Column, description: Column, address: Column, reference: Column) -> Column:
    """What an application is called, with its reference unless the name holds it."""
    called = clean(F.coalesce(*[F.nullif(clean(c), F.lit("")) for c in (name, description, address)], F.lit("Planning application")))
    ref = clean(reference)
    return F.when((ref != "") & ~F.contains(F.lower(called), F.lower(ref)), F.concat(called, F.lit(" ("), ref, F.lit(")"))).otherwise(called)


def coordinates(*pairs: tuple[Column, Column]) -> Column:
    """struct<lat, lon>: each from the first of the (lat, lon) pairs that has it, null unless both are found."""
    return valid_point(F.coalesce(*[lenient_number(a) for a, _ in pairs]), F.coalesce(*[lenient_number(o) for _, o in pairs]))


def planning_key(code: Column, ident: Column, since: Column, metres: int) -> Column:
    return F.concat_ws("|", F.coalesce(F.nullif(postcode(code), F.lit("")), text(ident)), F.date_format(since, "yyyy-MM-dd"), F.lit(str(metres)))


def company_number(*candidates: Column) -> Column:
    """The first filled number, upper case without spaces; '' without one."""
    return F.coalesce(*[F.nullif(F.replace(F.upper(clean(c)), F.lit(" "), F.lit("")), F.lit("")) for c in candidates], F.lit(""))


def chunk(ordinal: Column, size: int) -> Column:
    """The number of the batch that a 0-based ordinal falls into."""
    return F.floor(ordinal / size).cast("long")
