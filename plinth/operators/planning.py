"""Planning contexts, constraint look-ups and flood summaries built from joined rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.geo import distance_text, geojson_polygons
from plinth.functions.text import clean, lenient_number, postcode
from plinth.operators.dedup import top_k
from plinth.sources.feeds import alias_columns

#: Fields of an application and their spellings, compared as letters and digits.
FIELDS = {
    "authority": ["authority", "localAuthority", "council"], "reference": ["reference", "applicationReference", "planningReference"], "site_address": ["siteAddress", "address", "location"],
    "postcode": ["postcode", "sitePostcode"], "proposal": ["proposal", "description", "developmentDescription"], "application_type": ["applicationType", "type"], "status": ["status", "applicationStatus"],
    "decision": ["decision", "decisionType"], "received": ["receivedDate", "dateReceived"], "validated": ["validatedDate", "dateValidated"], "decided": ["decisionDate", "dateDecision"],
    "url": ["portalUrl", "url", "applicationUrl"], "uprn": ["uprn"],
}
POSITIVE, SILENT = "positive-results-only", "no-authoritative-negative-coverage"
APPLICATION = "struct<date:string,metres:bigint,reference:string,description:string>"


def planning_context(found: Column, failed: Column, prior: Column, most: int = 6) -> Column:
    """struct<coverage_status, coverage_mode, count, latest, applications>.

    found: array of ``APPLICATION`` within the radius, in any order. Applications make it observed; a look-up without
    any is unknown, a failed one unavailable, unless ``prior`` (the same struct) was observed and is kept. Only an
    observed context has a count and a latest application.
    """
    newest = F.array_sort(found, lambda a, b: F.when(F.coalesce(a["date"], F.lit("")) > F.coalesce(b["date"], F.lit("")), -1).when(F.coalesce(a["date"], F.lit("")) < F.coalesce(b["date"], F.lit("")), 1).when(a["metres"] < b["metres"], -1).when(a["metres"] > b["metres"], 1).otherwise(0))
    some = F.coalesce(F.size(found), F.lit(0)) > 0
    first = F.get(newest, 0)
    label = F.concat_ws(" - ", first["reference"], first["description"], F.concat(distance_text(first["metres"]), F.lit(" away")))

    def context(status: str, mode: str, full: bool) -> Column:
        return F.struct(F.lit(status).alias("coverage_status"), F.lit(mode).alias("coverage_mode"), (F.size(found) if full else F.lit(None)).cast("int").alias("count"), (label if full else F.lit(None)).cast("string").alias("latest"), (F.slice(newest, 1, most) if full else F.lit(None)).cast(f"array<{APPLICATION}>").alias("applications"))

    kept = prior.isNotNull() & (prior["coverage_status"] == "observed")
    return F.when(failed & kept, prior).when(failed, context("unavailable", SILENT, False)).when(some, context("observed", POSITIVE, True)).otherwise(context("unknown", SILENT, False))


def normalised_applications(raw: DataFrame, ordinal: str) -> DataFrame:
    """The ``FIELDS`` of applications, cleaned, '' where missing; the last row by ``ordinal`` of each authority and reference (case aside).

    The postcode comes from the site's address where there is none of its own. Rows without a reference or a site's
    address are left out.
    """
    df = alias_columns(raw, FIELDS | {"__ordinal": [ordinal]}).withColumn("__ordinal", F.col("__ordinal").cast("long"))
    df = df.withColumns({c: clean(c) for c in FIELDS})
    found = F.regexp_extract(F.upper("site_address"), r"\b([A-Z]{1,2}[0-9][A-Z0-9]?\s*[0-9][A-Z]{2})\b", 1)
    df = df.withColumn("postcode", F.coalesce(F.nullif(postcode("postcode"), F.lit("")), postcode(found))).where("reference <> '' and site_address <> ''")
    keyed = df.withColumn("__a", F.lower("authority")).withColumn("__r", F.lower("reference"))
    return top_k(keyed, ["__a", "__r"], [F.col("__ordinal").desc()], 1).drop("__a", "__r", "__ordinal")


def active_alerts(items: DataFrame) -> DataFrame:
    """(alert_id, severity, polygons) of alerts of severity 1 to 3, from (alert_id, severity_level, shape as GeoJSON).

    Raises if one of them has no usable polygon: its area would pass for unaffected.
    """
    level = F.coalesce(lenient_number("severity_level"), F.lit(0.0)).cast("int")
    active = items.select("alert_id", level.alias("severity"), geojson_polygons("shape").alias("polygons")).where(F.col("severity").between(1, 3))
    bad = active.where(F.coalesce(F.size("polygons"), F.lit(0)) <= 0).agg(F.count("*"), F.min("alert_id")).first()
    if bad[0]:
        raise ValueError(f"{bad[0]} active alerts without a polygon, {bad[1]} among them")
    return active


def constraint_labels(entities: DataFrame, key: str, labels: dict[str, str], most: int = 3) -> DataFrame:
    """(key, constraint_count, labels map): entities (key, dataset, name) counted, whether mapped or not, and named by label."""
    label = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    by = entities.withColumn("label", F.try_element_at(label, F.col("dataset"))).groupBy(key, "label").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("name")).alias("names"))
    shown = F.concat(F.col("label"), F.lit(": "), F.array_join(F.slice("names", 1, most), ", "), F.when(F.size("names") > most, F.concat(F.lit(" +"), (F.size("names") - most).cast("string"), F.lit(" more"))).otherwise(""))
    return by.withColumn("shown", shown).groupBy(key).agg(F.sum("n").alias("constraint_count"), F.map_from_entries(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "shown")))).alias("labels"))


def flood_summary(alerts: DataFrame, point_id: str, km: float = 5.0) -> DataFrame:
    """(point_id, alerts, severity, nearest_km, status) from ``spatial.polygon_alerts``: the most severe, then the nearest, comes first."""
    g = alerts.groupBy(point_id).agg(F.count("*").alias("alerts"), F.min_by(F.struct("severity", "distance_km"), F.struct("severity", "distance_km", "alert_id")).alias("__f"))
    text = F.concat(F.col("alerts").cast("string"), F.when(F.col("alerts") == 1, " active alert within ").otherwise(" active alerts within "), F.lit(f"{km:g}km"))
    return g.select(point_id, "alerts", F.col("__f.severity").alias("severity"), F.round("__f.distance_km", 3).alias("nearest_km"), text.alias("status"))


def flood_status(points: DataFrame, alerts: DataFrame, point_id: str, km: float = 5.0) -> DataFrame:
    """``flood_summary`` for every point; those without an alert count 0 and say so."""
    both = points.select(point_id).join(flood_summary(alerts, point_id, km), point_id, "left")
    return both.withColumn("alerts", F.coalesce("alerts", F.lit(0))).withColumn("status", F.coalesce("status", F.lit(f"No current flood alert within {km:g}km")))
