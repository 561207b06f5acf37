"""Contracts and gates. Each check gives failures as text; an empty list passes. Only counts reach the driver."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.temporal import is_fresh
from plinth.functions.text import clean

LEDGER = frozenset("id market district address price date property_record_id paon saon street locality town postcode price_text property_type source kind category".split())
RULED = frozenset("estate estate_id estate_type estate_classification estate_rule_id estate_registry_version estate_evidence_status estate_review_status".split())
FACTS = frozenset("epc_matched epc_rating epc_source epc_registration_date floor_area_sqft floor_area_sqm price_per_sqft".split())
CONTEXT = frozenset("geocode latitude longitude coordinate_precision coordinate_source environment_agency historic_england ofsted ordnance_survey planning planning_constraints uprn".split())
PUBLIC = LEDGER | RULED | FACTS | CONTEXT
RESTRICTED = frozenset("companies_house open_street_map planning_history epc_address epc_certificate_number epc_history epc_match_diagnostics epc_match_score epc_search epc_search_diagnostics epc_source_address query_address search_address source_address".split())
SCHOOL_LABELS = dict.fromkeys(("DfE / Ofsted school data", "Get Information About Schools Surrey extract"), "DfE Get Information about Schools (GIAS)")


@dataclass(frozen=True)
class Contract:
    """Which columns may be published. Restricted ones are dropped, unknown ones refused; nothing is read for it."""

    public: frozenset[str] = PUBLIC
    restricted: frozenset[str] = RESTRICTED
    source_labels: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def project(self, df: DataFrame) -> DataFrame:
        unknown = set(df.columns) - self.public - self.restricted
        if unknown:
            raise ValueError(f"fields outside the contract: {', '.join(sorted(unknown))}")
        out = df.select(*[c for c in df.columns if c not in self.restricted])
        for name, labels in self.source_labels.items():
            if name in out.columns:
                label = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
                out = out.withColumn(name, F.col(name).withField("source", F.coalesce(F.try_element_at(label, F.col(f"{name}.source")), F.col(f"{name}.source"))))
        return out

    def failures(self, columns: Iterable[str]) -> list[str]:
        have = set(columns)
        return [f"restricted field published: {c}" for c in sorted(have & self.restricted)] + [f"unknown field published: {c}" for c in sorted(have - self.public - self.restricted)]


def coverage_failures(rows: DataFrame, stage: str = "normal", strict_only: frozenset[str] = frozenset({"constraints"})) -> list[str]:
    """rows: what ``aggregates.coverage`` gives. Stage base checks postcodes only, normal all but ``strict_only``, strict all."""
    out = []
    for r in rows.collect():  # one row per predicate
        if stage == "base" and r["name"] != "postcodes" or stage != "strict" and r["name"] in strict_only:
            continue
        if float(r["pct"]) < r["minimum"]:
            out.append(f"{r['name']}: {r['pct']}% is below {r['minimum']}%")
    return out


def reconcile(actual: DataFrame, stated: Mapping[str, int]) -> list[str]:
    """actual: one row of counts; stated: what the metadata says of the same names."""
    row = actual.first()
    have = row.asDict() if row else {}
    return [f"{k}: stated {v}, counted {have.get(k)}" for k, v in stated.items() if have.get(k) != v]


def replay_mismatches(stored: DataFrame, replayed: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column): fields in which a stored row differs from its replay; rows of one side only differ in all."""
    both = stored.select(key, *[F.col(c).alias(f"s_{c}") for c in columns]).join(replayed.select(key, *[F.col(c).alias(f"r_{c}") for c in columns]), key, "full")
    bad = F.array_compact(F.array(*[F.when(~F.col(f"s_{c}").eqNullSafe(F.col(f"r_{c}")), F.lit(c)) for c in columns]))
    return both.select(key, F.explode(bad).alias("column"))


def expansion_failures(rows: int, preserved: int, reused: int, initial: int, pending: int, strict: bool = False) -> list[str]:
    checks = {"initial and preserved rows don't add up": initial + preserved != rows, "more pending than initial": pending > initial, "more reused than preserved": reused > preserved, "rows are pending": strict and pending > 0}
    return [k for k, bad in checks.items() if bad] + (["a count is negative"] if min(rows, preserved, reused, initial, pending) < 0 else [])


def close_expansion(initial: int, found: int) -> tuple[int, int]:
    """(resolved, pending) of the new rows after a run that resolved ``found``."""
    done = max(0, min(initial, found))
    return done, initial - done


def feed_gate(df: DataFrame, price: str, ident: str, day: str, floor: int, least_rows: int = 4500, earliest: str = "1995-01-01", cohort: tuple[int, int] = (2_000_000, 3_000_000)) -> list[str]:
    """Record floor, price floor, a filled price cohort, unique ids and the earliest day, from one aggregate."""
    r = df.agg(F.count("*").alias("n"), F.min(price).alias("low"), F.count_if(F.col(price).between(*cohort)).alias("cohort"), F.countDistinct(ident).alias("ids"), F.min(day).cast("string").alias("first")).first()
    checks = {f"{r['n']} rows, {least_rows} needed": r["n"] < least_rows, "a price is below the floor": r["n"] > 0 and r["low"] < floor, "the price cohort is empty": r["cohort"] == 0, "ids repeat": r["ids"] != r["n"], "a day is too early": r["n"] > 0 and r["first"] < earliest}
    return [k for k, bad in checks.items() if bad]


def drift_failures(stated: float, actual: float, points: float = 2.0) -> list[str]:
    return [f"stated {stated}% but {actual}% found"] if abs(stated - actual) > points else []


def news_violations(items: DataFrame) -> DataFrame:
    """(rule, n): broken rules of a news feed, at most 100 items and link-only."""
    broken = {
        "id": ~F.col("id").rlike("^news-[0-9a-f]{20}$"), "url": ~F.col("url").startswith("https://"),
        "score": ~F.col("score").between(0, 100), "rights": F.col("rights_mode") != "link-only", "title": clean("title") == "",
    }
    one = items.agg(*[F.count_if(F.coalesce(c, F.lit(True))).alias(k) for k, c in broken.items()], (F.count("*") - F.countDistinct("id")).alias("repeated_id"), (F.count("*") - F.countDistinct("url")).alias("repeated_url"), F.greatest(F.lit(0), F.count("*") - 100).alias("too_many"))
    names = [*broken, "repeated_id", "repeated_url", "too_many"]
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).cast("long").alias("n")) for n in names]))).where("n > 0")


NEWS = frozenset("id title url source source_id published_at score scoring_version location topics reason rights_mode".split())
UNLICENSED = frozenset(("body", "image", "summary"))


def news_failures(items: DataFrame, stated: Mapping[str, object]) -> list[str]:
    """Of a news feed and its metadata: fields it needs and mustn't have, versions, and ``news_violations``."""
    have = set(items.columns)
    out = [f"missing field: {c}" for c in sorted(NEWS - have)] + [f"unlicensed content: {c}" for c in sorted(UNLICENSED & have)]
    out += [f"{k} is {stated.get(k)!r}" for k, v in (("schema_version", 1), ("rights_mode", "link-only")) if stated.get(k) != v]
    if NEWS <= have:
        stale = items.where(~F.col("scoring_version").eqNullSafe(F.lit(stated.get("scoring_version")))).count()
        out += [f"{stale} items of another scoring version"] if stale else []
        out += [f"{r['rule']}: {r['n']}" for r in news_violations(items).collect()]  # one row per rule
    return out


def history_failures(keys: DataFrame, base: DataFrame, stated: Mapping[str, int], most: int = 200_000) -> list[str]:
    """Of a map of histories: its size, keys that the ledger doesn't have, and the coverage that its metadata states.

    keys: key (a property or a transaction); base: property_record_id, id. Only counts reach the driver.
    """
    k, prop = keys.select("key").distinct(), F.col("key").startswith("property:")
    n = k.agg(F.count("*").alias("all"), F.count_if(prop).alias("properties")).first()
    known = base.select(F.col("property_record_id").alias("key")).where("key <> ''").distinct()
    ids = base.select(F.col("id").cast("string").alias("key")).where("key <> ''").distinct()
    strays = k.where(prop).join(known, "key", "left_anti").count(), k.where(~prop).join(ids, "key", "left_anti").count()
    checked = known.count()
    checks = {
        f"{n['all']} keys, {most} allowed": n["all"] > most,
        f"properties checked: stated {stated.get('properties_checked')}, the ledger has {checked}": stated.get("properties_checked") != checked,
        f"keys outside the ledger: {strays[0]} properties, {strays[1]} transactions": any(strays),
        f"properties with history: stated {stated.get('properties_with_history')}, found {n['properties']}": stated.get("properties_with_history") != n["properties"],
    }
    return [text for text, bad in checks.items() if bad]


def planning_truthful(status: Column, mode: Column, applications: Column, latest: Column, count: Column) -> Column:
    """Observed needs positive evidence; unknown and unavailable must make no negative claim. Null stands for an absent field."""
    some, last = F.coalesce(F.size(applications), F.lit(0)) > 0, clean(latest)
    state = F.lower(clean(status))
    observed = (mode == "positive-results-only") & some & (last != "") & ~F.lower(last).startswith("no recent")
    other = (mode == "no-authoritative-negative-coverage") & ~some & (last == "") & count.isNull()
    return F.coalesce(F.when(state == "observed", observed).when(state.isin("unknown", "unavailable"), other), F.lit(False))


def planning_current(truthful: Column, status: Column, updated: Column, now: Column) -> Column:
    return F.lower(clean(status)).isin("observed", "unknown") & truthful & is_fresh(updated, now)


def lookup_succeeded(status: Column, count: Column) -> Column:
    """Explicitly successful, or without status but with a positive count."""
    state = F.lower(clean(status))
    return F.coalesce(state.isin("successful", "success", "matched") | ((state == "") & (count > 0)), F.lit(False))


def lookup_positive(status: Column, count: Column) -> Column:
    return lookup_succeeded(status, count) & F.coalesce(count > 0, F.lit(False))


def markdown(rows: DataFrame, failures: list[str], title: str = "Data completeness") -> str:
    """A report of coverage rows and failures."""
    lines = [f"# {title}", "", "| Field | Found | Total | Share | Minimum |", "|---|---:|---:|---:|---:|"]
    lines += [f"| {r['name']} | {r['found']} | {r['total']} | {r['pct']}% | {r['minimum']}% |" for r in rows.collect()]
    return "\n".join([*lines, "", "## Failures", "", *([f"- {f}" for f in failures] or ["None."])]) + "\n"
