"""Rule registries and the join that takes a rule only if no other matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.text import clean, text

#: Rules above this size are left to Spark's own choice of join.
BROADCAST_ROWS = 20_000


def audit_safe(scope: Column, ranges: Column, status: Column, special: Column, codes: Column) -> Column:
    """Whether a rule can be checked from an address alone: whole streets, ranges that parse, or the special segment with postcodes; never on hold."""
    ranged = scope.isin("house_range", "odd_house_range", "even_house_range") & (F.coalesce(F.size(ranges), F.lit(0)) > 0)
    segment = (scope == "segment") & special & (F.coalesce(F.size(codes), F.lit(0)) > 0)
    return F.coalesce((F.coalesce(status, F.lit("")) != "hold") & ((scope == "whole") | ranged | segment), F.lit(False))


def usable_aliases(estate: Column, aliases: Column, disabled: list[tuple[str, str]]) -> Column:
    """Cleaned aliases of an estate, without the (estate, alias) pairs that are disabled; the same alias of another estate stays."""
    pairs = [f"{e}|{a}" for e, a in disabled]
    return F.filter(F.transform(aliases, lambda a: clean(a)), lambda a: ~F.concat(text(estate), F.lit("|"), a).isin(pairs))


def in_ranges(number: Column, ranges: Column) -> Column:
    """number within any of array<struct<minimum,maximum,parity>>; parity is odd, even or ''."""
    return F.exists(ranges, lambda r: (number >= r["minimum"]) & (number <= r["maximum"]) & ((r["parity"] == "") | (number % 2 == F.when(r["parity"] == "odd", 1).otherwise(0))))


def unique_rule_join(rows: DataFrame, rules: DataFrame, row_id: str, street: str, authority: str, places: Column, code: str, house: str, outputs: list[str]) -> DataFrame:
    """Adds the ``outputs`` of the one rule that a row matches; null with none, or with two or more.

    rules: street (canonical), aliases, authorities, towns, postcodes: array<string>; ranges; and the outputs. The
    street or an alias, the authority and one of the row's places must be equal; postcodes and house ranges count where
    a rule has them. A spelling that a rule lists twice counts twice. Rows need a unique ``row_id``; those with a blank
    street or authority, or without any place, match nothing.
    """
    spelt = rules.withColumn("__street", F.explode(F.concat(F.array("street"), F.coalesce("aliases", F.array().cast("array<string>")))))
    spelt = spelt.select("__street", "authorities", "towns", "postcodes", "ranges", F.struct(*outputs).alias("__rule"))
    if rules.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        spelt = F.broadcast(spelt)
    own = F.array_compact(F.transform(places, lambda p: F.nullif(p, F.lit(""))))
    number = F.when(F.col(house).rlike("^[0-9]+$"), F.col(house).try_cast("int"))
    left = rows.where((F.col(street) != "") & (F.col(authority) != "")).withColumn("__places", own).withColumn("__house", number).select(row_id, F.col(street).alias("__own"), F.col(authority).alias("__authority"), "__places", F.col(code).alias("__code"), "__house")
    blank = lambda c: F.coalesce(F.size(c), F.lit(0)) == 0
    hits = left.join(
        spelt,
        (F.col("__own") == F.col("__street")) & F.array_contains("authorities", F.col("__authority")) & F.arrays_overlap("__places", "towns")
        & (blank(F.col("postcodes")) | F.array_contains("postcodes", F.col("__code"))) & (blank(F.col("ranges")) | F.coalesce(in_ranges(F.col("__house"), F.col("ranges")), F.lit(False))),
    )
    one = hits.groupBy(row_id).agg(F.count("*").alias("__n"), F.any_value("__rule").alias("__rule")).where("__n = 1").drop("__n")
    return rows.join(one, row_id, "left").select(*rows.columns, *[F.col(f"__rule.{c}").alias(c) for c in outputs])
