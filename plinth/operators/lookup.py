"""Look-up joins: by priority of keys, from donors, and with one evaluation per key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def priority_lookup(new: DataFrame, old: DataFrame, exact: str, alternatives: Sequence[str], donor: str, ordinal: str, extras: Sequence[str], price: str | None = None, area: str | None = None, rate: str | None = None) -> DataFrame:
    """Carries ``extras`` from old rows over to new ones; all key columns are in both tables.

    A new row takes the last old row of its exact key, else the one of the first alternative key that is unique in both
    tables. Fields that it lacks come from the donor: the first old row of the ``donor`` key with any extra. With
    ``price``, ``area`` and ``rate`` given, the rate is worked out anew wherever an area was carried over, so a donor's
    rate never stands for another price. Adds ``carried`` (any extra came) and ``reused`` (the donor gave one the match
    lacks). New rows are neither lost nor multiplied.
    """
    pack = F.struct(*extras)
    filled = F.coalesce(*[F.col(c).cast("string") for c in extras]).isNotNull()

    def side(name: str, rows: DataFrame, key: str, pick: Column) -> DataFrame:
        return rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"__{name}")).agg(pick.alias(f"__{name}_row"))

    out = new.join(side("exact", old, exact, F.max_by(pack, ordinal)), F.col(exact) == F.col("__exact"), "left")
    match = F.col("__exact_row")
    for k, key in enumerate(alternatives):
        name = f"alt{k}"
        # Counted with partial aggregation, null keys left out: no window gathers the rows that lack a key.
        grouped = old.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"__{name}")).agg(F.count("*").alias("__n"), F.any_value(pack).alias(f"__{name}_row")).where("__n = 1").drop("__n")
        single = new.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"__{name}")).agg(F.count("*").alias("__n")).where("__n = 1").drop("__n")
        out = out.join(grouped.join(single, f"__{name}", "left_semi"), F.col(key) == F.col(f"__{name}"), "left")
        match = F.coalesce(match, F.col(f"__{name}_row"))
    out = out.withColumn("__match", match).join(side("donor", old.where(filled), donor, F.min_by(pack, ordinal)), F.col(donor) == F.col("__donor"), "left")
    gained = [F.col(f"__match.{c}").isNull() & F.col(f"__donor_row.{c}").isNotNull() for c in extras]
    reused, carried = gained[0], F.coalesce(*[F.coalesce(F.col(f"__match.{c}"), F.col(f"__donor_row.{c}")).cast("string") for c in extras]).isNotNull()
    for g in gained[1:]:
        reused = reused | g
    values = {c: F.coalesce(F.col(f"__match.{c}"), F.col(f"__donor_row.{c}")) for c in extras}
    if price and area and rate:
        values[rate] = F.when(values[area] > 0, F.bround(F.col(price) / values[area]).cast("long"))
    kept = [c for c in new.columns if c not in extras]
    return out.select(*[F.col(c) for c in kept], *[v.alias(c) for c, v in values.items()], carried.alias("carried"), reused.alias("reused"))


def donor_fill(df: DataFrame, key: str, ordinal: str, fields: Sequence[str]) -> DataFrame:
    """Fills what a row lacks from the first row of its key that has the field. One pass: an aggregate joined back."""
    firsts = [F.min_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(ordinal))).alias(f"__{c}") for c in fields]
    donors = df.groupBy(key).agg(*firsts)
    joined = df.join(donors, key, "left")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in fields else F.col(c) for c in df.columns])


def evaluate_once(df: DataFrame, keys: Sequence[str], evaluate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Runs an expensive step on distinct keys and joins its columns back."""
    return df.join(evaluate(df.select(*keys).distinct()), list(keys), "left")


def missing_keys(emitted: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """(key, side): keys that only one of the tables has. Empty if they agree."""
    a, b = emitted.select(key).distinct(), base.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("emitted")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("base")))
