"""Summaries, metadata and coverage, each in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.temporal import cache_valid, freshness
from plinth.functions.text import finite_positive


def summary(df: DataFrame, group: str, price: str, day: str, rate: str | None = None, skip_blank: bool = True) -> DataFrame:
    """(group, count, avg, latest, max[, avg_rate, rated]): whole numbers, ties to even; blank groups are skipped."""
    rows = df.where(F.coalesce(F.trim(F.col(group).cast("string")), F.lit("")) != "") if skip_blank else df
    parts = [F.count("*").alias("count"), F.bround(F.avg(price)).cast("long").alias("avg"), F.max(day).alias("latest"), F.max(price).alias("max")]
    if rate:
        good = F.when(finite_positive(rate), F.col(rate))
        parts += [F.bround(F.avg(good)).cast("long").alias("avg_rate"), F.count(good).alias("rated")]
    return rows.groupBy(group).agg(*parts)


def metadata(df: DataFrame, code: str, ident: str, day: str) -> DataFrame:
    """One row: rows, distinct non-blank postcodes, distinct identities, the latest day."""
    return df.agg(F.count("*").alias("rows"), F.countDistinct(F.nullif(F.trim(F.col(code)), F.lit(""))).alias("postcodes"), F.countDistinct(ident).alias("properties"), F.max(day).alias("latest"))


def value_counts(df: DataFrame, column: str, most: int | None = None) -> DataFrame:
    """(value, n), most frequent first and then by value."""
    out = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")
    return out if most is None else out.limit(most)


def coverage(df: DataFrame, predicates: dict[str, tuple[Column, float]]) -> DataFrame:
    """(name, found, total, pct, minimum) of each predicate, all from one scan; pct rounded to tenths as a decimal, then a double."""
    one = df.agg(F.count("*").alias("total"), *[F.count_if(c).alias(f"f{k}") for k, (c, _) in enumerate(predicates.values())])
    rows = [F.struct(F.lit(n).alias("name"), F.col(f"f{k}").alias("found"), F.lit(float(m)).alias("minimum")) for k, (n, (_, m)) in enumerate(predicates.items())]
    flat = one.select("total", F.inline(F.array(*rows)))
    pct = F.when(F.col("total") == 0, 0).otherwise(F.round(F.col("found").cast("decimal(20,0)") * 100 / F.col("total"), 1)).cast("double")
    return flat.select("name", "found", "total", pct.alias("pct"), "minimum")


def freshness_histogram(df: DataFrame, observed: str, now: Column, hours: float = 30) -> DataFrame:
    return df.groupBy(freshness(F.col(observed), now, hours).alias("state")).agg(F.count("*").alias("n"))


def terminal_accounting(rows: DataFrame, cache: DataFrame, key: str, status: str, updated: str, now: Column, days: float) -> DataFrame:
    """One row: requested, resolved, pending, errors, matched, no_match of the rows' keys in a cache (one row per key).

    Resolved are keys with evidence that is still valid (``cache_valid``, certificate): matched, and no_match of fewer
    than ``days`` whole days. Everything else is pending, a stale no_match and an error included.
    """
    both = rows.select(key).join(cache.select(key, F.col(status).alias("__status"), F.col(updated).alias("__updated")), key, "left")
    valid = cache_valid(F.col("__status"), F.col("__updated"), now, days, "certificate")
    counted = {s: valid & F.coalesce(F.col("__status") == s, F.lit(False)) for s in ("matched", "no_match")}
    resolved = counted["matched"] | counted["no_match"]
    return both.agg(
        F.count("*").alias("requested"), F.count_if(resolved).alias("resolved"), F.count_if(~resolved).alias("pending"), F.count_if(F.col("__status") == "error").alias("errors"),
        *[F.count_if(c).alias(s) for s, c in counted.items()],
    )


def grouped_list(df: DataFrame, key: str, entry: list[str], order: list[str]) -> DataFrame:
    """(key, items): rows of a key as structs, sorted by ``order``."""
    packed = F.struct(*order, F.struct(*entry).alias("e"))
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(packed)), lambda x: x["e"]).alias("items"))


def year_range(df: DataFrame, year: Column) -> DataFrame:
    return df.agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"))


def cohort_counts(df: DataFrame, carried: str = "carried", reused: str = "reused") -> DataFrame:
    return df.agg(F.count("*").alias("rows"), F.count_if(F.col(carried)).alias("preserved"), F.count_if(F.col(reused)).alias("reused"), F.count_if(~F.col(carried)).alias("new"))
