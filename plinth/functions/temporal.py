"""Dates, freshness and time-to-live. ``now`` is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plinth.functions.text import text


def iso_z(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_when(c: Column | str, fallback: Column | None = None) -> Column:
    """A timestamp from RFC 822 or ISO text (times without zone are UTC), else the fallback."""
    raw = F.regexp_replace(F.trim(text(c)), r"^[A-Za-z]{3,9},\s*", "")
    raw = F.regexp_replace(raw, r"\s(GMT|UTC|UT|Z)$", " +0000")
    tries = [F.try_to_timestamp(raw, F.lit(p)) for p in ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm Z", "d MMM yyyy HH:mm:ss")]
    return F.coalesce(*tries, raw.try_cast("timestamp"), F.lit(None).cast("timestamp") if fallback is None else fallback)


def velocity_cutoff(latest: Column | str, lag: int = 2) -> Column:
    """The last day of the month ``lag`` months before."""
    if lag < 0:
        raise ValueError("lag must not be negative")
    return F.last_day(F.add_months(latest, -lag))


def age_hours(c: Column, now: Column) -> Column:
    return (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(c.cast("timestamp"))) / 3600.0


def is_fresh(c: Column, now: Column, hours: float = 30) -> Column:
    """Between now and ``hours`` ago; what lies in the future isn't fresh, nor is null."""
    return F.coalesce(age_hours(c, now).between(0, hours), F.lit(False))


def freshness(c: Column, now: Column, hours: float = 30) -> Column:
    return F.when(c.isNull(), "missing").when(is_fresh(c, now, hours), "fresh").otherwise("stale")


def cache_valid(status: Column, updated: Column, now: Column, days: float, policy: str = "any") -> Column:
    """Whether a cached row may be used again; the future counts as fresh.

    any: by age alone. matched: status matched and fewer whole days than the limit. certificate: matched always, errors
    never, others by whole days. seconds: by age in seconds, errors never. What has reached the limit has expired; a
    limit of 0 or less leaves matched certificates alone.
    """
    age = age_hours(updated, now)
    whole = F.floor(age / 24)
    some = F.lit(days > 0)
    rules = {
        "any": some & (age < days * 24),
        "matched": some & (status == "matched") & (whole < days),
        "certificate": F.when(status == "matched", True).when(status == "error", False).otherwise(some & (whole < days)),
        "seconds": some & (status != "error") & (age * 3600 < days * 86400),
    }
    return F.coalesce(rules[policy], F.lit(False))


def retry_wait(after: Column, attempt: Column) -> Column:
    """Seconds to wait before a request is tried again, 1 to 90."""
    return F.least(F.lit(90), F.greatest(F.lit(1), F.coalesce(after.cast("int"), 25 * (attempt + 1))))
