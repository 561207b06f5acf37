"""Caches with a time to live, as tables (source, key, status, updated_at, payload)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.temporal import cache_valid
from plinth.operators.dedup import top_k


def latest(cache: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The newest row of each key; ties by status and payload."""
    return top_k(cache, keys or ["source", "key"], [F.col("updated_at").desc_nulls_last(), F.col("status"), F.col("payload")], 1)


def work_set(rows: DataFrame, cache: DataFrame, key: str, now: Column, days: float, policy: str) -> DataFrame:
    """Distinct keys of the rows that no valid cached row covers: what has to be fetched."""
    valid = cache.where(cache_valid(F.col("status"), F.col("updated_at"), now, days, policy)).select(key)
    return rows.select(key).where(F.col(key).isNotNull()).distinct().join(valid, key, "left_anti")


def upsert(cache: DataFrame, fresh: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """New rows replace old ones of their key, but an error never replaces a dated observation."""
    keys = keys or ["source", "key"]
    both = cache.withColumn("__new", F.lit(0)).unionByName(fresh.withColumn("__new", F.lit(1)))
    usable = F.when(F.col("status") == "error", 0).otherwise(1)
    return top_k(both, keys, [usable.desc(), F.col("__new").desc(), F.col("updated_at").desc_nulls_last(), F.col("status"), F.col("payload")], 1).drop("__new")


def purge(cache: DataFrame, source: str) -> DataFrame:
    """Without what a disabled source left behind."""
    return cache.where(F.col("source") != source)
