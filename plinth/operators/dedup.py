"""Order-aware distinct rows, uniqueness, top-k and row limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key. ``order`` must be total for a defined result."""
    return top_k(df, keys, order, 1)


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each key; Spark cuts to k before the shuffle (window group limit)."""
    at = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__at", at).where(F.col("__at") <= k).drop("__at")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows by the hash of their keys in several parts a core, for steps that make much of few bytes: adaptive execution leaves these parts as they are."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism), *keys)


def last_wins(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """The last row of each key by ``ordinal``, in the first one's place: ``ordinal`` becomes the least of the key."""
    w = W.partitionBy(*keys)
    ranked = df.withColumn("__at", F.row_number().over(w.orderBy(F.col(ordinal).desc()))).withColumn("__first", F.min(ordinal).over(w))
    return ranked.where("__at = 1").withColumn(ordinal, F.col("__first")).drop("__at", "__first")


def unique_only(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key no other row has."""
    return df.withColumn("__n", F.count("*").over(W.partitionBy(*keys))).where("__n = 1").drop("__n")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def limited(df: DataFrame, ordinal: str, limit: int | None, changed: dict[str, Column]) -> DataFrame:
    """Applies the columns to rows up to the ordinal; the others pass through unchanged (null where the column is new)."""
    for name, value in changed.items():
        old = F.col(name) if name in df.columns else F.lit(None)
        df = df.withColumn(name, value if limit is None else F.when(F.col(ordinal) <= limit, value).otherwise(old))
    return df
