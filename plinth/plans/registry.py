"""How queries are registered: a function over (spark, sf_dir), and the same in DuckDB's SQL where it can be said."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Synthetic coordinates: arithmetic on a key, the same in Spark and SQL.
LAT, LON = "(CAST(51.03 AS DOUBLE) + ({k} * 7919 % 5200) / CAST(10000.0 AS DOUBLE))", "(CAST(-0.90 AS DOUBLE) + ({k} * 104729 % 10200) / CAST(10000.0 AS DOUBLE))"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def located(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("lat", F.expr(f"cast({LAT.format(k=key)} as double)")).withColumn("lon", F.expr(f"cast({LON.format(k=key)} as double)"))
