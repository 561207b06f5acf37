"""Connected components of an edge list, in rounds of joins that survive the loss of executors."""

from __future__ import annotations

import itertools
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_counter = itertools.count()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a local one where that is unset (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        at = f"{os.getcwd()}/spark-warehouse/checkpoints"
    return at.rstrip("/")


def cut(df: DataFrame, tag: str) -> DataFrame:
    """The same rows from a table written to the shared folder, so later steps neither compute them again nor depend on an executor.

    ``discard`` removes it; what is left (tables that a result still reads) goes when the application ends.
    """
    spark = df.sparkSession
    at = f"{shared_folder(spark)}/plinth-{tag}-{next(_counter)}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    df.write.parquet(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    table = spark.read.schema(df.schema).parquet(at)
    table.written_to = at
    return table


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``cut`` wrote, once nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_version(text: Column) -> Column:
    """Tells rows with one id but different texts apart: a hash of 31 bits."""
    return F.pmod(F.xxhash64(text), F.lit(1 << 31)).cast("int")


def components(edges: DataFrame, tag: str = "components", max_rounds: int = 60) -> DataFrame:
    """(id, root): every id of ``edges`` (a, b: long) with the least id of its component.

    Large-star and small-star rounds in turn: each keeps the components and the least ids and shortens all paths, so
    the rounds grow with the logarithm of the longest path. Stops when a round leaves all edges as they were. An
    empty list gives no rows; loops, repeated edges and both directions are allowed; null ends are ignored.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), tag)
    sign = _signature(now)
    for _ in range(max_rounds):
        if not sign[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        after = cut(small.select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct(), tag)
        before, was = now, sign
        now, sign = after, _signature(after)
        discard(before)
        if sign == was:
            break
    else:
        raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
    return now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("id"), "root").unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
