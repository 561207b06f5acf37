"""Windows, sessions and retention over events: the batch forms of the streaming operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.operators import state
from plinth.plans.registry import query, table
from plinth.sources import feeds
from plinth.streaming import refresh


@query("""
SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS "end", event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(20, 4))) AS DOUBLE) AS total FROM events GROUP BY 1, 2, 3""")
def daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh.windowed_counts(table(spark, sf_dir, "events"), "ts", "1 day", None, ["event_type"], "value")


@query("""
WITH w AS (SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) - to_days(CAST(k AS INTEGER)) AS start FROM events, range(0, 7) t(k))
SELECT start, start + INTERVAL 7 DAY AS "end", event_type, count(*) AS n FROM w GROUP BY 1, 2, 3""")
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh.windowed_counts(table(spark, sf_dir, "events"), "ts", "7 days", "1 day", ["event_type"])


@query("""
WITH l AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM l)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refresh.sessions(table(spark, sf_dir, "events"), "user_id", "ts", "2 hours")


@query("""
SELECT user_id, event_type, ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS pos FROM events WHERE ts >= TIMESTAMP '2024-01-30' - INTERVAL 14 DAY) WHERE pos = 1""")
def retention_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return refresh.latest_batch(rows, ["user_id", "event_type"], "ts", 14, F.lit("2024-01-30").cast("timestamp_ntz")).select("user_id", "event_type", "ts", "event_id")


@query("""
SELECT user_id AS key, event_type AS status, event_id AS payload FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'error' THEN 0 ELSE 1 END DESC, CASE WHEN event_id % 2 = 1 THEN 1 ELSE 0 END DESC, ts DESC, event_type, event_id) AS pos FROM events) WHERE pos = 1""")
def cache_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd events are new, even ones old; errors never replace an observation."""
    e = table(spark, sf_dir, "events").select(F.lit("u").alias("source"), F.col("user_id").alias("key"), F.col("event_type").alias("status"), F.col("ts").alias("updated_at"), F.col("event_id").alias("payload"))
    odd = F.col("payload") % 2 == 1
    return state.upsert(e.where(~odd), e.where(odd)).select("key", "status", "payload")


@query("""
SELECT o_orderkey AS tx, CAST(floor(o_totalprice) AS BIGINT) AS price, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
WHERE o_orderstatus <> 'P' AND o_totalprice >= 200000 AND o_orderpriority <> '5-LOW'""")
def archive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of the positional archive, through its filters."""
    blank = F.lit("")
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("tx"), F.floor("o_totalprice").cast("string").alias("price"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm").alias("day"), blank.alias("postcode"), F.when(F.col("o_orderpriority") == "5-LOW", "O").otherwise("D").alias("type"), blank.alias("is_new"), blank.alias("tenure"),
        *[blank.alias(c) for c in "paon saon street locality town district".split()], F.lit(" Anyshire ").alias("county"), blank.alias("category"), F.when(F.col("o_orderstatus") == "P", "D").otherwise("A").alias("status"),
    )
    return feeds.archive_rows(raw, 200000, "Anyshire").select(F.col("tx").cast("long").alias("tx"), "price", "day")
