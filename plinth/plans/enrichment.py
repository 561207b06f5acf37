"""Dimensions, certificate facts, places, corrections and repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions import records
from plinth.operators import enrich
from plinth.plans.registry import LAT, LON, located, query, table


@query(f"""
WITH d AS (SELECT 'B' || (s_suppkey % 60) AS code, CAST({LAT.format(k="s_suppkey")} AS DOUBLE) AS lat, CAST({LON.format(k="s_suppkey")} AS DOUBLE) AS lon FROM supplier),
f AS (SELECT code, lat, lon FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY lat, lon) AS pos FROM d) WHERE pos = 1)
SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 51.5 ELSE round(lat, 7) END AS latitude, CASE WHEN c_custkey % 3 = 0 THEN -0.25 ELSE round(lon, 7) END AS longitude, CASE WHEN c_custkey % 3 = 0 THEN 'row' WHEN lat IS NOT NULL THEN 'postcode' END AS coordinate_source
FROM customer LEFT JOIN f ON code = 'B' || (c_custkey % 90)""")
def geocode_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = located(table(spark, sf_dir, "supplier"), "s_suppkey").select(F.concat(F.lit("b "), (F.col("s_suppkey") % 60).cast("string")).alias("postcode"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), F.concat(F.lit("B"), (k % 90).cast("string")).alias("postcode"), F.when(k % 3 == 0, 51.5).alias("latitude"), F.when(k % 3 == 0, -0.25).alias("longitude"))
    return enrich.geocoded(rows, s).select("id", "latitude", "longitude", "coordinate_source")


@query("""
SELECT p_partkey AS id, CAST(round_even(p_size * 7 + 0.25, 1) AS DOUBLE) AS sqm, CAST(round_even((p_size * 7 + 0.25::DOUBLE) * 10.76391041671::DOUBLE, 0) AS BIGINT) AS sqft, CAST(round_even(p_retailprice * 1000 / round_even((p_size * 7 + 0.25::DOUBLE) * 10.76391041671::DOUBLE, 0), 0) AS BIGINT) AS per_sqft FROM part""")
def floor_area_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = records.epc_facts((F.col("p_size") * 7 + 0.25).cast("double"), F.col("p_retailprice") * 1000)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), facts.alias("f")).select("id", "f.sqm", "f.sqft", "f.per_sqft")


@query("""
WITH e AS (SELECT user_id, event_id, 'P' || (event_id % 9) AS name, CASE event_type WHEN 'error' THEN 'station' WHEN 'click' THEN 'fast food' ELSE 'place' END AS kind, CAST(51.0 + (event_id % 97) / 10000.0::DOUBLE AS DOUBLE) AS lat FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id, lower(name), kind ORDER BY event_id) AS first FROM e),
m AS (SELECT user_id, name, kind, event_id, CAST(round(2 * 6371000.0 * asin(sqrt(pow(sin(radians(lat - 51.0) / 2), 2)))) AS BIGINT) AS metres FROM o WHERE first = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, kind = 'station' ORDER BY metres, event_id) AS pos FROM m)
SELECT user_id, name, kind, metres FROM r WHERE pos <= CASE WHEN kind = 'station' THEN 1 ELSE 6 END""")
def nearby_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("event_id"), F.col("event_type")
    name = F.concat(F.lit("P"), (k % 9).cast("string"))
    tags = F.when(t == "error", F.create_map(F.lit("name"), name, F.lit("railway"), F.lit("station"))).when(t == "click", F.create_map(F.lit("name"), name, F.lit("amenity"), F.lit("fast_food"))).otherwise(F.create_map(F.lit("name"), name))
    rows = table(spark, sf_dir, "events").select("user_id", k.alias("ordinal"), tags.alias("tags"), (F.lit(51.0) + (k % 97) / F.lit(10000.0)).alias("place_lat"), F.lit(0.0).alias("place_lon"))
    return enrich.nearby_places(rows, "user_id", F.lit(51.0), F.lit(0.0))


@query("""
SELECT n_nationkey, n_name, CASE WHEN n_nationkey = 3 AND n_name = 'NATION_3' THEN 99 ELSE n_regionkey END AS n_regionkey FROM nation""")
def corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    fix = spark.createDataFrame([(3, "NATION_3", 99), (4, "NATION_3", 98)], "n_nationkey int, n_name string, n_regionkey int")
    return enrich.corrected(table(spark, sf_dir, "nation"), fix, ["n_nationkey", "n_name"])


@query("SELECT c_custkey FROM customer WHERE 'B' || (c_custkey % 50) IN (SELECT 'B' || (s_suppkey % 7) FROM supplier)")
def postcode_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("b"), (F.col("c_custkey") % 50).cast("string")).alias("code"))
    wanted = table(spark, sf_dir, "supplier").select(F.concat(F.lit("B "), (F.col("s_suppkey") % 7).cast("string")).alias("code"))
    return enrich.in_list(rows, "code", wanted).select("c_custkey")


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'Order ' || o_custkey || CASE WHEN contains('Order ' || o_custkey, CAST(o_orderkey AS VARCHAR)) THEN '' ELSE ' (' || o_orderkey || ')' END WHEN o_orderstatus = 'F' THEN 'Ref ' || o_orderkey ELSE 'Planning application' END AS label,
  (o_custkey % 40) || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|1200' AS planning_key, CASE WHEN o_orderstatus = 'F' THEN 'SC' || o_custkey ELSE '' END AS company, CAST(floor(o_orderkey / 8) AS BIGINT) AS chunk FROM orders""")
def labels_and_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    name = F.when(s == "O", F.concat(F.lit(" Order "), F.col("o_custkey").cast("string")))
    address = F.when(s == "F", F.concat(F.lit("Ref "), k))
    label = records.application_label(name, F.lit(None), address, F.when(s != "P", k))
    company = F.when(s == "F", F.concat(F.lit("sc "), F.col("o_custkey").cast("string")))
    key = records.planning_key((F.col("o_custkey") % 40).cast("string"), k, F.col("o_orderdate"), 1200)
    return table(spark, sf_dir, "orders").select("o_orderkey", label.alias("label"), key.alias("planning_key"), records.company_number(F.lit(" "), company).alias("company"), records.chunk(F.col("o_orderkey"), 8).alias("chunk"))


@query("""
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'successful' END AS lookup_status, CAST(CASE WHEN event_type = 'click' THEN greatest(1, event_id % 4) WHEN event_type = 'view' THEN 0 END AS INTEGER) AS constraint_count FROM events""")
def repaired_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("event_type")
    state = F.when(t == "click", "Matched").when(t == "view", "no_match").otherwise("error")
    fixed = enrich.repaired_lookup(state, (F.col("event_id") % 4).cast("double"), F.lit(None).cast("string"), F.lit("2024-01-01"))
    return table(spark, sf_dir, "events").select("event_id", fixed.alias("f")).select("event_id", "f.lookup_status", "f.constraint_count")
