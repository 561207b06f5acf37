"""Summaries, filters, distinct rows and identities of the ledger, over orders and lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.temporal import velocity_cutoff
from plinth.functions.text import category, lenient_number, mapped, price_text, property_record_id, property_type, rule_id, transaction_id
from plinth.operators import aggregates, dedup
from plinth.plans.registry import query, table


@query("""
SELECT c_mktsegment AS market, count(*) AS count, CAST(round_even(avg(o_totalprice), 0) AS BIGINT) AS avg, max(o_orderdate) AS latest, max(o_totalprice) AS max,
  CAST(round_even(avg(o_totalprice / 100) FILTER (WHERE o_orderstatus <> 'P'), 0) AS BIGINT) AS avg_rate, count(*) FILTER (WHERE o_orderstatus <> 'P') AS rated
FROM orders JOIN customer ON o_custkey = c_custkey WHERE trim(c_mktsegment) <> '' GROUP BY 1""")
def market_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).withColumn("rate", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 100)).withColumnRenamed("c_mktsegment", "market")
    return aggregates.summary(rows, "market", "o_totalprice", "o_orderdate", "rate")


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_totalprice >= 400000 AND o_orderdate >= TIMESTAMP '1996-01-01'")
def price_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").where((F.col("o_totalprice") >= 400000) & (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")))
    return rows.select("o_orderkey", "o_totalprice", "o_orderdate").orderBy(F.desc("o_orderdate"), F.desc("o_totalprice"), F.desc("o_orderkey"))


_LINE = "l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query(f"""
SELECT {_LINE} FROM (SELECT {_LINE}, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS pos FROM lineitem) WHERE pos = 1""")
def first_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c) for c in "l_shipdate l_partkey l_suppkey l_quantity l_extendedprice".split()]
    return dedup.first_wins(table(spark, sf_dir, "lineitem").select(*_LINE.split(", ")), ["l_orderkey", "l_linenumber"], order)


@query("""
SELECT user_id, event_type, min(event_id) AS event_id, max_by(value, event_id) AS value FROM events GROUP BY user_id, event_type""")
def last_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return dedup.last_wins(rows, ["user_id", "event_type"], "event_id")


@query("""
SELECT o_custkey, o_orderdate, o_orderkey, pos FROM (
  SELECT o_custkey, o_orderdate, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS INTEGER) AS pos FROM orders) WHERE pos <= 6""")
def top_six_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window as W

    order = [F.desc("o_orderdate"), F.col("o_orderkey")]
    top = dedup.top_k(table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], order, 6)
    return top.withColumn("pos", F.row_number().over(W.partitionBy("o_custkey").orderBy(*order)))


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT o_orderkey, 'tx-' || substr(sha256(o_orderkey || '|' || o_custkey || '|' || upper(o_orderstatus) || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|' || upper(o_orderpriority) || '|'), 1, 20) AS transaction_id,
  'pe:' || o_orderstatus || ':' || trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '-', 'g'), '-') || ':whole' AS rule_id,
  'GBP ' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS price_text FROM orders""")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", transaction_id("tx-", "o_orderkey", "o_custkey", "o_orderstatus", day, "o_orderpriority", F.lit(None)).alias("transaction_id"),
        rule_id("o_orderstatus", "o_orderpriority", F.lit("whole")).alias("rule_id"), price_text("o_totalprice").alias("price_text"),
    )


@query("""
WITH a AS (SELECT c_custkey, upper(c_mktsegment) || ' ' || c_custkey AS line, c_custkey % 7 = 0 AS tailed FROM customer)
SELECT c_custkey AS id, 'property:' || line || CASE WHEN c_custkey % 3 = 0 THEN ' KT11 2JJ|KT112JJ' WHEN c_custkey % 3 = 1 THEN '|GU14QQ' WHEN tailed THEN ' KT22 7RX|KT227RX' ELSE '|NOPOSTCODE' END AS property_id FROM a""")
def property_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    code = F.when(k % 3 == 0, "KT11 2JJ").when(k % 3 == 1, "gu1-4qq").otherwise("")
    tail = F.when((k % 3 == 2) & (k % 7 == 0), ", kt22 7rx").when(k % 3 == 0, ", KT11 2JJ").otherwise("")
    line = F.concat(F.lower("c_mktsegment"), F.lit(",  "), k.cast("string"), tail)
    return table(spark, sf_dir, "customer").select(k.alias("id"), property_record_id(line, code).alias("property_id"))


@query("""
SELECT p_partkey, CAST(regexp_extract(p_brand, '-?[0-9]+(\\.[0-9]+)?') AS DOUBLE) AS number, CASE p_type WHEN 'ECONOMY' THEN 'Detached' WHEN 'MEDIUM' THEN 'Terraced' ELSE NULL END AS kind,
  CASE p_type WHEN 'PROMO' THEN 'B' WHEN 'SMALL' THEN 'A' WHEN 'LARGE' THEN 'X' ELSE 'A' END AS category,
  CASE p_type WHEN 'STANDARD' THEN 'woking-district' WHEN 'LARGE' THEN 'spelthorne' ELSE NULL END AS market FROM part""")
def code_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("p_type")
    kind = F.when(t == "ECONOMY", "http://example.org/def/detached").when(t == "MEDIUM", "T").otherwise("O")
    cat = F.when(t == "PROMO", "http://example.org/additionalPricePaidTransaction").when(t == "SMALL", "category-a").when(t == "LARGE", "category-x").otherwise("")
    place = F.when(t == "STANDARD", " Woking ").when(t == "LARGE", "SPELTHORNE").otherwise("elsewhere")
    return table(spark, sf_dir, "part").select("p_partkey", lenient_number("p_brand").alias("number"), property_type(kind).alias("kind"), category(cat).alias("category"), mapped(place, {"woking": "woking-district", "spelthorne": "spelthorne"}).alias("market"))


@query("""
WITH m AS (SELECT l_returnflag, CAST(max(l_shipdate) AS DATE) AS latest FROM lineitem GROUP BY 1),
c AS (SELECT l_returnflag, latest, last_day(latest - INTERVAL 2 MONTH) AS cutoff FROM m)
SELECT l_returnflag, latest, cutoff, count(*) FILTER (WHERE CAST(l_shipdate AS DATE) <= cutoff) AS mature, count(*) AS n FROM lineitem JOIN c USING (l_returnflag) GROUP BY 1, 2, 3""")
def velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", F.to_date("l_shipdate").alias("day"))
    # Counts per day are small, so the cutoff joins with them and the lines are read once.
    days = rows.groupBy("l_returnflag", "day").agg(F.count("*").alias("k"))
    latest = days.groupBy("l_returnflag").agg(F.max("day").alias("latest")).withColumn("cutoff", velocity_cutoff("latest", 2))
    return days.join(latest, "l_returnflag").groupBy("l_returnflag", "latest", "cutoff").agg(F.sum(F.when(F.col("day") <= F.col("cutoff"), F.col("k")).otherwise(0)).alias("mature"), F.sum("k").alias("n"))


@query("""
SELECT count(*) AS rows, count(DISTINCT nullif(trim(o_orderpriority), '')) AS postcodes, count(DISTINCT o_custkey) AS properties, max(o_orderdate) AS latest FROM orders""")
def dataset_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.metadata(table(spark, sf_dir, "orders"), "o_orderpriority", "o_custkey", "o_orderdate")


@query("SELECT p_name AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, value LIMIT 12")
def most_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.value_counts(table(spark, sf_dir, "part"), "p_name", 12)


@query("""
SELECT o_custkey, list({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus} ORDER BY o_orderdate, o_orderkey)::VARCHAR AS items FROM orders GROUP BY 1""")
def history_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = aggregates.grouped_list(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"])
    one = F.transform("items", lambda x: F.concat(F.lit("{'o_orderkey': "), x["o_orderkey"].cast("string"), F.lit(", 'o_orderstatus': "), x["o_orderstatus"], F.lit("}")))
    return out.select("o_custkey", F.concat(F.lit("["), F.array_join(one, ", "), F.lit("]")).alias("items"))


@query("SELECT min(year(o_orderdate)) AS first_year, max(year(o_orderdate)) AS last_year FROM orders")
def year_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    return aggregates.year_range(rows, F.year("o_orderdate").cast("long"))
