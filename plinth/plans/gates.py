"""Coverage, freshness, reconciliation and contract checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.text import house_ranges, planning_year, present
from plinth.operators import aggregates, lookup, planning, quality, state
from plinth.plans.registry import query, table

_NOW = "2024-01-20 00:00:00"


@query("""
WITH j AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)),
c AS (SELECT count(*) AS total, count(*) FILTER (WHERE trim(text) <> '') AS f0, count(*) FILTER (WHERE quality IS NOT NULL) AS f1, count(*) FILTER (WHERE quality = 1) AS f2, count(*) FILTER (WHERE toxic = 0) AS f3 FROM j)
SELECT name, found, total, CAST(round(CAST(found AS DECIMAL(20, 0)) * 100 / total, 1) AS DOUBLE) AS pct, minimum FROM c, LATERAL (VALUES ('text', f0, 99.0::DOUBLE), ('labelled', f1, 35.0::DOUBLE), ('good', f2, 75.0::DOUBLE), ('clean', f3, 30.0::DOUBLE)) t(name, found, minimum)""")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return aggregates.coverage(rows, {"text": (present("text"), 99.0), "labelled": (F.col("quality").isNotNull(), 35.0), "good": (F.col("quality") == 1, 75.0), "clean": (F.col("toxic") == 0, 30.0)})


@query(f"""
SELECT CASE WHEN t IS NULL THEN 'missing' WHEN epoch(TIMESTAMP '{_NOW}') - floor(epoch(t)) BETWEEN 0 AND 30 * 3600 THEN 'fresh' ELSE 'stale' END AS state, count(*) AS n
FROM (SELECT CASE WHEN event_type <> 'error' THEN ts END AS t FROM events) GROUP BY 1""")
def freshness_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.when(F.col("event_type") != "error", F.col("ts").cast("timestamp")).alias("t"))
    return aggregates.freshness_histogram(rows, "t", F.lit(_NOW).cast("timestamp"))


@query("""
SELECT o_orderkey, unnest(list_filter([CASE WHEN o_orderkey % 11 = 0 THEN 'o_orderstatus' END, CASE WHEN o_orderkey % 13 = 0 THEN 'o_orderpriority' END], lambda x: x IS NOT NULL)) AS "column" FROM orders""")
def replay_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    k = F.col("o_orderkey")
    replayed = stored.select(k, F.when(k % 11 == 0, "?").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.when(k % 13 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    return quality.replay_mismatches(stored, replayed, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("""
SELECT key, 'base' AS side FROM (SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT key, 'emitted' FROM (SELECT o_custkey AS key FROM orders EXCEPT SELECT c_custkey FROM customer)""")
def key_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.missing_keys(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")), "key")


@query("""
WITH e AS (SELECT CASE WHEN o_orderkey % 97 = 0 THEN -o_custkey ELSE o_custkey END AS key FROM orders), b AS (SELECT c_custkey AS key FROM customer)
SELECT key, 'base' AS side FROM (SELECT key FROM b EXCEPT SELECT key FROM e) UNION ALL SELECT key, 'emitted' FROM (SELECT key FROM e EXCEPT SELECT key FROM b)""")
def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``key_integrity``, with keys that the other table doesn't have on either side."""
    k = F.col("o_custkey")
    emitted = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 97 == 0, -k).otherwise(k).alias("key"))
    return lookup.missing_keys(emitted, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")), "key")


@query("""
SELECT count(*) AS rows, count(*) FILTER (WHERE l_returnflag = 'A') AS preserved, count(*) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'F') AS reused, count(*) FILTER (WHERE l_returnflag <> 'A') AS "new" FROM lineitem""")
def cohort_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_returnflag") == "A").alias("carried"), ((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")).alias("reused"))
    return aggregates.cohort_counts(rows)


@query("""
WITH j AS (SELECT CASE WHEN quality = 1 THEN 'matched' WHEN toxic = 1 THEN 'error' WHEN quality = 0 THEN 'no_match' END AS status, floor((doc_id % 25) * 12 / 24.0) AS age FROM documents LEFT JOIN labels USING (doc_id)),
k AS (SELECT *, coalesce(status = 'matched', false) AS m, coalesce(status = 'no_match' AND age < 10, false) AS n FROM j)
SELECT count(*) AS requested, count(*) FILTER (WHERE m OR n) AS resolved, count(*) FILTER (WHERE NOT m AND NOT n) AS pending, count(*) FILTER (WHERE status = 'error') AS errors, count(*) FILTER (WHERE m) AS matched, count(*) FILTER (WHERE n) AS no_match FROM k""")
def terminal_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as cached evidence of 0 to 12 days, in half days, so some lie exactly at the limit of 10 and half a day beyond."""
    now = F.lit(_NOW).cast("timestamp")
    status = F.when(F.col("quality") == 1, "matched").when(F.col("toxic") == 1, "error").when(F.col("quality") == 0, "no_match")
    cache = table(spark, sf_dir, "labels").select("doc_id", status.alias("status"), (now - F.make_dt_interval(hours=(F.col("doc_id") % 25 * 12).cast("int"))).alias("updated_at"))
    return aggregates.terminal_accounting(table(spark, sf_dir, "documents"), cache, "doc_id", "status", "updated_at", now, 10)


_TTL = f"""
WITH s AS (SELECT user_id, event_type, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type, event_id) AS pos FROM events),
c AS (SELECT user_id, event_type AS status, (epoch(TIMESTAMP '{_NOW}') - floor(epoch(ts))) / 3600.0 AS age FROM s WHERE pos = 1),
p AS (SELECT user_id, [age < 240, status = 'click' AND floor(age / 24) < 10, CASE status WHEN 'click' THEN true WHEN 'error' THEN false ELSE floor(age / 24) < 10 END, status <> 'error' AND age * 3600 < 864000] AS ok FROM c),
u AS (SELECT DISTINCT user_id FROM events)
SELECT user_id, policy FROM u JOIN p USING (user_id), LATERAL (VALUES ('any', 1), ('matched', 2), ('certificate', 3), ('seconds', 4)) t(policy, k) WHERE NOT ok[k]"""


@query(_TTL)
def ttl_work_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which users' cached state has to be fetched again, under each of the four policies."""
    e = table(spark, sf_dir, "events")
    cache = e.select(F.lit("users").alias("source"), F.col("user_id").alias("key"), F.col("event_type").alias("status"), F.col("ts").cast("timestamp").alias("updated_at"), F.col("event_id").alias("payload"))
    newest = state.latest(cache).withColumn("status", F.when(F.col("status") == "click", "matched").otherwise(F.col("status")))
    users = e.select(F.col("user_id").alias("key")).distinct()
    now = F.lit(_NOW).cast("timestamp")
    parts = [state.work_set(users, newest, "key", now, 10, p).select(F.col("key").alias("user_id"), F.lit(p).alias("policy")) for p in ("any", "matched", "certificate", "seconds")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("""
SELECT p_partkey, CASE WHEN p_size <= p_partkey % 50 THEN p_size END AS minimum, CASE WHEN p_size <= p_partkey % 50 THEN CAST(p_partkey % 50 AS INTEGER) END AS maximum, CASE WHEN p_size <= p_partkey % 50 THEN CASE WHEN p_partkey % 2 = 0 THEN 'odd' ELSE '' END END AS parity,
  CAST(CASE WHEN p_partkey % 3 = 0 THEN 1995 + p_size WHEN p_partkey % 3 = 1 AND p_size BETWEEN 10 AND 24 THEN 2000 + p_size WHEN p_partkey % 3 = 1 AND p_size > 24 THEN 1900 + p_size END AS INTEGER) AS year FROM part""")
def parsed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = F.concat(size, F.lit(" - "), (k % 50).cast("string"), F.when(k % 2 == 0, " Odd").otherwise(""))
    ranges = house_ranges(F.array(text))
    reference = F.when(k % 3 == 0, F.concat(F.lit("AB/"), (F.col("p_size") + 1995).cast("string"), F.lit("/1"))).when(k % 3 == 1, F.concat(size, F.lit("/0001"))).otherwise("none")
    r = F.get(ranges, 0)
    return table(spark, sf_dir, "part").select("p_partkey", r["minimum"].alias("minimum"), r["maximum"].alias("maximum"), r["parity"].alias("parity"), planning_year(F.lit(""), reference, now_year=2024).alias("year"))


@query("""
WITH e AS (SELECT user_id, event_type AS dataset, 'n' || (event_id % 5) AS name FROM events),
g AS (SELECT user_id, dataset, count(*) AS n, list_sort(list_distinct(list(name))) AS names FROM e GROUP BY 1, 2)
SELECT user_id, CAST(sum(n) AS BIGINT) AS constraint_count, max(CASE WHEN dataset = 'click' THEN 'Clicks: ' || array_to_string(names[1:3], ', ') || CASE WHEN len(names) > 3 THEN ' +' || (len(names) - 3) || ' more' ELSE '' END END) AS clicks FROM g GROUP BY 1""")
def constraint_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("dataset"), F.concat(F.lit("n"), (F.col("event_id") % 5).cast("string")).alias("name"))
    out = planning.constraint_labels(rows, "user_id", {"click": "Clicks"})
    return out.select("user_id", "constraint_count", F.try_element_at("labels", F.lit("Clicks")).alias("clicks"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'observed' WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'observed' ELSE 'unavailable' END ELSE 'unknown' END AS status, CASE WHEN o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderkey % 2 = 0) THEN true ELSE true END AS truthful FROM orders""")
def planning_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observation states: found, failed with and without a prior observation, nothing found; all of them truthful."""
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    app = F.array(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_custkey").alias("metres"), k.cast("string").alias("reference"), F.col("o_orderpriority").alias("description"))).cast(f"array<{planning.APPLICATION}>")
    none = F.array().cast(f"array<{planning.APPLICATION}>")
    context = planning.planning_context(F.when(s == "F", app).otherwise(none), s == "O", F.when(k % 2 == 0, planning.planning_context(app, F.lit(False), F.lit(None).cast(f"struct<coverage_status:string,coverage_mode:string,count:int,latest:string,applications:array<{planning.APPLICATION}>>"))))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", context.alias("c"))
    truth = quality.planning_truthful(F.col("c.coverage_status"), F.col("c.coverage_mode"), F.col("c.applications"), F.col("c.latest"), F.col("c.count"))
    return rows.select("o_orderkey", F.col("c.coverage_status").alias("status"), truth.alias("truthful"))


@query("SELECT s_suppkey AS id, s_name AS address, s_acctbal AS price FROM supplier")
def contract_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("address"), F.col("s_acctbal").alias("price"), F.lit("x").alias("epc_address"), F.lit("y").alias("companies_house"))
    return quality.Contract().project(rows)
