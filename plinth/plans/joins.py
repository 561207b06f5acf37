"""Look-up, rule and fuzzy joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.text import jaccard
from plinth.operators import fuzzy, lookup, rules
from plinth.operators.dedup import spread
from plinth.plans.registry import query, table

_NEW = "SELECT o_orderkey AS id, 'E' || o_orderkey AS k1, o_custkey || '|' || strftime(o_orderdate, '%Y%m%d') AS k2, o_custkey || '|' || o_orderstatus AS k3, o_custkey AS donor, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders"
_OLD = "SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE 'E' END || o_orderkey AS k1, o_custkey || '|' || strftime(o_orderdate, '%Y%m%d') AS k2, o_custkey || '|' || o_orderstatus AS k3, o_custkey AS donor, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS note, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey % 100 + 25 END AS area FROM orders"


@query(f"""
WITH n AS ({_NEW}), o AS ({_OLD}),
e AS (SELECT k1, max_by({{'note': note, 'area': area}}, ord) AS r FROM o GROUP BY 1),
a2 AS (SELECT k2, any_value({{'note': note, 'area': area}}) AS r FROM o GROUP BY 1 HAVING count(*) = 1),
a3 AS (SELECT k3, any_value({{'note': note, 'area': area}}) AS r FROM o GROUP BY 1 HAVING count(*) = 1),
dn AS (SELECT donor, min_by({{'note': note, 'area': area}}, ord) AS r FROM o WHERE note IS NOT NULL OR area IS NOT NULL GROUP BY 1),
j AS (SELECT n.*, coalesce(e.r, CASE WHEN count(*) OVER (PARTITION BY n.k2) = 1 THEN a2.r END, CASE WHEN count(*) OVER (PARTITION BY n.k3) = 1 THEN a3.r END) AS m, dn.r AS d
  FROM n LEFT JOIN e ON n.k1 = e.k1 LEFT JOIN a2 ON n.k2 = a2.k2 LEFT JOIN a3 ON n.k3 = a3.k3 LEFT JOIN dn ON n.donor = dn.donor)
SELECT id, price, coalesce(m.note, d.note) AS note, coalesce(m.area, d.area) AS area, CAST(round_even(price / coalesce(m.area, d.area), 0) AS BIGINT) AS rate,
  coalesce(m.note, d.note) IS NOT NULL OR coalesce(m.area, d.area) IS NOT NULL AS carried, (m.note IS NULL AND d.note IS NOT NULL) OR (m.area IS NULL AND d.area IS NOT NULL) AS reused FROM j""")
def priority_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    cust = F.col("o_custkey").cast("string")
    keys = [F.concat(cust, F.lit("|"), F.date_format("o_orderdate", "yyyyMMdd")).alias("k2"), F.concat(cust, F.lit("|"), F.col("o_orderstatus")).alias("k3"), F.col("o_custkey").alias("donor")]
    new = o.select(k.alias("id"), F.concat(F.lit("E"), k.cast("string")).alias("k1"), *keys, F.floor("o_totalprice").cast("long").alias("price"))
    old = o.select(k.alias("ord"), F.concat(F.when(k % 3 == 0, "X").otherwise("E"), k.cast("string")).alias("k1"), *keys, F.when(k % 5 != 0, F.col("o_orderpriority")).alias("note"), F.when(k % 4 != 0, F.col("o_custkey") % 100 + 25).alias("area"), F.lit(None).cast("long").alias("rate"))
    out = lookup.priority_lookup(new, old, "k1", ["k2", "k3"], "donor", "ord", ["note", "area", "rate"], price="price", area="area", rate="rate")
    return out.select("id", "price", "note", "area", "rate", "carried", "reused")


@query("""
WITH e AS (SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN value END AS value, CASE WHEN event_id % 7 = 0 THEN event_type END AS kind FROM events),
d AS (SELECT user_id, min_by(value, event_id) FILTER (WHERE value IS NOT NULL) AS value, min_by(kind, event_id) FILTER (WHERE kind IS NOT NULL) AS kind FROM e GROUP BY 1)
SELECT event_id, user_id, coalesce(e.value, d.value) AS value, coalesce(e.kind, d.kind) AS kind FROM e JOIN d USING (user_id)""")
def donor_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(k % 3 == 0, F.col("value")).alias("value"), F.when(k % 7 == 0, F.col("event_type")).alias("kind"))
    return lookup.donor_fill(rows, "user_id", "event_id", ["value", "kind"])


#: (rule, street, aliases, authority, towns, postcodes, lowest, highest, parity)
_RULES = [
    ("r1", "BRAND 1", ["BRAND 11"], "ECONOMY", ["T0", "T1"], [], None, None, ""),
    ("r2", "BRAND 2", [], "MEDIUM", ["T2"], [], 1, 25, "odd"),
    ("r3", "BRAND 2", [], "MEDIUM", ["T2"], [], 20, 50, ""),
    ("r4", "BRAND 3", ["BRAND 3"], "PROMO", ["T0"], [], None, None, ""),
    ("r5", "BRAND 5", ["BRAND 15", "BRAND 25"], "LARGE", ["T0", "T1", "T2"], ["P1", "P2"], None, None, ""),
    ("r6", "BRAND 7", [], "SMALL", ["T1"], [], 10, 40, "even"),
    ("r7", "BRAND 8", [], "STANDARD", ["T3"], [], None, None, ""),
]


def _list(values: list[str]) -> str:
    return f"[{', '.join(repr(v) for v in values)}]::VARCHAR[]"


@query(f"""
WITH rules(rule, street, authority, towns, codes, low, high, parity) AS (VALUES {", ".join(f"('{r}', {_list([s, *al])}, '{a}', {_list(t)}, {_list(p)}, {lo if lo is not None else "NULL::INTEGER"}, {hi if hi is not None else "NULL::INTEGER"}, '{par}')" for r, s, al, a, t, p, lo, hi, par in _RULES)}),
spelt AS (SELECT * EXCLUDE (street), unnest(street) AS street FROM rules),
rows_ AS (SELECT p_partkey AS id, upper(replace(p_brand, '#', ' ')) AS street, p_type AS authority, 'T' || (p_partkey % 4) AS town, 'P' || (p_partkey % 3) AS code, p_size AS house FROM part),
hits AS (SELECT id, count(*) AS n, any_value(rule) AS rule FROM rows_ JOIN spelt USING (street, authority)
  WHERE list_contains(towns, town) AND (len(codes) = 0 OR list_contains(codes, code)) AND (low IS NULL OR (house BETWEEN low AND high AND (parity = '' OR house % 2 = CASE parity WHEN 'odd' THEN 1 ELSE 0 END))) GROUP BY 1)
SELECT id, house, CASE WHEN n = 1 THEN rule END AS rule FROM rows_ LEFT JOIN hits USING (id)""")
def rule_join_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(k.alias("id"), F.upper(F.replace("p_brand", F.lit("#"), F.lit(" "))).alias("street"), F.col("p_type").alias("authority"), F.concat(F.lit("T"), (k % 4).cast("string")).alias("town"), F.concat(F.lit("P"), (k % 3).cast("string")).alias("code"), F.col("p_size").alias("house"), F.col("p_size").cast("string").alias("paon"))
    schema = "rule string, street string, aliases array<string>, authorities array<string>, towns array<string>, postcodes array<string>, ranges array<struct<minimum:int,maximum:int,parity:string>>"
    known = spark.createDataFrame([(r, s, al, [a], t, p, [] if lo is None else [(lo, hi, par)]) for r, s, al, a, t, p, lo, hi, par in _RULES], schema)
    return rules.unique_rule_join(rows, known, "id", "street", "authority", F.array("town"), "code", "paon", ["rule"]).select("id", "house", "rule")


def _line(key: str, kind: str) -> str:
    return f"{key} % 40 || ' ' || list_extract(['OAK', 'ELM', 'ASH', 'THE YEW'], CAST({key} % 4 AS INTEGER) + 1) || ' COTTAGE ' || {kind}"


@query(f"""
WITH l AS (SELECT c_custkey AS id, c_nationkey AS block, string_split({_line("c_custkey", "c_mktsegment")}, ' ') AS w, CAST(c_custkey % 40 AS VARCHAR) AS no FROM customer),
r AS (SELECT s_suppkey AS site, s_nationkey AS block, string_split({_line("s_suppkey", "CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END")}, ' ') AS w, CAST(s_suppkey % 40 AS VARCHAR) AS no, s_acctbal FROM supplier),
x AS (SELECT id, site, list_filter(l.w, lambda t: length(t) >= 2 AND t <> 'THE') AS a, list_filter(r.w, lambda t: length(t) >= 2 AND t <> 'THE') AS b, l.no = r.no AS same_no, s_acctbal FROM l JOIN r USING (block)),
y AS (SELECT *, len(list_intersect(a, b)) AS n, len(list_distinct(list_concat(a, b))) AS u, least(len(list_distinct(a)), len(list_distinct(b))) AS m, list_filter(a, lambda t: NOT regexp_matches(t, '^[0-9]+$'))[1] AS lead FROM x),
s AS (SELECT id, site, s_acctbal, round(least(1.0::DOUBLE, 0.62::DOUBLE * n / m + 0.28::DOUBLE * n / u + CASE WHEN same_no THEN 0.14 ELSE 0 END + CASE WHEN n > 0 AND list_contains(b, lead) THEN 0.06 ELSE 0 END), 6) AS score FROM y),
k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, site) AS pos FROM s)
SELECT id, site, score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, site) AS best FROM k WHERE pos <= 8 AND score >= 0.55 AND s_acctbal > 0) WHERE best = 1""")
def token_match_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = F.array(*[F.lit(x) for x in ("OAK", "ELM", "ASH", "THE YEW")])

    def line(key: str, kind) -> object:
        k = F.col(key)
        return F.concat_ws(" ", (k % 40).cast("string"), F.get(trees, (k % 4).cast("int")), F.lit("COTTAGE"), kind)

    c, s = spread(table(spark, sf_dir, "customer"), "c_custkey"), table(spark, sf_dir, "supplier")
    blank = F.lit("")
    left = c.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("block"), line("c_custkey", F.col("c_mktsegment")).alias("la"))
    right = s.select(F.col("s_suppkey").alias("site"), F.col("s_nationkey").alias("block"), line("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, "BUILDING").otherwise("MACHINERY")).alias("ra"), "s_acctbal")
    left = left.withColumn("lt", fuzzy.address_tokens(F.col("la"), blank, blank)).withColumn("ln", fuzzy.numbers(F.col("la"))).drop("la")
    right = right.withColumn("rt", fuzzy.address_tokens(F.col("ra"), blank, blank)).withColumn("rn", fuzzy.numbers(F.col("ra"))).drop("ra")
    score = fuzzy.token_score(F.col("lt"), F.col("rt"), F.col("ln"), F.col("rn"), blank, blank)
    return fuzzy.best_token_match(left, right, "block", "id", score, F.col("s_acctbal") > 0, [F.col("site")], row_columns=["lt", "ln"], candidate_columns=["rt", "rn"]).select("id", "site", "score")


@query("""
WITH p AS (SELECT c_custkey AS id, c_nationkey AS block, CASE WHEN c_custkey % 3 = 0 THEN 'NONE ' ELSE 'HOUSE ' END || c_custkey AS address FROM customer),
reg AS (SELECT o_orderkey AS sale_id, c_nationkey AS block, CASE WHEN o_orderkey % 2 = 0 THEN 'HOUSE ' ELSE 'OLD HOUSE ' END || c_custkey AS sale_address, o_orderdate AS date, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders JOIN customer ON o_custkey = c_custkey),
known AS (SELECT o_custkey AS id, o_orderdate AS date, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders),
exact AS (SELECT id, sale_id FROM p JOIN reg USING (block) WHERE address = sale_address),
rest AS (SELECT * FROM p WHERE id NOT IN (SELECT id FROM exact)),
signed AS (SELECT id, block, sale_address, len(list_intersect(string_split(address, ' '), string_split(sale_address, ' '))) / len(list_distinct(list_concat(string_split(address, ' '), string_split(sale_address, ' ')))) AS score FROM rest JOIN reg USING (block) JOIN known USING (id, date, price)),
anchor AS (SELECT id, block, arg_max(sale_address, {'s': score, 'a': sale_address}) AS sale_address FROM signed GROUP BY 1, 2)
SELECT id, sale_id, 'exact-address' AS method FROM exact UNION SELECT id, sale_id, 'known-sale-anchor' FROM anchor JOIN reg USING (block, sale_address)""")
def anchor_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    o = table(spark, sf_dir, "orders")
    price = F.floor("o_totalprice").cast("long").alias("price")
    p = c.select(k.alias("property_id"), F.col("c_nationkey").alias("block"), F.concat(F.when(k % 3 == 0, "NONE ").otherwise("HOUSE "), k.cast("string")).alias("address"))
    reg = o.join(c, F.col("o_custkey") == k).select(F.col("o_orderkey").alias("sale_id"), F.col("c_nationkey").alias("block"), F.concat(F.when(F.col("o_orderkey") % 2 == 0, "HOUSE ").otherwise("OLD HOUSE "), k.cast("string")).alias("sale_address"), F.col("o_orderdate").alias("date"), price)
    known = o.select(F.col("o_custkey").alias("property_id"), F.col("o_orderdate").alias("date"), price)
    return fuzzy.anchored_sales(p, known, reg, jaccard(F.split("address", " "), F.split("sale_address", " "))).select(F.col("property_id").alias("id"), "sale_id", "method")


@query()
def ratio_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as properties, parts of the same block as applications: by number first, then by scored address."""
    s, p = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    k = F.col("s_suppkey")
    props = s.select(k.alias("property_id"), F.concat((k % 50).cast("string"), F.lit(" RED WIDGET LANE")).alias("address"), F.concat(F.lit("B"), (k % 25).cast("string")).alias("postcode"), F.when(k % 10 == 0, F.concat(F.lit("U"), k.cast("string"))).otherwise("").alias("uprn"))
    q = F.col("p_partkey")
    apps = p.select(q.alias("reference"), F.concat((q % 50).cast("string"), F.lit(" "), F.upper("p_name"), F.lit(" LANE")).alias("site_address"), F.concat(F.lit("B"), (q % 25).cast("string")).alias("postcode"), F.when(q % 7 == 0, F.concat(F.lit("U"), q.cast("string"))).otherwise("").alias("uprn"))
    return fuzzy.match_applications(props, apps)
