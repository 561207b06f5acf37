from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plinth.operators import aggregates, articles, dedup, fuzzy, lookup, planning, quality, rules, spatial, state


def table(spark, values, schema):
    return spark.createDataFrame(values, schema)


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_first_and_last_wins(spark):
    df = table(spark, [(1, "a", 3), (2, "a", 4), (3, "b", 5)], "o int, k string, v int")
    assert pairs(dedup.first_wins(df, ["k"], [F.col("o")]), "k", "v") == [("a", 3), ("b", 5)]
    assert pairs(dedup.last_wins(df, ["k"], "o"), "k", "o", "v") == [("a", 1, 4), ("b", 3, 5)]  # first place, last value
    assert pairs(dedup.unique_only(df, ["k"]), "k") == [("b",)]
    once = dedup.first_wins(df, ["k"], [F.col("o")])
    assert pairs(dedup.first_wins(once, ["k"], [F.col("o")]), "k") == pairs(once, "k")


def test_limit_passes_the_rest_through(spark):
    df = table(spark, [(1, 10), (2, 20), (3, 30)], "o int, v int")
    assert pairs(dedup.limited(df, "o", 2, {"v": F.col("v") + 1, "w": F.lit(1)}), "o", "v", "w") == [(1, 11, 1), (2, 21, 1), (3, 30, None)]


OLD = "ord int, k1 string, k2 string, donor string, note string, area long, rate long"
NEW = "id int, k1 string, k2 string, donor string, price long"


def look(spark, new, old):
    return pairs(lookup.priority_lookup(table(spark, new, NEW), table(spark, old, OLD), "k1", ["k2"], "donor", "ord", ["note", "area", "rate"], price="price", area="area", rate="rate"), "id", "note", "area", "rate", "carried", "reused")


def test_priority_tiers(spark):
    old = [(1, "E1", "A", "p1", "first", 10, 1), (2, "E1", "B", "p1", "last", None, 1), (3, "E3", "C", "p2", "alt", 5, 1), (4, "E4", "D", "p3", "d1", 7, 1), (5, "E5", "D", "p3", "d2", 8, 1)]
    assert look(spark, [(1, "E1", "Z", "p9", 100)], old) == [(1, "last", None, None, True, False)]  # exact: the last row wins
    assert look(spark, [(1, "X", "C", "p9", 100)], old) == [(1, "alt", 5, 20, True, False)]  # second key, unique on both sides
    assert look(spark, [(1, "X", "D", "p9", 100)], old) == [(1, None, None, None, False, False)]  # repeated in the old table
    assert look(spark, [(1, "X", "C", "p9", 100), (2, "Y", "C", "p9", 100)], old) == [(1, None, None, None, False, False), (2, None, None, None, False, False)]  # repeated in the new one
    assert look(spark, [(1, "X", "Q", "p3", 100)], old) == [(1, "d1", 7, 14, True, True)]  # donor only
    # The donor's rate was that of another sale; it is worked out anew.
    assert look(spark, [(1, "E1", "Z", "p1", 100)], old) == [(1, "last", 10, 10, True, True)]


def test_donor_fill_and_integrity(spark):
    df = table(spark, [(1, "p", None, "x"), (2, "p", 5, None), (3, "p", 6, "y"), (4, None, None, "z")], "o int, k string, a int, b string")
    assert pairs(lookup.donor_fill(df, "k", "o", ["a", "b"]), "o", "a", "b")[:3] == [(1, 5, "x"), (2, 5, "x"), (3, 6, "y")]
    a, b = table(spark, [("1",), ("2",)], "k string"), table(spark, [("2",), ("3",)], "k string")
    assert pairs(lookup.missing_keys(a, b, "k"), "k", "side") == [("1", "emitted"), ("3", "base")]


RULES = "rule string, street string, aliases array<string>, authorities array<string>, towns array<string>, postcodes array<string>, ranges array<struct<minimum:int,maximum:int,parity:string>>"


@pytest.mark.parametrize(("row", "want"), [
    (("HIGH RD", "A", "T", "", "5"), "r1"), (("HIGH ROAD", "A", "T", "", "5"), "r1"), (("HIGH RD", "A", "X", "", "5"), None), (("HIGH RD", "B", "T", "", "5"), None),
    (("GATED", "A", "T", "KT11", "1"), "r2"), (("GATED", "A", "T", "", "1"), None),
    (("LONG", "A", "T", "", "7"), "r3"), (("LONG", "A", "T", "", "8"), None), (("LONG", "A", "T", "", "7A"), None), (("LONG", "A", "T", "", "85"), None),
    (("TWICE", "A", "T", "", "1"), None), (("SPELT", "A", "T", "", "1"), None), (("HIGH RD", "", "T", "", "1"), None), (("HIGH RD", "A", "", "", "1"), None),
])
def test_rule_join(spark, row, want):
    known = table(spark, [("r1", "HIGH RD", ["HIGH ROAD"], ["A"], ["T"], [], []), ("r2", "GATED", [], ["A"], ["T"], ["KT11"], []), ("r3", "LONG", [], ["A"], ["T"], [], [(7, 84, "odd")]), ("r4", "TWICE", [], ["A"], ["T"], [], []), ("r5", "TWICE", [], ["A"], ["T"], [], []), ("r6", "SPELT", ["SPELT"], ["A"], ["T"], [], [])], RULES)
    df = table(spark, [(1, *row)], "id int, street string, authority string, town string, code string, paon string")
    assert pairs(rules.unique_rule_join(df, known, "id", "street", "authority", F.array("town"), "code", "paon", ["rule"]), "id", "rule") == [(1, want)]


def score(spark, a, b, pa="", pb=""):
    df = table(spark, [(a, b, pa, pb)], "a string, b string, pa string, pb string")
    t = lambda c: fuzzy.address_tokens(F.col(c), F.lit(""), F.lit(""))
    return df.select(fuzzy.token_score(t("a"), t("b"), fuzzy.numbers(F.col("a")), fuzzy.numbers(F.col("b")), F.col("pa"), F.col("pb"))).first()[0]


def test_token_score(spark):
    assert score(spark, "12 Oak Lodge", "12 Oak Lodge") == 1.0
    assert score(spark, "12 Oak Lodge", "12 Oak Lodge", "A1", "A2") == 0.0
    assert score(spark, "The Flat", "The House") == 0.0
    assert score(spark, "12 Oak", "12 Elm") == pytest.approx(0.62 / 2 + 0.28 / 3 + 0.14)
    p = table(spark, [("Flat 2 Oak", "Oak Flat 2"), ("12 Oak", "14 Oak"), ("", "Oak")], "a string, b string").select(fuzzy.planning_score(fuzzy.planning_tokens(F.col("a")), fuzzy.planning_tokens(F.col("b"))))
    got = [r[0] for r in p.collect()]
    from difflib import SequenceMatcher as M

    assert got == [pytest.approx(round(0.55 + 0.35 * M(None, "FLAT 2 OAK", "OAK FLAT 2").ratio() + 0.1, 3)), pytest.approx(round((0.55 / 3 + 0.35 * M(None, "12 OAK", "14 OAK").ratio()) * 0.45, 3)), 0.0]


def test_best_match_scores_lines_once(spark):
    lines = ["1 OAK", "2 ELM", "3 OAK"]
    left = [(k, k % 2, lines[k % 3]) for k in range(60)] + [(60, None, "1 OAK"), (7, 1, "3 OAK"), (61, 0, None)]
    right = [(k, k % 2, [*lines, "OAK"][k % 4], k % 5) for k in range(200)] + [(200, None, "1 OAK", 1)]
    rows, found = table(spark, left, "id int, b int, l string"), table(spark, right, "site int, b int, r string, ok int")
    scored = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(a, b):
        scored.add(1)
        return -1.0 if a is None else 0.3 + 0.3 * (a == b) + 0.1 * (a.split()[-1] == b.split()[-1])

    got = fuzzy.best_token_match(rows, found, "b", "id", score("l", "r"), F.col("ok") > 3, [F.col("site").desc()], row_columns=["l"], candidate_columns=["r"]).persist()
    points = lambda a, b: -1.0 if a is None else round(0.3 + 0.3 * (a == b) + 0.1 * (a.split()[-1] == b.split()[-1]), 6)
    want = {}
    for k in {r[0] for r in left}:
        every = sorted((-points(a, r), -site, ok) for i, b, a in left for site, c, r, ok in right if i == k and b is not None and b == c)
        best = [(k, -site, -s) for s, site, ok in every[:8] if -s >= 0.55 and ok > 3]
        want |= {k: best[0]} if best else {}
    assert pairs(got, "id", "site", "score") == sorted(want.values()) and len(want) > 20
    assert scored.value <= 2 * 2 * 4 * 4 * 2  # of 6,000 pairs; an expression may be worked out for a filter and a result


def test_applications_of_equal_addresses(spark):
    props = [(f"p{k}", f"{k % 3} RED WIDGET LANE", f"B{k % 2}", "U1" if k == 0 else "") for k in range(40)] + [("q", "1 RED WIDGET LANE", "", "")]
    apps = [(f"r{k}", f"{k % 3} {'RED WIDGET' if k % 4 else 'BLUE GADGET'} LANE", f"B{k % 2}", f"U{k}" if k < 3 else "") for k in range(50)] + [("r7", "1 RED WIDGET LANE", "B1", "")]
    got = fuzzy.match_applications(table(spark, props, "property_id string, address string, postcode string, uprn string"), table(spark, apps, "reference string, site_address string, postcode string, uprn string"))
    want = [("p0", "r1", 1.0, "uprn")] + [(p, r, 1.0, "address") for p, a, c, u in props for r, s, d, _ in apps if not u and c and c == d and a == s]
    assert pairs(got, "property_id", "reference", "confidence", "method") == sorted(want) and len(want) > 100
    # Regular expressions over both sides of a join were worked out anew for each pair.
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [line for line in plan if " Join " in line.replace("- Join", "- Join ").replace(":", " ") and "regexp" in line]


def test_anchor(spark):
    props = table(spark, [("p1", "1 OAK", "B"), ("p2", "OAK LODGE", "B")], "property_id string, address string, block string")
    known = table(spark, [("p2", "2020-01-01", 5)], "property_id string, date string, price long")
    reg = table(spark, [("s1", "B", "1 OAK", "2019-01-01", 3), ("s2", "B", "2 OAK", "2020-01-01", 5), ("s3", "B", "2 OAK", "2010-01-01", 4)], "sale_id string, block string, sale_address string, date string, price long")
    got = pairs(fuzzy.anchored_sales(props, known, reg, F.lit(1.0)), "property_id", "sale_id", "method")
    assert got == [("p1", "s1", "exact-address"), ("p2", "s2", "known-sale-anchor"), ("p2", "s3", "known-sale-anchor")]


def test_nearest(spark):
    points = table(spark, [(1, "A", 51.0, 0.0), (2, "", 51.0, 0.0), (3, "Z", 52.0, 0.0)], "id int, block string, lat double, lon double")
    sites = table(spark, [(10, "A", 51.001, 0.0), (11, "B", 51.0001, 0.0), (12, "B", 51.0001, 0.0), (13, "B", 51.0102, 0.0)], "site int, block string, lat double, lon double")
    got = pairs(spatial.nearest(points, sites, "id", "block", "site", ["site"], metres=150), "id", "site", "blocked")
    assert got == [(1, 10, True), (2, 11, False)]  # the block's site wins though farther; ties by site; none within reach of 3


def test_crowded_sites(spark):
    import math
    import random

    rng = random.Random(4)
    spot = lambda: (51 + rng.randrange(60) / 2000, -0.5 + rng.randrange(60) / 2000)
    points = [(k, f"B{k % 4}", *spot()) for k in range(120)] + [(120, "B1", None, -0.5), (121, None, 51.0, -0.5)]
    sites = [(k, f"B{k % 3}", f"s{k}", *spot()) for k in range(700)] + [(k, "B0", f"s{k}", 51.01, -0.49) for k in range(700, 1000)] + [(1000, "B1", "s1000", None, None)]
    ps, ss = table(spark, points, "id int, block string, lat double, lon double"), table(spark, sites, "site int, block string, name string, lat double, lon double")

    def away(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return 2 * 6_371_000 * math.asin(math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2))

    listed, near, square = {}, {}, {}
    for k, block, lat, lon in points:
        reach = [] if lat is None else sorted((away(lat, lon, y, x), s, b, y, x) for s, b, _, y, x in sites if y is not None)
        if five := sorted((math.floor(d + 0.5), s) for d, s, *_ in reach if d <= 1500)[:5]:
            listed[k] = five
        cells = lambda a, b: abs(math.floor(a / 0.01) - math.floor(b / 0.01)) <= 2
        own = [r for r in reach if r[2] == block] if block in ("B0", "B1", "B2") else [r for r in reach if cells(lat, r[3]) and cells(lon, r[4])]
        if own and own[0][0] <= 1500:
            near[k] = round(own[0][0], 3)
        box = [r for r in reach if abs(r[3] - lat) <= 1200 / 111_320 and abs(r[4] - lon) <= 1200 / (111_320 * math.cos(math.radians(lat)))]
        if box:
            square[k] = (len(box), sum(r[0] <= 1200 for r in box), sum(r[0] > 1200 for r in box))
    got = spatial.nearest_listed(ps, ss.withColumn("rating", F.lit("")), "id", "name", "rating", 1500, order="site").collect()
    assert {r["id"]: [(s["metres"], int(s["name"][1:])) for s in r["nearest"]] for r in got} == listed and len(listed) > 100
    got = spatial.nearest(ps, ss, "id", "block", "site", ["site"], 1500).collect()
    place = {s: (y, x) for s, _, _, y, x in sites}
    assert {r["id"]: round(away(r["lat"], r["lon"], *place[r["site"]]), 3) for r in got} == near and len(near) > 100
    got = spatial.in_square_then_circle(ps, ss.withColumnRenamed("site", "site_id"), "id", 1200).collect()
    assert {r["id"]: (r["in_square"], r["in_circle"], r["outside"]) for r in got} == square
    # Of 120 x 700 pairs and more, few are compared.
    few = dedup.top_k(ss.selectExpr("site", "lat __lat", "lon __lon").where("lat is not null"), ["__lat", "__lon"], [F.col("site")], 1)
    assert spatial._closest(ps.select("lat", "lon").distinct(), few, [], 1, 1500).count() < 120 * 40


def test_listed_and_alerts(spark):
    points = table(spark, [(1, 51.0, 0.0), (2, 53.0, 0.0)], "id int, lat double, lon double")
    sites = table(spark, [(f"s{k}", r, 51.0 + k / 1000, 0.0) for k, r in enumerate(["", "Good", "", "", "", "", "", "Outstanding"])], "name string, rating string, lat double, lon double")
    r = spatial.nearest_listed(points, sites, "id", "name", "rating").collect()
    # s7 is outstanding, but not among the five nearest.
    assert len(r) == 1 and [s["name"] for s in r[0]["nearest"]] == ["s0", "s1", "s2", "s3", "s4"] and r[0]["best"]["name"] == "s1"
    tied = table(spark, [(2, "a", "Good", 51.0, 0.0), (1, "b", "Good", 51.0, 0.0)], "at int, name string, rating string, lat double, lon double")
    assert [spatial.nearest_listed(points, tied, "id", "name", "rating", order=o).first()["best"]["name"] for o in (None, "at")] == ["a", "b"]
    assert spatial.nearest_listed(points, sites.withColumn("rating", F.lit("")), "id", "name", "rating").first()["best"] is None


def test_planning_states(spark):
    app = f"array<{planning.APPLICATION}>"
    df = table(spark, [(1, [("2024-01-01", 5, "r", "d"), ("2024-02-01", 9, "q", "e")], False), (2, [], False), (3, [], True)], f"id int, found {app}, failed boolean")
    c = planning.planning_context(F.col("found"), F.col("failed"), F.lit(None).cast(f"struct<coverage_status:string,coverage_mode:string,count:int,latest:string,applications:{app}>"))
    got = df.select("id", c.alias("c")).orderBy("id").collect()
    assert [r["c"]["coverage_status"] for r in got] == ["observed", "unknown", "unavailable"]
    assert got[0]["c"]["latest"] == "q - e - 10m away" and got[1]["c"]["count"] is None


@pytest.mark.parametrize(("status", "mode", "apps", "latest", "count", "want"), [
    ("observed", "positive-results-only", ["a"], "x", 1, True), ("observed", "positive-results-only", [], "x", 1, False), ("observed", "positive-results-only", ["a"], "No recent ones", 1, False),
    ("unknown", "no-authoritative-negative-coverage", None, None, None, True), ("unknown", "no-authoritative-negative-coverage", [], "", 0, False), (None, None, None, None, None, False),
])
def test_truthfulness(rows, status, mode, apps, latest, count, want):
    got = rows([(status, mode, apps, latest, count)], "s string, m string, a array<string>, l string, c int", quality.planning_truthful(F.col("s"), F.col("m"), F.col("a"), F.col("l"), F.col("c")))
    assert got == [(want,)]


def test_contract(spark):
    df = table(spark, [(1, "x", "y")], "id int, address string, epc_history string")
    c = quality.Contract()
    assert c.project(df).columns == ["id", "address"] and c.failures(df.columns) == ["restricted field published: epc_history"]
    with pytest.raises(ValueError, match="raw_response"):
        c.project(df.withColumn("raw_response", F.lit(1)))


def test_summary_and_coverage(spark):
    df = table(spark, [("a", 1, "2020", 3.0), ("a", 2, "2021", None), ("", 9, "2022", 1.0), ("b", 5, "2019", float("nan"))], "m string, p long, d string, r double")
    assert pairs(aggregates.summary(df, "m", "p", "d", "r"), "m", "count", "avg", "latest", "max", "avg_rate", "rated") == [("a", 2, 2, "2021", 2, 3, 1), ("b", 1, 5, "2019", 5, None, 0)]
    rows = aggregates.coverage(df, {"postcodes": (F.col("p") < 9, 99.0), "constraints": (F.col("p") < 0, 99.0)})
    assert pairs(rows, "name", "found", "pct") == [("constraints", 0, 0.0), ("postcodes", 3, 75.0)]
    assert len(quality.coverage_failures(rows)) == 1 and len(quality.coverage_failures(rows, "strict")) == 2
    assert aggregates.coverage(df.limit(0), {"x": (F.lit(True), 1.0)}).first()["pct"] == 0.0


def test_terminal_accounting_asks_for_valid_evidence(spark):
    at = F.lit("2024-01-20").cast("timestamp")
    rows = table(spark, [(k,) for k in "aabcdefg"], "k string")
    cache = table(spark, [("a", "matched", 900), ("b", "no_match", 239), ("c", "no_match", 240), ("d", "error", 1), ("e", "missing", 1), ("f", None, 1), ("z", "matched", 1)], "k string, s string, hours int")
    cache = cache.withColumn("t", at - F.make_dt_interval(hours=F.col("hours")))
    got = pairs(aggregates.terminal_accounting(rows, cache, "k", "s", "t", at, 10), "requested", "resolved", "pending", "errors", "matched", "no_match")
    assert got == [(8, 3, 5, 1, 2, 1)]


def test_gates(spark):
    assert quality.expansion_failures(10, 6, 5, 4, 4) == [] and quality.expansion_failures(10, 6, 7, 4, 5, strict=True) == ["more pending than initial", "more reused than preserved", "rows are pending"]
    assert quality.drift_failures(98.0, 95.9) and not quality.drift_failures(98.0, 96.0)
    df = table(spark, [(1, 2500000, "1999-01-01"), (1, 1, "1990-01-01")], "id int, price long, day string")
    assert len(quality.feed_gate(df, "price", "id", "day", 2_000_000)) == 4
    items = table(spark, [("news-" + "0" * 20, "https://a", 5, "link-only", "t"), ("x", "http://b", 101, "full", " ")], "id string, url string, score int, rights_mode string, title string")
    assert [r["rule"] for r in quality.news_violations(items).collect()] == ["id", "url", "score", "rights", "title"]
    a = table(spark, [(1, "x"), (2, None)], "k int, v string")
    b = table(spark, [(1, "x"), (2, "y")], "k int, v string")
    assert pairs(quality.replay_mismatches(a, b, "k", ["v"]), "k", "column") == [(2, "v")]


def test_cache_upsert(spark):
    schema = "source string, key string, status string, updated_at timestamp, payload string"
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    old = table(spark, [("s", "a", "matched", t, "1"), ("s", "b", "error", t, "2")], schema)
    new = table(spark, [("s", "a", "error", t, "3"), ("s", "b", "matched", t, "4"), ("s", "c", "error", t, "5")], schema)
    assert pairs(state.upsert(old, new), "key", "payload") == [("a", "1"), ("b", "4"), ("c", "5")]
    assert state.purge(old, "s").count() == 0


def test_article_tiers_and_penalties(spark):
    schema = "title string, description string, published_at timestamp, quality int, bias int, geography string, towns array<string>"
    import datetime as dt

    now = dt.datetime(2024, 6, 1)
    at = F.lit("2024-06-01").cast("timestamp")
    rows = [("Mansion sold for £12m", "housing", now, 7, 0, "", ["Esher"]), ("Mansion sold for £12m", "housing", now - dt.timedelta(days=31), 7, 0, "", None), ("Nothing here", "", now, 5, 0, "Surrey", None)]
    got = articles.scored(table(spark, rows, schema), at, {"town": "towns"}).select("match_type", "location", "score", "penalty", "admitted", "reason").collect()
    # 22 town + (house, housing, mansion, prime mansion = 3*4) 12 + 9 + (sold 2 + 7) 9 + 7 + 7 + 5
    hits = sum(t in "mansion sold for £12m housing" for t in articles.PROPERTY) * 3 + sum(t in "mansion sold for £12m housing" for t in articles.PRIME) * 3
    assert (got[0]["match_type"], got[0]["location"], got[0]["score"]) == ("town", "Esher", 22 + hits + 9 + 9 + 7 + 7 + 5)
    assert got[1]["match_type"] == "national" and got[1]["penalty"] == 20 and got[2]["match_type"] == "county" and not got[2]["admitted"]
    assert got[0]["reason"] == "Matches Esher · Transaction · High-value event"


def test_near_duplicate_chain(spark):
    base = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf"]
    a, b, c = " ".join(base), " ".join([*base[1:], "hotel"]), " ".join([*base[2:], "hotel", "india"])
    schema = "id string, url string, title string, location string, topics array<string>, score int, published_at string"
    rows = [("a", "https://x/a", a, "L", ["T"], 9, "1"), ("b", "https://x/b", b, "L", ["T"], 8, "1"), ("c", "https://x/c", c, "L", ["T"], 7, "1"), ("d", "https://x/a", "other words entirely", "L", ["T"], 6, "1"), ("e", "https://x/e", a, "M", ["T"], 5, "1"), ("f", "http://x/f", "no", "M", ["T"], 5, "1")]
    # b is similar to a and goes, so c, similar to b alone, stays; d has a's address; e lies elsewhere; f isn't https.
    assert pairs(articles.near_duplicate_titles(table(spark, rows, schema)), "id") == [("a",), ("c",), ("e",)]


def test_greedy_rounds_give_the_choice_one_by_one(spark):
    import random

    rng = random.Random(3)
    edges = {tuple(sorted(rng.sample(range(60), 2))) for _ in range(120)} | {(k, k + 1) for k in range(60, 70)}
    kept = []
    for k in range(71):
        if not any((o, k) in edges for o in kept):
            kept.append(k)
    gone = articles.greedily_removed(table(spark, sorted(edges), "first int, second int"))
    assert sorted(r["id"] for r in gone.collect()) == sorted(set(range(71)) - set(kept))
    assert articles.greedily_removed(table(spark, [], "first int, second int")).count() == 0


def test_feed_order_and_ids(spark):
    rows = [(str(k), f"https://x/{k}", f"title number{k} alone{k}", "L", ["T"], k % 3, f"2024-01-0{k}") for k in range(1, 8)]
    df = table(spark, rows, "id string, url string, title string, location string, topics array<string>, score int, published_at string")
    assert [r["id"] for r in articles.feed(df, 4).collect()] == ["5", "2", "7", "4"]
    import hashlib

    assert df.select(articles.article_id(F.lit("s"), "url")).first()[0] == "news-" + hashlib.sha256(b"s|https://x/1").hexdigest()[:20]


def test_near_duplicate_titles_are_whole_texts(spark, tmp_path):
    import random

    from plinth.plans import QUERIES

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9)))
    opening, texts = " ".join(word() for _ in range(12)), []
    for _ in range(12):
        body = [word() for _ in range(rng.randrange(30, 90))]
        texts.append(f"{opening} {' '.join(body)}")
        texts += [f"{word()} {opening} {' '.join(w if rng.random() > share else word() for w in body)}" for share in (0.02, 0.1, 0.2, 0.4)]
        texts.append(texts[-1])
    rows = [(k, t, rng.choice(["en", "de"])) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    sets, kept = {k: set(t.upper().split()) for k, t, _ in rows}, []
    for k, t, lang in sorted(rows, key=lambda r: (-len(r[1]), r[0])):
        if not any(t == rows[o][1] or lang == rows[o][2] and len(sets[k] & sets[o]) / len(sets[k] | sets[o]) >= 0.72 for o in kept):
            kept.append(k)
    assert sorted(r["id"] for r in QUERIES["near_duplicate_titles"](spark, str(tmp_path)).collect()) == sorted(kept) and len(kept) > 12


def test_phrases(spark):
    terms = articles.catalogue(table(spark, [("Old Oak",), ("Oak Lane",), ("x",), (None,)], "t string"), "t")
    docs = table(spark, [(1, "the old OAK, lane"), (2, "oaklane"), (3, None)], "id int, t string")
    got = articles.phrase_matches(docs, terms, "id", "t").collect()
    assert [(r["id"], r["matches"]) for r in got] == [(1, ["Oak Lane", "Old Oak"])]
