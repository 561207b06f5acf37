from __future__ import annotations

import hashlib
import html
import random
import re
import unicodedata
from datetime import date, datetime, timedelta
from difflib import SequenceMatcher
from math import asin, cos, radians, sin, sqrt
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from plinth.functions import geo, temporal, text


def strings(n=150):
    rng = random.Random(5)
    pool = "aZ9 .,&-/\t\n  éßüÅ£#'\"<>" + "KT11 2JJ"
    return [None, "", " ", *("".join(rng.choice(pool) for _ in range(rng.randrange(0, 25))) for _ in range(n))]


def test_text_forms_against_plain_python(spark):
    values = strings()
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(text.clean("v"), text.canonical("v"), text.postcode("v"), text.compact_key("v"), text.sorted_tokens("v"), text.folded("v")).collect()
    for v, r in zip(values, got, strict=True):
        v = v or ""
        canonical = re.sub("[^A-Z0-9]+", " ", v.upper()).strip()
        bare = "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)).replace("&", " AND ")
        assert r[0] == " ".join(v.split())
        assert r[1] == canonical
        assert r[2] == re.sub("[^A-Z0-9]", "", v.upper())
        assert r[3] == re.sub("[^a-z0-9]", "", v.lower())
        assert r[4] == " ".join(sorted(canonical.split()))
        assert r[5] == re.sub("[^A-Z0-9]+", " ", bare.upper()).strip()


def test_urls(rows):
    urls = ["https://A.example.org//x//y/?q=1#f", "http://a.example.org/x", "https://a.example.org", " https://u@H.example.org:8080/a/ ", "", None, "nonsense"]

    def plain(u):
        p = urlsplit((u or "").strip())
        return f"https://{p.netloc.lower()}{re.sub('/{2,}', '/', p.path).rstrip('/') or '/'}" if p.scheme == "https" and p.netloc else ""

    assert [r[0] for r in rows([(u,) for u in urls], "u string", text.canonical_url("u"))] == [plain(u) for u in urls]


def test_html_text(rows):
    v = "<p>A &amp;lt; b &eacute;</p> &nbsp;c"
    assert rows([(v,), (None,)], "v string", text.strip_tags("v", full=True))[0][0] == " ".join(re.sub("<[^>]+>", " ", html.unescape(v)).split())
    assert rows([(None,)], "v string", text.strip_tags("v"))[0][0] == ""


@pytest.mark.parametrize(("address", "code", "given", "want"), [
    ("The Old Grove, High Pitfold, Hindhead", "", None, "property:THE OLD GROVE HIGH PITFOLD HINDHEAD|NOPOSTCODE"),
    ("1 High Street, KT11 2JJ", "", None, "property:1 HIGH STREET KT11 2JJ|KT112JJ"),
    ("1 High Street, KT11 2JJ", "kt11 2jj", None, "property:1 HIGH STREET KT11 2JJ|KT112JJ"),
    ("1 High Street", "kt11 2jj", None, "property:1 HIGH STREET|KT112JJ"),
    ("", "", "lr-1", "lr-1"), ("", "KT11 2JJ", "lr-1", ""), (None, None, None, ""),
])
def test_property_identity(rows, address, code, given, want):
    assert rows([(address, code, given)], "a string, p string, g string", text.property_record_id("a", "p", F.col("g"))) == [(want,)]


def test_transaction_id_keeps_every_slot(rows):
    got = rows([("a", None, "c"), ("a", "c", None)], "x string, y string, z string", text.transaction_id("lr-", "x", "y", "z"))
    assert got[0] != got[1] and all(re.fullmatch("lr-[0-9a-f]{20}", g[0]) for g in got)


def test_sale_id_ignores_spacing(rows):
    parts = [("1  high\tstreet ", "KT11 2JJ"), ("1 HIGH STREET", "kt112jj"), ("1 HIGHSTREET", "KT112JJ")]
    got = [g[0] for g in rows(parts, "a string, c string", text.sale_id("a", "c", F.lit(5), F.lit("2020-01-02"), F.lit("Detached"), F.lit("A")))]
    assert got[0] == got[1] == "lr-" + hashlib.sha256(b"1 HIGH STREET|KT112JJ|5|2020-01-02|DETACHED|A").hexdigest()[:20] and got[2] != got[0]


def test_money_replicates_and_fixes(rows):
    values = ["£5 MILLION", "£1,250,000", "£3BN", "none", "£2.5m and £900k", "£5 many", None]
    got = rows([(v,) for v in values], "v string", text.money_value("v"), text.money_value("v", strict=True))
    assert [g[0] for g in got] == [5e6, 1, 3e9, 0, 2.5e6, 5e6, 0]
    assert [g[1] for g in got] == [5e6, 1250000, 3e9, 0, 2.5e6, 5, 0]


def test_numbers(rows):
    got = rows([("a -1,234.5 b", "12"), ("none", " 7 "), (None, "1.5"), ("x", None)], "v string, w string", text.lenient_number("v"), text.whole_number("w"))
    assert got == [(-1234.5, 12), (None, 7), (None, None), (None, None)]
    assert rows([(1.0,), (0.0,), (float("nan"),), (float("inf"),), (None,)], "x double", text.finite_positive("x")) == [(True,), (False,), (False,), (False,), (False,)]
    assert rows([("24.9",), ("25",), ("4000.1",), ("",)], "a string", text.floor_area("a")) == [(None,), (25.0,), (None,), (None,)]
    # The first valid area counts, not the first number.
    assert rows([("10", "100"), ("90", "100"), (None, "9"), ("x", None)], "a string, b string", text.floor_area("a", "b")) == [(100.0,), (90.0,), (None,), (None,)]
    flat = {"rooms.0.floor_area": "50", "total-floor-area": "10", "gross.floorArea": "120 m2", "height": "3"}
    assert rows([(flat,), ({},), (None,)], "m map<string,string>", text.any_floor_area(F.col("m"))) == [(120.0,), (None,), (None,)]


def test_house_ranges(rows):
    values = [["7-84"], ["7-84 odd"], ["84-7"], ["7 to 9"], ["1-2", "x"], []]
    got = [r[0] for r in rows([(v,) for v in values], "v array<string>", text.house_ranges("v"))]
    assert [None if g is None else [tuple(x) for x in g] for g in got] == [[(7, 84, "")], [(7, 84, "odd")], None, None, None, []]
    assert rows([(["7-84 odd"],)], "v array<string>", text.house_ranges("v", "even_house_range"))[0][0] is None


def test_names_years_maps(rows):
    assert rows([(["a", "b", "c", "d", "e"],)], "v array<string>", text.short_names(F.col("v"))) == [("a, b, c +2 more",)]
    got = rows([("", "AB/2019/1"), ("", "19/0001"), ("", "87/0001"), ("1900", "x"), ("2003", "AB/2019")], "d string, r string", text.planning_year("d", "r", now_year=2024))
    assert [g[0] for g in got] == [2019, 2019, 1987, None, 2003]
    assert rows([("STANDARDPRICEPAIDTRANSACTION",), ("http://x/y/additionalPricePaidTransaction",), ("category-b",), ("",)], "c string", text.category("c")) == [("A",), ("B",), ("B",), ("A",)]


def test_sequence_ratio(rows):
    pairs = [("12 high view", "high view 12"), ("", "a"), ("same", "same"), (None, "a")]
    got = [r[0] for r in rows(pairs, "a string, b string", text.ratcliff_ratio("a", "b"))]
    assert got == [SequenceMatcher(None, a, b).ratio() if a is not None else None for a, b in pairs]


def test_dates(rows):
    assert rows([(date(2026, 5, 6),)], "d date", temporal.velocity_cutoff("d", 2)) == [(date(2026, 3, 31),)]
    with pytest.raises(ValueError, match="negative"):
        temporal.velocity_cutoff("d", -1)
    got = rows([("Tue, 02 Jan 2024 03:04:05 GMT",), ("2024-01-02T03:04:05Z",), ("2024-01-02",), ("junk",)], "d string", temporal.parse_when("d"))
    assert [g[0] for g in got] == [datetime(2024, 1, 2, 3, 4, 5)] * 2 + [datetime(2024, 1, 2), None]
    assert rows([("3600", 0), (None, 1), (None, 9)], "a string, n int", temporal.retry_wait(F.col("a"), F.col("n"))) == [(90,), (50,), (90,)]


def test_freshness_and_policies(rows):
    now = datetime(2024, 1, 10)
    times = [now - timedelta(hours=1), now - timedelta(hours=31), now + timedelta(hours=1), None]
    at = F.lit("2024-01-10 00:00:00").cast("timestamp")
    assert [r[0] for r in rows([(t,) for t in times], "t timestamp", temporal.freshness(F.col("t"), at))] == ["fresh", "stale", "stale", "missing"]
    cases = [("matched", 10), ("no_match", 1), ("error", 1), ("no_match", 3), ("matched", -1)]
    data = [(s, now - timedelta(days=d)) for s, d in cases]
    got = rows(data, "s string, t timestamp", *[temporal.cache_valid(F.col("s"), F.col("t"), at, 2, p) for p in ("any", "matched", "certificate", "seconds")])
    assert got == [(False, False, True, False), (True, False, True, True), (True, False, False, False), (False, False, False, False), (True, True, True, True)]


@pytest.mark.parametrize(("status", "days", "limit", "want"), [
    ("matched", 2, 2, (False, False, True, False)), ("matched", 1.999, 2, (True, True, True, True)), ("matched", 2.5, 2, (False, False, True, False)),
    ("no_match", 2, 2, (False, False, False, False)), ("no_match", 1.999, 2, (True, False, True, True)), ("no_match", 2.5, 2, (False, False, False, False)),
    ("matched", 0, 0, (False, False, True, False)), ("no_match", 0, 0, (False, False, False, False)), ("matched", -1, 0, (False, False, True, False)), ("matched", 0, -1, (False, False, True, False)),
])
def test_what_reaches_the_limit_has_expired(rows, status, days, limit, want):
    now = datetime(2024, 1, 10)
    policies = [temporal.cache_valid(F.col("s"), F.col("t"), F.lit("2024-01-10 00:00:00").cast("timestamp"), limit, p) for p in ("any", "matched", "certificate", "seconds")]
    assert rows([(status, now - timedelta(days=days))], "s string, t timestamp", *policies) == [want]


def test_distances(rows):
    def plain(a, b, c, d):
        h = sin(radians(c - a) / 2) ** 2 + cos(radians(a)) * cos(radians(c)) * sin(radians(d - b) / 2) ** 2
        return 2 * 6371000 * asin(sqrt(h))

    p = (51.2, -0.5, 51.3, -0.4)
    assert rows([p], "a double, b double, c double, d double", geo.haversine_m(*[F.col(c) for c in "abcd"]))[0][0] == pytest.approx(plain(*p))
    assert rows([(944.0,), (951.0,), (None,), (12.0,)], "m double", geo.distance_text(F.col("m")), geo.walk_text(F.col("m"))) == [("940m", "c. 15 min"), ("1.0km", "c. 15 min"), ("", ""), ("10m", "c. 1 min")]
    assert rows([("POINT(-0.5 51.2)",), ("POINT (x)",), (None,)], "w string", geo.wkt_point("w")) == [((51.2, -0.5),), (None,), (None,)]


def test_polygon_with_hole(rows):
    shape = '{"type":"Polygon","coordinates":[[[-0.4,51.3],[-0.3,51.3],[-0.3,51.4],[-0.4,51.4],[-0.4,51.3]],[[-0.365,51.355],[-0.355,51.355],[-0.355,51.365],[-0.365,51.365],[-0.365,51.355]],[[0,0],[1,1]]]}'
    poly = geo.geojson_polygons(F.lit(shape))[0]
    got = rows([(-0.36, 51.36), (-0.37, 51.35), (-0.5, 51.35)], "lon double, lat double", geo.polygon_distance_km(F.col("lat"), F.col("lon"), poly["outer"], poly["holes"]))
    assert got[0][0] > 0.2 and got[1][0] == 0.0 and got[2][0] == pytest.approx(0.1 * 111.32 * cos(radians(51.35)))
    # A polygon whose outer ring is too short goes; its hole never takes its place.
    assert rows([('{"type":"Polygon","coordinates":[[[0,0],[1,1]],[[0,0],[1,0],[1,1],[0,0]]]}',), ("junk",)], "g string", F.size(geo.geojson_polygons("g"))) == [(0,), (0,)]


def test_grid_reference(rows):
    lat, lon = rows([(651409.903, 313177.270)], "e double, n double", geo.bng_to_wgs84("e", "n"))[0][0]
    assert lat == pytest.approx(52.6579786, abs=2e-4) and lon == pytest.approx(1.7160519, abs=2e-4)
