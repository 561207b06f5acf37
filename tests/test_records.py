"""Applications, alerts, coverage states, gates of published feeds and payloads of several shapes."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from plinth.operators import fuzzy, planning, quality, rules
from plinth.sources import feeds, syndication


def table(spark, values, schema):
    return spark.createDataFrame(values, schema)


def test_applications(spark):
    raw = table(spark, [
        (1, "Town", "AB/1", "1 High  St, KT11 2JJ", None, "old"), (2, "TOWN", "ab/1", "1 High St, KT11 2JJ", " ", "new"), (3, "Town", "AB/2", "2 Low St", "gu1 4qq", None),
        (4, "Town", "", "3 Low St", None, "no reference"), (5, "Town", "AB/3", None, None, "no address"), (6, None, "AB/4", "4 Low St", None, ""),
    ], "n int, local_authority string, `Application Reference` string, siteAddress string, site_postcode string, description string")
    got = sorted(tuple(r) for r in planning.normalised_applications(raw, "n").select("authority", "reference", "site_address", "postcode", "proposal", "uprn").collect())
    assert got == [("", "AB/4", "4 Low St", "", "", ""), ("TOWN", "ab/1", "1 High St, KT11 2JJ", "KT112JJ", "new", ""), ("Town", "AB/2", "2 Low St", "GU14QQ", "", "")]
    assert planning.normalised_applications(raw.limit(0), "n").count() == 0


def test_active_alerts(spark):
    shape = json.dumps({"type": "Polygon", "coordinates": [[[0, 51], [1, 51], [1, 52], [0, 51]]]})
    schema = "alert_id string, severity_level string, shape string"
    fine = table(spark, [("a", "1", shape), ("b", "3", shape), ("c", "4", None), ("d", None, None)], schema)
    assert sorted((r["alert_id"], r["severity"]) for r in planning.active_alerts(fine).collect()) == [("a", 1), ("b", 3)]
    with pytest.raises(ValueError, match="1 active alerts without a polygon, e"):
        planning.active_alerts(fine.unionByName(table(spark, [("e", "2", None)], schema)))


def test_points_without_alert_say_so(spark):
    points = table(spark, [(1,), (2,)], "id int")
    alerts = table(spark, [(1, "a", 2, 0.5)], "id int, alert_id string, severity int, distance_km double")
    got = sorted(tuple(r) for r in planning.flood_status(points, alerts, "id").select("id", "alerts", "status").collect())
    assert got == [(1, 1, "1 active alert within 5km"), (2, 0, "No current flood alert within 5km")]


def test_disabled_aliases_belong_to_their_estate(rows):
    got = rows([("e1", ["OLD  RD", "NEW RD"]), ("e2", ["OLD RD"]), (None, ["OLD RD"]), ("e1", None)], "e string, a array<string>", rules.usable_aliases(F.col("e"), F.col("a"), [("e1", "OLD RD")]))
    assert got == [(["NEW RD"],), (["OLD RD"],), (["OLD RD"],), (None,)]


def test_sales_coverage(spark):
    props = table(spark, [("a", "KT11 2JJ"), ("b", ""), ("c", "GU1 4QQ"), ("d", "KT1 1AA"), ("e", "KT2 2BB")], "property_id string, postcode string")
    cache = table(spark, [("kt112jj", "2024-01-01", None), ("GU14QQ", None, "timeout"), ("KT22BB", "2024-01-01", None)], "postcode string, updated_at string, last_error string")
    chosen = table(spark, [("KT11 2JJ",), ("GU1 4QQ",), ("KT1 1AA",)], "postcode string")
    got = {r[0]: tuple(r)[1:] for r in fuzzy.sales_coverage(props, cache, chosen).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": "complete", "b": "unavailable", "c": "unavailable", "d": "unavailable", "e": "not_checked"}
    assert got["a"][1] == "" and got["c"][1] == "timeout" and got["d"][1]
    assert {r[0]: r[1] for r in fuzzy.sales_coverage(props, cache).collect()}["e"] == "complete"


def test_news_gate(spark):
    item = ("news-" + "0" * 20, "t", "https://a/x", "s", "s1", "2024-01-01", 5, "v2", "L", ["T"], "r", "link-only")
    schema = "id string, title string, url string, source string, source_id string, published_at string, score int, scoring_version string, location string, topics array<string>, reason string, rights_mode string"
    items, stated = table(spark, [item], schema), {"schema_version": 1, "rights_mode": "link-only", "scoring_version": "v2"}
    assert quality.news_failures(items, stated) == []
    assert quality.news_failures(items, stated | {"scoring_version": "v3"}) == ["1 items of another scoring version"]
    assert quality.news_failures(items.withColumn("body", F.lit("x")), stated | {"schema_version": 2}) == ["unlicensed content: body", "schema_version is 2"]
    assert quality.news_failures(items.drop("reason"), stated) == ["missing field: reason"]


def test_history_gate(spark):
    base = table(spark, [("property:a|X", "1"), ("property:b|X", "2"), ("property:b|X", "3"), ("", "")], "property_record_id string, id string")
    keys = table(spark, [("property:a|X",), ("1",)], "key string")
    assert quality.history_failures(keys, base, {"properties_checked": 2, "properties_with_history": 1}) == []
    bad = quality.history_failures(keys.unionByName(table(spark, [("property:z|X",), ("9",)], "key string")), base, {"properties_checked": 3}, most=3)
    assert len(bad) == 4 and "1 properties, 1 transactions" in bad[2]


def test_payloads(spark, rows, tmp_path):
    payloads = ['{"data":{"certificates":[{"a":"1"}]}}', '{"data":{"rows":[{"a":"2"},{"a":"3"}]}}', '{"data":[{"a":"4"}]}', '[{"a":"5"}]', '{"x":1}']
    got = rows([(p,) for p in payloads], "p string", F.transform(feeds.unwrap_payload(F.col("p"), "struct<a:string>"), lambda x: x["a"]))
    assert [g[0] for g in got] == [["1"], ["2", "3"], ["4"], ["5"], None]
    (tmp_path / "a.json").write_text('{"applications":[{"a":1},{"a":2}]}')
    (tmp_path / "b.json").write_text('{"other":[{"a":1}]}')
    assert feeds.read_records(spark, str(tmp_path / "a.json")).count() == 2
    with pytest.raises(ValueError, match="none of the lists"):
        feeds.read_records(spark, str(tmp_path / "b.json"))


def test_page_loop():
    assert feeds.all_pages(str, lambda p: int(p) < 100, 50) == ["0", "50", "100"]
    with pytest.raises(RuntimeError, match="more than 3 pages"):
        feeds.all_pages(str, lambda p: True, 50, most=3)


def test_encoded_content(spark):
    xml = '<rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><item><title>T</title><link>https://a.example.org/x</link><content:encoded><![CDATA[<p>Body &amp; more</p>]]></content:encoded></item></channel></rss>'
    got = syndication.entries(table(spark, [(xml,)], "x string"), "x", F.lit("2024-01-01").cast("timestamp")).first()
    assert (got["title"], got["description"]) == ("T", "Body & more")
