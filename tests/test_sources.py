from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from plinth.operators.quality import Contract
from plinth.sources import feeds, syndication


def test_feed_round_trip(spark, tmp_path):
    path = str(tmp_path / "feed.js")
    df = spark.createDataFrame([(2, "b; window.X = 1", None), (1, "a", 3.5)], "id int, t string, v double")
    feeds.write_assignments(path, {"ROWS": df, "META": {"n": 2}}, [F.col("id")])
    assert [tuple(r) for r in feeds.read_assignment(spark, path, "ROWS", "id int, t string, v double").collect()] == [(1, "a", 3.5), (2, "b; window.X = 1", None)]
    assert '"v"' not in open(path).read().split("\n")[0].split("},{")[1]  # null fields are absent
    assert feeds.read_assignment(spark, path, "OTHER", "id int").count() == 0
    with pytest.raises(ValueError, match="0 assignments"):
        feeds.read_assignment(spark, path, "OTHER", "id int", exactly_one=True)


def test_publish_drops_restricted(spark, tmp_path):
    path = str(tmp_path / "ledger.js")
    df = spark.createDataFrame([("t1", "1 Oak", "KT11 2JJ", "secret"), ("t2", "1 Oak", "KT11 2JJ", "secret")], "id string, address string, postcode string, epc_address string")
    meta = feeds.publish_ledger(df, Contract(), path, {"a": 1}, ("R", "S", "M"), df.groupBy("postcode").count(), [F.col("id")])
    assert meta["distinctProperties"] == 1 and "secret" not in open(path).read()
    rows, _, stamped = feeds.read_ledger(spark, path, "id string, property_record_id string", "postcode string, count long", "schemaVersion int", ("R", "S", "M"))
    assert rows.first()["property_record_id"] == "property:1 OAK|KT112JJ" and stamped["schemaVersion"] == feeds.FEED_VERSION


def test_archive_filters(spark, tmp_path):
    def row(price="2000000", day="2025-02-03 00:00", kind="D", county="ANYSHIRE", status="A"):
        return ["{x}", price, day, "KT11 2JJ", kind, "N", "F", "1", "", "OAK", "", "TOWN", "DISTRICT", county, "A", status]

    lines = [row(), row("1999999"), row("2000000.5"), row(day="2025"), row(kind="O"), row(county="OTHER"), row(status="D"), row()[:14]]
    (tmp_path / "pp-2025.csv").write_text("\n".join(",".join(f'"{c}"' for c in r) for r in lines))
    got = feeds.read_archive(spark, str(tmp_path), 2_000_000, "Anyshire").collect()
    assert [(r["price"], r["day"], r["file_year"]) for r in got] == [(2000000, "2025-02-03", 2025)] * 2


def test_csv_and_json(spark, tmp_path):
    feeds.write_csv(spark.createDataFrame([("a", "1")], "x string, y string"), str(tmp_path / "c"), ["y", "x"])
    back = feeds.read_header_csv(spark, str(tmp_path / "c"))
    assert back.columns == ["y", "x"] and feeds.read_header_csv(spark, str(tmp_path / "c"), {"z"}) is None
    (tmp_path / "d.json").write_text(json.dumps({"results": [{"a": 1}, {"a": 2}]}))
    assert feeds.read_records(spark, str(tmp_path / "d.json")).count() == 2
    odd = spark.createDataFrame([("", "r1", "x")], "`Site Address` string, `App_Ref` string, other string")
    assert feeds.alias_columns(odd, {"reference": ["reference", "appref"], "address": ["siteAddress", "other"], "none": ["zz"]}).first().asDict() == {"reference": "r1", "address": "x", "none": None}


def test_payloads(rows):
    payload = json.dumps({"links": {"next": {"href": "/p2"}}, "items": [{"a": "1"}], "results": {"bindings": [{"x": {"value": "v"}}, {}]}})
    got = rows([(payload,), ("[]",), (None,)], "p string", feeds.next_page(F.col("p")), F.size(feeds.unwrap_payload(F.col("p"), "struct<a:string>")), feeds.binding_rows(F.col("p"), ["x"]))
    assert got[0][0] == "/p2" and got[0][1] == 1 and [r["x"] for r in got[0][2]] == ["v", None] and got[1][1] == 0
    assert rows([('{"a":[{"b":1},"c"],"d":null}',), ("junk",), (None,)], "p string", feeds.flatten_json("p")) == [({"a.0.b": "1", "a.1": "c"},), ({},), (None,)]


def test_cache_file(spark, tmp_path):
    path = str(tmp_path / "cache.json")
    df = spark.createDataFrame([("b", "matched", '{"x":1}'), ("a", "error", None)], "key string, status string, payload string").withColumn("updated_at", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    feeds.write_cache(df, path, 3, "store", "2024-01-02T03:04:05Z")
    back = feeds.read_cache(spark, path, 3, "store")
    assert sorted((r["key"], r["status"], str(r["updated_at"])) for r in back.collect()) == [("a", "error", "2024-01-02 03:04:05"), ("b", "matched", "2024-01-02 03:04:05")]
    assert feeds.read_cache(spark, path, 4, "store").count() == 0


def test_history_and_asset(spark, tmp_path):
    rec = spark.createDataFrame([("p", 1)], "property_id string, n int")
    keys = spark.createDataFrame([("p", "p"), ("t1", "p")], "key string, property_id string")
    feeds.write_history(str(tmp_path / "h.js"), rec, keys, "H", {}, local=True)
    assert (tmp_path / ".local-only").exists() and '"t1":{"property_id":"p","n":1}' in (tmp_path / "h.js").read_text()
    d, r, g = spark.createDataFrame([("e",)], "estate_id string"), spark.createDataFrame([("e", "r", "s", "whole")], "estate_id string, rule_id string, street string, scope string"), spark.createDataFrame([("x", 1.0)], "estate_id string, lat double")
    with pytest.raises(ValueError, match="without geometry"):
        feeds.asset_rows(d, r, g)


def test_syndication(spark):
    rss = '<?xml version="1.0"?><rss><channel><item><title>A &amp;amp; b</title><link>https://x.org/1?u=2</link><description>&lt;p&gt;Hi&lt;/p&gt;</description><pubDate>Tue, 02 Jan 2024 03:04:05 GMT</pubDate></item><item><title>No link</title></item></channel></rss>'
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>C</title><link rel="self" href="https://x.org/s"/><link rel="alternate" href="https://x.org/2/"/><updated>2024-01-03T00:00:00Z</updated></entry></feed>'
    df = spark.createDataFrame([("r", rss), ("a", atom), ("e", ""), ("n", None)], "source string, xml string")
    got = sorted(tuple(r) for r in syndication.entries(df, "xml", F.lit("2024-06-01").cast("timestamp")).select("source", "url", "title", "description", F.col("published_at").cast("string")).collect())
    assert got == [("a", "https://x.org/2", "C", "", "2024-01-03 00:00:00"), ("r", "https://x.org/1", "A & b", "Hi", "2024-01-02 03:04:05")]
