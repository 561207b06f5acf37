from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plinth.functions import records
from plinth.operators import enrich, planning, quality


def test_certificate_fields(rows):
    flat = {"lmk-key": "k1", "POSTCODE": "KT11 2JJ", "lodgement_datetime": "2020-01-02T03:04", "current-energy-rating": "c", "address-line-1": "1 Oak", "Address Line 2": "1 OAK", "post_town": "Town", "total_floor_area": "80", "x": ""}
    got = rows([(flat,), ({},)], "m map<string,string>", records.certificate_fields(F.col("m")), records.debug_keys(F.col("m")))
    assert tuple(got[0][0]) == ("k1", "KT11 2JJ", "2020-01-02", "C", "1 Oak, Town")
    assert got[0][1] == ["Address Line 2", "POSTCODE", "address-line-1", "total_floor_area"] and tuple(got[1][0]) == ("", "", "", "", "")


def test_coordinates(rows):
    pair = records.coordinates((F.col("a"), F.col("b")), (F.col("c"), F.col("d")))
    got = rows([("51.2", "-0.5", None, None), (None, "-0.5", "51", "9"), (None, None, "51", None), ("95", "0", None, None)], "a string, b string, c string, d string", pair)
    assert [g[0] and tuple(g[0]) for g in got] == [(51.2, -0.5), (51.0, -0.5), None, None]


def test_labels(rows):
    got = rows([({"railway": "station"},), ({"amenity": "fast_food"},), ({"shop": "x"},), ({},)], "t map<string,string>", records.place_kind(F.col("t")))
    assert [g[0] for g in got] == ["station", "fast food", "x", "place"]
    assert rows([("Barn AB/1", "ab/1"), (None, None), ("Barn", "AB/1")], "n string, r string", records.application_label(F.col("n"), F.lit(""), F.lit(None), F.col("r"))) == [("Barn AB/1",), ("Planning application",), ("Barn (AB/1)",)]


def test_schools_and_uprns(spark):
    raw = spark.createDataFrame([("A", "Open", "51.2", "-0.4", "", "", ""), ("B", "Closed", "51.2", "-0.4", "", "", ""), ("C", "Proposed to open", "", "", "516000", "160000", ""), ("D", "", "", "", "", "", "KT11 2JJ"), ("E", "Open", "", "", "", "", ""), ("", "Open", "1", "1", "", "", "")], "SchoolName string, Status string, Lat string, Long string, Easting string, Northing string, Postcode string")
    dim = spark.createDataFrame([("KT112JJ", 51.3, -0.41)], "postcode string, latitude double, longitude double")
    got = {r["name"]: (r["lat"], r["lon"]) for r in enrich.schools(raw, dim).collect()}
    assert set(got) == {"A", "C", "D"} and got["D"] == (51.3, -0.41) and got["C"] == pytest.approx((51.328, -0.336), abs=5e-3)
    raw = spark.createDataFrame([("1", "51.2", "-0.4", "", ""), ("2", "", "", "516000", "160000"), ("3", "", "", "1", "1"), ("4", "60", "0", "", "")], "UPRN string, LATITUDE string, LONGITUDE string, X_COORDINATE string, Y_COORDINATE string")
    assert sorted(r["uprn"] for r in enrich.uprns(raw, (51.0, -0.9, 51.6, 0.2), (470000, 120000, 560000, 190000)).collect()) == ["1", "2"]


def test_repairs(rows):
    kind = f"struct<coverage_status:string,coverage_mode:string,count:int,latest:string,applications:array<{planning.APPLICATION}>>"
    old = [(("", "", 0, "No recent applications", []),), ((None, None, 1, None, [("2024-01-01", 5, "r", "d")]),), (None,)]
    c = F.col("c")
    truth = quality.planning_truthful(c["coverage_status"], c["coverage_mode"], c["applications"], c["latest"], c["count"])
    got = [r[0] for r in rows(old, f"c {kind}", enrich.repaired_planning(c, truth))]
    assert (got[0]["coverage_status"], got[0]["count"], got[0]["latest"]) == ("unknown", None, None)
    assert (got[1]["coverage_status"], got[1]["count"], got[1]["latest"]) == ("observed", 1, "d") and got[2] is None
    got = rows([("no_match", 2.0), ("matched", None), ("matched", 2.0), ("error", 1.0)], "s string, n double", enrich.repaired_lookup(F.col("s"), F.col("n"), F.lit(""), F.lit("t")))
    assert [g[0] and (g[0]["constraint_count"], g[0]["updated_at"]) for g in got] == [(0, "t"), (1, "t"), (2, "t"), None]


def test_clear(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, latitude double")
    assert enrich.clear_context(df).columns == ["id"]
