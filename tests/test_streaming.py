from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plinth.streaming import refresh

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string"


@pytest.fixture
def folder(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    rows = [(k, t + dt.timedelta(hours=k), k % 3, "matched" if k % 4 else "error") for k in range(24)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def finish(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_retention(spark, folder):
    got = finish(refresh.retained(refresh.event_stream(spark, folder, SCHEMA), ["user_id"]), "kept", "append")
    assert got.count() == 3


def test_windows_match_the_batch_form(spark, folder):
    stream = finish(refresh.windowed_counts(refresh.event_stream(spark, folder, SCHEMA), "ts", "6 hours", "3 hours", ["user_id"], late="1 hour"), "windows", "complete")
    batch = refresh.windowed_counts(spark.read.parquet(folder), "ts", "6 hours", "3 hours", ["user_id"])
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))


def test_sessions(spark, folder):
    got = refresh.sessions(spark.read.parquet(folder), "user_id", "ts", "4 hours")
    assert sorted((r["user_id"], r["n"]) for r in got.collect()) == [(0, 8), (1, 8), (2, 8)]
    assert refresh.sessions(spark.read.parquet(folder), "user_id", "ts", "2 hours").count() == 24


def test_state_with_time_to_live(spark, folder):
    got = finish(refresh.expiring(refresh.event_stream(spark, folder, SCHEMA), "user_id", {"error": 1}, status="event_type"), "state", "update")
    assert {r["key"]: r["status"] for r in got.collect()} == {"0": "matched", "1": "matched", "2": "matched"}


def test_upsert_batches_resume(spark, folder, tmp_path):
    rows = refresh.event_stream(spark, folder, SCHEMA).select(F.lit("s").alias("source"), F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("status"), F.col("ts").alias("updated_at"), F.col("event_id").alias("payload"))
    for _ in range(2):
        refresh.run_available(rows, str(tmp_path / "ck"), refresh.upsert_batches(str(tmp_path / "table"), ["source", "key"]))
    got = spark.read.parquet(str(tmp_path / "table/batch=0"))
    assert sorted((r["key"], r["payload"]) for r in got.collect()) == [("0", 21), ("1", 22), ("2", 23)]
