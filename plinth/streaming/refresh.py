"""The refresh operations over unbounded input, and their batch forms."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from plinth.operators.state import upsert


def event_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 16) -> DataFrame:
    """Parquet files of a folder as a stream; ``ts`` becomes a zoned timestamp, as watermarks need it."""
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def retained(stream: DataFrame, keys: list[str], ts: str = "ts", days: int = 14) -> DataFrame:
    """The first arrival of each key within the retention; state is dropped behind the watermark."""
    return stream.withWatermark(ts, f"{days} days").dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, ts: str, length: str, slide: str | None, keys: list[str], value: str | None = None, late: str | None = None) -> DataFrame:
    """(start, end, keys, n[, total]) of tumbling or sliding windows; batch or stream (``late``: the watermark)."""
    if late:
        events = events.withWatermark(ts, late)
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    parts = [F.count("*").alias("n")] + ([F.sum(F.col(value).cast("decimal(20,4)")).cast("double").alias("total")] if value else [])
    return events.groupBy(w.alias("w"), *keys).agg(*parts).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, *[c for c in ("n", "total") if c == "n" or value])


def sessions(events: DataFrame, key: str, ts: str, gap: str, late: str | None = None) -> DataFrame:
    """(key, start, end, n) of sessions that ``gap`` of silence ends; ``end`` is the last event plus the gap."""
    if late:
        events = events.withWatermark(ts, late)
    return events.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def latest_batch(events: DataFrame, keys: list[str], ts: str, days: int, now: Column) -> DataFrame:
    """Batch form of ``retained`` over a closed set: the first row of each key no older than the retention."""
    recent = events.where(F.col(ts) >= now - F.expr(f"interval {days} days"))
    return recent.withColumn("__at", F.row_number().over(W.partitionBy(*keys).orderBy(ts, *[c for c in events.columns if c != ts]))).where("__at = 1").drop("__at")


def expiring(stream: DataFrame, key: str, days: dict[str, float], ts: str = "ts", status: str = "status") -> DataFrame:
    """(key, status, ts): the valid state of a cache fed by a stream. A status is forgotten after its days (absent: kept), unless it's refreshed; errors never replace an observation."""

    def update(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"key": [k[0]], "status": ["expired"], "ts": [pd.Timestamp(0)]})
            return
        now = state.get if state.exists else None
        for pdf in batches:
            for s, t in pdf.sort_values(ts)[[status, ts]].itertuples(index=False):
                if now is None or s != "error" or now[0] == "error":
                    now = (s, int(t.timestamp() * 1000))
        if now is None:
            return
        state.update(now)
        if now[0] in days:
            state.setTimeoutTimestamp(max(now[1] + int(days[now[0]] * 86_400_000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"key": [k[0]], "status": [now[0]], "ts": [pd.Timestamp(now[1], unit="ms")]})

    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(status).alias(status), F.col(ts).alias(ts)).withWatermark(ts, "1 hour")
    return rows.groupBy("key").applyInPandasWithState(update, "key string, status string, ts timestamp", "status string, ms long", "update", GroupStateTimeout.EventTimeTimeout)


def upsert_batches(table_path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch step that merges into a cache table: a table per batch number, so a batch that runs again changes nothing."""

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number == 0:
            merged = upsert(batch.limit(0), batch, keys)
        else:
            merged = upsert(spark.read.parquet(f"{table_path}/batch={number - 1}"), batch, keys)
        merged.write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    return step


def run_available(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> None:
    """Works off what has arrived and stops; the checkpoint resumes it."""
    stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(step).start().awaitTermination()
