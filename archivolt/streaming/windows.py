"""Structured Streaming over event tables: windows with watermarks, sessions, and a deduplicating change feed.

Each transformation takes a streaming or a batch DataFrame alike, so its result can be compared with the batch plan."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 10) -> DataFrame:
    """Parquet event files of a folder (or one file of it) as a stream, in bounded micro-batches."""
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger)
    if os.path.isfile(path):
        return stream.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path))
    return stream.parquet(path)


def tumbling(events: DataFrame, time: str = "ts", width: str = "1 day", late: str = "1 hour", keys: tuple[str, ...] = ("event_type",), slide: str | None = None) -> DataFrame:
    """(window_start, keys, events, total): counts and sums of `value` in tumbling or sliding windows."""
    e = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    w = F.window("_t", width, slide) if slide else F.window("_t", width)
    out = e.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("events"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *keys, "events", F.round("total", 4).alias("total"))


def sessions(events: DataFrame, key: str = "user_id", time: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(key, session_start, events): sessions closed by a gap."""
    e = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    return e.groupBy(key, F.session_window("_t", gap).alias("w")).agg(F.count("*").alias("events")).select(key, F.col("w.start").cast("timestamp_ntz").alias("session_start"), "events")


def first_seen(events: DataFrame, keys: list[str], time: str = "ts", late: str = "1 hour") -> DataFrame:
    """Events without repeats of their keys, state bounded by the watermark."""
    return events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late).dropDuplicatesWithinWatermark(keys).drop("_t")


def upsert_sink(stream: DataFrame, merge, checkpoint: str) -> StreamingQuery:
    """Run merge(batch, id) once for each micro-batch until the input is used up; restarts go on from the checkpoint."""
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def to_memory(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Run a stream to its end into a table in memory: for tests and small reports."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


def rate(processed: Column, elapsed: Column) -> Column:
    """Rows a second, null before any time has passed."""
    return F.try_divide(processed.cast("double"), elapsed.cast("double"))
