"""Queries that run as streams and must give what the batch gives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.plans.registry import Registry
from voxloom.session import table_folder
from voxloom.sources import table
from voxloom.sources.sinks import read_shards
from voxloom.streaming import jobs as J

STREAMS = Registry()


def _stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    from pathlib import Path

    schema = table(spark, folder, name).schema
    path = Path(folder) / f"{name}.parquet"
    return J.file_stream(spark, str(path) if path.is_dir() else f"{folder}/{name}.parque[t]", schema)


@STREAMS.query("stream_windows", "SELECT event_type, time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n, round(avg(value), 3) AS mean FROM events GROUP BY 1, 2")
def stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Daily windows of a stream of events, complete when the stream is drained."""
    rows = _stream(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = J.windowed_counts(rows, "ts", ["event_type"], "value", "1 day", None, "40 days")
    done = J.drained(out, table_folder(spark, "stream-out"), table_folder(spark, "stream-state"), "complete")
    return done.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n", F.round("mean", 3).alias("mean"))


@STREAMS.query("stream_shards", "SELECT DISTINCT id FROM samples")
def stream_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Ids in the shards that a stream of samples has committed: each once."""
    out = table_folder(spark, "stream-shards")
    J.into_shards(_stream(spark, folder, "samples"), out, "train", table_folder(spark, "stream-state")).awaitTermination()
    return read_shards(spark, out, "train").select("id")


@STREAMS.query("stream_last_values", """
SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS r FROM events) WHERE r <= 100 GROUP BY 1""")
def stream_last_values(spark: SparkSession, folder: str) -> DataFrame:
    """Mean of the last hundred values of each series, kept as state."""
    rows = _stream(spark, folder, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    out = J.last_values(rows, "event_type", "t", "value", 100)
    done = J.drained(out, table_folder(spark, "stream-out"), table_folder(spark, "stream-state"), "update", ["event_type"])
    return done.select("event_type", "n", F.round("mean", 4).alias("mean"))


@STREAMS.query("stream_dominance", """
SELECT recording_id, arg_max(speaker_id, (seconds, -speaker_id)) AS dominant, max(seconds) AS seconds FROM (
  SELECT recording_id, speaker_id, round(sum(end_time - start_time), 2) AS seconds FROM speaker_segments WHERE start_time < end_time AND NOT isnan(start_time) AND NOT isnan(end_time) AND speaker_id IS NOT NULL GROUP BY 1, 2) GROUP BY recording_id""")
def stream_dominance(spark: SparkSession, folder: str) -> DataFrame:
    """The speaker with most speaking time of each recording so far, from totals kept as state."""
    rows = _stream(spark, folder, "speaker_segments").where("start_time < end_time and not isnan(start_time) and not isnan(end_time) and speaker_id is not null")
    out = J.running_totals(rows, ["recording_id", "speaker_id"], F.col("end_time") - F.col("start_time"), "seconds")
    done = J.drained(out, table_folder(spark, "stream-out"), table_folder(spark, "stream-state"), "update", ["recording_id", "speaker_id"])
    best = done.groupBy("recording_id").agg(F.max(F.struct(F.round("seconds", 2).alias("seconds"), (-F.col("speaker_id")).alias("first"))).alias("b"))
    return best.select("recording_id", (-F.col("b.first")).alias("dominant"), "b.seconds")


@STREAMS.query("stream_means", """
SELECT CAST(label AS VARCHAR) AS label, count(*) AS n, round(avg(CAST(embedding[1] AS DOUBLE)), 4) AS first, round(avg(CAST(embedding[64] AS DOUBLE)), 4) AS last FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL GROUP BY 1""")
def stream_means(spark: SparkSession, folder: str) -> DataFrame:
    """The mean vector of every label so far, kept as a sum; its first and last places."""
    out = J.running_means(_stream(spark, folder, "embeddings"), "label", "embedding")
    done = J.drained(out, table_folder(spark, "stream-out"), table_folder(spark, "stream-state"), "update", ["label"])
    return done.select("label", "n", F.round(F.col("mean")[0], 4).alias("first"), F.round(F.col("mean")[63], 4).alias("last"))


@STREAMS.query("stream_majority", """
SELECT window_start, user_id, sum(n)::BIGINT AS n, arg_max(event_type, (n, -code)) AS event_type FROM (
  SELECT w AS window_start, user_id, event_type, count(*) AS n, dense_rank() OVER (ORDER BY event_type) AS code FROM (SELECT *, unnest([time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01'), time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') - INTERVAL 12 HOUR]) AS w FROM events) GROUP BY 1, 2, 3)
GROUP BY 1, 2""")
def stream_majority(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's most frequent kind of event in windows of a day that slide by half a day."""
    rows = _stream(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = J.sliding_majority(rows, "ts", "user_id", "event_type", "1 day", "12 hours", "2 days")
    done = J.drained(out, table_folder(spark, "stream-out"), table_folder(spark, "stream-state"), "complete")
    return done.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "user_id", "n", "event_type")


@STREAMS.query("stream_hysteresis", """
SELECT event_type, count(*) AS n, CAST(sum(CASE WHEN f THEN 1 ELSE 0 END) AS BIGINT) AS n_on FROM (
  SELECT event_type, coalesce(last_value(e IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, CAST(event_id AS VARCHAR) ROWS UNBOUNDED PRECEDING), false) AS f FROM (
    SELECT *, CASE WHEN value > 150 THEN true WHEN value < 50 THEN false END AS e FROM events)) GROUP BY event_type""")
def stream_hysteresis(spark: SparkSession, folder: str) -> DataFrame:
    """How many events of each kind come while its flag is on."""
    rows = _stream(spark, folder, "events").withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")))
    out = J.streamed_hysteresis(rows, "event_type", "t", "event_id", "value", 150, 50)
    done = J.drained(out, table_folder(spark, "stream-out"), table_folder(spark, "stream-state"))
    return done.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if("on").alias("n_on"))
