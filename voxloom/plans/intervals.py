"""Queries on speech segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators.runbitmaps import periods_and_gaps
from voxloom.plans.registry import Registry
from voxloom.sources import table

INTERVALS = Registry()

_PERIODS = """
WITH s AS (
  SELECT DISTINCT recording_id, speaker_id, CAST(round(start_time * 1000) AS BIGINT) AS s, CAST(round(end_time * 1000) AS BIGINT) AS e
  FROM speaker_segments
  WHERE speaker_id IS NOT NULL AND NOT isnan(start_time) AND NOT isnan(end_time)),
m AS (
  SELECT *, max(e) OVER (PARTITION BY recording_id, speaker_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM s WHERE s < e),
g AS (
  SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id, speaker_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island
  FROM m),
p AS (SELECT recording_id, speaker_id, min(s) AS s, max(e) AS e FROM g GROUP BY recording_id, speaker_id, island),
n AS (SELECT *, lead(s) OVER (PARTITION BY recording_id, speaker_id ORDER BY s) AS next FROM p)
SELECT recording_id, speaker_id, 'period' AS kind, s AS start_ms, e AS end_ms FROM n
UNION ALL
SELECT recording_id, speaker_id, 'gap' AS kind, e AS start_ms, next AS end_ms FROM n WHERE next IS NOT NULL
"""


@INTERVALS.query("p2_found", _PERIODS)
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Continuous speech of each speaker in a recording, and the silences between."""
    found = periods_and_gaps(table(spark, folder, "speaker_segments"), ["recording_id", "speaker_id"], "start_time", "end_time")
    return found.select("recording_id", "speaker_id", "kind", F.col("start_unit").alias("start_ms"), F.col("end_unit").alias("end_ms"))
