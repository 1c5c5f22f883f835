"""Further queries on speech segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions.extensions import register_table_functions
from voxloom.operators import segments as G
from voxloom.plans.registry import Registry
from voxloom.sources import table

SEGMENTS = Registry()
_CLEAN = "(SELECT DISTINCT recording_id, speaker_id, start_time, end_time, confidence FROM speaker_segments WHERE start_time IS NOT NULL AND end_time IS NOT NULL AND NOT isnan(start_time) AND NOT isnan(end_time) AND start_time < end_time AND speaker_id IS NOT NULL)"


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "speaker_segments").where("start_time < end_time and not isnan(start_time) and not isnan(end_time) and speaker_id is not null")
    return rows.select("recording_id", "speaker_id", "start_time", "end_time", "confidence").distinct()


@SEGMENTS.query("merged_within_gap", f"""
SELECT recording_id, round(min(start_time), 3) AS start_time, round(max(end_time), 3) AS end_time, count(*) AS n FROM (
  SELECT *, sum(CASE WHEN reach IS NULL OR round(start_time - reach, 6) > 0.05 THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id ORDER BY start_time, end_time ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT *, max(end_time) OVER (PARTITION BY recording_id ORDER BY start_time, end_time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {_CLEAN})) GROUP BY recording_id, island HAVING round(max(end_time) - min(start_time), 6) >= 0.3""")
def merged_within_gap(spark: SparkSession, folder: str) -> DataFrame:
    """Speech of a recording merged over pauses up to 0.05 s, of 0.3 s at least."""
    rows = G.merged(_clean(spark, folder), ["recording_id"], "start_time", "end_time", 0.05).where("round(end_time - start_time, 6) >= 0.3")
    return rows.select("recording_id", F.round("start_time", 3).alias("start_time"), F.round("end_time", 3).alias("end_time"), "n")


@SEGMENTS.query("speaker_turns", f"""
SELECT recording_id, min(speaker_id) AS speaker_id, round(min(start_time), 3) AS start_time, round(max(end_time), 3) AS end_time, count(*) AS n FROM (
  SELECT *, sum(CASE WHEN before = speaker_id AND round(start_time - until, 6) <= 0.3 THEN 0 ELSE 1 END) OVER (PARTITION BY recording_id ORDER BY start_time, end_time, speaker_id ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT *, lag(speaker_id) OVER w AS before, lag(end_time) OVER w AS until FROM (SELECT DISTINCT recording_id, speaker_id, start_time, end_time FROM {_CLEAN}) WINDOW w AS (PARTITION BY recording_id ORDER BY start_time, end_time, speaker_id))) GROUP BY recording_id, island""")
def speaker_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Turns: segments of the same speaker that follow each other within 0.3 s."""
    rows = _clean(spark, folder).groupBy("recording_id", "speaker_id", "start_time", "end_time").agg(F.min("confidence").alias("confidence"))
    rows = G.speaker_turns(rows, "recording_id", "start_time", "end_time", "speaker_id", "confidence", 0.3)
    return rows.select("recording_id", "speaker_id", F.round("start_time", 3).alias("start_time"), F.round("end_time", 3).alias("end_time"), "n")


@SEGMENTS.query("resegmented", f"""
SELECT recording_id, min(speaker_id) AS speaker_id, round(min(start_time), 3) AS start_time, round(max(end_time), 3) AS end_time, count(*) AS n FROM (
  SELECT *, sum(CASE WHEN before = speaker_id AND round(start_time - until, 6) <= 0.3 THEN 0 ELSE 1 END) OVER (PARTITION BY recording_id ORDER BY start_time, end_time, speaker_id ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT *, lag(speaker_id) OVER w AS before, lag(end_time) OVER w AS until FROM (SELECT DISTINCT recording_id, speaker_id, start_time, end_time FROM {_CLEAN} WHERE round(end_time - start_time, 6) >= 0.5) WINDOW w AS (PARTITION BY recording_id ORDER BY start_time, end_time, speaker_id))) GROUP BY recording_id, island""")
def resegmented(spark: SparkSession, folder: str) -> DataFrame:
    """Turns of the segments of half a second or more."""
    rows = _clean(spark, folder).groupBy("recording_id", "speaker_id", "start_time", "end_time").agg(F.min("confidence").alias("confidence"))
    rows = G.resegmented(rows, "recording_id", "start_time", "end_time", "speaker_id", "confidence", 0.5, 0.3)
    return rows.select("recording_id", "speaker_id", F.round("start_time", 3).alias("start_time"), F.round("end_time", 3).alias("end_time"), "n")


@SEGMENTS.query("fixed_segments", f"""
SELECT recording_id, segment, round(segment * 5.0, 6) AS start, round(least((segment + 1) * 5.0, d), 6) AS "end" FROM (
  SELECT recording_id, d, unnest(generate_series(0, CAST(ceil(round(d / 5.0, 6)) AS BIGINT) - 1)) AS segment FROM (SELECT recording_id, round(max(end_time), 3) AS d FROM {_CLEAN} GROUP BY 1) WHERE d > 0)""")
def fixed_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Tiles of five seconds of each recording."""
    spans = _clean(spark, folder).groupBy("recording_id").agg(F.round(F.max("end_time"), 3).alias("d"))
    return G.fixed_segments(spans, "recording_id", "d", 5.0)


@SEGMENTS.query("overlap_ratio", f"""
WITH s AS (SELECT DISTINCT recording_id, speaker_id, CAST(round(start_time * 1000) AS BIGINT) AS s, CAST(round(end_time * 1000) AS BIGINT) AS e FROM {_CLEAN}),
i AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY recording_id, speaker_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM (
  SELECT *, max(e) OVER (PARTITION BY recording_id, speaker_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s WHERE s < e)),
m AS (SELECT recording_id, speaker_id, min(s) AS s, max(e) AS e FROM i GROUP BY recording_id, speaker_id, island),
v AS (SELECT recording_id, t, sum(d) AS d FROM (SELECT recording_id, s AS t, 1 AS d FROM m UNION ALL SELECT recording_id, e, -1 FROM m) GROUP BY 1, 2),
l AS (SELECT recording_id, sum(d) OVER (PARTITION BY recording_id ORDER BY t) AS level, lead(t) OVER (PARTITION BY recording_id ORDER BY t) - t AS lasts FROM v)
SELECT recording_id, CAST(sum(CASE WHEN level > 0 THEN lasts ELSE 0 END) AS BIGINT) AS speech_ms, CAST(sum(CASE WHEN level > 1 THEN lasts ELSE 0 END) AS BIGINT) AS overlap_ms,
  round(sum(CASE WHEN level > 1 THEN lasts ELSE 0 END) / sum(CASE WHEN level > 0 THEN lasts ELSE 0 END), 6) AS overlap_ratio FROM l GROUP BY recording_id""")
def overlap_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """How much of a recording's speech is of several speakers at once."""
    return G.overlap_ratio(_clean(spark, folder), "recording_id", "start_time", "end_time", "speaker_id")


@SEGMENTS.query("dominant_speakers", f"""
SELECT recording_id, arg_max(speaker_id, (seconds, -speaker_id)) AS dominant, max(seconds) AS seconds, count(*) AS n_speakers, round(max(seconds) / sum(seconds), 6) AS share FROM (
  SELECT recording_id, speaker_id, round(sum(end_time - start_time), 3) AS seconds FROM {_CLEAN} GROUP BY 1, 2) GROUP BY recording_id""")
def dominant_speakers(spark: SparkSession, folder: str) -> DataFrame:
    """The speaker with most speaking time of each recording."""
    return G.dominance(_clean(spark, folder), "recording_id", "speaker_id", "start_time", "end_time")


_GRID = "(SELECT recording_id, f.frame, max(struct_pack(s := start_time, w := speaker_id)).w AS who FROM (SELECT recording_id, speaker_id, start_time, unnest(generate_series(CAST(floor(round(start_time / 0.1, 6)) AS BIGINT), CAST(ceil(round(end_time / 0.1, 6)) AS BIGINT) - 1)) AS frame FROM {clean} WHERE {cond}) f GROUP BY 1, 2)"
_HYP, _REF = (_GRID.format(clean=_CLEAN, cond=c) for c in ("confidence > 0.7", "true"))


@SEGMENTS.query("diarisation_error", f"""
SELECT recording_id, CAST(sum(CASE WHEN r.who IS NOT NULL AND h.who IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missed, CAST(sum(CASE WHEN h.who IS NOT NULL AND r.who IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS false_alarm,
  CAST(sum(CASE WHEN h.who <> r.who THEN 1 ELSE 0 END) AS BIGINT) AS confused, CAST(count(r.who) AS BIGINT) AS speech,
  round((sum(CASE WHEN r.who IS NOT NULL AND h.who IS NULL THEN 1 ELSE 0 END) + sum(CASE WHEN h.who IS NOT NULL AND r.who IS NULL THEN 1 ELSE 0 END) + sum(CASE WHEN h.who <> r.who THEN 1 ELSE 0 END)) / count(r.who), 6) AS der
FROM {_HYP} h FULL JOIN {_REF} r USING (recording_id, frame) GROUP BY recording_id""")
def diarisation_error(spark: SparkSession, folder: str) -> DataFrame:
    """The sure segments as a hypothesis against all segments, on frames of 0.1 s."""
    rows = _clean(spark, folder)
    return G.diarisation_error(rows.where("confidence > 0.7"), rows, "recording_id", "start_time", "end_time", "speaker_id", 0.1)


@SEGMENTS.query("overlap_pairs", f"""
SELECT a.recording_id, a.speaker_id AS a, b.speaker_id AS b, count(*) AS n, round(sum(least(a.end_time, b.end_time) - greatest(a.start_time, b.start_time)), 3) AS seconds
FROM {_CLEAN} a JOIN {_CLEAN} b ON a.recording_id = b.recording_id AND a.speaker_id < b.speaker_id AND a.start_time < b.end_time AND b.start_time < a.end_time GROUP BY 1, 2, 3""")
def overlap_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of speakers that talk at the same time: an interval join through time buckets."""
    rows = _clean(spark, folder).select("recording_id", "speaker_id", "start_time", "end_time", "confidence")
    width = 16.0
    bucketed = rows.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("start_time") / width), F.floor(F.col("end_time") / width))))
    a = bucketed.select("recording_id", "bucket", *[F.col(c).alias(f"{c}_a") for c in ("speaker_id", "start_time", "end_time")])
    b = bucketed.select("recording_id", "bucket", *[F.col(c).alias(f"{c}_b") for c in ("speaker_id", "start_time", "end_time")])
    hit = a.join(b, ["recording_id", "bucket"]).where("speaker_id_a < speaker_id_b and start_time_a < end_time_b and start_time_b < end_time_a")
    # A pair that shares several buckets counts in the one in which its overlap begins.
    begins = F.greatest("start_time_a", "start_time_b")
    hit = hit.where(F.floor(begins / width) == F.col("bucket"))
    return hit.groupBy("recording_id", F.col("speaker_id_a").alias("a"), F.col("speaker_id_b").alias("b")).agg(F.count("*").alias("n"), F.round(F.sum(F.least("end_time_a", "end_time_b") - begins), 3).alias("seconds"))


@SEGMENTS.query("sliding_segments", f"SELECT recording_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT recording_id, unnest(generate_series(0, CAST(floor(round((d - 1.0) / 0.5, 6)) AS BIGINT))) FROM (SELECT recording_id, round(max(end_time), 3) AS d FROM {_CLEAN} GROUP BY 1) WHERE d >= 1) GROUP BY 1")
def sliding_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of one second every half second in each recording."""
    spans = _clean(spark, folder).groupBy("recording_id").agg(F.round(F.max("end_time"), 3).alias("d")).where("d >= 1")
    rows = spans.withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.round((F.col("d") - 1.0) / 0.5, 6)))))
    return rows.groupBy("recording_id").agg(F.count("*").alias("n"))


@SEGMENTS.query("window_table", f"""
SELECT recording_id, CAST(k AS INT) AS segment, k * 20.0 AS start, k * 20.0 + 40.0 AS "end" FROM (
  SELECT recording_id, unnest(generate_series(0, CAST(floor(round((d - 40.0) / 20.0, 6)) AS BIGINT))) AS k FROM (SELECT recording_id, round(max(end_time), 3) AS d FROM {_CLEAN} GROUP BY 1) WHERE d >= 40)""")
def window_table(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of 40 s every 20 s of each recording, by a table function."""
    register_table_functions(spark)
    _clean(spark, folder).groupBy("recording_id").agg(F.round(F.max("end_time"), 3).alias("d")).createOrReplaceTempView("voxloom_spans")
    return spark.sql("SELECT recording_id, segment, start, end FROM voxloom_spans, LATERAL sliding_windows(d, 40D, 20D)")


@SEGMENTS.query("rttm_lines", f"SELECT DISTINCT 'SPEAKER ' || recording_id || ' 1 ' || printf('%.3f', start_time) || ' ' || printf('%.3f', end_time - start_time) || ' speaker_' || speaker_id AS line FROM {_CLEAN}")
def rttm_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Segments as lines of the usual text form."""
    line = F.format_string("SPEAKER %s 1 %.3f %.3f speaker_%d", "recording_id", "start_time", F.col("end_time") - F.col("start_time"), "speaker_id")
    return _clean(spark, folder).select(line.alias("line")).distinct()
