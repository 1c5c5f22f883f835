"""Islands of intervals that lie close to each other, and what follows from them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.runbitmaps import periods_and_gaps

SHARD = 1 << 15  # frames that are painted together


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], begins: Column, output: str = "island") -> DataFrame:
    """Number the islands of each key: a new one begins wherever ``begins`` is true."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__new", F.coalesce(begins.cast("int"), F.lit(1))).withColumn(output, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def merged(df: DataFrame, keys: Sequence[str], start: str, end: str, gap: float, strict: bool = False, **aggregates: Column) -> DataFrame:
    """Intervals of each key merged where the next begins no more than ``gap`` after all before end.

    With ``strict`` the gap must be less than ``gap``. ``aggregates`` are computed over each island, beside
    ``n``, the smallest start and the largest end. Rows with a null or NaN bound don't count; keys are expected to
    hold a recording's worth of rows each.
    """
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull() & ~F.isnan(start) & ~F.isnan(end))
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    distance = F.round(F.col(start) - reach, 6)
    rows = islands(rows, keys, [start, end], (distance >= gap) if strict else (distance > gap))
    return rows.groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n"), *[c.alias(n) for n, c in aggregates.items()])


def speaker_turns(df: DataFrame, key: str, start: str, end: str, speaker: str, confidence: str, gap: float) -> DataFrame:
    """Segments of one recording joined while the speaker stays the same and pauses are short.

    The end of the joined segment is the largest, its confidence the smallest.
    """
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull() & ~F.isnan(start) & ~F.isnan(end) & F.col(speaker).isNotNull())
    w = Window.partitionBy(key).orderBy(start, end, speaker)
    new = (F.lag(speaker).over(w) != F.col(speaker)) | (F.round(F.col(start) - F.lag(end).over(w), 6) > gap)
    rows = islands(rows, [key], [start, end, speaker], new)
    return rows.groupBy(key, "island").agg(F.min(speaker).alias(speaker), F.min(start).alias(start), F.max(end).alias(end), F.min(confidence).alias(confidence), F.count("*").alias("n"))


def overlap_ratio(df: DataFrame, key: str, start: str, end: str, who: str) -> DataFrame:
    """For each key the time with speech, with several speakers, and the ratio, by an event sweep.

    The sweep sorts bounds instead of making frames, so its cost does not depend on the length of time.
    """
    one = periods_and_gaps(df, [key, who], start, end).where("kind = 'period'")
    events = one.select(F.col(key).alias("k"), F.explode(F.array(F.struct(F.col("start_unit").alias("t"), F.lit(1).alias("d")), F.struct(F.col("end_unit").alias("t"), F.lit(-1).alias("d")))).alias("e"))
    events = events.groupBy("k", F.col("e.t").alias("t")).agg(F.sum("e.d").alias("d"))
    w = Window.partitionBy("k").orderBy("t")
    events = events.select("k", F.sum("d").over(w).alias("level"), (F.lead("t").over(w) - F.col("t")).alias("lasts"))
    out = events.groupBy("k").agg(F.sum(F.when(F.col("level") > 0, F.col("lasts")).otherwise(0)).alias("speech_ms"), F.sum(F.when(F.col("level") > 1, F.col("lasts")).otherwise(0)).alias("overlap_ms"))
    return out.select(F.col("k").alias(key), "speech_ms", "overlap_ms", F.round(F.col("overlap_ms") / F.nullif("speech_ms", F.lit(0)), 6).alias("overlap_ratio"))


def dominance(df: DataFrame, key: str, who: str, start: str, end: str) -> DataFrame:
    """The speaker with most speaking time of each key, ties to the smallest, with its share."""
    each = df.where(F.col(who).isNotNull() & (F.col(start) < F.col(end)) & ~F.isnan(start) & ~F.isnan(end)).groupBy(key, who).agg(F.sum(F.col(end) - F.col(start)).alias("seconds"))
    each = each.withColumn("seconds", F.round("seconds", 3))
    best = F.max(F.struct("seconds", (-F.col(who)).alias("first")))
    out = each.groupBy(key).agg(best.alias("b"), F.sum("seconds").alias("total"), F.count("*").alias("n_speakers"))
    return out.select(key, (-F.col("b.first")).cast("int").alias("dominant"), F.col("b.seconds").alias("seconds"), "n_speakers", F.round(F.col("b.seconds") / F.nullif("total", F.lit(0.0)), 6).alias("share"))


def diarisation_error(hypothesis: DataFrame, reference: DataFrame, key: str, start: str, end: str, who: str, step: float = 0.01) -> DataFrame:
    """Missed, false and confused frames, and their ratio to the reference's speech.

    A frame's speaker is the one of the segment that starts last in it, the largest of several. Keys found on one side only count whole;
    without reference speech the rate is 0 without a hypothesis and 1 with one. Rows with a null key, bound or speaker don't count.

    Time is cut into shards of ``SHARD`` frames, each painted by itself, so neither a long recording nor a fine step makes rows.
    """

    def side(df: DataFrame, number: int) -> DataFrame:
        first, last = F.floor(F.round(F.col(start) / step, 6)).cast("bigint"), F.ceil(F.round(F.col(end) / step, 6)).cast("bigint") - 1
        rows = df.select(F.col(key).alias("k"), F.lit(number).alias("side"), F.col(start).cast("double").alias("at"), F.col(who).cast("bigint").alias("w"), first.alias("a"), last.alias("b"))
        rows = rows.dropna().where("b >= a")
        return rows.withColumn("shard", F.explode(F.sequence(F.floor(F.col("a") / SHARD), F.floor(F.col("b") / SHARD))))

    def paint(t: pa.Table) -> pa.Table:
        base = t.column("shard")[0].as_py() * SHARD
        side, at, w = (t.column(c).to_numpy() for c in ("side", "at", "w"))
        a, b = np.maximum(t.column("a").to_numpy() - base, 0), np.minimum(t.column("b").to_numpy() - base, SHARD - 1)
        speech, speaker = np.zeros((2, SHARD), bool), np.zeros((2, SHARD), np.int64)
        for i in np.lexsort((w, at)):  # what starts last is painted last
            speech[side[i], a[i] : b[i] + 1] = True
            speaker[side[i], a[i] : b[i] + 1] = w[i]
        h, r = speech
        found = [r & ~h, h & ~r, h & r & (speaker[0] != speaker[1]), r]
        return pa.table({"k": t.column("k").slice(0, 1), **{n: pa.array([int(x.sum())]) for n, x in zip(("missed", "false_alarm", "confused", "speech"), found, strict=True)}})

    both = side(hypothesis, 0).unionByName(side(reference, 1))
    parts = both.groupBy("k", "shard").applyInArrow(paint, f"k {both.schema['k'].dataType.simpleString()}, missed bigint, false_alarm bigint, confused bigint, speech bigint")
    out = parts.groupBy(F.col("k").alias(key)).agg(*[F.sum(c).alias(c) for c in ("missed", "false_alarm", "confused", "speech")])
    wrong = F.col("missed") + F.col("false_alarm") + F.col("confused")
    return out.withColumn("der", F.when(F.col("speech") > 0, F.round(wrong / F.col("speech"), 6)).otherwise(F.when(F.col("false_alarm") > 0, 1.0).otherwise(0.0)))


def resegmented(df: DataFrame, key: str, start: str, end: str, speaker: str, confidence: str, least: float, gap: float) -> DataFrame:
    """Turns again after segments shorter than ``least`` are dropped: see :func:`speaker_turns`; with ``duration``."""
    rows = df.where(F.round(F.col(end) - F.col(start), 6) >= least)
    return speaker_turns(rows, key, start, end, speaker, confidence, gap).withColumn("duration", F.round(F.col(end) - F.col(start), 6))


def fixed_segments(df: DataFrame, key: str, length: str, width: float) -> DataFrame:
    """Tiles of ``width`` seconds of each row's ``length``: ``key``, ``segment`` from 0, ``start`` and ``end``; a shorter rest is a tile too.

    Null, NaN, infinite or non-positive lengths give no tile.
    """
    seconds = F.col(length).cast("double")
    rows = df.select(F.col(key), seconds.alias("__l")).where(~F.isnan("__l") & (F.col("__l") > 0) & (F.col("__l") < float("inf")))
    count = F.ceil(F.round(F.col("__l") / width, 6)).cast("bigint")
    rows = rows.withColumn("segment", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)))
    return rows.select(key, "segment", F.round(F.col("segment") * width, 6).alias("start"), F.round(F.least((F.col("segment") + 1) * width, F.col("__l")), 6).alias("end"))


def flag_runs(df: DataFrame, keys: Sequence[str], order: str, flag: Column, least: int = 1) -> DataFrame:
    """Runs of consecutive numbered rows with a true flag: first and last number, and length."""
    rows = df.where(flag)
    w = Window.partitionBy(*keys).orderBy(order)
    rows = rows.withColumn("__run", F.col(order) - F.row_number().over(w))
    out = rows.groupBy(*keys, "__run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))
    return out.where(F.col("n") >= least).drop("__run")


def hysteresis(df: DataFrame, keys: Sequence[str], order: str, value: str, on: float, off: float, output: str) -> DataFrame:
    """On from a value over ``on`` until one under ``off``; off at first, and values between change nothing."""
    event = F.when(F.col(value) > on, True).when(F.col(value) < off, False)
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(output, F.coalesce(F.last(event, ignorenulls=True).over(w), F.lit(False)))
