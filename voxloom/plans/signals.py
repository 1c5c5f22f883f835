"""Queries on signals, which are made from the events by a fixed formula as the tables hold none."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions import signals as A
from voxloom.functions.voices import adaptive
from voxloom.functions.voices import voice_features as voice_kernel
from voxloom.plans.registry import Registry
from voxloom.sources import table

SIGNALS = Registry()
N, RATE = 160, 8000
_SIGNAL = "(SELECT event_id, list_transform(generate_series(0, 159), lambda i: 0.5 * sin(2 * pi() * 440 * i / 8000)) AS clean, list_transform(generate_series(0, 159), lambda i: 0.5 * sin(2 * pi() * 440 * i / 8000) + (0.01 + value / 10000) * cos(7.0 * i)) AS noisy FROM events)"
_D = "list_dot_product"


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores: a small file is one task's, but every row becomes a signal that takes its time."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key)


def _signals(spark: SparkSession, folder: str) -> DataFrame:
    """Tones of 20 ms, one an event, made for whole batches."""
    i = np.arange(N)
    clean, ripple = 0.5 * np.sin(2 * np.pi * 440 * i / RATE), np.cos(7.0 * i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = batch.column(1).to_numpy(zero_copy_only=False)
            n = len(value)
            lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * N), pa.array(x.ravel()))
            noisy = clean + (0.01 + value / 10000)[:, None] * ripple
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(np.tile(clean, (n, 1))), lists(noisy), pa.array(np.full(n, RATE, np.int32))], ["event_id", "clean", "noisy", "rate"])

    return _spread(table(spark, folder, "events").select("event_id", "value"), "event_id").mapInArrow(run, "event_id bigint, clean array<double>, noisy array<double>, rate int")


LONG = 4000
_GATED = f"""(SELECT emb_id, list_transform(generate_series(0, {LONG - 1}), lambda i: CASE WHEN (i // 500) % 3 < 2 THEN 0.5 * sin(2 * pi() * (200 + (emb_id % 7) * 50) * i / 8000) ELSE 0 END) AS clean,
  list_transform(generate_series(0, {LONG - 1}), lambda i: CASE WHEN i % 1999 = 700 THEN 1.0 ELSE (CASE WHEN (i // 500) % 3 < 2 THEN 0.5 * sin(2 * pi() * (200 + (emb_id % 7) * 50) * i / 8000) ELSE 0 END) + (0.002 + (emb_id % 5) * 0.01) * cos(7.0 * i + emb_id % 11) END) AS noisy FROM speaker_embeddings)"""


def _long_signals(spark: SparkSession, folder: str) -> DataFrame:
    """Half a second of bursts of a tone, silences, ripple and clicks for every embedding: many frames, each with something to find."""
    i = np.arange(LONG)
    on = (i // 500) % 3 < 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            for start in range(0, len(key), 256):
                k = key[start : start + 256, None]
                clean = np.where(on, 0.5 * np.sin(2 * np.pi * (200 + (k % 7) * 50) * i / RATE), 0.0)
                noisy = np.where(i % 1999 == 700, 1.0, clean + (0.002 + (k % 5) * 0.01) * np.cos(7.0 * i + k % 11))
                lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * LONG), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(k.ravel()), lists(clean), lists(noisy), pa.array(np.full(len(k), RATE, np.int32))], ["emb_id", "clean", "noisy", "rate"])

    return _spread(table(spark, folder, "speaker_embeddings").select("emb_id"), "emb_id").mapInArrow(run, "emb_id bigint, clean array<double>, noisy array<double>, rate int")


def _checked(x: np.ndarray, rate: int) -> dict[str, float]:
    """Measures that SQL can give too."""
    flags, _ = A.energy_vad(x, rate)
    return {
        "percentile_snr": A.percentile_snr(x), "quick_snr": A.quick_snr(x), "frame_snr": A.frame_snr(x, rate), "speech_share": float(flags.mean()), "n_crossings": float((np.diff(x >= 0) != 0).sum()),
        "n_loud": float((np.abs(x) > 0.99).sum()), "n_dropouts": float(len(A.dropouts(x, rate))),
    }


def _mean_power(size: int, hop: int, last: int) -> str:
    return f"list_transform(generate_series(0, {last}), lambda k: list_sum(list_transform(noisy[k * {hop} + 1 : k * {hop} + {size}], lambda v: v * v)) / {size})"


@SIGNALS.query("signal_checks", f"""
WITH s AS (SELECT emb_id, noisy, list_sort(list_transform(noisy, lambda v: v * v)) AS p, {_mean_power(160, 80, (LONG - 1 - 160) // 80)} AS f, {_mean_power(160, 160, LONG // 160 - 1)} AS e, {_mean_power(40, 40, LONG // 40 - 1)} AS d FROM {_GATED}),
t AS (SELECT *, list_sort(e) AS se, 0.1 * (len(p) - 1) AS lo, 0.9 * (len(p) - 1) AS hi, list_sort(f) AS sf, 0.1 * (len(f) - 1) AS fl, list_transform(d, lambda v: CASE WHEN v < 0.01 * list_avg(d) THEN 1 ELSE 0 END) AS low FROM s),
u AS (SELECT *, p[CAST(floor(lo) AS INT) + 1] + (lo - floor(lo)) * (p[CAST(floor(lo) AS INT) + 2] - p[CAST(floor(lo) AS INT) + 1]) AS p10, p[CAST(floor(hi) AS INT) + 1] + (hi - floor(hi)) * (p[CAST(floor(hi) AS INT) + 2] - p[CAST(floor(hi) AS INT) + 1]) AS p90,
  sf[CAST(floor(fl) AS INT) + 1] + (fl - floor(fl)) * (sf[CAST(floor(fl) AS INT) + 2] - sf[CAST(floor(fl) AS INT) + 1]) AS f10 FROM t)
SELECT emb_id, round(least(40, 10 * log10(list_avg(p[{LONG // 2 + 1} : {LONG}]) / list_avg(p[1 : {LONG // 10}]))), 4) AS percentile_snr, round(10 * log10(p90 / p10), 4) AS quick_snr, round(10 * log10(list_avg(f) / f10), 4) AS frame_snr,
  round(list_avg(list_transform(e, lambda v: CASE WHEN v > greatest(2 * list_avg(se[1 : {max(1, LONG // 160 // 10)}]), 1e-10) THEN 1.0 ELSE 0.0 END)), 4) AS speech_share,
  CAST(list_sum(list_transform(generate_series(2, {LONG}), lambda k: CASE WHEN (noisy[k] >= 0) <> (noisy[k - 1] >= 0) THEN 1 ELSE 0 END)) AS BIGINT) AS n_crossings, CAST(list_sum(list_transform(noisy, lambda v: CASE WHEN abs(v) > 0.99 THEN 1 ELSE 0 END)) AS BIGINT) AS n_loud,
  CAST(len(list_filter(regexp_extract_all(array_to_string(low, ''), '1+'), lambda r: len(r) >= 2)) - CASE WHEN low[1] = 1 AND low[2] = 1 THEN 1 ELSE 0 END - CASE WHEN low[-1] = 1 AND low[-2] = 1 THEN 1 ELSE 0 END AS BIGINT) AS n_dropouts FROM u""")
def signal_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Blind SNRs, speech frames, crossings, full-scale samples and dropouts of the longer signals."""
    m = A.measured(_long_signals(spark, folder).select("emb_id", "noisy", "rate"), "noisy", "rate", _checked)
    of = lambda n: F.col("measures")[n]
    return m.select("emb_id", *[F.round(of(n), 4).alias(n) for n in ("percentile_snr", "quick_snr", "frame_snr", "speech_share")], *[of(n).cast("bigint").alias(n) for n in ("n_crossings", "n_loud", "n_dropouts")])


@SIGNALS.query("voice_features")
def voice_features(spark: SparkSession, folder: str) -> DataFrame:
    """Loudness, harmonicity, anomalies, speakers and overlaps of the longer signals, in long form."""
    rows = A.measured(_long_signals(spark, folder).select("emb_id", "noisy", "rate"), "noisy", "rate", voice_kernel)
    return rows.select("emb_id", F.explode("measures").alias("measure", "value")).withColumn("value", F.round("value", 4))


@SIGNALS.query("enhanced_signals")
def enhanced_signals(spark: SparkSession, folder: str) -> DataFrame:
    """How far filtering by the noise's level brings the longer signals, against their clean form, and its status."""
    rows = A.filtered(_long_signals(spark, folder).withColumn("before", F.col("noisy")), "noisy", "rate", adaptive)
    forms = F.explode(F.array(F.struct(F.lit(True).alias("done"), F.col("noisy").alias("x")), F.struct(F.lit(False).alias("done"), F.col("before").alias("x"))))
    rows = rows.select("emb_id", "status", "clean", forms.alias("f")).select("emb_id", "status", "clean", "f.done", "f.x")
    ratios = A.with_ratios(rows, "clean", "x").groupBy("emb_id")
    return ratios.agg(F.first("status").alias("status"), *[F.round(F.max(F.when(F.col("done") == d, F.col("si_sdr"))), 4).alias(n) for n, d in (("before", False), ("after", True))])


@SIGNALS.query("signal_levels", f"""
SELECT event_id, round(sqrt({_D}(noisy, noisy) / 160), 6) AS rms, round(20 * log10(sqrt({_D}(noisy, noisy) / 160)), 4) AS db, round(list_max(list_transform(noisy, lambda v: abs(v))), 6) AS peak, 0.02 AS seconds FROM {_SIGNAL}""")
def signal_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Level, peak and length of every signal."""
    rows = _signals(spark, folder).withColumn("seconds", A.seconds(F.col("noisy"), F.col("rate"))).select("event_id", "noisy", "seconds")
    return A.with_levels(rows, "noisy").select("event_id", F.round("rms", 6).alias("rms"), F.round("db", 4).alias("db"), F.round("peak", 6).alias("peak"), "seconds")


@SIGNALS.query("signal_ratios", f"""
WITH s AS (SELECT event_id, clean, noisy, list_transform(list_zip(clean, noisy), lambda z: z[1] - z[2]) AS diff, list_transform(clean, lambda v: v - list_avg(clean)) AS r, list_transform(noisy, lambda v: v - list_avg(noisy)) AS e FROM {_SIGNAL}),
k AS (SELECT *, {_D}(r, e) / {_D}(r, r) AS scale FROM s)
SELECT event_id, round(least(40, 10 * log10({_D}(clean, clean) / {_D}(diff, diff))), 4) AS snr, round(10 * log10(scale * scale * {_D}(r, r) / ({_D}(e, e) - 2 * scale * {_D}(r, e) + scale * scale * {_D}(r, r))), 4) AS si_sdr FROM k""")
def signal_ratios(spark: SparkSession, folder: str) -> DataFrame:
    """Noise and distortion of the noisy against the clean signal."""
    rows = A.with_ratios(_signals(spark, folder).select("event_id", "clean", "noisy"), "clean", "noisy")
    return rows.select("event_id", F.round("snr", 4).alias("snr"), F.round("si_sdr", 4).alias("si_sdr"))


@SIGNALS.query("signal_features")
def signal_features(spark: SparkSession, folder: str) -> DataFrame:
    """Spectral and blind measures of every signal, in long form."""
    rows = A.measured(_signals(spark, folder).select("event_id", "noisy", "rate"), "noisy", "rate")
    return rows.select("event_id", F.explode("measures").alias("measure", "value")).withColumn("value", F.round("value", 6))
