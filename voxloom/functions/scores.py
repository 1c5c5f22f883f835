"""Composite scores, gates and levels of quality metrics, as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.functions.scalars import clipped, ladder

# Weights of the metrics in each scoring profile.
PROFILES = {
    "balanced": {"pesq": 0.25, "stoi": 0.25, "si_sdr": 0.20, "snr": 0.15, "naturalness": 0.15},
    "intelligibility": {"pesq": 0.15, "stoi": 0.40, "si_sdr": 0.20, "snr": 0.15, "naturalness": 0.10},
    "quality": {"pesq": 0.40, "stoi": 0.20, "si_sdr": 0.15, "snr": 0.15, "naturalness": 0.10},
    "naturalness": {"pesq": 0.20, "stoi": 0.20, "si_sdr": 0.15, "snr": 0.10, "naturalness": 0.35},
}
# Points (value, share) between which each metric is scaled linearly.
SCALES = {
    "pesq": [(1.0, 0.0), (1.5, 0.1), (2.5, 0.4), (3.5, 0.7), (4.5, 1.0)],
    "stoi": [(0.0, 0.0), (0.5, 0.3), (0.8, 0.7), (1.0, 1.0)],
    "si_sdr": [(-10.0, 0.0), (0.0, 0.2), (10.0, 0.5), (20.0, 0.8), (30.0, 1.0)],
    "snr": [(0.0, 0.0), (40.0, 1.0)],
    "naturalness": [(0.0, 0.0), (1.0, 1.0)],
}
# Least, wanted and largest value of each metric in the production profile.
THRESHOLDS = {"pesq": (3.0, 3.5, 5.0), "stoi": (0.8, 0.9, 1.0), "si_sdr": (10.0, 15.0, 30.0), "snr": (20.0, 25.0, 40.0)}
GRADES = [(90.0, "A"), (80.0, "B"), (70.0, "C"), (60.0, "D")]
CATEGORIES = [(90.0, "excellent"), (70.0, "good"), (50.0, "fair"), (30.0, "poor")]  # fixed values, below them very_poor


def scaled(x: Column, points: Sequence[tuple[float, float]]) -> Column:
    """The share of ``x`` on the line through the points, ends held; a missing or NaN value counts as half."""
    out = F.when(x.isNull() | F.isnan(x), 0.5).when(x <= points[0][0], points[0][1])
    for (a, low), (b, high) in zip(points, points[1:], strict=False):
        out = out.when(x < b, low + (high - low) * (x - a) / (b - a))
    return out.otherwise(points[-1][1])


def score(metrics: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """Weighted sum of the scaled metrics, of 100; a metric that is not given is missing."""
    missing = F.lit(None).cast("double")
    return sum((scaled(metrics.get(m, missing), SCALES[m]) * w for m, w in weights.items()), F.lit(0.0)) * 100


def grade(points: Column) -> Column:
    return ladder(points, GRADES, "F")


def category(points: Column) -> Column:
    return ladder(points, CATEGORIES, "very_poor")


def attainment(x: Column, least: float, wanted: float, largest: float) -> Column:
    """0 under the least value, 1 from the wanted one on, linear between, 0.8 over the largest; missing is 0."""
    return (
        F.when(x.isNull() | F.isnan(x) | (x < least), 0.0).when(x > largest, 0.8).when(x >= wanted, 1.0).otherwise((x - least) / (wanted - least))
    )


def gate_failures(metrics: Mapping[str, Column], thresholds: Mapping[str, tuple[float, float, float]] = THRESHOLDS) -> Column:
    """Names, in order, of the metrics that miss their least value; missing metrics fail."""
    return F.array_compact(F.array(*[F.when(x.isNull() | F.isnan(x) | (x < thresholds[m][0]), m) for m, x in metrics.items()]))


def alert_level(x: Column, bounds: tuple[float, float, float, float], larger_is_worse: bool = False) -> Column:
    """``critical``, ``high``, ``medium`` or ``low`` for the first of four bounds that is crossed, else null."""
    out = None
    for bound, name in zip(bounds, ("critical", "high", "medium", "low"), strict=True):
        hit = (x > bound) if larger_is_worse else (x < bound)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def relative_change(current: Column, baseline: Column, tolerance: float) -> Column:
    """``improved``, ``degraded`` or ``stable`` by the change against the baseline; null without one."""
    change = (current - baseline) / F.abs(F.nullif(baseline, F.lit(0.0)))
    return F.when(change > tolerance, "improved").when(change < -tolerance, "degraded").when(change.isNotNull(), "stable")


def issue_severity(base: Column, impact: Column, confidence: Column) -> Column:
    """Product of how bad an issue is by itself, its impact and how sure it is."""
    return clipped(base * impact * confidence, 0.0, 1.0)


def severity_level(severity: Column) -> Column:
    return ladder(severity, [(0.8, "critical"), (0.6, "high"), (0.4, "medium")], "low")


def repair_priority(severity: Column, ease: Column, confidence: Column) -> Column:
    """What is severe, sure and hard to mend comes first."""
    return severity * (1 - ease) * confidence


# SNRs in dB from which less filtering is enough.
FILTERING = [(35, "none"), (25, "light"), (15, "moderate")]


def filtering_level(snr: Column) -> Column:
    """How much filtering a signal needs; null for no SNR."""
    return ladder(snr, FILTERING, "aggressive")


def improved(before: dict[str, Column], after: dict[str, Column]) -> Column:
    """Whether a filter was worth it: 3 dB of SNR gained, and 5 dB or half a point of PESQ or a tenth of STOI; null counts as no gain."""
    gain = lambda m: F.coalesce(after[m] - before[m], F.lit(0.0))
    # The least gains.
    return (gain("snr") >= 3) & ((gain("snr") > 5) | (gain("pesq") > 0.5) | (gain("stoi") > 0.1))

