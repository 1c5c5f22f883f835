"""Grouped statistics of metrics, exact percentiles included."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


PARTS = 1024  # of a group that is ranked


def unpivoted(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Long form (``keys``, ``metric``, ``value``); missing and NaN values give no row."""
    rows = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("m"))
    return rows.select(*keys, "m.metric", "m.value").where("value is not null and not isnan(value)")


def described(df: DataFrame, keys: Sequence[str], value: str, percents: Mapping[str, float] | None = None, digits: int = 4) -> DataFrame:
    """Count, mean, population deviation, extremes and exact interpolated percentiles.

    Percentiles are aggregated as counts of distinct values, so repeated values cost nothing.
    """
    percents = percents or {"p25": 0.25, "median": 0.5, "p75": 0.75}
    r = lambda c: F.round(c, digits)
    out = [F.count(value).alias("n"), r(F.avg(value)).alias("mean"), r(F.stddev_pop(value)).alias("std"), r(F.min(value)).alias("min"), r(F.max(value)).alias("max")]
    out += [r(F.percentile(value, F.lit(p))).alias(name) for name, p in percents.items()]
    return df.groupBy(*keys).agg(*out)


def success_rates(df: DataFrame, keys: Sequence[str], success: Column, value: Column) -> DataFrame:
    """Rows, successes, their share in percent, and the mean value of the successes; null outcomes are failures."""
    ok = F.coalesce(success, F.lit(False))
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(ok).alias("n_ok"), F.round(F.avg(ok.cast("double")) * 100, 4).alias("success_percent"), F.round(F.avg(F.when(ok, value)), 4).alias("mean_of_ok")
    )


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean by weight; a missing value counts as 0, rows without weight not at all."""
    return F.sum(F.coalesce(value, F.lit(0.0)) * weight) / F.nullif(F.sum(weight), F.lit(0))


def correlations(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], digits: int = 4) -> DataFrame:
    """Pearson correlation of all pairs of metrics in one aggregation, with its strength."""
    pairs = [(a, b) for i, a in enumerate(metrics) for b in metrics[i + 1 :]]
    wide = df.groupBy(*keys).agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = wide.select(*keys, F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(f"c{i}"), digits).alias("r")) for i, (a, b) in enumerate(pairs)])).alias("p"))
    size = F.abs(F.col("p.r"))
    return rows.select(*keys, "p.a", "p.b", "p.r", F.when(size >= 0.7, "strong").when(size >= 0.4, "moderate").when(size.isNotNull(), "weak").alias("strength"))


def linear_fit(df: DataFrame, keys: Sequence[str], x: str, y: str, digits: int = 6) -> DataFrame:
    """Slope, intercept, R² and direction of a least-squares line."""
    out = df.groupBy(*keys).agg(F.count(y).alias("n"), F.regr_slope(y, x).alias("s"), F.regr_intercept(y, x).alias("i"), F.regr_r2(y, x).alias("q"))
    return out.select(
        *keys, "n", F.round("s", digits).alias("slope"), F.round("i", 4).alias("intercept"), F.round("q", digits).alias("r2"),
        F.when(F.abs("s") < 0.001, "stable").when(F.col("s") > 0, "improving").when(F.col("s") < 0, "degrading").alias("direction"),
    )


def histogram_peaks(df: DataFrame, keys: Sequence[str], value: str, bins: int, share: float) -> DataFrame:
    """Bins that are local peaks of at least ``share`` of the largest bin: two or more tell several modes.

    Bins cut the range from the least to the largest value; an empty bin counts as 0.
    """
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*keys, F.col(value).alias("v"))
    ends = rows.groupBy(*keys).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))).otherwise(0).cast("int")
    counts = rows.join(ends, list(keys)).groupBy(*keys, at.alias("bin")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys).orderBy("bin")
    near = lambda f, d: F.when(f("bin").over(w) == F.col("bin") + d, f("n").over(w)).otherwise(0)
    marked = counts.withColumns({"before": near(F.lag, -1), "after": near(F.lead, 1), "top": F.max("n").over(Window.partitionBy(*keys))})
    return marked.where((F.col("n") > F.col("before")) & (F.col("n") >= F.col("after")) & (F.col("n") > share * F.col("top"))).select(*keys, "bin", "n")


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows; each task keeps no more than ``n``."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], spread: Column, n: int, output: str = "place") -> DataFrame:
    """The first ``n`` rows of each group with their place; groups are ranked in ``PARTS`` parts before the parts are ranked.

    ``spread`` is a hash of the row. ``order`` should end with a unique column. The ranks within parts are limited to ``n`` by
    each task before anything is moved, so the parts bound what one task sorts, not what is shuffled.
    """
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    rows = df.withColumn("__part", F.pmod(spread, F.lit(PARTS)))
    rows = rows.withColumn("__r", rank(*keys, "__part")).where(F.col("__r") <= n)
    return rows.withColumn(output, rank(*keys)).where(F.col(output) <= n).drop("__part", "__r")


def rescaled(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Add ``minmax`` (0.5 where all values are equal) and ``zscore`` (0 there) of a value within its key."""
    s = df.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"), F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"))
    rows = df.join(s, list(keys)) if keys else df.join(s, F.lit(True))
    v = F.col(value)
    one = F.when(v.isNotNull(), F.when(F.col("__hi") > F.col("__lo"), (v - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))).otherwise(0.5))
    z = F.when(v.isNotNull(), F.when(F.col("__s") > 0, (v - F.col("__m")) / F.col("__s")).otherwise(0.0))
    return rows.withColumns({"minmax": one, "zscore": z}).drop("__lo", "__hi", "__m", "__s")


def method_scores(df: DataFrame, method: str, volume: str, high: str, snr: str, suppression: str) -> DataFrame:
    """Score and rank of each method: -2 |1 - volume| + 1.5 high + 0.5 snr + 2 suppression, of the means; ties by name."""
    c = {k: F.avg(v) for k, v in (("volume", volume), ("high", high), ("snr", snr), ("suppression", suppression))}
    score = -2 * F.abs(1 - c["volume"]) + 1.5 * c["high"] + 0.5 * c["snr"] + 2 * c["suppression"]
    rows = df.groupBy(method).agg(score.alias("score"))  # one row for each method
    return rows.withColumn("place", F.row_number().over(Window.orderBy(F.desc_nulls_last("score"), method)))


def parameter_importance(df: DataFrame, parameters: Sequence[str], score: str) -> DataFrame:
    """``importance`` of each parameter: the population variance of the mean scores of its values; null is a value."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(p).alias("parameter"), F.col(p).cast("string").alias("setting")) for p in parameters])).alias("p"), F.col(score).alias("score"))
    means = long.groupBy("p.parameter", "p.setting").agg(F.avg("score").alias("mean"))
    return means.groupBy("parameter").agg(F.count("mean").alias("n_settings"), F.var_pop("mean").alias("importance"))


def success_profile(df: DataFrame, success: str, metrics: Sequence[str], least: int = 10) -> DataFrame:
    """``min``, ``target`` and ``max`` (10th, 50th, 90th percentile) of each metric over the successes.

    A missing metric counts as 0, a row without outcome not at all. Without ``least`` rows and both outcomes there is no profile.
    """
    rows = df.where(F.col(success).isNotNull())
    known = rows.agg(F.count("*").alias("n"), F.count_if(success).alias("n_ok"), *[F.percentile(F.when(F.col(success), F.coalesce(F.col(m).cast("double"), F.lit(0.0))), F.array(*map(F.lit, (0.1, 0.5, 0.9)))).alias(f"p{i}") for i, m in enumerate(metrics)])
    known = known.where((F.col("n") >= least) & (F.col("n_ok") > 0) & (F.col("n_ok") < F.col("n")))
    rows = known.select("n", "n_ok", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"p{i}").alias("p")) for i, m in enumerate(metrics)])).alias("m"))
    return rows.select("m.metric", "n", "n_ok", *[F.col("m.p")[i].alias(name) for i, name in enumerate(("min", "target", "max"))])
