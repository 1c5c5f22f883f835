"""Tests, effect sizes and corrections, as aggregations."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.series import numbered


def normal_cdf(z: Column) -> Column:
    """The normal distribution function by a logistic formula that is within 0.0002 of it."""
    return 1 / (1 + F.exp(-(1.5976 * z + 0.07056 * z * z * z)))


def two_sided(t: Column) -> Column:
    """p-value of a statistic that is near normal."""
    return 2 * (1 - normal_cdf(F.abs(t)))


def group_effects(df: DataFrame, group: str, value: str, a: str, b: str) -> DataFrame:
    """Welch's t of two groups with its p-value, Cohen's d, Glass's delta and Hedges' g; null if a group has under two values."""
    x, y = (F.when(F.col(group) == g, F.col(value)) for g in (a, b))
    s = df.agg(*[f(c).alias(f"{n}{k}") for n, f in (("m", F.avg), ("s", F.stddev_samp), ("n", F.count)) for k, c in (("a", x), ("b", y))])
    c = F.col
    error = F.sqrt(c("sa") * c("sa") / c("na") + c("sb") * c("sb") / c("nb"))
    t = (c("ma") - c("mb")) / F.nullif(error, F.lit(0.0))
    pooled = F.sqrt(((c("na") - 1) * c("sa") * c("sa") + (c("nb") - 1) * c("sb") * c("sb")) / (c("na") + c("nb") - 2))
    d = (c("ma") - c("mb")) / F.nullif(pooled, F.lit(0.0))
    return s.select(
        F.lit(a).alias("a"), F.lit(b).alias("b"), c("na").alias("n_a"), c("nb").alias("n_b"), F.round(t, 6).alias("t"), F.round(two_sided(t), 6).alias("p"), (F.abs(t) > 2).alias("significant"),
        F.round(d, 6).alias("cohen_d"), F.round((c("ma") - c("mb")) / c("sb"), 6).alias("glass_delta"), F.round(d * (1 - 3 / (4 * (c("na") + c("nb")) - 9)), 6).alias("hedges_g"),
    )


def paired_test(df: DataFrame, keys: Sequence[str], before: Column, after: Column) -> DataFrame:
    """Paired t of two columns over each key, with the mean difference and its 95 % interval."""
    rows = df.select(*keys, (after - before).cast("double").alias("d")).where("d is not null")
    s = rows.groupBy(*keys).agg(F.count("d").alias("n"), F.avg("d").alias("m"), F.stddev_samp("d").alias("s"))
    error = F.col("s") / F.sqrt("n")
    t = F.col("m") / F.nullif(error, F.lit(0.0))
    return s.select(*keys, "n", F.round("m", 6).alias("mean_difference"), F.round(t, 6).alias("t"), F.round(two_sided(t), 6).alias("p"), F.round(F.col("m") - 1.96 * error, 6).alias("low"), F.round(F.col("m") + 1.96 * error, 6).alias("high"))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    h = d
    for m in range(1, 100_000):
        for t in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + t * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + t / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return front * h


def student_p(t: float, freedom: float) -> float:
    """Two-sided p-value of Student's t."""
    return incomplete_beta(freedom / 2, 0.5, freedom / (freedom + t * t))


def correlation_p(r: float | None, n: int) -> float | None:
    """p-value of a Pearson correlation of n pairs; null without one or with under three pairs."""
    if r is None or n < 3 or math.isnan(r):
        return None
    return student_p(r * math.sqrt((n - 2) / (1 - r * r)), n - 2) if abs(r) < 1 else 0.0


def shapiro_p(w: float, n: int) -> float:
    """p-value of Shapiro and Wilk's W by Royston's approximation (1995)."""
    if n == 3:
        return max(0.0, 6 / math.pi * (math.asin(math.sqrt(min(w, 1.0))) - math.asin(math.sqrt(0.75))))
    if w >= 1:
        return 1.0
    y, x = math.log(1 - w), math.log(n)
    if n <= 11:
        gamma = 0.459 * n - 2.273
        if y >= gamma:
            return 1e-99
        y = -math.log(gamma - y)
        mean, log_sd = ((0.5440, -0.39978, 0.025054, -6.714e-4), (1.3822, -0.77857, 0.062767, -0.0020322))
        at: float = n
    else:
        mean, log_sd = ((-1.5861, -0.31082, -0.083751, 0.0038915), (-0.4803, -0.082676, 0.0030302))
        at = x
    poly = lambda c: sum(k * at**i for i, k in enumerate(c))
    return 0.5 * math.erfc((y - poly(mean)) / math.exp(poly(log_sd)) / math.sqrt(2))


def wilcoxon_p(plus: float, n: int, ties: float, zeros: int) -> float:
    """Two-sided p-value of the signed-rank sum of n differences: exact to 50 without ties and zeros, else normal.

    ``ties`` is the sum of t³ - t over groups of t equal differences.
    """
    if n <= 50 and not ties and not zeros:
        ways = np.zeros(n * (n + 1) // 2 + 1)
        ways[0] = 1
        for k in range(1, n + 1):
            ways[k:] = ways[k:] + ways[:-k]
        less = int(round(min(plus, n * (n + 1) / 2 - plus)))
        return float(min(1.0, 2 * ways[: less + 1].sum() / 2.0**n))
    spread = math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48)
    return math.erfc(abs(plus - n * (n + 1) / 4) / spread / math.sqrt(2)) if spread > 0 else 1.0


def _with(df: DataFrame, added: str, f: Callable[[dict], list]) -> DataFrame:
    """Add columns that ``f`` gives for each row of a small result."""
    names = [x.split()[0] for x in added.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [f(r) for r in batch.to_pylist()]
            kinds = {"double": pa.float64(), "string": pa.string(), "boolean": pa.bool_()}
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([g[i] for g in got], kinds[x.split()[1]]) for i, x in enumerate(added.split(", ")))], [*batch.schema.names, *names])

    return df.mapInArrow(run, ", ".join([*(f"`{x.name}` {x.dataType.simpleString()}" for x in df.schema.fields), added]))


def correlation_tests(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], level: float = 0.05) -> DataFrame:
    """Pearson correlation of all pairs of metrics with its p-value by Student's t, strength and significance."""
    pairs = [(a, b) for i, a in enumerate(metrics) for b in metrics[i + 1 :]]
    wide = df.groupBy(*keys).agg(*[f for i, (a, b) in enumerate(pairs) for f in (F.corr(a, b).alias(f"c{i}"), F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias(f"n{i}"))])
    rows = wide.select(*keys, F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r"), F.col(f"n{i}").alias("n")) for i, (a, b) in enumerate(pairs)])).alias("p")).select(*keys, "p.*")
    rows = _with(rows, "p double", lambda x: [correlation_p(x["r"], x["n"])])
    size = F.abs("r")
    return rows.withColumns({"strength": F.when(size > 0.7, "strong").when(size > 0.4, "moderate").when(size.isNotNull(), "weak"), "significant": F.col("p") < level})


def paired_choice(df: DataFrame, a: str, b: str, level: float = 0.05) -> DataFrame:
    """The test that suits the pairs: paired t if there are 30 and their differences (``a`` - ``b``) are normal by Shapiro and Wilk's test, else Wilcoxon's signed ranks.

    One row with ``test``, ``statistic``, ``p``, ``significant``, ``cohen_d`` (of the pooled deviations), its ``effect``,
    ``mean_difference``, ``low`` and ``high`` (95 %), and ``normality_p``. Pairs with a missing value don't count. Ranks
    are numbered in parts (see :func:`numbered`), so no column is sorted by one task.
    """
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    rows = df.select(x.alias("a"), y.alias("b"), (x - y).alias("d")).where("d is not null and not isnan(d)")
    s = rows.agg(F.count("d").alias("n"), F.avg("d").alias("m"), F.stddev_samp("d").alias("s"), F.stddev_samp("a").alias("sa"), F.stddev_samp("b").alias("sb"), F.min("d").alias("lo"), F.max("d").alias("hi"), F.count_if(F.col("d") == 0).alias("zeros"))
    bounds = s.select("lo", "hi", "n")
    part = lambda v, lo, hi: F.when(hi > lo, F.floor((v - lo) / (hi - lo) * 1024)).otherwise(0)
    placed = rows.select("d").join(bounds, F.lit(True))
    ordered = numbered(placed, [], ["d"], part(F.col("d"), F.col("lo"), F.col("hi")))
    score = _normal_score((F.col("rn") - 0.375) / (F.col("n") + 0.25))
    ordered = ordered.withColumn("z", score)
    end = lambda k: F.max(F.when(F.col("rn") == F.col("n") - k, F.col("d"))) - F.max(F.when(F.col("rn") == k + 1, F.col("d")))
    normal = ordered.agg(F.sum(F.col("z") * F.col("z")).alias("zz"), F.sum(F.col("z") * F.col("d")).alias("zd"), end(0).alias("end0"), end(1).alias("end1"))
    size = placed.where("d <> 0").select(F.abs("d").alias("v"), (F.col("d") > 0).alias("up"), F.greatest(F.abs("lo"), F.abs("hi")).alias("top"))
    equal = numbered(size, [], ["v"], part(F.col("v"), F.lit(0.0), F.col("top"))).groupBy("v").agg(F.min("rn").alias("i"), F.max("rn").alias("j"), F.count_if("up").alias("up"))
    t = (F.col("j") - F.col("i") + 1).cast("double")
    ranks = equal.agg(F.sum((F.col("i") + F.col("j")) / 2.0 * F.col("up")).alias("plus"), F.sum(t * t * t - t).alias("ties"))
    whole = s.join(normal, F.lit(True)).join(ranks, F.lit(True))

    def test(r: dict) -> list:
        n, m, sd = r["n"], r["m"], r["s"]
        if n < 2:
            return [None] * 10
        p_normal = shapiro_p(shapiro_w(n, sd * sd * (n - 1), r["zz"], r["zd"], r["end0"], r["end1"]), n) if n >= 3 and sd > 0 else None
        if (n >= 30 and p_normal is not None and p_normal >= 0.05) or r["zeros"] == n:
            name, statistic = "paired t", m / (sd / math.sqrt(n)) if sd > 0 else None
            p = student_p(statistic, n - 1) if statistic is not None else None
        else:
            used = n - r["zeros"]
            name, statistic = "wilcoxon", min(r["plus"], used * (used + 1) / 2 - r["plus"])
            p = wilcoxon_p(r["plus"], used, r["ties"], r["zeros"])
        pooled = math.sqrt((r["sa"] ** 2 + r["sb"] ** 2) / 2)
        d = m / pooled if pooled > 0 else 0.0
        effect = next(k for k, top in (("negligible", 0.2), ("small", 0.5), ("medium", 0.8), ("large", math.inf)) if abs(d) < top)
        error = 1.96 * sd / math.sqrt(n)
        return [name, statistic, p, p is not None and p < level, d, effect, m, m - error, m + error, p_normal]

    added = "test string, statistic double, p double, significant boolean, cohen_d double, effect string, mean_difference double, low double, high double, normality_p double"
    return _with(whole, added, test).select("n", *[x.split()[0] for x in added.split(", ")])


def shapiro_w(n: int, squares: float, zz: float, zd: float, end0: float, end1: float) -> float:
    """W from sums over the ordered values: of squared deviations, of squared normal scores, of scores times values, and the outer two spans."""
    if n == 3:
        return min(1.0, end0 * end0 / 2 / squares)
    inverse = NormalDist().inv_cdf
    z0, z1, u = -inverse((1 - 0.375) / (n + 0.25)), -inverse((2 - 0.375) / (n + 0.25)), 1 / math.sqrt(n)
    poly = lambda c: sum(k * u ** (i + 1) for i, k in enumerate(c))
    a0 = z0 / math.sqrt(zz) + poly((0.221157, -0.147981, -2.071190, 4.434685, -2.706056))
    if n <= 5:
        scale, inner = math.sqrt((zz - 2 * z0 * z0) / (1 - 2 * a0 * a0)), zd - z0 * end0
        total = a0 * end0 + inner / scale
    else:
        a1 = z1 / math.sqrt(zz) + poly((0.042981, -0.293762, -1.752461, 5.682633, -3.582633))
        scale = math.sqrt((zz - 2 * z0 * z0 - 2 * z1 * z1) / (1 - 2 * a0 * a0 - 2 * a1 * a1))
        total = a0 * end0 + a1 * end1 + (zd - z0 * end0 - z1 * end1) / scale
    return min(1.0, total * total / squares)


def _normal_score(p: Column) -> Column:
    """Inverse of the normal distribution function by Acklam's rational formulas, within 2e-9 of its size."""
    a = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
    b = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0)
    c = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
    d = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)

    def poly(k: Sequence[float], x: Column) -> Column:
        out = F.lit(k[0])
        for v in k[1:]:
            out = out * x + v
        return out

    q, low = p - 0.5, F.sqrt(-2 * F.log(F.least(p, 1 - p)))
    tail = poly(c, low) / poly(d, low)
    return F.when(p < 0.02425, tail).when(p > 1 - 0.02425, -tail).otherwise(poly(a, q * q) * q / poly(b, q * q))


def corrected(df: DataFrame, p: str, tie: str) -> DataFrame:
    """p-values of a family of tests, corrected four ways: ``bonferroni``, ``holm``, ``fdr_bh``, ``fdr_by``.

    The family is as many rows as there are tests, not records, and is ranked in one window.
    """
    w = Window.orderBy(p, tie)
    rows = df.where(F.col(p).isNotNull()).withColumn("__r", F.row_number().over(w)).withColumn("__m", F.count("*").over(Window.partitionBy(F.lit(1))))
    rows = rows.withColumn("__h", F.aggregate(F.sequence(F.lit(1), F.col("__m").cast("int")), F.lit(0.0), lambda s, k: s + 1 / k))
    up, down = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    one = lambda c: F.round(F.least(F.lit(1.0), c), 6)
    step = F.col(p) * F.col("__m") / F.col("__r")
    out = rows.withColumn("bonferroni", one(F.col(p) * F.col("__m"))).withColumn("holm", one(F.max(F.col(p) * (F.col("__m") - F.col("__r") + 1)).over(up)))
    return out.withColumn("fdr_bh", one(F.min(step).over(down))).withColumn("fdr_by", one(F.min(step * F.col("__h")).over(down))).drop("__r", "__m", "__h")


def bootstrap_interval(df: DataFrame, keys: Sequence[str], row: str, value: str, rounds: int = 200, level: float = 0.95) -> DataFrame:
    """Mean of each key with a bootstrap interval; each row weighs as a Poisson variable drawn from its hash.

    Rows are aggregated to one sum a round before anything is shuffled, so no sample is ever held.
    """
    u = (F.pmod(F.xxhash64(row, "b"), F.lit(1_000_003)) + 0.5) / 1_000_003
    cuts = [0.367879, 0.735759, 0.919699, 0.981012, 0.996340, 0.999406]
    weight = sum((F.when(u >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    rows = df.where(F.col(value).isNotNull()).select(*keys, row, F.col(value).cast("double").alias("v"), F.explode(F.sequence(F.lit(1), F.lit(rounds))).alias("b")).withColumn("w", weight)
    means = rows.groupBy(*keys, "b").agg((F.sum(F.col("v") * F.col("w")) / F.nullif(F.sum("w"), F.lit(0))).alias("m"))
    tail = (1 - level) / 2
    out = means.groupBy(*keys).agg(F.round(F.percentile("m", F.lit(tail)), 6).alias("low"), F.round(F.percentile("m", F.lit(1 - tail)), 6).alias("high"))
    return out.join(df.groupBy(*keys).agg(F.round(F.avg(F.col(value).cast("double")), 6).alias("mean")), list(keys))


def best_threshold(df: DataFrame, keys: Sequence[str], score: str, truth: Column, thresholds: Sequence[float]) -> DataFrame:
    """The threshold of best F1 for each key, the lowest of several."""
    t = df.select(*keys, F.col(score).cast("double").alias("s"), truth.alias("y")).where("s is not null and y is not null")
    sums = [f(F.when(c, 1).otherwise(0)).alias(f"{n}{i}") for i, x in enumerate(thresholds) for n, f, c in (("tp", F.sum, (F.col("s") >= x) & F.col("y")), ("fp", F.sum, (F.col("s") >= x) & ~F.col("y")), ("fn", F.sum, (F.col("s") < x) & F.col("y")))]
    wide = t.groupBy(*keys).agg(*sums)
    f1 = lambda i: F.round(F.coalesce(2.0 * F.col(f"tp{i}") / F.nullif(2 * F.col(f"tp{i}") + F.col(f"fp{i}") + F.col(f"fn{i}"), F.lit(0)), F.lit(0.0)), 6)
    best = F.array_max(F.array(*[F.struct(f1(i).alias("f1"), F.lit(-x).alias("first")) for i, x in enumerate(thresholds)]))
    return wide.select(*keys, best["f1"].alias("f1"), (-best["first"]).alias("threshold"))


def required_size(effect: Column, alpha: float = 0.05, power: float = 0.8) -> Column:
    """Rows that each of two groups needs for an effect (Cohen's d) to be found with the power, by the normal distribution; null for no effect."""
    z = NormalDist().inv_cdf(1 - alpha / 2) + NormalDist().inv_cdf(power)
    return F.ceil(2 * F.pow(z / F.nullif(effect, F.lit(0.0)), F.lit(2.0)))


def achieved_power(n: Column, effect: Column, alpha: float = 0.05) -> Column:
    """Power with which two groups of ``n`` rows find an effect, by the normal distribution (see :func:`normal_cdf`)."""
    return normal_cdf(F.abs(effect) * F.sqrt(n / 2) - NormalDist().inv_cdf(1 - alpha / 2))


def experiment_winner(df: DataFrame, group: str, value: str, weight: str, a: str, b: str, least: int = 10) -> DataFrame:
    """The arm of larger weighted mean, if both have ``least`` rows and Welch's t is over 2: ``A``, ``B`` or null."""
    arm = lambda g: F.sum(F.when(F.col(group) == g, F.col(value) * F.col(weight))) / F.nullif(F.sum(F.when((F.col(group) == g) & F.col(value).isNotNull(), F.col(weight))), F.lit(0))
    means = df.agg(arm(a).alias("mean_a"), arm(b).alias("mean_b"))
    t = group_effects(df, group, value, a, b).select("n_a", "n_b", "t", "p").join(means, F.lit(True))  # one row each
    clear = (F.col("n_a") >= least) & (F.col("n_b") >= least) & (F.abs("t") > 2)
    return t.withColumn("winner", F.when(clear, F.when(F.col("mean_a") > F.col("mean_b"), "A").otherwise("B")))


def learned_weights(df: DataFrame, metrics: Sequence[str], target: str, rounds: int = 5000) -> dict[str, float]:
    """Weights of the metrics, none negative and 1 in all, whose weighted sum is nearest to the target in squares.

    Only sums of products come to the driver (a number for each pair of metrics); rows with a missing value don't count. Equal weights without rows.
    """
    columns = [F.col(c).cast("double") for c in (*metrics, target)]
    good = df.where(F.lit(True))
    for c in columns:
        good = good.where(c.isNotNull() & ~F.isnan(c))
    k = len(metrics)
    sums = good.agg(F.count("*"), *[F.sum(columns[i] * columns[j]) for i in range(k) for j in range(k + 1)]).first()
    if not sums[0]:
        return dict.fromkeys(metrics, 1 / k)
    products = np.array(sums[1:], float).reshape(k, k + 1) / sums[0]
    gram, aim = products[:, :k], products[:, k]
    step, w = 1 / max(np.linalg.eigvalsh(gram)[-1], 1e-12), np.full(k, 1 / k)
    ahead, pace = w, 1.0
    for _ in range(rounds):
        y = ahead - step * (gram @ ahead - aim)
        # The nearest point of the simplex.
        down = np.sort(y)[::-1]
        over = (np.cumsum(down) - 1) / np.arange(1, k + 1)
        new = np.maximum(y - over[np.flatnonzero(down > over)[-1]], 0)
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead, pace, w = new + (pace - 1) / faster * (new - w), faster, new
    return dict(zip(metrics, w.tolist(), strict=True))


MOST_PATTERNS = 10_000  # of a pattern base, which is sent to every task


def matched_patterns(df: DataFrame, key: str, kind: str, features: Sequence[str], patterns: DataFrame, name: str, least: float = 0.5) -> DataFrame:
    """The pattern of the same kind that is most similar to each row: ``key``, ``name``, ``similarity``; rows without one over ``least`` are left out.

    Similarity is the mean over the features of 1 less the difference's share of the larger size; a missing feature counts 0.
    Ties go to the smallest name. More than ``MOST_PATTERNS`` patterns are refused.
    """
    if patterns.limit(MOST_PATTERNS + 1).count() > MOST_PATTERNS:
        raise ValueError("too many patterns to send to every task")
    theirs = F.broadcast(patterns.select(F.col(kind).alias("__kind"), F.col(name).alias("__name"), *[F.col(f).cast("double").alias(f"__{f}") for f in features]))
    both = df.select(F.col(key).alias("__key"), F.col(kind).alias("__k"), *[F.col(f).cast("double").alias(f) for f in features]).join(theirs, F.col("__k") == F.col("__kind"))
    alike = lambda f: 1 - F.abs(F.col(f) - F.col(f"__{f}")) / F.greatest(F.abs(f), F.abs(f"__{f}"), F.lit(1e-12))
    both = both.withColumn("similarity", F.round(sum((F.coalesce(alike(f), F.lit(0.0)) for f in features), F.lit(0.0)) / len(features), 9)).where(F.col("similarity") >= least)
    # The best of each row: a minimum with partial aggregation.
    best = both.groupBy("__key").agg(F.min(F.struct((-F.col("similarity")).alias("s"), F.col("__name").alias("n"))).alias("b"))
    return best.select(F.col("__key").alias(key), F.col("b.n").alias(name), (-F.col("b.s")).alias("similarity"))
