"""Measures, trends and tests of the survey against direct computations and known figures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import signals as A
from voxloom.operators import aggregates as G
from voxloom.operators import records as R
from voxloom.operators import series as W
from voxloom.operators import statistics as T


def numbered(spark, x):
    return spark.createDataFrame([("s", i + 1, float(v)) for i, v in enumerate(x)], "k string, rn bigint, v double")


def test_turning_points_against_loop(spark):
    x = np.random.default_rng(3).uniform(0, 5, 300)
    found = []
    for i in range(10, 290):
        a, b = (np.polyfit(np.arange(10), x[j : j + 10], 1)[0] for j in (i - 10, i))
        change = abs(b - a) * 10 / (x.max() - x.min())
        if change > 0.5 and (a > 0) != (b > 0):
            found.append((-min(0.99, change), i + 1))
    want = []
    for _, i in sorted(found):
        if all(abs(i - j) > 10 for j in want):
            want.append(i)
    got = sorted(r.rn for r in W.turning_points(numbered(spark, x), ["k"], "v").collect())
    assert got == sorted(want) and len(found) > len(got) > 5
    assert W.turning_points(numbered(spark, x[:20]), ["k"], "v").count() == 0


def test_degradations(spark):
    rows = [("high", k, 5 - 0.1 * k) for k in range(8)] + [("medium", k, 5 - 0.02 * k) for k in range(8)] + [("up", k, 0.1 * k) for k in range(8)] + [("few", k, -float(k)) for k in range(4)] + [("loose", k, (-1) ** k - 0.02 * k) for k in range(8)]
    got = {r.k: r for r in W.degradations(spark.createDataFrame(rows, "k string, rn int, v double"), ["k"], "rn", "v").collect()}
    assert {k: r.severity for k, r in got.items()} == {"high": "high", "medium": "medium"} and got["high"].last_value == pytest.approx(4.3)


def test_seasons(spark):
    x = np.sin(2 * np.pi * np.arange(120) / 12)
    r = W.seasons(numbered(spark, x), ["k"], "v").first()
    assert r.period == 12 and r.strength == pytest.approx(1) and r.component == pytest.approx(x[:12].tolist(), abs=1e-9)
    assert W.seasons(numbered(spark, np.random.default_rng(1).normal(size=100)), ["k"], "v").first().period is None


def test_scores_of_methods_and_parameters(spark):
    df = spark.createDataFrame([("a", 1.0, 0.5, 2.0, 0.5, True), ("a", 0.5, 0.5, 2.0, 0.5, False), ("b", 1.0, 1.0, 2.0, 1.0, True)], "m string, v double, h double, s double, i double, ok boolean")
    got = {r.m: (r.score, r.place) for r in G.method_scores(df, "m", "v", "h", "s", "i").collect()}
    assert got == {"a": (pytest.approx(-0.5 + 0.75 + 1 + 1), 2), "b": (pytest.approx(1.5 + 1 + 2), 1)}
    assert {r.parameter: r.importance for r in G.parameter_importance(df, ["m", "s"], "v").collect()} == {"m": pytest.approx(np.var([0.75, 1.0])), "s": 0}
    many = spark.range(0, 20).select(F.col("id").cast("double").alias("v"), (F.col("id") >= 10).alias("ok"))
    r = G.success_profile(many, "ok", ["v"]).first()
    assert (r["min"], r.target, r["max"]) == pytest.approx(np.percentile(np.arange(10.0, 20), [10, 50, 90]))
    assert G.success_profile(many.where("ok"), "ok", ["v"]).count() == 0 and G.success_profile(many.limit(9), "ok", ["v"]).count() == 0


def test_exact_distributions(spark):
    assert T.student_p(2.228139, 10) == pytest.approx(0.05, abs=1e-6) and T.student_p(12.7062, 1) == pytest.approx(0.05, abs=1e-6) and T.student_p(1.0, 1) == pytest.approx(0.5)
    assert T.wilcoxon_p(0, 5, 0, 0) == pytest.approx(2 / 32) and T.wilcoxon_p(8, 10, 0, 0) == pytest.approx(0.048828125)
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 4.0), (4.0, 3.0), (5.0, 6.0), (None, 1.0)], "a double, b double")
    r = T.correlation_tests(df, [], ["a", "b"]).first()
    assert r.n == 5 and r.r == pytest.approx(0.8219949) and r.p == pytest.approx(0.08770, abs=1e-4) and r.strength == "strong" and not r.significant


def test_choice_of_the_paired_test(spark):
    # Shapiro and Wilk's own example (1965): W = 0.79 for the weights of 11 men.
    men = [148.0, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    r = T.paired_choice(spark.createDataFrame([(float(v), 0.0) for v in men], "a double, b double"), "a", "b").first()
    assert r.normality_p == pytest.approx(0.0067, abs=2e-4) and r.test == "wilcoxon" and r.p == pytest.approx(2 / 2048)
    g = np.random.default_rng(1)
    for d, name in ((g.normal(0.3, 1, 200), "paired t"), (g.exponential(1, 200), "wilcoxon"), (g.normal(0.3, 1, 20), "wilcoxon")):
        rows = spark.createDataFrame([(float(v), 0.0) for v in d], "a double, b double")
        r = T.paired_choice(rows, "a", "b").first()
        assert r.test == name and r.n == len(d) and r.mean_difference == pytest.approx(d.mean())
        ranks = np.abs(d).argsort().argsort() + 1
        want = d.mean() / (d.std(ddof=1) / np.sqrt(len(d))) if name == "paired t" else min(ranks[d > 0].sum(), ranks[d < 0].sum())
        assert r.statistic == pytest.approx(want)


def test_further_signal_measures():
    rng = np.random.default_rng(4)
    x = 0.5 * np.sin(2 * np.pi * 440 * np.arange(8000) / 8000)
    noise = rng.normal(0, 0.01, 8000)
    snr, confidence = A.enhanced_snr(x + noise, 8000)
    assert confidence == 0.95 and snr == pytest.approx(10 * np.log10((x**2).mean() / (noise**2).mean()), abs=1.5)
    speech = rng.normal(0, 0.3, 16000) * np.repeat([1, 0.01, 1, 0.01], 4000)
    snr, confidence = A.enhanced_snr(speech, 8000)
    assert confidence == 0.9 and snr > 30
    assert A.enhanced_snr(rng.normal(0, 0.3, 16000), 8000)[0] < snr / 1.5 and A.enhanced_snr(np.zeros(800), 8000)[1] == 0.3
    assert A.frame_snr(speech, 8000) == pytest.approx(10 * np.log10(0.5 * 10**4), abs=1.5) and A.frame_snr(x[:160], 8000) == 0
    assert A.quick_snr(np.zeros(50)) == 40 and A.quick_snr(np.linspace(0, 1, 101)) == pytest.approx(10 * np.log10(0.81 / 0.01))
    assert A.spectral_distortion(x + noise, 2 * (x + noise), 8000) == pytest.approx(20 * np.log10(2), abs=1e-6)
    assert A.spectral_peaks(np.array([0, 1, 0.95, 1, 0, 0.5, 0.5, 0.5, 0.2])) == {1, 3, 6}
    assert A.si_sar(x, x) == 40 and A.si_sar(x, x + 0.4 * np.sin(2 * np.pi * 1000 * np.arange(8000) / 8000)) == pytest.approx(20 * np.log10(0.5 / 0.4) - 2.5, abs=1e-2)
    assert {"enhanced_snr", "frame_snr", "quick_snr"} <= set(A.features(x, 8000))


def test_every_source_takes_turns(spark, sf):
    from voxloom.plans.records import interleaved_all

    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "s string, t int")
    got = {r.t: r.turn for r in R.interleaved(df, "s", ["t"], F.col("t"), {"a": 2.0}).collect()}
    assert got == {1: 0.5, 2: 1.0, 3: 1.0, 4: 1.0, 5: 2.0}
    out = interleaved_all(spark, sf)
    assert out.where("turn is not null").count() == spark.read.parquet(f"{sf}/samples.parquet").select("id").distinct().count()
