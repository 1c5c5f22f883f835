"""Queries on quality metrics of samples and on failures.

The samples carry a confidence and a length; the metrics of a sample are derived from them by fixed
formulas that stand in for measured ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.functions import scalars as S
from voxloom.functions import scores as C
from voxloom.operators import aggregates as A
from voxloom.operators.records import first_of_each, keep_best
from voxloom.operators.statistics import learned_weights
from voxloom.plans.records import ONCE, PLAIN
from voxloom.plans.registry import Registry
from voxloom.sources import table

METRICS = Registry()
NAMES = ["pesq", "stoi", "si_sdr", "snr"]

VIEW = f"""(SELECT id, {PLAIN} AS dataset, split, stoi, 1 + 3.5 * stoi AS pesq, 10 * ln(len + 1) - 5 AS si_sdr, 12 * ln(len + 1) AS snr, len FROM (
  SELECT *, CASE WHEN confidence_score BETWEEN 0 AND 1 THEN CAST(confidence_score AS DOUBLE) END AS stoi,
    CASE WHEN length BETWEEN 0.01 AND 3600 THEN CAST(length AS DOUBLE) END AS len FROM ({ONCE})))"""


def view(spark: SparkSession, folder: str) -> DataFrame:
    rows = first_of_each(table(spark, folder, "samples").select("id", "dataset_name", "split", "confidence_score", "length", "ingested_at"), ["id"], ["ingested_at"])
    stoi = F.when(F.col("confidence_score").between(0, 1), F.col("confidence_score").cast("double"))
    seconds = F.when(F.col("length").between(0.01, 3600), F.col("length").cast("double"))
    rows = rows.select("id", S.plain_name(F.col("dataset_name")).alias("dataset"), "split", stoi.alias("stoi"), seconds.alias("len"))
    return rows.withColumns({"pesq": 1 + 3.5 * F.col("stoi"), "si_sdr": 10 * F.log(F.col("len") + 1) - 5, "snr": 12 * F.log(F.col("len") + 1)})


def _columns() -> dict:
    return {m: F.col(m) for m in NAMES}


_FIVE = "round(avg({0}), 4) AS mean, round(stddev_pop({0}), 4) AS std, round(min({0}), 4) AS min, round(max({0}), 4) AS max"
_LONG = f"(SELECT id, dataset, split, unnest([struct_pack(metric := 'pesq', value := pesq), struct_pack(metric := 'stoi', value := stoi), struct_pack(metric := 'si_sdr', value := si_sdr), struct_pack(metric := 'snr', value := snr)], recursive := true) FROM {VIEW})"


@METRICS.query("metric_summary", f"""
SELECT metric, count(value) AS n, {_FIVE.format('value')}, round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS p75
FROM {_LONG} WHERE value IS NOT NULL GROUP BY metric""")
def metric_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Mean, deviation, extremes and quartiles of every metric."""
    return A.described(A.unpivoted(view(spark, folder), ["id"], NAMES), ["metric"], "value")


@METRICS.query("metric_summary_by_dataset", f"""
SELECT dataset, metric, count(value) AS n, {_FIVE.format('value')}, round(quantile_cont(value, 0.1), 4) AS p10, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.9), 4) AS p90
FROM {_LONG} WHERE value IS NOT NULL GROUP BY dataset, metric""")
def metric_summary_by_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """The same for every source, with deciles: the comparison of methods in a batch."""
    return A.described(A.unpivoted(view(spark, folder), ["dataset"], NAMES), ["dataset", "metric"], "value", {"p10": 0.1, "p50": 0.5, "p90": 0.9})


@METRICS.query("missing_as_zero", f"""
SELECT count(*) AS n, round(avg(coalesce(snr, 0)), 4) AS avg_snr, round(stddev_pop(coalesce(snr, 0)), 4) AS std_snr, round(avg(coalesce(pesq, 0)), 4) AS avg_pesq,
  round(quantile_cont(coalesce(snr, 0), 0.25), 4) AS p25_snr, round(quantile_cont(coalesce(snr, 0), 0.75), 4) AS p75_snr FROM {VIEW}""")
def missing_as_zero(spark: SparkSession, folder: str) -> DataFrame:
    """Aggregates in which a missing metric counts as zero."""
    snr, pesq = F.coalesce("snr", F.lit(0.0)), F.coalesce("pesq", F.lit(0.0))
    r = lambda c, name: F.round(c, 4).alias(name)
    return view(spark, folder).agg(
        F.count("*").alias("n"), r(F.avg(snr), "avg_snr"), r(F.stddev_pop(snr), "std_snr"), r(F.avg(pesq), "avg_pesq"), r(F.percentile(snr, F.lit(0.25)), "p25_snr"), r(F.percentile(snr, F.lit(0.75)), "p75_snr")
    )


@METRICS.query("metric_correlations", f"""
SELECT 'pesq' AS a, 'snr' AS b, round(corr(pesq, snr), 4) AS r FROM {VIEW} UNION ALL SELECT 'pesq', 'si_sdr', round(corr(pesq, si_sdr), 4) FROM {VIEW} UNION ALL SELECT 'si_sdr', 'snr', round(corr(si_sdr, snr), 4) FROM {VIEW}""")
def metric_correlations(spark: SparkSession, folder: str) -> DataFrame:
    """Correlations of pairs of metrics."""
    return A.correlations(view(spark, folder), [], ["pesq", "si_sdr", "snr"]).select("a", "b", "r")


@METRICS.query("metric_fit", f"SELECT dataset, count(pesq) AS n, round(regr_slope(pesq, len), 6) AS slope, round(regr_intercept(pesq, len), 4) AS intercept, round(regr_r2(pesq, len), 6) AS r2 FROM {VIEW} WHERE pesq IS NOT NULL AND len IS NOT NULL GROUP BY dataset")
def metric_fit(spark: SparkSession, folder: str) -> DataFrame:
    """The line of a metric over length, for every source."""
    return A.linear_fit(view(spark, folder).where("pesq is not null and len is not null"), ["dataset"], "len", "pesq").drop("direction")


@METRICS.query("cross_dataset_consistency", f"""
SELECT metric, round(avg(m), 4) AS mean, round(stddev_pop(m), 4) AS std, round(1 / (1 + stddev_pop(m) / abs(avg(m))), 4) AS consistency
FROM (SELECT dataset, metric, avg(value) AS m FROM {_LONG} WHERE value IS NOT NULL GROUP BY dataset, metric) GROUP BY metric""")
def cross_dataset_consistency(spark: SparkSession, folder: str) -> DataFrame:
    """How alike the sources' means are."""
    each = A.unpivoted(view(spark, folder), ["dataset"], NAMES).groupBy("dataset", "metric").agg(F.avg("value").alias("m"))
    spread = F.stddev_pop("m") / F.abs(F.avg("m"))
    return each.groupBy("metric").agg(F.round(F.avg("m"), 4).alias("mean"), F.round(F.stddev_pop("m"), 4).alias("std"), F.round(1 / (1 + spread), 4).alias("consistency"))


@METRICS.query("best_dataset", f"""
SELECT metric, arg_max(dataset, m) AS best FROM (SELECT dataset, metric, round(avg(value), 8) AS m FROM {_LONG} WHERE value IS NOT NULL AND dataset IS NOT NULL GROUP BY dataset, metric) GROUP BY metric""")
def best_dataset(spark: SparkSession, folder: str) -> DataFrame:
    """The source with the best mean of every metric."""
    each = A.unpivoted(view(spark, folder).where("dataset is not null"), ["dataset"], NAMES).groupBy("dataset", "metric").agg(F.round(F.avg("value"), 8).alias("m"))
    return each.groupBy("metric").agg(F.max_by("dataset", "m").alias("best"))


@METRICS.query("weighted_means", f"SELECT dataset, round(sum(coalesce(pesq, 0) * len) / sum(len), 4) AS pesq, round(sum(coalesce(stoi, 0) * len) / sum(len), 4) AS stoi FROM {VIEW} WHERE len IS NOT NULL GROUP BY dataset")
def weighted_means(spark: SparkSession, folder: str) -> DataFrame:
    """Means by length; missing values count as 0."""
    rows = view(spark, folder).where("len is not null")
    return rows.groupBy("dataset").agg(*[F.round(A.weighted_mean(F.col(m), F.col("len")), 4).alias(m) for m in ("pesq", "stoi")])


@METRICS.query("learned_thresholds", f"""
SELECT metric, round(quantile_cont(value, 0.25), 4) AS least, round(quantile_cont(value, 0.75), 4) AS wanted, round(greatest(quantile_cont(value, 0.95), CASE metric WHEN 'pesq' THEN 5.0 WHEN 'stoi' THEN 1.0 WHEN 'si_sdr' THEN 30.0 ELSE 40.0 END), 4) AS largest
FROM {_LONG} WHERE value IS NOT NULL GROUP BY metric""")
def learned_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """Thresholds learned from what was measured; the largest value never falls."""
    largest = F.coalesce(*[F.when(F.col("metric") == m, F.lit(t[2])) for m, t in C.THRESHOLDS.items()])
    rows = A.unpivoted(view(spark, folder), ["id"], NAMES).groupBy("metric").agg(*[F.percentile("value", F.lit(p)).alias(n) for n, p in (("a", 0.25), ("b", 0.75), ("c", 0.95))])
    return rows.select("metric", F.round("a", 4).alias("least"), F.round("b", 4).alias("wanted"), F.round(F.greatest(F.col("c"), largest), 4).alias("largest"))


_SCALED = {"naturalness": "0.5"}
for _m in NAMES:
    _p = C.SCALES[_m]
    _SCALED[_m] = f"CASE WHEN {_m} IS NULL THEN 0.5 WHEN {_m} <= {_p[0][0]} THEN {_p[0][1]} " + " ".join(f"WHEN {_m} < {b} THEN {low} + ({high} - {low}) * ({_m} - ({a})) / ({b} - ({a}))" for (a, low), (b, high) in zip(_p, _p[1:], strict=False)) + f" ELSE {_p[-1][1]} END"
_SCORE = f"round(({' + '.join(f'{w} * {_SCALED[m]}' for m, w in C.PROFILES['quality'].items())}) * 100, 4)"


@METRICS.query("scores", f"SELECT id, {_SCORE} AS score, CASE WHEN {_SCORE} >= 90 THEN 'A' WHEN {_SCORE} >= 80 THEN 'B' WHEN {_SCORE} >= 70 THEN 'C' WHEN {_SCORE} >= 60 THEN 'D' ELSE 'F' END AS grade FROM {VIEW}")
def scores(spark: SparkSession, folder: str) -> DataFrame:
    """The composite score of every sample, missing metrics at half, with its grade."""
    rows = view(spark, folder).select("id", F.round(C.score(_columns(), C.PROFILES["quality"]), 4).alias("score"))
    return rows.withColumn("grade", C.grade(F.col("score")))


@METRICS.query("score_percentiles", f"SELECT id, round((rank() OVER (ORDER BY score) - 1) * 100.0 / count(*) OVER (), 4) AS percentile FROM (SELECT id, {_SCORE} AS score FROM {VIEW})")
def score_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    """The share of samples with a lower score, from counts of distinct scores instead of one global sort."""
    rows = view(spark, folder).select("id", F.round(C.score(_columns(), C.PROFILES["quality"]), 4).alias("score"))
    counts = rows.groupBy("score").agg(F.count("*").alias("n")).withColumn("band", F.floor("score"))
    bands = counts.groupBy("band").agg(F.sum("n").alias("b")).withColumn("under", F.coalesce(F.sum("b").over(Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = Window.partitionBy("band").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    lower = counts.withColumn("own", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(bands, "band").select("score", (F.col("own") + F.col("under")).alias("lower"))
    whole = bands.agg(F.sum("b").alias("whole"))
    return rows.join(lower, "score").join(whole, F.lit(True)).select("id", F.round(F.col("lower") * 100.0 / F.col("whole"), 4).alias("percentile"))


@METRICS.query("top_scores", f"SELECT id, score, row_number() OVER (ORDER BY score DESC, id) AS place FROM (SELECT id, {_SCORE} AS score FROM {VIEW}) ORDER BY score DESC, id LIMIT 100")
def top_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The hundred best samples, ties by id."""
    best = A.top(scores(spark, folder).select("id", "score"), [F.desc("score"), F.col("id")], 100)
    return best.withColumn("place", F.row_number().over(Window.orderBy(F.desc("score"), "id")))


@METRICS.query("gates", f"""
SELECT failing, count(*) AS n FROM (SELECT concat_ws(',', CASE WHEN pesq IS NULL OR pesq < 3 THEN 'pesq' END, CASE WHEN stoi IS NULL OR stoi < 0.8 THEN 'stoi' END, CASE WHEN si_sdr IS NULL OR si_sdr < 10 THEN 'si_sdr' END, CASE WHEN snr IS NULL OR snr < 20 THEN 'snr' END) AS failing FROM {VIEW}) GROUP BY failing""")
def gates(spark: SparkSession, folder: str) -> DataFrame:
    """Samples by the quality gates that they fail."""
    return view(spark, folder).groupBy(F.array_join(C.gate_failures(_columns()), ",").alias("failing")).agg(F.count("*").alias("n"))


_ATTAIN = " + ".join(f"CASE WHEN {m} IS NULL OR {m} < {t[0]} THEN 0 WHEN {m} > {t[2]} THEN 0.8 WHEN {m} >= {t[1]} THEN 1 ELSE ({m} - {t[0]}) / ({t[1]} - {t[0]}) END" for m, t in C.THRESHOLDS.items())


@METRICS.query("attainment", f"SELECT split, count(*) AS n, round(avg(({_ATTAIN}) / 4), 4) AS attained FROM {VIEW} GROUP BY split")
def attainment(spark: SparkSession, folder: str) -> DataFrame:
    """How far each split's samples reach the wanted values."""
    whole = sum((C.attainment(F.col(m), *t) for m, t in C.THRESHOLDS.items()), F.lit(0.0)) / len(C.THRESHOLDS)
    return view(spark, folder).groupBy("split").agg(F.count("*").alias("n"), F.round(F.avg(whole), 4).alias("attained"))


@METRICS.query("alert_levels", f"SELECT CASE WHEN pesq < 1.5 THEN 'critical' WHEN pesq < 2.5 THEN 'high' WHEN pesq < 3 THEN 'medium' WHEN pesq < 3.5 THEN 'low' END AS level, count(*) AS n FROM {VIEW} GROUP BY 1")
def alert_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Samples by the alert that their metric raises."""
    return view(spark, folder).groupBy(C.alert_level(F.col("pesq"), (1.5, 2.5, 3.0, 3.5)).alias("level")).agg(F.count("*").alias("n"))


@METRICS.query("outliers", f"""
SELECT id, metric, round((value - m) / s, 4) AS z FROM {_LONG} JOIN (SELECT metric, avg(value) AS m, stddev_pop(value) AS s FROM {_LONG} WHERE value IS NOT NULL GROUP BY metric) USING (metric) WHERE abs((value - m) / s) > 2.5""")
def outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics further than 2.5 deviations from their mean."""
    rows = A.unpivoted(view(spark, folder), ["id"], NAMES)
    stats = rows.groupBy("metric").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s")).where("s > 0")
    z = (F.col("value") - F.col("m")) / F.col("s")
    return rows.join(stats, "metric").where(F.abs(z) > 2.5).select("id", "metric", F.round(z, 4).alias("z"))


@METRICS.query("baseline_changes", f"""
SELECT b.dataset, b.metric, CASE WHEN (c.m - b.m) / abs(b.m) > 0.01 THEN 'improved' WHEN (c.m - b.m) / abs(b.m) < -0.01 THEN 'degraded' ELSE 'stable' END AS change
FROM (SELECT dataset, metric, avg(value) AS m FROM {_LONG} WHERE split = 'train' GROUP BY ALL) b JOIN (SELECT dataset, metric, avg(value) AS m FROM {_LONG} WHERE split = 'test' GROUP BY ALL) c ON b.dataset = c.dataset AND b.metric = c.metric""")
def baseline_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Test against train, by source and metric."""
    rows = A.unpivoted(view(spark, folder).where("dataset is not null"), ["dataset", "split"], NAMES)
    rows = rows.groupBy("dataset", "metric").agg(F.avg(F.when(F.col("split") == "train", F.col("value"))).alias("b"), F.avg(F.when(F.col("split") == "test", F.col("value"))).alias("c")).where("b is not null and c is not null")
    return rows.select("dataset", "metric", C.relative_change(F.col("c"), F.col("b"), 0.01).alias("change"))


_LO_HI = f"(SELECT dataset, min(snr) AS lo, max(snr) AS hi FROM {VIEW} WHERE snr IS NOT NULL AND dataset IS NOT NULL GROUP BY dataset)"


@METRICS.query("histogram_peaks", f"""
WITH b AS (SELECT v.dataset, CAST(CASE WHEN hi > lo THEN least(floor((snr - lo) / (hi - lo) * 20), 19) ELSE 0 END AS INTEGER) AS bin, count(*) AS n FROM {VIEW} v JOIN {_LO_HI} e ON v.dataset = e.dataset WHERE snr IS NOT NULL GROUP BY 1, 2),
m AS (SELECT *, CASE WHEN lag(bin) OVER w = bin - 1 THEN lag(n) OVER w ELSE 0 END AS before, CASE WHEN lead(bin) OVER w = bin + 1 THEN lead(n) OVER w ELSE 0 END AS after, max(n) OVER (PARTITION BY dataset) AS top FROM b WINDOW w AS (PARTITION BY dataset ORDER BY bin))
SELECT dataset, bin, n FROM m WHERE n > before AND n >= after AND n > 0.3 * top""")
def histogram_peaks(spark: SparkSession, folder: str) -> DataFrame:
    """Modes of a metric by source."""
    return A.histogram_peaks(view(spark, folder).where("dataset is not null"), ["dataset"], "snr", 20, 0.3)


@METRICS.query("error_statistics", """
SELECT coalesce(category, 'unknown') AS category, count(*) AS n, count(DISTINCT file_path) AS n_files, round(avg(CASE WHEN recovery_successful THEN 1.0 ELSE 0.0 END) * 100, 4) AS success_percent, CAST(sum(retry_count) AS BIGINT) AS retries
FROM (SELECT DISTINCT * FROM error_records) GROUP BY 1""")
def error_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Failures and recoveries by category; repeated rows count once."""
    rows = table(spark, folder, "error_records").distinct().groupBy(F.coalesce("category", F.lit("unknown")).alias("category"))
    ok = F.coalesce("recovery_successful", F.lit(False)).cast("double")
    return rows.agg(F.count("*").alias("n"), F.count_distinct("file_path").alias("n_files"), F.round(F.avg(ok) * 100, 4).alias("success_percent"), F.sum("retry_count").alias("retries"))


@METRICS.query("failing_files", "SELECT file_path, count(*) AS n FROM (SELECT DISTINCT * FROM error_records) WHERE file_path IS NOT NULL GROUP BY file_path ORDER BY n DESC, file_path LIMIT 10")
def failing_files(spark: SparkSession, folder: str) -> DataFrame:
    """The ten files that fail most."""
    rows = table(spark, folder, "error_records").distinct().where("file_path is not null").groupBy("file_path").agg(F.count("*").alias("n"))
    return A.top(rows, [F.desc("n"), F.col("file_path")], 10)


_KIND = "CASE " + " ".join("WHEN " + " AND ".join(f"regexp_matches(lower(coalesce(error_message, '')), '{'|'.join(w)}')" for w in lists) + f" THEN '{k}'" for k, lists in S.ERROR_WORDS) + " ELSE 'unknown_error' END"


@METRICS.query("error_kinds", f"SELECT category, {_KIND} AS kind, count(*) AS n FROM error_records GROUP BY 1, 2")
def error_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """What the message says beside what the category says."""
    return table(spark, folder, "error_records").groupBy("category", S.error_kind(F.col("error_message")).alias("kind")).agg(F.count("*").alias("n"))


@METRICS.query("failure_patterns", "SELECT retry_count > 1 AS retried, coalesce(category, 'unknown') AS category, count(*) AS n, round(avg(CASE WHEN recovery_successful THEN 0.0 ELSE 1.0 END), 4) AS failure_rate FROM error_records GROUP BY 1, 2 HAVING avg(CASE WHEN recovery_successful THEN 0.0 ELSE 1.0 END) > 0.5")
def failure_patterns(spark: SparkSession, folder: str) -> DataFrame:
    """Groups in which more than half of the recoveries fail."""
    failed = F.when(F.coalesce("recovery_successful", F.lit(False)), 0.0).otherwise(1.0)
    rows = table(spark, folder, "error_records").groupBy((F.col("retry_count") > 1).alias("retried"), F.coalesce("category", F.lit("unknown")).alias("category"))
    return rows.agg(F.count("*").alias("n"), F.avg(failed).alias("f")).where("f > 0.5").select("retried", "category", "n", F.round("f", 4).alias("failure_rate"))


@METRICS.query("worst_per_category", "SELECT file_path, category, max(retry_count) AS retry_count FROM error_records WHERE file_path IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2")
def worst_per_category(spark: SparkSession, folder: str) -> DataFrame:
    """Of a file's failures of one category, the one with most retries."""
    return keep_best(table(spark, folder, "error_records").where("file_path is not null and category is not null"), "file_path", "category", "retry_count")


@METRICS.query("retry_delays", "SELECT category, retry_count, round(2.0 * (retry_count + 1), 4) AS linear, round(2.0 * pow(2, retry_count), 4) AS exponential, round(2.0 / 2, 4) AS escalated, count(*) AS n FROM error_records WHERE retry_count IS NOT NULL GROUP BY 1, 2")
def retry_delays(spark: SparkSession, folder: str) -> DataFrame:
    """Seconds before the next attempt under each strategy."""
    rows = table(spark, folder, "error_records").where("retry_count is not null").groupBy("category", "retry_count").agg(F.count("*").alias("n"))
    delay = lambda s: F.round(S.retry_delay(F.lit(2.0), F.col("retry_count"), F.lit(s)), 4)
    return rows.select("category", "retry_count", delay("linear").alias("linear"), delay("exponential").alias("exponential"), delay("escalation").alias("escalated"), "n")


@METRICS.query("persistent_categories", """
WITH m AS (SELECT DISTINCT coalesce(category, 'unknown') AS category, date_trunc('month', occurred_at) AS month FROM error_records WHERE occurred_at IS NOT NULL)
SELECT category, count(*) AS n_months FROM m GROUP BY category HAVING count(*) > 0.5 * (SELECT count(DISTINCT month) FROM m)""")
def persistent_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Categories that occur in more than half of the months."""
    months = table(spark, folder, "error_records").where("occurred_at is not null").select(F.coalesce("category", F.lit("unknown")).alias("category"), F.trunc("occurred_at", "month").alias("month")).distinct()
    whole = months.agg(F.count_distinct("month").alias("whole"))
    return months.groupBy("category").agg(F.count("*").alias("n_months")).join(whole, F.lit(True)).where("n_months > 0.5 * whole").drop("whole")


@METRICS.query("filtering_levels", f"""
SELECT level, count(*) AS n, CAST(sum(CASE WHEN gain >= 3 AND (gain > 5 OR stoi > 0.9) THEN 1 ELSE 0 END) AS BIGINT) AS n_improved FROM (
  SELECT CASE WHEN snr IS NULL THEN NULL WHEN snr >= 35 THEN 'none' WHEN snr >= 25 THEN 'light' WHEN snr >= 15 THEN 'moderate' ELSE 'aggressive' END AS level, coalesce(snr * 0.2, 0) AS gain, coalesce(stoi, 0) AS stoi FROM {VIEW}) GROUP BY level""")
def filtering_levels(spark: SparkSession, folder: str) -> DataFrame:
    """How much filtering samples need, and for how many a fifth more SNR would be worth it."""
    rows = view(spark, folder)
    none = F.lit(None).cast("double")
    better = C.improved({"snr": F.col("snr"), "pesq": none, "stoi": F.lit(0.8)}, {"snr": F.col("snr") * 1.2, "pesq": none, "stoi": F.col("stoi")})
    return rows.groupBy(C.filtering_level(F.col("snr")).alias("level")).agg(F.count("*").alias("n"), F.count_if(better).alias("n_improved"))


@METRICS.query("metric_weights")
def metric_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Weights of the metrics under which their mean is nearest to the samples' lengths on a scale of a minute."""
    rows = view(spark, folder).withColumn("target", F.col("len") / 60)
    found = learned_weights(rows, NAMES, "target")
    return spark.createDataFrame([(m, round(w, 6)) for m, w in found.items()], "metric string, weight double")
