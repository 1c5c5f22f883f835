"""Queries on vectors and on statistics of groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators import aggregates as A
from voxloom.operators import statistics as T
from voxloom.operators import vectors as V
from voxloom.plans.metrics import NAMES, VIEW, view
from voxloom.plans.registry import Registry
from voxloom.sources import table

VECTORS = Registry()
_CENTRES = "(SELECT label, list(m ORDER BY i) AS centroid FROM (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(generate_series(1, 64)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings) GROUP BY 1, 2) GROUP BY label)"


@VECTORS.query("centroids", f"SELECT label, CAST(i AS BIGINT) AS i, round(centroid[i], 5) AS x FROM (SELECT label, centroid, unnest(generate_series(1, 64)) AS i FROM {_CENTRES})")
def centroids(spark: SparkSession, folder: str) -> DataFrame:
    """The mean vector of every label, place by place."""
    rows = V.centroids(table(spark, folder, "embeddings"), "label", "embedding").select("label", F.posexplode("centroid").alias("i", "x"))
    return rows.select("label", (F.col("i") + 1).cast("bigint").alias("i"), F.round("x", 5).alias("x"))


@VECTORS.query("nearest_centroid", f"""
SELECT vec_id, nearest, similarity FROM (SELECT vec_id, c.label AS nearest, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c.centroid), 4) AS similarity,
  row_number() OVER (PARTITION BY vec_id ORDER BY round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), c.centroid), 9) DESC, c.label) AS n FROM embeddings, {_CENTRES} c) WHERE n = 1""")
def nearest_centroid(spark: SparkSession, folder: str) -> DataFrame:
    """The label whose mean is nearest to each vector."""
    rows = table(spark, folder, "embeddings")
    centres = V.centroids(rows, "label", "embedding").withColumnRenamed("label", "nearest")
    return V.nearest_centroid(rows, "vec_id", "embedding", centres, "nearest").withColumn("similarity", F.round("similarity", 4))


@VECTORS.query("nearest_neighbours", """
SELECT q, id, similarity, place FROM (SELECT a.vec_id AS q, b.vec_id AS id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 5) AS similarity,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) DESC, b.vec_id) AS place FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0) WHERE place <= 5""")
def nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest of all vectors for every twentieth: exact, in blocks."""
    found = V.nearest(table(spark, folder, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 5)
    return found.select("q", "id", F.round("similarity", 5).alias("similarity"), "place")


@VECTORS.query("verified_pairs", """
SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4) AS similarity, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.7 AS same, round((list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) + 1) / 2, 4) AS scaled
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def verified_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Each vector against the next."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    pairs = rows.join(rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")), "vec_id")
    c = V.cosine(F.col("embedding"), F.col("other"))
    return pairs.select("vec_id", F.round(c, 4).alias("similarity"), (c >= 0.7).alias("same"), F.round((c + 1) / 2, 4).alias("scaled"))


@VECTORS.query("label_spread", f"SELECT e.label, count(*) AS n, round(avg(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centroid)), 4) AS mean_similarity FROM embeddings e JOIN {_CENTRES} c ON e.label = c.label GROUP BY e.label")
def label_spread(spark: SparkSession, folder: str) -> DataFrame:
    """How near a label's vectors are to their mean."""
    rows = table(spark, folder, "embeddings")
    both = rows.join(V.centroids(rows, "label", "embedding"), "label")
    return both.groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg(V.cosine(F.col("embedding"), F.col("centroid"))), 4).alias("mean_similarity"))


_PHI = "1 / (1 + exp(-(1.5976 * abs({z}) + 0.07056 * abs({z}) * abs({z}) * abs({z}))))"


def _effects(a: str, b: str) -> str:
    stats = f"SELECT avg(value) FILTER (event_type = '{a}') AS ma, avg(value) FILTER (event_type = '{b}') AS mb, stddev_samp(value) FILTER (event_type = '{a}') AS sa, stddev_samp(value) FILTER (event_type = '{b}') AS sb, count(value) FILTER (event_type = '{a}') AS na, count(value) FILTER (event_type = '{b}') AS nb FROM events"
    return f"SELECT *, (ma - mb) / sqrt(sa * sa / na + sb * sb / nb) AS z, (ma - mb) / sqrt(((na - 1) * sa * sa + (nb - 1) * sb * sb) / (na + nb - 2)) AS d FROM ({stats})"


@VECTORS.query("group_effects", f"SELECT 'click' AS a, 'purchase' AS b, na AS n_a, nb AS n_b, round(z, 6) AS t, round(2 * (1 - {_PHI.format(z='z')}), 6) AS p, abs(z) > 2 AS significant, round(d, 6) AS cohen_d, round((ma - mb) / sb, 6) AS glass_delta, round(d * (1 - 3 / (4 * (na + nb) - 9)), 6) AS hedges_g FROM ({_effects('click', 'purchase')})")
def group_effects(spark: SparkSession, folder: str) -> DataFrame:
    """Two kinds of events against each other."""
    return T.group_effects(table(spark, folder, "events"), "event_type", "value", "click", "purchase")


@VECTORS.query("paired_test", """
WITH d AS (SELECT user_id, avg(value) FILTER (event_type = 'click') AS a, avg(value) FILTER (event_type = 'view') AS b FROM events GROUP BY user_id)
SELECT n, round(m, 6) AS mean_difference, round(m / (s / sqrt(n)), 6) AS t, round(m - 1.96 * s / sqrt(n), 6) AS low, round(m + 1.96 * s / sqrt(n), 6) AS high FROM (SELECT count(b - a) AS n, avg(b - a) AS m, stddev_samp(b - a) AS s FROM d)""")
def paired_test(spark: SparkSession, folder: str) -> DataFrame:
    """The mean of one kind of event against another, paired by user."""
    of = lambda e: F.avg(F.when(F.col("event_type") == e, F.col("value")))
    rows = table(spark, folder, "events").groupBy("user_id").agg(of("click").alias("a"), of("view").alias("b"))
    return T.paired_test(rows, [], F.col("a"), F.col("b")).drop("p")


@VECTORS.query("paired_choice")
def paired_choice(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs by the test that suits their differences."""
    of = lambda e: F.avg(F.when(F.col("event_type") == e, F.col("value")))
    return T.paired_choice(table(spark, folder, "events").groupBy("user_id").agg(of("view").alias("a"), of("click").alias("b")), "a", "b")


_TESTS = f"(SELECT event_type, round(2 * (1 - {_PHI.format(z='z')}), 9) AS p FROM (SELECT e.event_type, (avg(value) - any_value(m)) / (stddev_samp(value) / sqrt(count(value))) AS z FROM events e, (SELECT avg(value) AS m FROM events) GROUP BY e.event_type))"


@VECTORS.query("corrected_tests", f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY p, event_type) AS r, count(*) OVER () AS m FROM {_TESTS}), h AS (SELECT *, (SELECT sum(1.0 / k) FROM (SELECT unnest(generate_series(1, (SELECT max(m) FROM r))) AS k)) AS h FROM r)
SELECT event_type, p, round(least(1, p * m), 6) AS bonferroni, round(least(1, max(p * (m - r + 1)) OVER (ORDER BY p, event_type ROWS UNBOUNDED PRECEDING)), 6) AS holm,
  round(least(1, min(p * m / r) OVER (ORDER BY p, event_type ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS fdr_bh, round(least(1, min(p * m / r * h) OVER (ORDER BY p, event_type ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS fdr_by FROM h""")
def corrected_tests(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the kinds of events differ from the mean of all, corrected for their number."""
    events = table(spark, folder, "events").select("event_type", "value")
    whole = events.agg(F.avg("value").alias("m"))
    s = events.groupBy("event_type").agg(F.avg("value").alias("a"), F.stddev_samp("value").alias("s"), F.count("value").alias("n")).join(whole, F.lit(True))
    z = (F.col("a") - F.col("m")) / (F.col("s") / F.sqrt("n"))
    return T.corrected(s.select("event_type", F.round(T.two_sided(z), 9).alias("p")), "p", "event_type")


@VECTORS.query("bootstrap_means")
def bootstrap_means(spark: SparkSession, folder: str) -> DataFrame:
    """Means of the kinds of events with bootstrap intervals."""
    return T.bootstrap_interval(table(spark, folder, "events"), ["event_type"], "event_id", "value")


@VECTORS.query("best_threshold", f"""
SELECT dataset, max(f1) AS f1, min(t) FILTER (f1 = top) AS threshold FROM (SELECT *, max(f1) OVER (PARTITION BY dataset) AS top FROM (
  SELECT dataset, t, round(coalesce(2.0 * sum(CASE WHEN stoi >= t AND y THEN 1 ELSE 0 END) / nullif(2 * sum(CASE WHEN stoi >= t AND y THEN 1 ELSE 0 END) + sum(CASE WHEN stoi >= t AND NOT y THEN 1 ELSE 0 END) + sum(CASE WHEN stoi < t AND y THEN 1 ELSE 0 END), 0), 0), 6) AS f1
  FROM (SELECT dataset, stoi, split = 'train' AS y FROM {VIEW} WHERE stoi IS NOT NULL AND split IS NOT NULL), (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8]::DOUBLE[]) AS t) GROUP BY dataset, t)) GROUP BY dataset""")
def best_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """The bound on a metric that best tells one split, by source."""
    return T.best_threshold(view(spark, folder), ["dataset"], "stoi", F.col("split") == "train", [k / 10 for k in range(1, 9)])


@VECTORS.query("sample_sizes", f"""
SELECT event_type, n, d AS effect, CAST(coalesce(ceil(2 * pow(2.8015852162522725 / nullif(d, 0), 2)), 0) AS BIGINT) AS required, round(CASE WHEN z >= 0 THEN {_PHI.format(z='z')} ELSE 1 - {_PHI.format(z='z')} END, 5) AS power FROM (
  SELECT *, d * sqrt(n / 2.0) - 1.9599639845400536 AS z FROM (SELECT e.event_type, count(value) AS n, abs(round((avg(value) - any_value(m)) / any_value(s), 4)) AS d FROM events e, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events) GROUP BY e.event_type))""")
def sample_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """How far each kind of event is from all, to four digits, and how many rows it takes to see that; 0 without an effect."""
    events = table(spark, folder, "events").select("event_type", "value")
    whole = events.agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))
    rows = events.groupBy("event_type").agg(F.count("value").alias("n"), F.avg("value").alias("a")).join(whole, F.lit(True))
    d = F.abs(F.round((F.col("a") - F.col("m")) / F.nullif("s", F.lit(0.0)), 4))
    return rows.select("event_type", "n", d.alias("effect"), F.coalesce(T.required_size(d), F.lit(0)).alias("required"), F.round(T.achieved_power(F.col("n"), d), 5).alias("power"))


@VECTORS.query("experiment_winner", f"""
SELECT n_a, n_b, round(z, 6) AS t, mean_a, mean_b, CASE WHEN n_a >= 10 AND n_b >= 10 AND abs(z) > 2 THEN CASE WHEN mean_a > mean_b THEN 'A' ELSE 'B' END END AS winner FROM (
  SELECT na AS n_a, nb AS n_b, z FROM ({_effects('error', 'purchase')})), (
  SELECT round(sum(value * (1 + user_id % 3)) FILTER (event_type = 'error') / sum(1 + user_id % 3) FILTER (event_type = 'error' AND value IS NOT NULL), 6) AS mean_a,
    round(sum(value * (1 + user_id % 3)) FILTER (event_type = 'purchase') / sum(1 + user_id % 3) FILTER (event_type = 'purchase' AND value IS NOT NULL), 6) AS mean_b FROM events)""")
def experiment_winner(spark: SparkSession, folder: str) -> DataFrame:
    """Two kinds of events as the arms of an experiment, with users weighing differently."""
    events = table(spark, folder, "events").withColumn("w", 1 + F.col("user_id") % 3)
    out = T.experiment_winner(events, "event_type", "value", "w", "error", "purchase")
    return out.select("n_a", "n_b", "t", F.round("mean_a", 6).alias("mean_a"), F.round("mean_b", 6).alias("mean_b"), "winner")


@VECTORS.query("parameter_importance", f"""
SELECT parameter, count(m) AS n_settings, round(var_pop(m), 9) AS importance FROM (
  SELECT 'dataset' AS parameter, dataset AS setting, avg(stoi) AS m FROM {VIEW} GROUP BY dataset UNION ALL SELECT 'split', split, avg(stoi) FROM {VIEW} GROUP BY split) GROUP BY parameter""")
def parameter_importance(spark: SparkSession, folder: str) -> DataFrame:
    """How much a metric's mean differs between sources and between splits."""
    rows = A.parameter_importance(view(spark, folder), ["dataset", "split"], "stoi")
    return rows.select("parameter", "n_settings", F.round("importance", 9).alias("importance"))


@VECTORS.query("success_profile", f"""
WITH s AS (SELECT split = 'train' AS ok, {", ".join(f"coalesce({m}, 0) AS {m}" for m in NAMES)} FROM {VIEW} WHERE split IS NOT NULL),
n AS (SELECT count(*) AS n, CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS n_ok FROM s)
""" + " UNION ALL ".join(f"SELECT '{m}' AS metric, n, n_ok, round(quantile_cont({m}, 0.1), 5) AS min, round(quantile_cont({m}, 0.5), 5) AS target, round(quantile_cont({m}, 0.9), 5) AS max FROM s, n WHERE ok GROUP BY n, n_ok" for m in NAMES))
def success_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The usual range of each metric over the samples of one split."""
    rows = A.success_profile(view(spark, folder).withColumn("ok", F.col("split") == "train"), "ok", NAMES)
    return rows.select("metric", "n", "n_ok", *[F.round(c, 5).alias(c) for c in ("min", "target", "max")])


@VECTORS.query("matched_patterns", f"""
SELECT id, pattern, s AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, pattern) AS n FROM (
  SELECT v.id, p.pattern, round((CASE WHEN v.pesq IS NULL OR p.pesq IS NULL THEN 0 ELSE 1 - abs(v.pesq - p.pesq) / greatest(abs(v.pesq), abs(p.pesq), 1e-12) END + CASE WHEN v.snr IS NULL OR p.snr IS NULL THEN 0 ELSE 1 - abs(v.snr - p.snr) / greatest(abs(v.snr), abs(p.snr), 1e-12) END) / 2, 9) AS s
  FROM {VIEW} v JOIN (SELECT split, dataset || '/' || split AS pattern, avg(pesq) AS pesq, avg(snr) AS snr FROM {VIEW} WHERE dataset IS NOT NULL AND split IS NOT NULL GROUP BY 1, 2) p ON v.split = p.split) WHERE s >= 0.5) WHERE n = 1""")
def matched_patterns(spark: SparkSession, folder: str) -> DataFrame:
    """The source whose mean metrics in the same split each sample is most like."""
    rows = view(spark, folder).select("id", "split", "dataset", "pesq", "snr")
    base = rows.where("dataset is not null and split is not null").groupBy("split", F.concat_ws("/", "dataset", "split").alias("pattern")).agg(F.avg("pesq").alias("pesq"), F.avg("snr").alias("snr"))
    return T.matched_patterns(rows, "id", "split", ["pesq", "snr"], base, "pattern")
