"""Queries on rankings, rules, sessions and lookups in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.functions import scores as C
from voxloom.functions.extensions import rule_hits
from voxloom.operators import aggregates as A
from voxloom.plans.metrics import NAMES, VIEW, view
from voxloom.plans.registry import Registry
from voxloom.sources import table

EXTRAS = Registry()


@EXTRAS.query("method_ranks", f"""
SELECT dataset, round(mean, 4) AS mean, row_number() OVER (ORDER BY round(mean, 8) DESC, dataset) AS place FROM (
  SELECT dataset, (avg(pesq) + avg(stoi) + avg(si_sdr) + avg(snr)) / 4 AS mean FROM {VIEW} WHERE dataset IS NOT NULL GROUP BY dataset)""")
def method_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Sources by the mean of their raw metrics."""
    means = view(spark, folder).where("dataset is not null").groupBy("dataset").agg((sum((F.avg(m) for m in NAMES[1:]), F.avg(NAMES[0])) / len(NAMES)).alias("mean"))
    return means.select("dataset", F.round("mean", 4).alias("mean"), F.row_number().over(Window.orderBy(F.desc(F.round("mean", 8)), "dataset")).alias("place"))


@EXTRAS.query("worst_samples", f"""
SELECT dataset, id, place FROM (SELECT dataset, id, row_number() OVER (PARTITION BY dataset ORDER BY stoi, id) AS place FROM {VIEW} WHERE stoi < 0.8 AND dataset IS NOT NULL) WHERE place <= 10""")
def worst_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The ten samples of each source that miss a threshold most."""
    rows = view(spark, folder).where("stoi < 0.8 and dataset is not null").select("dataset", "id", "stoi")
    return A.top_per_group(rows, ["dataset"], [F.col("stoi"), F.col("id")], F.xxhash64("id"), 10).select("dataset", "id", "place")


@EXTRAS.query("rescaled_lengths", f"""
SELECT v.id, round((len - lo) / (hi - lo), 6) AS minmax, round((len - m) / s, 4) AS zscore FROM {VIEW} v JOIN (SELECT split, min(len) AS lo, max(len) AS hi, avg(len) AS m, stddev_pop(len) AS s FROM {VIEW} GROUP BY split) t ON v.split = t.split""")
def rescaled_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """Lengths on a common scale within each split."""
    rows = A.rescaled(view(spark, folder).select("id", "split", "len"), ["split"], "len")
    return rows.select("id", F.round("minmax", 6).alias("minmax"), F.round("zscore", 4).alias("zscore"))


_RULES = {"quiet": "snr < 15", "muffled": "pesq < 2.5", "short": "len < 1", "unsure": "stoi < 0.5"}


@EXTRAS.query("rule_hits", " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS n FROM {VIEW} WHERE {c}" for n, c in _RULES.items()))
def rules(spark: SparkSession, folder: str) -> DataFrame:
    """How many samples each rule of a table of rules holds for."""
    return view(spark, folder).select(F.explode(rule_hits(_RULES)).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


@EXTRAS.query("issue_priorities", """
SELECT category, round(s, 4) AS severity, CASE WHEN s >= 0.8 THEN 'critical' WHEN s >= 0.6 THEN 'high' WHEN s >= 0.4 THEN 'medium' ELSE 'low' END AS level, round(s * (1 - ok) * 0.9, 4) AS priority FROM (
  SELECT coalesce(category, 'unknown') AS category, least(1, greatest(0, (1 - avg(CASE WHEN recovery_successful THEN 1.0 ELSE 0.0 END)) * 1.2 * 0.9)) AS s, avg(CASE WHEN recovery_successful THEN 1.0 ELSE 0.0 END) AS ok FROM error_records GROUP BY 1)""")
def issue_priorities(spark: SparkSession, folder: str) -> DataFrame:
    """Severity and priority of the kinds of failure, from how often recovery fails."""
    ok = F.avg(F.when(F.coalesce("recovery_successful", F.lit(False)), 1.0).otherwise(0.0))
    rows = table(spark, folder, "error_records").groupBy(F.coalesce("category", F.lit("unknown")).alias("category")).agg(ok.alias("ok"))
    rows = rows.withColumn("s", C.issue_severity(1 - F.col("ok"), F.lit(1.2), F.lit(0.9)))
    return rows.select("category", F.round("s", 4).alias("severity"), C.severity_level(F.col("s")).alias("level"), F.round(C.repair_priority(F.col("s"), F.col("ok"), F.lit(0.9)), 4).alias("priority"))


@EXTRAS.query("user_sessions", """
SELECT user_id, min(ts) AS start_at, count(*) AS n FROM (SELECT *, sum(CASE WHEN before IS NULL OR ts >= before + INTERVAL 2 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (
  SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)) GROUP BY user_id, s""")
def user_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of each user, parted by two hours without an event."""
    rows = table(spark, folder, "events").groupBy("user_id", F.session_window("ts", "2 hours").alias("w")).agg(F.count("*").alias("n"))
    return rows.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start_at"), "n")


@EXTRAS.query("previous_errors", """
SELECT e.event_id, x.ts AS error_at FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF JOIN (SELECT user_id, ts FROM events WHERE event_type = 'error') x ON e.user_id = x.user_id AND e.ts >= x.ts""")
def previous_errors(spark: SparkSession, folder: str) -> DataFrame:
    """The last error of the same user before each purchase: an as-of join as one window."""
    events = table(spark, folder, "events").where("event_type in ('purchase', 'error')")
    w = Window.partitionBy("user_id").orderBy("ts", (F.col("event_type") == "purchase")).rowsBetween(Window.unboundedPreceding, 0)
    rows = events.select("event_id", "event_type", F.last(F.when(F.col("event_type") == "error", F.col("ts")), ignorenulls=True).over(w).alias("error_at"))
    return rows.where("event_type = 'purchase' and error_at is not null").select("event_id", F.col("error_at").cast("timestamp_ntz").alias("error_at"))


@EXTRAS.query("preferences", """
SELECT split, count(*) AS n, CAST(sum(CASE WHEN better THEN 1 ELSE 0 END) AS BIGINT) AS n_better, round(avg(sure), 4) AS mean_confidence, CAST(sum(CASE WHEN sure >= 0.8 THEN 1 ELSE 0 END) AS BIGINT) AS n_sure FROM (
  SELECT id, arg_max(split, ingested_at) AS split, arg_max(length, ingested_at) > 5 AS better, arg_max(least(greatest(CAST(confidence_score AS DOUBLE), 0), 1), ingested_at) AS sure FROM samples WHERE confidence_score IS NOT NULL AND split IS NOT NULL AND length IS NOT NULL GROUP BY id) GROUP BY split""")
def preferences(spark: SparkSession, folder: str) -> DataFrame:
    """Judgements of which the last of an id wins, with confidences held between 0 and 1."""
    rows = table(spark, folder, "samples").where("confidence_score is not null and split is not null and length is not null")
    last = rows.groupBy("id").agg(F.max_by(F.struct("split", (F.col("length") > 5).alias("better"), F.least(F.greatest(F.col("confidence_score").cast("double"), F.lit(0.0)), F.lit(1.0)).alias("sure")), "ingested_at").alias("j"))
    return last.groupBy("j.split").agg(F.count("*").alias("n"), F.count_if("j.better").alias("n_better"), F.round(F.avg("j.sure"), 4).alias("mean_confidence"), F.count_if(F.col("j.sure") >= 0.8).alias("n_sure"))


@EXTRAS.query("region_cube", """
SELECT r_name, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY CUBE (r_name, o_orderpriority)""")
def region_cube(spark: SparkSession, folder: str) -> DataFrame:
    """Totals by two dimensions and all their margins."""
    t = lambda name: table(spark, folder, name)
    rows = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.cube("r_name", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@EXTRAS.query("parts_never_returned", "SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45")
def parts_never_returned(spark: SparkSession, folder: str) -> DataFrame:
    """A difference of sets of keys."""
    back = table(spark, folder, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select("l_partkey")
    return table(spark, folder, "part").select("p_partkey").subtract(back)
