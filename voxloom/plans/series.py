"""Queries on metric series: the values of each event type in order of time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.operators import series as W
from voxloom.operators.aggregates import linear_fit
from voxloom.operators.segments import flag_runs, hysteresis
from voxloom.plans.registry import Registry
from voxloom.sources import table

SERIES = Registry()
_ORDER = "PARTITION BY event_type ORDER BY ts, event_id"
_RN = f"(SELECT *, row_number() OVER ({_ORDER}) AS rn FROM events)"


def series(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    return W.numbered(events, ["event_type"], ["ts", "event_id"], F.date_trunc("hour", "ts"))


@SERIES.query("moving_average", f"SELECT event_id, round(avg(value) OVER ({_ORDER} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS ma7, round(avg(value) OVER ({_ORDER} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 4) AS ma30 FROM events")
def moving_average(spark: SparkSession, folder: str) -> DataFrame:
    """Trailing means over 7 and 30 values."""
    rows = W.moving_average(series(spark, folder), ["event_type"], "value", 7, "ma7")
    return W.moving_average(rows, ["event_type"], "value", 30, "ma30").select("event_id", F.round("ma7", 4).alias("ma7"), F.round("ma30", 4).alias("ma30"))


@SERIES.query("rolling_anomalies", f"""
SELECT event_id, z, CASE WHEN abs(z) > 4 THEN 'high' WHEN abs(z) > 3 THEN 'medium' ELSE 'low' END AS severity, round(least(0.99, abs(z) / 5), 4) AS confidence FROM (
  SELECT event_id, round((value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0), 4) AS z, count(value) OVER w AS n FROM events WINDOW w AS ({_ORDER} ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING)) WHERE n = 20 AND abs(z) > 2""")
def rolling_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """Values far from the mean of the twenty around them."""
    rows = W.centred_zscore(series(spark, folder), ["event_type"], "value", 20, "z").withColumn("z", F.round("z", 4))
    rows = rows.select("event_id", "z", W.severity(F.col("z"), 2.0).alias("severity"), F.round(F.least(F.lit(0.99), F.abs("z") / 5), 4).alias("confidence"))
    return rows.where("severity is not null")


@SERIES.query("change_points", f"""
SELECT event_id, round(b, 4) AS slope_before, round(a, 4) AS slope_after FROM (
  SELECT event_id, CASE WHEN count(value) OVER p = 10 THEN regr_slope(value, rn) OVER p END AS b, CASE WHEN count(value) OVER f = 10 THEN regr_slope(value, rn) OVER f END AS a FROM {_RN}
  WINDOW p AS (PARTITION BY event_type ORDER BY rn ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), f AS (PARTITION BY event_type ORDER BY rn ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)) WHERE a * b < 0 AND abs(a - b) > 15""")
def change_points(spark: SparkSession, folder: str) -> DataFrame:
    """Rows at which the slope turns sharply."""
    rows = W.change_points(series(spark, folder), ["event_type"], "value", 10, "turn").where("turn > 15")
    return rows.select("event_id", F.round("slope_before", 4).alias("slope_before"), F.round("slope_after", 4).alias("slope_after"))


@SERIES.query("turning_points")
def turning_points(spark: SparkSession, folder: str) -> DataFrame:
    """Rows at which a trend turns for its series' range, the surest of any that are near each other."""
    rows = W.turning_points(series(spark, folder), ["event_type"], "value")
    return rows.select("event_id", "event_type", "rn", F.round("slope_before", 4).alias("slope_before"), F.round("slope_after", 4).alias("slope_after"), F.round("confidence", 4).alias("confidence"))


@SERIES.query("seasonality", f"""
SELECT a.event_type, k.lag, count(*) AS n, round(corr(a.value, b.value), 4) AS autocorrelation FROM (VALUES (7), (30)) k(lag), {_RN} a JOIN {_RN} b ON a.event_type = b.event_type AND a.rn = b.rn + k.lag GROUP BY ALL""")
def seasonality(spark: SparkSession, folder: str) -> DataFrame:
    """Correlation of each series with itself 7 and 30 rows earlier."""
    rows = series(spark, folder).select("event_type", "rn", "value")
    out = [W.lagged(rows, ["event_type"], "value", k, "earlier").where("earlier is not null").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.corr("value", "earlier"), 4).alias("autocorrelation")).withColumn("lag", F.lit(k)) for k in (7, 30)]
    return out[0].unionByName(out[1]).select("event_type", "lag", "n", "autocorrelation")


_DAILY = "(SELECT CAST(ts AS DATE) AS day, event_type, avg(value) AS v FROM events GROUP BY 1, 2)"


@SERIES.query("leading_indicators", f"""
SELECT a, b, lag, round(r, 4) AS r FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY round(abs(r), 8) DESC, lag) AS n FROM (
  SELECT x.event_type AS a, y.event_type AS b, k.lag, corr(x.v, y.v) AS r FROM (SELECT unnest(generate_series(1, 6)) AS lag) k, {_DAILY} x JOIN {_DAILY} y ON y.day = x.day + CAST(k.lag AS INTEGER) AND x.event_type <> y.event_type GROUP BY ALL) WHERE r IS NOT NULL) WHERE n = 1""")
def leading_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """For each pair of series the lag, in days, at which the first foretells the second best."""
    daily = table(spark, folder, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.avg("value").alias("v"))
    x = daily.select(F.col("event_type").alias("a"), F.col("v").alias("x"), F.col("day"), F.explode(F.sequence(F.lit(1), F.lit(6))).alias("lag")).withColumn("day", F.date_add("day", F.col("lag")))
    rows = x.join(daily.select(F.col("event_type").alias("b"), F.col("v").alias("y"), "day"), "day").where("a <> b")
    each = rows.groupBy("a", "b", "lag").agg(F.corr("x", "y").alias("r")).where("r is not null")
    best = each.groupBy("a", "b").agg(F.max(F.struct(F.round(F.abs("r"), 8), (-F.col("lag")).alias("first"), "r")).alias("m"))
    return best.select("a", "b", (-F.col("m.first")).alias("lag"), F.round("m.r", 4).alias("r"))


@SERIES.query("forecast", f"""
SELECT event_type, CAST(h AS BIGINT) AS step, round(i + s * (n + h), 4) AS forecast, round(1.96 * sd * sqrt(1 + h / 10.0), 4) AS margin FROM (
  SELECT event_type, count(*) AS n, regr_slope(value, rn) AS s, regr_intercept(value, rn) AS i, stddev_pop(value) AS sd FROM {_RN} GROUP BY event_type HAVING count(*) > 10), (SELECT unnest(generate_series(1, 7)) AS h)""")
def forecast(spark: SparkSession, folder: str) -> DataFrame:
    """The line of each series carried on, with the margin growing by the step."""
    x = F.col("rn").cast("double")
    fit = series(spark, folder).groupBy("event_type").agg(F.count("*").alias("n"), F.regr_slope("value", x).alias("s"), F.regr_intercept("value", x).alias("i"), F.stddev_pop("value").alias("sd")).where("n > 10")
    rows = fit.withColumn("step", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(7).cast("bigint"))))
    return rows.select("event_type", "step", F.round(F.col("i") + F.col("s") * (F.col("n") + F.col("step")), 4).alias("forecast"), F.round(1.96 * F.col("sd") * F.sqrt(1 + F.col("step") / 10.0), 4).alias("margin"))


@SERIES.query("trends", f"SELECT event_type, count(value) AS n, round(regr_slope(value, rn), 6) AS slope, round(regr_intercept(value, rn), 4) AS intercept, round(regr_r2(value, rn), 6) AS r2, CASE WHEN abs(regr_slope(value, rn)) < 0.001 THEN 'stable' WHEN regr_slope(value, rn) > 0 THEN 'improving' ELSE 'degrading' END AS direction FROM {_RN} GROUP BY event_type")
def trends(spark: SparkSession, folder: str) -> DataFrame:
    """Slope and direction of every series."""
    return linear_fit(series(spark, folder).withColumn("x", F.col("rn").cast("double")), ["event_type"], "x", "value")


@SERIES.query("recent_window", f"""
SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean, round(median(value), 4) AS median, round(regr_slope(value, rn), 4) AS slope, CAST(sum(CASE WHEN value < 5 THEN 1 ELSE 0 END) AS BIGINT) AS n_below FROM (
  SELECT *, max(rn) OVER (PARTITION BY event_type) AS last FROM {_RN}) WHERE rn > last - 1000 GROUP BY event_type""")
def recent_window(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of the last thousand values of each series."""
    rows = W.latest(series(spark, folder), ["event_type"], 1000)
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"), F.round(F.percentile("value", F.lit(0.5)), 4).alias("median"),
        F.round(F.regr_slope("value", F.col("rn").cast("double")), 4).alias("slope"), F.count_if(F.col("value") < 5).alias("n_below"),
    )


@SERIES.query("pass_rate", f"SELECT event_id, round(p, 4) AS pass_rate FROM (SELECT event_id, rn, avg(CASE WHEN value >= 20 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY event_type ORDER BY rn ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS p FROM {_RN}) WHERE rn >= 10")
def pass_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Share of the last ten values that pass, from the tenth on."""
    rows = series(spark, folder).withColumn("ok", F.when(F.col("value") >= 20, 1.0).otherwise(0.0))
    return W.moving_average(rows, ["event_type"], "ok", 10, "p").where("rn >= 10").select("event_id", F.round("p", 4).alias("pass_rate"))


@SERIES.query("halves", f"""
SELECT event_type, round(a, 4) AS first_half, round(b, 4) AS second_half, CASE WHEN b / a > 1.2 THEN 'slowing' WHEN b / a < 0.8 THEN 'improving' ELSE 'stable' END AS direction FROM (
  SELECT event_type, avg(CASE WHEN 2 * rn <= last THEN value END) AS a, avg(CASE WHEN 2 * rn > last THEN value END) AS b FROM (SELECT *, max(rn) OVER (PARTITION BY event_type) AS last FROM {_RN}) GROUP BY event_type)""")
def halves(spark: SparkSession, folder: str) -> DataFrame:
    """First against second half of every series."""
    rows = series(spark, folder)
    rows = rows.join(rows.groupBy("event_type").agg(F.max("rn").alias("last")), "event_type")
    out = rows.groupBy("event_type").agg(F.avg(F.when(2 * F.col("rn") <= F.col("last"), F.col("value"))).alias("a"), F.avg(F.when(2 * F.col("rn") > F.col("last"), F.col("value"))).alias("b"))
    ratio = F.col("b") / F.nullif("a", F.lit(0.0))
    return out.select("event_type", F.round("a", 4).alias("first_half"), F.round("b", 4).alias("second_half"), F.when(ratio > 1.2, "slowing").when(ratio < 0.8, "improving").otherwise("stable").alias("direction"))


@SERIES.query("ends", f"""
SELECT event_type, round(avg(CASE WHEN rn > last - 5 THEN value END) - avg(CASE WHEN rn <= 5 THEN value END), 4) AS change FROM (SELECT *, max(rn) OVER (PARTITION BY event_type) AS last FROM {_RN}) GROUP BY event_type""")
def ends(spark: SparkSession, folder: str) -> DataFrame:
    """The last five values against the first five."""
    rows = series(spark, folder)
    rows = rows.join(rows.groupBy("event_type").agg(F.max("rn").alias("last")), "event_type")
    return rows.groupBy("event_type").agg(F.round(F.avg(F.when(F.col("rn") > F.col("last") - 5, F.col("value"))) - F.avg(F.when(F.col("rn") <= 5, F.col("value"))), 4).alias("change"))


@SERIES.query("week_over_week", """
SELECT event_type, round(avg(CASE WHEN r <= 7 THEN v END), 4) AS last_week, round(avg(CASE WHEN r > 7 THEN v END), 4) AS week_before FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) AS r FROM (SELECT CAST(ts AS DATE) AS day, event_type, avg(value) AS v FROM events GROUP BY 1, 2)) WHERE r <= 14 GROUP BY event_type""")
def week_over_week(spark: SparkSession, folder: str) -> DataFrame:
    """Mean of the last seven days against the seven before."""
    daily = table(spark, folder, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.avg("value").alias("v"))
    rows = daily.withColumn("r", F.row_number().over(Window.partitionBy("event_type").orderBy(F.desc("day")))).where("r <= 14")
    mean = lambda c, name: F.round(F.avg(F.when(c, F.col("v"))), 4).alias(name)
    return rows.groupBy("event_type").agg(mean(F.col("r") <= 7, "last_week"), mean(F.col("r") > 7, "week_before"))


@SERIES.query("bottlenecks", "SELECT event_id, round(value / m, 4) AS factor FROM events, (SELECT avg(value) AS m FROM events) WHERE value > 3 * m")
def bottlenecks(spark: SparkSession, folder: str) -> DataFrame:
    """Values over three times the mean of all."""
    events = table(spark, folder, "events").select("event_id", "value")
    return events.join(events.agg(F.avg("value").alias("m")), F.lit(True)).where("value > 3 * m").select("event_id", F.round(F.col("value") / F.col("m"), 4).alias("factor"))


@SERIES.query("user_batches", """
SELECT user_id, count(*) AS n, round(avg(CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END) * 100, 4) AS success_percent, round(avg(CASE WHEN event_type <> 'error' THEN value END), 4) AS mean_value,
  concat_ws(',', CASE WHEN avg(CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END) * 100 < 80 THEN 'success' END, CASE WHEN stddev_pop(value) > 0.5 * avg(value) THEN 'spread' END) AS flags FROM events GROUP BY user_id""")
def user_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Success, mean and what is conspicuous, for every user's batch."""
    ok = F.when(F.col("event_type") == "error", 0.0).otherwise(1.0)
    return table(spark, folder, "events").groupBy("user_id").agg(
        F.count("*").alias("n"), F.round(F.avg(ok) * 100, 4).alias("success_percent"), F.round(F.avg(F.when(F.col("event_type") != "error", F.col("value"))), 4).alias("mean_value"),
        F.concat_ws(",", F.when(F.avg(ok) * 100 < 80, "success"), F.when(F.stddev_pop("value") > 0.5 * F.avg("value"), "spread")).alias("flags"),
    )


@SERIES.query("transitions", "SELECT event_id, before, event_type FROM (SELECT event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE before <> event_type")
def transitions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows at which a user's kind of event changes."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, folder, "events").select("event_id", "event_type", F.lag("event_type").over(w).alias("before")).where("before <> event_type")


@SERIES.query("jumps", f"SELECT event_id, round(abs(value - before), 4) AS jump FROM (SELECT event_id, value, lag(value) OVER ({_ORDER}) AS before FROM events) WHERE abs(value - before) > 100")
def jumps(spark: SparkSession, folder: str) -> DataFrame:
    """Values more than 100 away from the one before."""
    rows = W.lagged(series(spark, folder).select("event_type", "rn", "event_id", "value"), ["event_type"], "value", 1, "before")
    return rows.where("abs(value - before) > 100").select("event_id", F.round(F.abs(F.col("value") - F.col("before")), 4).alias("jump"))


@SERIES.query("low_runs", f"""
SELECT event_type, min(rn) AS first, max(rn) AS last, count(*) AS n FROM (SELECT event_type, rn, rn - row_number() OVER (PARTITION BY event_type ORDER BY rn) AS run FROM {_RN} WHERE value < 20) GROUP BY event_type, run HAVING count(*) >= 4""")
def low_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Four or more low values in a row."""
    return flag_runs(series(spark, folder).select("event_type", "rn", "value"), ["event_type"], "rn", F.col("value") < 20, 4)


@SERIES.query("hysteresis", f"""
SELECT event_id, coalesce(last_value(e IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), false) AS active FROM (SELECT *, CASE WHEN value > 60 THEN true WHEN value < 40 THEN false END AS e FROM events)""")
def hysteresis_state(spark: SparkSession, folder: str) -> DataFrame:
    """Activity of each user that begins over one bound and ends under a lower one."""
    rows = table(spark, folder, "events").withColumn("at", F.struct("ts", "event_id"))
    return hysteresis(rows, ["user_id"], "at", "value", 60, 40, "active").select("event_id", "active")


@SERIES.query("props_keys", "SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, count(*) AS n, round(avg(value), 4) AS mean FROM events GROUP BY 1")
def props_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Values by a field of the JSON properties."""
    return table(spark, folder, "events").groupBy(F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"))


@SERIES.query("hourly_windows", "SELECT event_type, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def hourly_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Tumbling windows of six hours."""
    rows = table(spark, folder, "events").groupBy("event_type", F.window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return rows.select("event_type", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n", "total")


@SERIES.query("user_degradations", """
SELECT user_id, n, round(slope, 6) AS slope, round(r, 6) AS r, first_value, last_value, CASE WHEN slope > -0.05 THEN 'medium' ELSE 'high' END AS severity FROM (
  SELECT user_id, count(*) AS n, regr_slope(value, k) AS slope, corr(k, value) AS r, arg_min(value, k) AS first_value, arg_max(value, k) AS last_value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rn) AS k FROM (SELECT user_id, value, rn, max(rn) OVER (PARTITION BY user_id) AS last FROM (
      SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)) WHERE last - rn < 6 AND value IS NOT NULL AND NOT isnan(value)) GROUP BY user_id)
WHERE n >= 5 AND slope < -0.01 AND abs(r) > 0.7""")
def user_degradations(spark: SparkSession, folder: str) -> DataFrame:
    """Users whose last six values fall."""
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    rows = W.latest(W.numbered(events, ["user_id"], ["ts", "event_id"], F.date_trunc("hour", "ts")), ["user_id"], 6)
    out = W.degradations(rows, ["user_id"], "rn", "value")
    return out.select("user_id", "n", F.round("slope", 6).alias("slope"), F.round("r", 6).alias("r"), "first_value", "last_value", "severity")


@SERIES.query("seasons")
def seasons(spark: SparkSession, folder: str) -> DataFrame:
    """Period and strength of the strongest season in the daily means of each kind of event."""
    days = table(spark, folder, "events").groupBy("event_type", F.datediff(F.to_date("ts"), F.lit("1970-01-01")).alias("day")).agg(F.avg("value").alias("value"))
    return W.seasons(days, ["event_type"], "value", "day").select("event_type", "n", "period", F.round("strength", 4).alias("strength"))


@SERIES.query("recent_statistics", f"""
SELECT event_type, count(value) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, round(median(value), 4) AS median, round(min(value), 4) AS min, round(max(value), 4) AS max, round(regr_slope(value, rn), 6) AS slope,
  CASE WHEN regr_slope(value, rn) FILTER (last - rn < 5) < -0.1 THEN 'falling' ELSE 'steady' END AS trend FROM (
  SELECT *, max(rn) OVER (PARTITION BY event_type) AS last FROM {_RN}) WHERE last - rn < 20 GROUP BY event_type""")
def recent_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """The last twenty values of each series, with their slope and the trend of the last five."""
    rows = W.latest(series(spark, folder), ["event_type"], 20)
    five = F.regr_slope(F.when(F.col("from_end") <= 5, F.col("value")), F.col("rn"))
    r = lambda c, n: F.round(c, 4).alias(n)
    return rows.groupBy("event_type").agg(
        F.count("value").alias("n"), r(F.avg("value"), "mean"), r(F.stddev_samp("value"), "std"), r(F.percentile("value", F.lit(0.5)), "median"), r(F.min("value"), "min"), r(F.max("value"), "max"),
        F.round(F.regr_slope("value", "rn"), 6).alias("slope"), F.when(five < -0.1, "falling").otherwise("steady").alias("trend"),
    )
