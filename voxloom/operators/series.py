"""Row-frame windows over series of any length.

A window over a whole series would sort it in one task. Here the rows of a series are numbered in
two levels (within time buckets, and over one row for each bucket), cut into blocks of row
numbers, and each block gets the few rows before and after it that its frames reach into.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 16


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, output: str = "rn") -> DataFrame:
    """Add ``output``: the row's number, from 1, in its series by ``order``.

    ``bucket`` must not fall as ``order`` rises (a day of the first order column, say). Ties are in
    no defined order, so ``order`` should end with a unique column. Null keys form a series of their
    own, and rows with a null bucket come first.
    """
    rows = df.withColumn("__bucket", bucket)
    counts = rows.groupBy(*keys, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__bucket").alias("__b"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inner = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    rows = rows.withColumn("__own", F.row_number().over(inner))
    same = F.col("__bucket").eqNullSafe(F.col("__b"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return rows.join(counts, same).withColumn(output, F.col("__own") + F.col("__before")).drop("__own", "__before", "__bucket", "__b", *[f"__k{i}" for i in range(len(keys))])


def framed(df: DataFrame, keys: Sequence[str], before: int, after: int, number: str = "rn", block: int = BLOCK) -> DataFrame:
    """Rows with ``__block`` and ``__home``; copies of rows near a block's edge have ``__home`` false.

    Frames of up to ``before`` and ``after`` rows are then whole within (``keys``, ``__block``) for all
    home rows.
    """
    at = F.col(number) - 1
    here = F.floor(at / block).cast("bigint")
    reach = F.sequence(F.floor((at - after) / block).cast("bigint"), F.floor((at + before) / block).cast("bigint"))
    return df.withColumn("__block", F.explode(reach)).withColumn("__home", F.col("__block") == here)


def frame(keys: Sequence[str], before: int, after: int, number: str = "rn") -> object:
    """The window of a row with so many rows before and after it, for :func:`framed` rows."""
    return Window.partitionBy(*keys, "__block").orderBy(number).rowsBetween(-before, after)


def home(df: DataFrame) -> DataFrame:
    return df.where("__home").drop("__home", "__block")


def moving_average(df: DataFrame, keys: Sequence[str], value: str, width: int, output: str) -> DataFrame:
    """Mean of the row and the ``width`` - 1 before it, of as many as there are; nulls don't count."""
    rows = framed(df, keys, width - 1, 0)
    return home(rows.withColumn(output, F.avg(value).over(frame(keys, width - 1, 0))))


def centred_zscore(df: DataFrame, keys: Sequence[str], value: str, width: int, output: str) -> DataFrame:
    """Distance from the mean of a centred frame in sample deviations; null unless the frame is full.

    A frame of even width has one row more before than after. A frame without deviation gives null.
    """
    after = (width - 1) // 2
    rows = framed(df, keys, width - 1 - after, after)
    w = frame(keys, width - 1 - after, after)
    spread = F.stddev_samp(value).over(w)
    z = (F.col(value) - F.avg(value).over(w)) / F.when(spread > 0, spread)
    return home(rows.withColumn(output, F.when(F.count(value).over(w) == width, z)))


def severity(z: Column, low: float, high: float = 3.0, highest: float = 4.0) -> Column:
    """``high`` over 4, ``medium`` over 3, ``low`` over the given bound, else null."""
    a = F.abs(z)
    return F.when(a > highest, "high").when(a > high, "medium").when(a > low, "low")


def slopes(df: DataFrame, keys: Sequence[str], value: str, width: int) -> DataFrame:
    """Add ``slope_before`` of the ``width`` rows before the row, ``slope_after`` of those from it on; incomplete frames give null."""
    rows = framed(df, keys, width, width - 1)
    x = F.col("rn").cast("double")
    past, ahead = Window.partitionBy(*keys, "__block").orderBy("rn").rowsBetween(-width, -1), Window.partitionBy(*keys, "__block").orderBy("rn").rowsBetween(0, width - 1)
    rows = rows.withColumn("slope_before", F.when(F.count(value).over(past) == width, F.regr_slope(F.col(value), x).over(past)))
    return home(rows.withColumn("slope_after", F.when(F.count(value).over(ahead) == width, F.regr_slope(F.col(value), x).over(ahead))))


def change_points(df: DataFrame, keys: Sequence[str], value: str, width: int, output: str) -> DataFrame:
    """Add the slopes before and after each row and ``output``: how far they are apart, if they differ in sign.

    By the units of the value; :func:`turning_points` scales by the range and keeps rows apart.
    """
    rows = slopes(df, keys, value, width)
    return rows.withColumn(output, F.when(F.col("slope_before") * F.col("slope_after") < 0, F.abs(F.col("slope_after") - F.col("slope_before"))))


def turning_points(df: DataFrame, keys: Sequence[str], value: str, width: int = 10, least: float = 0.5, apart: int = 10) -> DataFrame:
    """Rows at which a trend turns: ``slope_before``, ``slope_after`` and ``confidence``, the change scaled by the series' range.

    The scaled change, ``width`` times the difference of the slopes over the range, is over ``least`` and the slopes differ
    in direction. Of rows within ``apart`` of each other the surest stays, the first of several. Series need over 2 ``width``
    rows. The candidates of one series (their numbers and confidences) are thinned out in one task.
    """
    ends = df.groupBy(*keys).agg((F.max(value) - F.min(value)).alias("__range"), F.max("rn").alias("__last"))
    ends = ends.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__range", "__last")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    rows = slopes(df, keys, value, width).join(ends, same).drop(*[f"__k{i}" for i in range(len(keys))])
    change = F.abs(F.col("slope_after") - F.col("slope_before")) * width / F.nullif("__range", F.lit(0.0))
    rows = rows.withColumn("__change", change).where((F.col("rn") <= F.col("__last") - width) & (F.col("__change") > least) & ((F.col("slope_before") > 0) != (F.col("slope_after") > 0)))
    rows = rows.withColumn("confidence", F.least(F.lit(0.99), "__change")).drop("__change", "__range", "__last")

    def thin(t: pa.Table) -> pa.Table:
        rn, sure = t.column("rn").to_numpy(), t.column("confidence").to_numpy()
        low, taken, keep = int(rn.min()), np.zeros(int(rn.max() - rn.min()) + 1, bool), []
        for i in np.lexsort((rn, -sure)):
            at = int(rn[i]) - low
            if not taken[at]:
                keep.append(i)
                taken[max(0, at - apart) : at + apart + 1] = True
        return t.take(pa.array(sorted(keep), pa.int64()))

    return rows.groupBy(*keys).applyInArrow(thin, rows.schema)


def degradations(df: DataFrame, keys: Sequence[str], order: str, value: str, least: int = 5) -> DataFrame:
    """Series that fall: slope under -0.01 a value and a correlation with the order of over 0.7.

    Values are numbered by ``order`` without those that are missing; ``least`` of them are needed. ``severity`` is
    ``medium`` for a slope over -0.05, else ``high``. For series cut to their recent values (see :func:`latest`).
    """
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    x = F.row_number().over(Window.partitionBy(*keys).orderBy(order)).cast("double")
    fit = rows.withColumn("__x", x).groupBy(*keys).agg(
        F.count("*").alias("n"), F.regr_slope(F.col(value), F.col("__x")).alias("slope"), F.corr("__x", value).alias("r"),
        F.min_by(value, "__x").alias("first_value"), F.max_by(value, "__x").alias("last_value"),
    )
    fit = fit.where((F.col("n") >= least) & (F.col("slope") < -0.01) & (F.abs("r") > 0.7))
    return fit.withColumn("severity", F.when(F.col("slope") > -0.05, "medium").otherwise("high"))


def seasonal_period(x: np.ndarray) -> tuple[int, float] | None:
    """Period of the strongest frequency and the correlation of the series with itself a period later.

    None if the series has under 14 values, the period is not under half of them, or the correlation is not over 0.5.
    """
    n = len(x)
    if n < 14:
        return None
    power = np.abs(np.fft.rfft(x)[1 : n // 2]) ** 2
    period = int(n / (int(power.argmax()) + 1))
    if not 0 < period < n // 2:
        return None
    a, b = x[period:] - x[period:].mean(), x[:-period] - x[:-period].mean()
    size = float(np.sqrt((a @ a) * (b @ b)))
    r = float(a @ b) / size if size > 0 else 0.0
    return (period, min(1.0, r)) if r > 0.5 else None


def seasons(df: DataFrame, keys: Sequence[str], value: str, order: str = "rn") -> DataFrame:
    """``period``, ``strength`` and ``component`` (the centred means of the period's places) of each series, null without a season.

    Missing values don't count. The transform is of the whole series, so one task holds its values (16 bytes each).
    """
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*keys, F.col(order).cast("bigint").alias("__o"), F.col(value).cast("double").alias("__v"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def one(t: pa.Table) -> pa.Table:
        x = t.column("__v").to_numpy()[np.argsort(t.column("__o").to_numpy(), kind="stable")]
        found = seasonal_period(x)
        out = {k: t.column(k).slice(0, 1) for k in keys} | {"n": pa.array([len(x)])}
        part = None
        if found:
            at = np.arange(len(x)) % found[0]
            means = np.bincount(at, x) / np.bincount(at)
            part = (means - means[at].mean()).tolist()
        return pa.table(out | {"period": pa.array([found and found[0]], pa.int32()), "strength": pa.array([found and found[1]], pa.float64()), "component": pa.array([part], pa.list_(pa.float64()))})

    return rows.groupBy(*keys).applyInArrow(one, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "n bigint, period int, strength double, component array<double>"]))


def lagged(df: DataFrame, keys: Sequence[str], value: str, lag: int, output: str) -> DataFrame:
    """Add the value ``lag`` rows earlier by a join of row numbers, whatever the lag."""
    earlier = df.select(*keys, (F.col("rn") + lag).alias("rn"), F.col(value).alias(output))
    return df.join(earlier, [*keys, "rn"], "left")


def latest(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` numbered rows of every series, with ``from_end`` 1 for the last."""
    size = df.groupBy(*keys).agg(F.max("rn").alias("__last"))
    return df.join(size, [*keys]).withColumn("from_end", F.col("__last") - F.col("rn") + 1).where(F.col("from_end") <= n).drop("__last")
