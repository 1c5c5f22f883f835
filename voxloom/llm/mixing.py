"""Sources mixed to target weights by Pfair scheduling.

Each source is a stream of blocks of a fixed size, and every slot of the mix serves one block. With weight w of all, a source's k-th
block (k = 1, 2, ...) may start from slot floor((k - 1) / w) and must end by slot ceil(k / w). In every slot the
earliest deadline among the blocks that may start is served, which keeps every source within less than one block
of its share at any slot.

Weights are whole numbers of blocks in a period, after which the schedule repeats itself, so one period is scheduled
and the slot of any block follows from its number: the records find their places without meeting.
A record is in the block in which it begins; records are not divided, so in seconds a source may be one record further off.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.series import numbered
from voxloom.session import cut_lineage

PERIOD = 1 << 20  # most blocks of a period; weights that need more are rounded to parts of it
PART = 1 << 16  # records of a source whose sizes are summed up together
SLOTS = 1024  # slots whose records are numbered together


def whole_weights(weights: Mapping[str, float]) -> dict[str, int]:
    """Blocks of each source in a period: in the exact proportion of the decimal weights if ``PERIOD`` holds it.

    Other weights are rounded to parts of ``PERIOD`` by the largest remainder, one part at least, so a share is off by
    at most one millionth for every source.
    """
    exact = {s: Fraction(str(w)) for s, w in sorted(weights.items())}
    if not exact:
        return {}
    unit = math.lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * unit) for s, w in exact.items()}
    common = math.gcd(*whole.values())
    whole = {s: n // common for s, n in whole.items()}
    if sum(whole.values()) <= PERIOD:
        return whole
    total = sum(exact.values())
    parts = {s: w * PERIOD / total for s, w in exact.items()}
    out = {s: max(1, int(p)) for s, p in parts.items()}
    for s in sorted(parts, key=lambda s: (int(parts[s]) - parts[s], s))[: max(0, PERIOD - sum(out.values()))]:
        out[s] += 1
    return out


def period_schedule(whole: Mapping[str, int]) -> dict[str, np.ndarray]:
    """For each source the slots, from 0, of its blocks in a period: earliest deadline first of what may start."""
    period = sum(whole.values())
    slots: dict[str, list[int]] = {s: [] for s in whole}
    waiting = [(0, s, 1) for s in sorted(whole)]
    ready: list[tuple[int, str]] = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-k * period // whole[s]), s))
            if k < whole[s]:
                heapq.heappush(waiting, (k * period // whole[s], s, k + 1))
        slots[heapq.heappop(ready)[1]].append(slot)
    return {s: np.array(x, np.int64) for s, x in slots.items()}


def running_total(df: DataFrame, group: Sequence[str], order: str, size: str, output: str, most: int) -> DataFrame:
    """Add ``output``: the sum of ``size`` over the rows of the group up to each row.

    ``order`` is a uniform hash (bigint), and no group has more than ``most`` rows. The hash's top bits cut a group into parts of about
    ``PART`` rows; sums run within parts and over one row for each part, so no group is ever sorted by one task.
    """
    bits = max(6, (most // PART).bit_length())
    rows = df.withColumn("__part", F.shiftright(F.col(order), 64 - bits))
    parts = rows.groupBy(*group, "__part").agg(F.sum(size).alias("__sum"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*group, "__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inner = Window.partitionBy(*group, "__part").orderBy(order, "key", "copy").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("__own", F.sum(size).over(inner)).join(parts, [*group, "__part"]).withColumn(output, F.col("__own") + F.col("__before")).drop("__part", "__own", "__before")


def mixed(df: DataFrame, key: str, source: Column, size: Column, targets: DataFrame, name: str, share: str, repeats: str, block: float) -> DataFrame:
    """The mix: ``source``, ``key``, ``copy`` (1 for the first use), ``size``, ``block``, ``slot``, ``release``, ``deadline``, ``position``.

    Every source of ``targets`` contributes its share of the total size, which is as large as the
    scarcest source allows when each record is used at most ``repeats`` times; a whole round of a
    source is used before any record of it again. Sizes are in whole units (the caller scales
    them), a block is ``block`` units. Blocks and slots are numbered from 1; ``release`` is the slot before which the block may
    not be served and ``deadline`` the last that may serve it. ``position`` is the record's number in the mix, from 1, by
    slot and its place in the block.

    Records with a null key, of no target source, or with a null or non-positive size don't
    take part; of repeated keys of a source the one of largest size counts once. Sources with no usable
    record or no share get nothing, and the shares of the others are kept in proportion. An empty
    table gives an empty mix.
    """
    spark = df.sparkSession
    goals = targets.select(F.col(name).alias("source"), F.col(share).cast("double").alias("weight"), F.col(repeats).cast("int").alias("most"))
    goals = goals.where("source is not null and weight > 0 and most > 0").groupBy("source").agg(F.sum("weight").alias("weight"), F.max("most").alias("most"))
    rows = df.select(source.alias("source"), F.col(key).cast("string").alias("key"), size.cast("bigint").alias("size")).where("size > 0 and key is not null")
    rows = rows.groupBy("source", "key").agg(F.max("size").alias("size"))
    rows = cut_lineage(rows.join(goals, "source"), "mix-rows")
    held = rows.groupBy("source", "weight", "most").agg(F.sum("size").alias("held"), F.count("*").alias("n")).collect()  # one row for each target
    whole = whole_weights({r.source: r.weight for r in held})
    period = sum(whole.values())
    total = min((r.held * r.most * period / whole[r.source] for r in held), default=0.0)
    need = [(r.source, whole[r.source], g := total * whole[r.source] / period, r.held, -int(-g // r.held)) for r in held]
    sources = F.broadcast(spark.createDataFrame(need, "source string, turns bigint, goal double, held bigint, rounds int"))  # a row for each target
    slots = period_schedule(whole)
    pattern = pa.table({
        "source": pa.array([s for s, x in slots.items() for _ in x], pa.string()),
        "turn": pa.array(np.concatenate([np.arange(len(x)) for x in slots.values()]) if slots else np.zeros(0, np.int64)),
        "place": pa.array(np.concatenate(list(slots.values())) if slots else np.zeros(0, np.int64)),
    })
    pattern = F.broadcast(spark.createDataFrame(pattern, "source string, turn bigint, place bigint"))  # PERIOD rows at most

    rows = rows.join(sources, "source").select("source", "key", "size", "turns", "goal", "held", "rounds", F.lit(0).alias("copy"), F.xxhash64("source", "key").alias("order"))
    rows = running_total(rows, ["source"], "order", "size", "through", max((r.n for r in held), default=0))
    used = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rounds"))))
    used = used.withColumn("through", F.col("through") + (F.col("copy") - 1) * F.col("held"))
    # A record is taken if most of it lies within the source's goal.
    used = used.where(F.col("through") - F.col("size") / 2 <= F.col("goal"))
    used = used.withColumn("done", F.floor((F.col("through") - F.col("size")) / block).cast("bigint"))
    used = used.withColumn("turn", F.col("done") % F.col("turns")).join(pattern, ["source", "turn"])
    used = used.withColumn("slot", F.expr(f"done div turns * {period} + place + 1"))
    used = numbered(used, [], ["slot", "through"], F.floor(F.col("slot") / SLOTS), "position")
    return used.select(
        "source", "key", "copy", "size", (F.col("done") + 1).alias("block"), "slot", F.expr(f"done * {period} div turns + 1").alias("release"),
        F.expr(f"((done + 1) * {period} + turns - 1) div turns").alias("deadline"), "position",
    )


def shares_reached(mix: DataFrame) -> DataFrame:
    """For each source: records and repeats used, size, and its actual share of the whole."""
    each = mix.groupBy("source").agg(F.count("*").alias("n_used"), F.max("copy").alias("most_used"), F.sum("size").alias("size"))
    return each.withColumn("actual_share", F.round(F.col("size") / F.sum("size").over(Window.partitionBy(F.lit(1))), 6))
