"""Items packed into containers of a fixed capacity, by bulk-synchronous best fit.

Items and the gaps of open containers are held in classes of equal size: an item class is a range of ranks, a gap class one
of container numbers, so items that want the same gap get the gaps that follow each other by their rank, and neither a
size nor a gap that many share is ever one task's rows.

Sizes are placed in a few bands, the largest first. In a band item and gap classes are sorted by value into ranges, one a task, and each
range is swept from its largest item down: an item takes the nearest gap that fits (its successor), and what is left of
the gap is a gap again. Then the gaps are updated and the sweep is repeated over ranges twice as wide for the items that found
none, until one range holds all of these; what finds no gap there opens containers. With one range this is best fit decreasing.

The rounds work on classes, of which there are a few for each size; the items are moved once, to find their ranks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.tokens import TOKENIZERS, VOCABULARY, tokens_of
from voxloom.session import cut_lineage, drop_table

BANDS = 4  # of sizes, placed one after the other
RANGE = 512  # classes in one range of a sweep
PART = 50_000  # items of one size that are ranked together
_ITEM, _GAP, _PLACED, _OPENED = range(4)
# Items: size, rank, number. Gaps: gap, first container, number. Placed: size, rank, number, first container, items in each.
_CLASSES = "kind int, value bigint, start bigint, n bigint, first bigint, each bigint"
_Classes = list[tuple[int, int, int]]


class _Gaps:
    """Containers by gap, as ranges of container numbers, with the next larger gap that is not empty."""

    def __init__(self, capacity: int) -> None:
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.some = np.zeros(capacity + 2, bool)
        self.some[capacity + 1] = True

    def successor(self, size: int) -> int:
        return size + int(self.some[size:].argmax())

    def put(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            self.ranges[gap].append((first, n))
            self.some[gap] = True

    def take(self, gap: int, most: int) -> tuple[int, int]:
        first, n = self.ranges[gap].pop()
        used = min(n, most)
        if used < n:
            self.ranges[gap].append((first + used, n - used))
        self.some[gap] = bool(self.ranges[gap])
        return first, used


def sweep(items: _Classes, gaps: _Classes, capacity: int, opened: int | None) -> tuple[list[tuple[int, int, int, int, int]], _Classes, _Classes, int]:
    """Best fit, from the largest item down: placed rows, items without a gap, gaps left, and containers opened so far.

    Items that find no gap open containers, numbered from ``opened`` on, unless that is None.
    """
    free, placed, none, count = _Gaps(capacity), [], [], opened or 0
    for gap, first, n in sorted(gaps):
        free.put(gap, first, n)
    for size, rank, left in sorted(items, reverse=True):
        while left:
            gap = free.successor(size)
            if gap > capacity:
                if opened is None:
                    none.append((size, rank, left))
                    break
                gap, each = capacity, capacity // size
                first, used = count, -(-left // each)
                count += used
            else:
                each = gap // size
                first, used = free.take(gap, -(-left // each))
            whole, rest = divmod(min(left, used * each), each)
            for n, start, to, k in ((whole, rank, first, each), (int(rest > 0), rank + whole * each, first + whole, rest)):
                if n:
                    placed.append((size, start, n * k, to, k))
                    free.put(gap - k * size, to, n)
            rank, left = rank + whole * each + rest, left - whole * each - rest
    return placed, none, [(gap, first, n) for gap, ranges in enumerate(free.ranges) for first, n in ranges], count


def _swept(classes: DataFrame, ranges: int, capacity: int, opened: int | None) -> DataFrame:
    """One round: every range of values swept by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        placed, none, gaps, count = sweep([r[1:4] for r in rows if r[0] == _ITEM], [(r[1], r[4], r[3]) for r in rows if r[0] == _GAP], capacity, opened)
        out = [(_PLACED, *r) for r in placed] + [(_ITEM, *r, None, None) for r in none] + [(_GAP, gap, None, n, first, None) for gap, first, n in gaps]
        if opened is not None:
            out.append((_OPENED, count, None, None, None, None))
        kinds = [pa.int32(), *[pa.int64()] * 5]
        columns = zip(*out, strict=True) if out else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["kind", "value", "start", "n", "first", "each"])

    return (classes.coalesce(1) if ranges == 1 else classes.repartitionByRange(ranges, "value")).mapInArrow(run, _CLASSES)


def packing_plan(counts: DataFrame, capacity: int) -> DataFrame:
    """Rows (``size``, ``rank``, ``number``, ``first``, ``each``) that place all items of ``counts`` (``size``, ``n``).

    In a row ``number`` items of a size, from ``rank`` on, go into containers that follow each other from ``first`` on, ``each`` into
    each. Every round is a job over tables of classes; only their number and the number of containers come to the driver.
    """
    spark = counts.sparkSession
    items = counts.select(F.lit(_ITEM).alias("kind"), F.col("size").alias("value"), F.lit(0).cast("bigint").alias("start"), "n", *[F.lit(None).cast("bigint").alias(c) for c in ("first", "each")])
    gaps, opened, placed, held = spark.createDataFrame([], _CLASSES), 0, [], None
    edges = [capacity * k // BANDS for k in range(BANDS, -1, -1)]
    for high, low in zip(edges, edges[1:], strict=False):
        band = items.where((F.col("value") > low) & (F.col("value") <= high))
        idle = gaps.where(F.col("value") <= low)  # of no use in this band
        classes = band.unionByName(gaps.where(F.col("value") > low))
        ranges = -(-classes.count() // RANGE) or 1
        while True:
            last = ranges == 1
            after = cut_lineage(_swept(classes, ranges, capacity, opened if last else None), "packing-round")
            placed.append(after.where(F.col("kind") == _PLACED))
            classes = after.where(F.col("kind").isin(_ITEM, _GAP))
            if last:
                break
            ranges = -(-ranges // 2)
        opened = after.where(F.col("kind") == _OPENED).first()["value"]
        gaps = cut_lineage(idle.unionByName(after.where(F.col("kind") == _GAP)), "packing-gaps")
        if held is not None:
            drop_table(held)
        held = gaps
    rows = reduce(DataFrame.unionByName, placed)
    plan = cut_lineage(rows.select(F.col("value").alias("size"), F.col("start").alias("rank"), F.col("n").alias("number"), "first", "each"), "packing-plan")
    for table in [*placed, held]:
        drop_table(table)
    return plan


def token_sizes(df: DataFrame, key: str, text: str, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``key`` and ``tokens`` of each row with a key and a text."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = tokens_of(folder, vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.cumsum([len(t) for t in texts])
            edges = np.unique(np.r_[0, np.searchsorted(sizes, np.arange(1_000_000, sizes[-1] if len(sizes) else 0, 1_000_000)), len(texts)])
            counts = [counter.count(texts[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())], ["key", "tokens"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null and text is not null")
    return rows.mapInArrow(run, f"key {kind}, tokens bigint").withColumnRenamed("key", key)


def packed(sizes: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """The container of each item: ``key``, ``piece``, ``n_pieces``, ``size``, ``container``, ``fill``.

    An item of size up to ``capacity`` is whole (``n_pieces`` is 1). A larger one is cut into pieces
    of the capacity and a rest, numbered from 0. ``fill`` is the share of the container that is used,
    1.0 at most. Items of size 0 need no room: their container and fill are null. Rows with a null key or size, or
    a negative size, don't count; a key that is repeated is packed as often. An empty table gives an
    empty result.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    items = sizes.select(F.col(key).alias("key"), F.col(size).cast("bigint").alias("whole")).where("key is not null and whole >= 0")
    number = F.greatest(F.lit(1), F.ceil(F.col("whole") / capacity)).cast("int")
    items = items.withColumn("n_pieces", number).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)))
    items = items.select("key", "piece", "n_pieces", F.when(F.col("piece") < F.col("n_pieces") - 1, F.lit(capacity)).otherwise(F.col("whole") - F.col("piece") * capacity).cast("bigint").alias("size"))
    items = cut_lineage(items, "packing-items")
    sized = items.where("size > 0")
    counts = cut_lineage(sized.groupBy("size").agg(F.count("*").alias("n")), "packing-sizes")  # `capacity` rows at most
    plan = packing_plan(counts, capacity)
    put = cut_lineage(_placed(sized, counts, plan), "packing-placed")
    drop_table(plan)
    drop_table(counts)
    fill = put.groupBy("container").agg(F.round(F.sum("size") / capacity, 6).alias("fill"))
    put = put.join(fill, "container").select("key", "piece", "n_pieces", "size", "container", "fill")
    none = items.where("size = 0").select("key", "piece", "n_pieces", "size", F.lit(None).cast("bigint").alias("container"), F.lit(None).cast("double").alias("fill"))
    return put.unionByName(none).withColumnRenamed("key", key)


def _placed(items: DataFrame, counts: DataFrame, plan: DataFrame) -> DataFrame:
    """Items with their ``container``: ranked within parts of their size, beside the rows of the plan for these ranks."""
    parts = F.broadcast(counts.select("size", F.ceil(F.col("n") / PART).alias("parts")))  # `capacity` rows at most
    items = items.join(parts, "size").withColumn("part", F.pmod(F.xxhash64("key", "piece"), F.col("parts"))).drop("parts")
    by = items.groupBy("size", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by = by.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))
    mine = plan.join(by, "size").where("rank < earlier + n and rank + number > earlier")
    kind = items.schema["key"].dataType.simpleString()
    types = {"key": kind, "piece": "int", "n_pieces": "int", "begin": "bigint", "first": "bigint", "each": "bigint"}
    none = lambda *names: [F.lit(None).cast(types[n]).alias(n) for n in names]
    mine = mine.select("size", "part", F.lit(False).alias("item"), (F.col("rank") - F.col("earlier")).alias("begin"), "first", "each", *none("key", "piece", "n_pieces"))
    rows = items.select("size", "part", F.lit(True).alias("item"), *none("begin", "first", "each"), "key", "piece", "n_pieces").unionByName(mine)
    order = ["size", "part", "item", "begin", "key", "piece"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rank, plan_rows = None, 0, np.zeros((3, 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            size, part, item = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            own = np.stack([batch.column(k).fill_null(0).to_numpy(zero_copy_only=False) for k in (3, 4, 5)])
            heads = np.flatnonzero(np.r_[True, (size[1:] != size[:-1]) | (part[1:] != part[:-1])])
            container = np.full(batch.num_rows, -1, np.int64)
            for a, b in zip(heads, np.r_[heads[1:], batch.num_rows], strict=True):
                if (size[a], part[a]) != group:
                    group, rank, plan_rows = (size[a], part[a]), 0, np.zeros((3, 0), np.int64)
                middle = a + int(np.searchsorted(item[a:b], True))
                if middle > a:
                    plan_rows = np.concatenate([plan_rows, own[:, a:middle]], axis=1)
                ranks = rank + np.arange(b - middle)
                begin, first, each = plan_rows[:, np.searchsorted(plan_rows[0], ranks, side="right") - 1]
                container[middle:b] = first + (ranks - begin) // each
                rank += b - middle
            chosen = pa.array(np.flatnonzero(item))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(chosen) for k in (6, 7, 8, 0)), pa.array(container).take(chosen)], ["key", "piece", "n_pieces", "size", "container"]
            )

    columns = ["size", "part", "item", "begin", "first", "each", "key", "piece", "n_pieces"]
    return rows.repartition("size", "part").sortWithinPartitions(*order).select(*columns).mapInArrow(place, f"key {kind}, piece int, n_pieces int, size bigint, container bigint")
