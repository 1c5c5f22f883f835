"""Continuous periods and gaps of time intervals, by compressed run bitmaps.

Time is cut into shards of ``2**SHARD_BITS`` exact units. Each interval sets bits in the
bitmap of its entity and shard; a bitmap is held as sorted runs of set bits, so its size
follows the number of changes and not the length of time. Uniting the pieces of a shard is one
vectorised pass over Arrow buffers, and so is uniting the shards of a block of ``2**BLOCK_BITS`` of them. What an
earlier block reaches into a later one follows from one row for each block. No stage holds more of one entity
than the runs of one block, or one row for each block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.session import cut_lineage

SHARD_BITS = 15
BLOCK_BITS = 10
LARGEST = float(1 << 52)


def unite_runs(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unite runs ``[start, end)`` row by row; touching runs become one.

    ``rows`` numbers the bitmap of each run. Gives rows, starts and ends of the set runs.
    """
    if not len(rows):
        return rows, starts, ends
    base = rows * (2 * width)
    order = np.argsort(base + starts, kind="stable")
    at, to = (base + starts)[order], np.maximum.accumulate((base + ends)[order])
    first = np.flatnonzero(np.r_[True, at[1:] > to[:-1]])
    last = np.r_[first[1:], len(at)] - 1
    row = at[first] // (2 * width)
    return row, at[first] - row * 2 * width, to[last] - row * 2 * width


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = 1 << SHARD_BITS
    for batch in batches:
        pieces = batch.column("pieces")
        counts = pieces.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pieces.flatten()
        starts = flat.field("s").to_numpy(zero_copy_only=False).astype(np.int64)
        ends = flat.field("e").to_numpy(zero_copy_only=False).astype(np.int64)
        row, s, e = unite_runs(np.repeat(np.arange(len(counts)), counts), starts, ends, width)
        offsets = pa.array(np.r_[0, np.cumsum(np.bincount(row, minlength=len(counts)))].astype(np.int32))
        kept = [name for name in batch.schema.names if name != "pieces"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in kept] + [pa.ListArray.from_arrays(offsets, pa.array(s)), pa.ListArray.from_arrays(offsets, pa.array(e))],
            [*kept, "starts", "ends"],
        )


def _blocks(n_keys: int, kinds: str):
    """Unite the runs of the shards of each block; rows come sorted by key and block, with a cover as one more run."""
    names = [*(f"k{i}" for i in range(n_keys)), "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            ends = _heads(held, names)
            if len(ends) > 1:  # the last block may go on in the next batch
                yield unite(held.slice(0, ends[-1]), ends[:-1])
                held = held.slice(ends[-1])
        if held is not None:
            yield unite(held, _heads(held, names))

    def unite(t: pa.Table, heads: np.ndarray) -> pa.RecordBatch:
        t = t.combine_chunks()
        group = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, t.num_rows]))
        lists = t.column("starts").combine_chunks()
        counts = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lambda c: t.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        at = np.repeat(t.column("shard").to_numpy() << SHARD_BITS, counts)
        cover = t.column("cover").combine_chunks()
        covered = np.flatnonzero(cover.is_valid().to_numpy(zero_copy_only=False))
        row = np.r_[np.repeat(group, counts), group[covered]]
        s = np.r_[flat("starts") + at, t.column("shard").to_numpy()[covered] << SHARD_BITS]
        e = np.r_[flat("ends") + at, cover.take(pa.array(covered)).to_numpy(zero_copy_only=False)]
        order = np.lexsort((s, row))
        row, s, e = row[order], s[order], e[order]
        # The largest end so far within the group: groups are lifted above each other before one running maximum.
        ranks = np.argsort(np.argsort(e, kind="stable"), kind="stable") + row * len(e)
        top = np.sort(e, kind="stable")[np.maximum.accumulate(ranks) - row * len(e)] if len(e) else e
        new = np.r_[True, (row[1:] != row[:-1]) | (s[1:] > top[:-1])] if len(e) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(e)] - 1
        offsets = pa.array(np.r_[0, np.cumsum(np.bincount(row[first], minlength=len(heads)))].astype(np.int32))
        keys = t.select(names).take(pa.array(heads)).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [*(keys.column(n).combine_chunks() for n in names), pa.ListArray.from_arrays(offsets, pa.array(s[first])), pa.ListArray.from_arrays(offsets, pa.array(top[last]))], [*names, "starts", "ends"]
        )

    return run, f"{kinds}, block bigint, starts array<bigint>, ends array<bigint>"


def _heads(t: pa.Table, names: Sequence[str]) -> np.ndarray:
    """Rows at which a new group of sorted rows begins."""
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for name in names:
        column = t.column(name).combine_chunks()
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False).astype(bool)
    return np.flatnonzero(new)


def _emit(n_keys: int):
    """Periods that end in a block, and gaps before the periods that begin in it, given what earlier blocks reach."""
    names = [f"k{i}" for i in range(n_keys)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("starts")
            counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            s, e = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("starts", "ends"))
            row = np.repeat(np.arange(batch.num_rows), counts)
            none = np.iinfo(np.int64).min
            held, since = (batch.column(c).fill_null(none).to_numpy(zero_copy_only=False) for c in ("held", "since"))
            last = batch.column("last").to_numpy(zero_copy_only=False).astype(bool)
            # What lies within or touches the reach of earlier blocks goes on with their period.
            reach = held.copy()
            inside = s <= held[row]
            np.maximum.at(reach, row[inside], e[inside])
            going = np.flatnonzero(held > none)
            row = np.r_[going, row[~inside]]
            s, e = np.r_[since[going], s[~inside]], np.r_[reach[going], e[~inside]]
            order = np.lexsort((s, row))
            row, s, e = row[order], s[order], e[order]
            follows = np.r_[row[1:] == row[:-1], False] if len(row) else np.zeros(0, bool)
            done = follows | last[row]
            at = np.flatnonzero(follows)
            rows = np.r_[row[done], row[at]]
            kind = pa.array(["period"] * int(done.sum()) + ["gap"] * len(at))
            chosen = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n).take(chosen) for n in names), kind, pa.array(np.r_[s[done], e[at]]), pa.array(np.r_[e[done], s[at + 1]])], [*names, "kind", "start_unit", "end_unit"]
            )

    return run


def periods_and_gaps(df: DataFrame, keys: Sequence[str], start: str, end: str, units_per_one: float = 1000.0) -> DataFrame:
    """Continuous periods and the gaps between them, for each entity.

    Bounds are rounded to whole units (``units_per_one`` units make 1 of the input, so seconds
    become milliseconds). Intervals are half open: those that overlap or touch belong to one
    period, and one clear unit is a gap. Gives ``keys``, ``kind`` ('period' or 'gap'), ``start_unit``
    and ``end_unit``.

    Rows with a null key, a null, NaN or infinite bound (or one beyond 2**52 units), or a start
    that is not before the end after rounding, don't count. Repeated rows change nothing, other
    columns are ignored whatever their names, and an empty table gives an empty result.
    """
    width = 1 << SHARD_BITS
    ks = [f"k{i}" for i in range(len(keys))]
    unit = lambda c: F.round(F.col(c).cast("double") * units_per_one)
    sane = lambda c: ~F.isnan(c) & (F.abs(F.col(c)) < LARGEST)
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, ks, strict=True)], unit(start).alias("s"), unit(end).alias("e"))
    rows = rows.where(sane("s") & sane("e") & (F.col("s") < F.col("e"))).dropna(subset=[*ks, "s", "e"])
    rows = rows.select(*ks, F.col("s").cast("bigint").alias("s"), F.col("e").cast("bigint").alias("e"))
    rows = rows.withColumns({"a": F.shiftright("s", SHARD_BITS), "b": F.shiftright(F.col("e") - 1, SHARD_BITS)})

    piece = lambda shard, s, e, cover: F.struct(shard.alias("shard"), s.cast("int").alias("s"), e.cast("int").alias("e"), cover.cast("bigint").alias("cover"))
    a, b, s, e, none = F.col("a"), F.col("b"), F.col("s"), F.col("e"), F.lit(None)
    pieces = F.array_compact(
        F.array(
            piece(a, s - a * width, F.least(e - a * width, F.lit(width)), none),
            F.when(b > a, piece(b, F.lit(0), e - b * width, none)),
            # Shards that are covered whole are one entry, however many they are.
            F.when(b > a + 1, piece(a + 1, none, none, b * width)),
        )
    )
    cut = rows.select(*ks, F.explode(pieces).alias("p")).select(*ks, "p.*")
    best = cut.groupBy(*ks, "shard", "s").agg(F.max("e").alias("e"), F.max("cover").alias("cover"))
    shards = best.groupBy(*ks, "shard").agg(
        F.collect_list(F.when(F.col("s").isNotNull(), F.struct("s", "e"))).alias("pieces"), F.max("cover").alias("cover")
    )
    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(ks, (rows.schema[k] for k in ks), strict=True))
    maps = shards.mapInArrow(_bitmaps, f"{kinds}, shard bigint, cover bigint, starts array<bigint>, ends array<bigint>")
    maps = maps.withColumn("block", F.shiftright("shard", BLOCK_BITS)).repartition(*ks, "block").sortWithinPartitions(*ks, "block")
    unite, form = _blocks(len(ks), kinds)
    blocks = cut_lineage(maps.select(*ks, "block", "shard", "cover", "starts", "ends").mapInArrow(unite, form), "runs")

    # From one row a block: how far earlier blocks reach, and where the period began that reaches so far.
    ends = blocks.select(*ks, "block", F.element_at("starts", 1).alias("first"), F.element_at("starts", -1).alias("latest"), F.element_at("ends", -1).alias("reach"))
    w = Window.partitionBy(*ks).orderBy("block")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumns({"held": F.max("reach").over(earlier), "last": F.lead("block").over(w).isNull()})
    began = F.when(F.col("held").isNull() | (F.col("latest") > F.col("held")), F.col("latest"))
    ends = ends.withColumn("since", F.last(began, ignorenulls=True).over(earlier)).select(*ks, "block", "held", "since", "last")
    out = blocks.join(ends, [*ks, "block"]).select(*ks, "starts", "ends", "held", "since", "last")
    out = out.mapInArrow(_emit(len(ks)), f"{kinds}, kind string, start_unit bigint, end_unit bigint")
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, ks, strict=True)], "kind", "start_unit", "end_unit")
