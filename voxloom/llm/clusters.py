"""Similarity clusters by reciprocal-nearest-neighbour average linkage.

A cluster is held as the sum of its members' unit vectors and their number, so the average cosine
between two clusters is the dot product of their means, whatever their sizes. Each pass lays the
clusters out in blocks by a hash of their direction, a sparse graph of which every block is a part; in a
block all mutual best pairs at or over the threshold are merged at once, round after round, until
there is none. Later passes hash with other directions over ever fewer clusters. The first passes merge
only closer pairs, so that near pairs come before far ones across blocks too.

The hash is the place of the largest of many random projections, level after level. How likely two clusters of the
least similarity share a block among so many blocks is measured by simulation, and passes go on until a pair had the
wanted chance to meet: their number follows from the number of clusters and the wanted recall, and has no other limit.

A block holds about ``BLOCK`` clusters whatever the number of rows or of copies; a group that fills
many blocks shrinks in each of them and meets itself in the next passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.session import cut_lineage, drop_table

SIMILARITY = 0.7  # fixed value: the project's threshold for one voice
RECALL = 0.99  # chance that a pair of clusters at the threshold has met when the passes end
BLOCK = 4096
EARLY = (0.9, 0.8)  # thresholds of the first passes
DIRECTIONS, LEVELS = 128, 3  # of the hash: projections of which the largest counts, and how often
_STATE = "cid bigint, n bigint, vector array<float>"


@cache
def _hashed_pairs(cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Hash places, in 0..1, of 20,000 simulated pairs of the given cosine."""
    g = np.random.default_rng(7)
    out, width = np.zeros((2, 20_000)), 1.0
    for _ in range(LEVELS):
        x = g.standard_normal((20_000, DIRECTIONS), dtype=np.float32)
        y = cosine * x + np.sqrt(1 - cosine**2) * g.standard_normal((20_000, DIRECTIONS), dtype=np.float32)
        width /= DIRECTIONS
        out += np.stack([x.argmax(1), y.argmax(1)]) * width
    return out[0], out[1]


def meeting_chance(blocks: int, cosine: float) -> float:
    """Chance that a pair of the given cosine shares one of ``blocks`` blocks in a pass."""
    x, y = _hashed_pairs(round(cosine, 4))
    return float((np.floor(x * blocks) == np.floor(y * blocks)).mean())


def unit_vectors(df: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """``cid``, ``n`` = 1 and the unit vector of each usable row.

    Null keys don't count, nor do vectors that are null, of another size, all zero or with a null,
    NaN or infinite value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            fits = np.flatnonzero((column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == size) & (batch.column(0).is_valid().to_numpy(zero_copy_only=False)))
            chosen = column.take(pa.array(fits))
            flat = chosen.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, size)
            peak = np.abs(flat).max(1, initial=0)
            good = np.isfinite(peak) & (peak > 0)
            unit = flat[good] / peak[good, None]
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            yield _state(batch.column(0).take(pa.array(fits[good])), np.ones(len(unit), np.int64), unit)

    return df.select(F.col(key).cast("bigint").alias("cid"), F.col(vector).cast("array<double>").alias("v")).mapInArrow(run, _STATE)


def _state(cid: pa.Array, n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    size = sums.shape[1] if sums.ndim == 2 else 0
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1, dtype=np.int32) * size), pa.array(sums.astype(np.float32).ravel()))
    return pa.RecordBatch.from_arrays([cid, pa.array(n), lists], ["cid", "n", "vector"])


def merge_block(cid: np.ndarray, n: np.ndarray, sums: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Average linkage inside one block: new cid of each row, and n and sums of the rows that lead.

    Ties go to the smallest cid. The last array names the rows that remain as clusters.
    """
    order = np.argsort(cid, kind="stable")
    leader = np.arange(len(cid))
    n, sums = n.copy(), sums.copy()
    active = order
    while len(active) > 1:
        mean = sums[active] / n[active, None].astype(np.float32)
        near = mean @ mean.T
        np.fill_diagonal(near, -2)
        best = near.argmax(1)
        rows = np.arange(len(active))
        value = near[rows, best]
        # An average is never above the largest value: what has no partner now never gets one.
        linked = value >= least
        mutual = linked & (best[best] == rows) & (rows < best)
        if not mutual.any():
            break
        keep, gone = active[mutual], active[best[mutual]]
        sums[keep] += sums[gone]
        n[keep] += n[gone]
        leader[gone] = keep
        linked[best[mutual]] = False
        active = active[linked]
    while (up := leader[leader] != leader).any():
        leader[up] = leader[leader[up]]
    return cid[leader], n, sums, np.flatnonzero(leader == np.arange(len(cid)))


def _pass(state: DataFrame, rows: int, least: float, seed: int, size: int) -> DataFrame:
    """One pass: rows with a vector are clusters; rows without name what a cluster (``into``) took in."""
    generator = np.random.default_rng(seed)
    planes = generator.standard_normal((size, DIRECTIONS * LEVELS)).astype(np.float32)
    blocks = max(1, -(-rows // BLOCK))
    tasks = min(blocks, max(512, blocks // 16))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            digits = (v @ planes).reshape(len(v), LEVELS, DIRECTIONS).argmax(2)
            code = (digits * DIRECTIONS ** np.arange(LEVELS, dtype=np.int64)[::-1]).sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], [*batch.schema.names, "code"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            whole = pa.Table.from_batches(held)
            while whole.num_rows >= 3 * BLOCK // 2:
                yield from one(whole.slice(0, 3 * BLOCK // 4))
                whole = whole.slice(3 * BLOCK // 4)
            held = whole.to_batches()
        if held:
            yield from one(pa.Table.from_batches(held))

    def one(held: pa.Table) -> Iterator[pa.RecordBatch]:
        if not held.num_rows:
            return
        cid, n = (held.column(k).to_numpy() for k in (0, 1))
        sums = held.column(2).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        into, n, sums, lead = merge_block(cid, n, sums, least)
        yield _with_into(_state(pa.array(cid[lead]), n[lead], sums[lead]), pa.nulls(len(lead), pa.int64()))
        gone = np.flatnonzero(into != cid)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cid[gone]), pa.array(n[gone]), pa.nulls(len(gone), pa.list_(pa.float32())), pa.array(into[gone])], ["cid", "n", "vector", "into"]
        )

    if blocks == 1:
        return state.coalesce(1).mapInArrow(merge, f"{_STATE}, into bigint")
    # Sorted rows make the blocks the same when a lost task is run again.
    laid = state.mapInArrow(place, f"{_STATE}, code bigint").repartitionByRange(tasks, "code", "cid").sortWithinPartitions("code", "cid")
    return laid.drop("code").mapInArrow(merge, f"{_STATE}, into bigint")


def _with_into(batch: pa.RecordBatch, into: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, into], [*batch.schema.names, "into"])


def similarity_clusters(df: DataFrame, key: str, vector: str, size: int, least: float = SIMILARITY, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """Members (``key``, ``cluster``) and clusters (``cluster``, ``n_members``, ``vector``: the sum of unit vectors).

    A cluster is named by its smallest key. Every usable row is a member of one cluster, be it alone
    in it. Rows that repeat a vector are merged like any others; a repeated key is one
    member, with the clusters' sums and sizes counting each of its rows. Unusable
    rows (see :func:`unit_vectors`) are in no cluster, and an empty table gives empty results.

    Two clusters at ``least`` have met in a block with the chance ``recall`` when the passes end, nearer ones with a greater
    one. With one block they have met for certain. A pass in which more than 1 - ``recall`` of the clusters were taken in
    starts the count again, since then there are new ones.
    """
    state = cut_lineage(unit_vectors(df, key, vector, size), "clusters-0")
    keys = cut_lineage(state.select("cid").distinct(), "clusters-keys")
    rows, number, missed = state.count(), 0, 1.0
    steps: list[DataFrame] = []
    while rows > 1 and missed > 1 - recall:
        threshold = max(least, EARLY[number]) if number < len(EARLY) else least
        both = cut_lineage(_pass(state, rows, threshold, 1000 + number, size), f"clusters-{number + 1}")
        left = both.where("into is null").count()
        if left < rows:
            steps.append(cut_lineage(both.where("into is not null").select("cid", "into"), "clusters-links"))
        if number == 0:
            drop_table(state)
        else:
            drop_table(previous)
        if threshold == least:
            missed = (missed if rows - left <= (1 - recall) * rows else 1.0) * (1 - meeting_chance(max(1, -(-rows // BLOCK)), least))
        previous, state = both, both.where("into is null").select("cid", "n", "vector")
        rows, number = left, number + 1
    members = keys.join(_last(steps), "cid", "left") if steps else keys.withColumn("into", F.lit(None).cast("bigint"))
    return members.select(F.col("cid").alias(key), F.coalesce("into", "cid").alias("cluster")), state.select(F.col("cid").alias("cluster"), F.col("n").alias("n_members"), "vector")


def _last(steps: list[DataFrame]) -> DataFrame:
    """Where each cluster that was taken in is in the end: links are followed twice as far with every round."""
    found = cut_lineage(reduce(DataFrame.unionByName, steps), "clusters-found")
    for links in steps:
        drop_table(links)
    while True:
        later = found.select(F.col("cid").alias("into"), F.col("into").alias("last"))
        after = cut_lineage(found.select("cid", "into").join(later, "into", "left").select("cid", F.coalesce("last", "into").alias("into"), F.isnotnull("last").alias("moved")), "clusters-found")
        drop_table(found)
        found = after
        if found.where("moved").isEmpty():
            return found.select("cid", "into")


def typical_members(df: DataFrame, key: str, vector: str, size: int, members: DataFrame, clusters: DataFrame, top: int = 3) -> DataFrame:
    """Clusters with their size and ``top`` most typical members: those nearest to the mean.

    Ties go to the smallest key. Clusters are ranked in parts of about ``BLOCK`` members before the parts are ranked.
    """
    sums = clusters.select("cluster", "n_members", F.col("vector").alias("sum"))
    units = unit_vectors(df, key, vector, size).select(F.col("cid").alias("m"), F.col("vector").alias("u"))
    rows = units.join(members.select(F.col(key).alias("m"), "cluster"), "m").join(sums, "cluster")
    dot = F.aggregate(F.zip_with("u", "sum", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda a, x: a + x)
    rows = rows.select("cluster", "n_members", "m", F.round(dot / F.col("n_members"), 6).alias("similarity"), F.pmod(F.xxhash64("m"), F.ceil(F.col("n_members") / BLOCK)).alias("part"))
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("similarity"), "m"))
    rows = rows.withColumn("r", rank("cluster", "part")).where(F.col("r") <= top).withColumn("r", rank("cluster")).where(F.col("r") <= top)
    return rows.select("cluster", "n_members", F.col("r").alias("place"), F.col("m").alias(key), "similarity")
