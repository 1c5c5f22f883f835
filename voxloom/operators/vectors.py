"""Vectors: centroids, nearest centroid, and exact nearest neighbours in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

GROUPS_HELD = 4096  # groups whose sums a task holds at once
MOST_VALUES = 20_000_000  # of all centroids together, which are sent to every task


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; null if either is null or all zero."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """The mean vector of every group; null and NaN places of a vector don't count there, nor do null groups and vectors.

    Every task sums its vectors as arrays, a row for each of its groups, and only these sums are taken apart and shuffled.
    """
    kind = df.schema[group].dataType.simpleString()
    rows = df.where(F.col(vector).isNotNull() & F.col(group).isNotNull()).select(F.col(group).alias("g"), F.col(vector).cast("array<double>").alias("v"))

    def emit(sums: dict, like: pa.DataType) -> pa.RecordBatch:
        lists = lambda i: pa.array([x[i] for x in sums.values()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array(list(sums), like), lists(0), lists(1)], ["g", "s", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            groups = batch.column(0).dictionary_encode()
            names, code = groups.dictionary.to_pylist(), groups.indices.to_numpy(zero_copy_only=False)
            for size in np.unique(sizes[sizes > 0]).tolist():
                here = np.flatnonzero(sizes == size)
                x = batch.column(1).take(pa.array(here)).flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, size)
                order = np.argsort(code[here], kind="stable")
                own = code[here][order]
                heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                known = ~np.isnan(x[order])
                s, n = np.add.reduceat(np.where(known, x[order], 0.0), heads), np.add.reduceat(known.astype(float), heads)
                for c, a, b in zip(own[heads], s, n, strict=True):
                    old = sums.get(names[c])
                    if old is None:
                        sums[names[c]] = (a, b)
                    else:
                        wide = max(len(old[0]), size)
                        sums[names[c]] = tuple(np.pad(p, (0, wide - len(p))) + np.pad(q, (0, wide - len(q))) for p, q in zip(old, (a, b), strict=True))
            if len(sums) >= GROUPS_HELD:
                yield emit(sums, batch.schema.field(0).type)
                sums = {}
            kept = batch.schema.field(0).type
        if sums:
            yield emit(sums, kept)

    parts = rows.mapInArrow(run, f"g {kind}, s array<double>, n array<double>").select("g", F.posexplode(F.arrays_zip("s", "n")).alias("i", "x"))
    means = parts.groupBy("g", "i").agg((F.sum("x.s") / F.nullif(F.sum("x.n"), F.lit(0.0))).alias("m"))
    return means.groupBy("g").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centroid")).withColumnRenamed("g", group)


def nearest_centroid(df: DataFrame, key: str, vector: str, centres: DataFrame, name: str, least: float = -1.0) -> DataFrame:
    """The centroid of largest cosine for each vector, null where none is over ``least``.

    The centroids go to every task as one matrix, and more than ``MOST_VALUES`` values of them are
    refused. Ties go to the smallest name. Vectors that are null, zero or of another size give null.
    """
    rows = sorted((r[name], r.centroid) for r in centres.select(name, "centroid").collect())
    if sum(len(c) for _, c in rows) > MOST_VALUES:
        raise ValueError("too many centroids for one matrix")
    names = [n for n, _ in rows]
    name_type = to_arrow_type(centres.schema[name].dataType)
    m = np.array([c for _, c in rows], np.float64) if rows else np.zeros((0, 1))
    m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
    kinds = f"{key} {df.schema[key].dataType.simpleString()}, {name} {centres.schema[name].dataType.simpleString()}, similarity double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            fits = np.flatnonzero(column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == m.shape[1])
            v = column.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, m.shape[1])
            norm = np.linalg.norm(v, axis=1)
            best, value = np.full(batch.num_rows, -1), np.full(batch.num_rows, np.nan)
            if len(names) and len(fits):
                s = v @ m.T / np.where(norm > 0, norm, np.nan)[:, None]
                good = np.flatnonzero(np.isfinite(s).all(1))
                best[fits[good]], value[fits[good]] = s[good].argmax(1), s[good].max(1)
            best[~(value > least)] = -1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([names[b] if b >= 0 else None for b in best], name_type), pa.array(value, from_pandas=True, mask=np.isnan(value))], [key, name, "similarity"]
            )

    return df.select(key, vector).mapInArrow(run, kinds)


def nearest(df: DataFrame, key: str, vector: str, queries: Column, k: int, block: int = 4096, rows: int | None = None) -> DataFrame:
    """The ``k`` nearest rows, by cosine, of each row that ``queries`` chooses: exact, in blocks against blocks.

    Each pair of a block of queries and a block of rows is one group of bounded size that keeps ``k`` rows for each
    query; these are ranked together. A row is no neighbour of itself; ties go to the smallest key.
    """
    good = df.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    sizes = df.agg(F.count("*").alias("n"), F.count_if(queries).alias("q")).first()
    rows, asking = rows or sizes.n, sizes.q
    n_rows, n_queries = -(-rows // block) or 1, -(-asking // block) or 1
    cb, qb = F.pmod(F.xxhash64("id"), F.lit(n_rows)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_queries))
    corpus = good.withColumn("cb", cb).withColumn("qb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_queries - 1).cast("bigint"))))
    asked = df.where(queries & F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    asked = asked.withColumn("qb", qb).withColumn("cb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_rows - 1).cast("bigint"))))

    def best(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"q": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "similarity": np.zeros(0)})
        if q.empty or c.empty:
            return empty
        unit = lambda t: (m := np.stack(t.v.to_numpy())) / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        c = c.sort_values("id")
        s = np.round(unit(q) @ unit(c).T, 9)
        s[q.id.to_numpy()[:, None] == c.id.to_numpy()[None]] = -np.inf
        top = np.argsort(-s, axis=1, kind="stable")[:, :k]
        out = pd.DataFrame({"q": np.repeat(q.id.to_numpy(), top.shape[1]), "id": c.id.to_numpy()[top.ravel()], "similarity": np.take_along_axis(s, top, 1).ravel()})
        return out[np.isfinite(out.similarity)]

    found = asked.groupBy("qb", "cb").cogroup(corpus.groupBy("qb", "cb")).applyInPandas(best, "q bigint, id bigint, similarity double")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("similarity"), "id"))
    return found.withColumn("place", place).where(F.col("place") <= k)
