"""Streams of records into shards, windows with late data, and state by key."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from voxloom.sources.sinks import write_shard


def file_stream(spark: SparkSession, pattern: str, schema: StructType, files: int | None = None) -> DataFrame:
    """Parquet files as they come, ``files`` of them in one batch."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(pattern)


def into_shards(stream: DataFrame, folder: str, split: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda d: d):
    """Start a query that writes each micro-batch as the shard of its number.

    A batch that is run again after a failure replaces its own shard, and rows whose id another shard has are
    left out, so that every id is written once whatever fails.
    """

    def commit(batch: DataFrame, number: int) -> None:
        write_shard(transform(batch), folder, split, number)

    return stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, keys: list[str], value: str, length: str, slide: str | None, late: str) -> DataFrame:
    """Count and mean by event-time window and key; rows later than ``late`` behind the newest are dropped."""
    window = F.window(time, length, slide) if slide else F.window(time, length)
    return stream.withWatermark(time, late).groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean")).select(F.col("w.start").alias("window_start"), *keys, "n", "mean")


def once_within(stream: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """The first row of each key; keys are forgotten when the watermark passes them."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def last_values(stream: DataFrame, key: str, order: str, value: str, n: int) -> DataFrame:
    """After each batch the mean of the last ``n`` values of each key, from state of ``n`` values a key."""

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times, values = state.get if state.exists else ([], [])
        for frame in frames:
            times, values = [*times, *frame["t"].tolist()], [*values, *frame["v"].tolist()]
            order_ = np.argsort(times, kind="stable")[-n:]
            times, values = [times[i] for i in order_], [values[i] for i in order_]
        state.update((times, values))
        yield pd.DataFrame({"k": [k[0]], "n": [len(values)], "mean": [float(np.mean(values)) if values else None]})

    rows = stream.select(F.col(key).cast("string").alias("k"), F.col(order).cast("double").alias("t"), F.col(value).cast("double").alias("v")).where("k is not null and t is not null and v is not null")
    out = rows.groupBy("k").applyInPandasWithState(update, "k string, n bigint, mean double", "t array<double>, v array<double>", "update", GroupStateTimeout.NoTimeout)
    return out.withColumnRenamed("k", key)


MOST_CENTROIDS = 20_000  # speakers in one shard of the state


def stateful_speakers(stream: DataFrame, group: str, key: str, vector: str, least: float = 0.7, shard_bits: int = 0) -> DataFrame:
    """A speaker number for every vector, kept across batches, for each data set by itself: ``group``, ``shard``, ``key``, ``speaker``.

    A vector goes to the nearest centroid whose cosine is over ``least``, and moves it; else it founds a new
    speaker. Null or zero vectors get speaker 0. Within a batch rows go by ``key``. State is held by data set and, for data sets with
    more speakers than one task can hold, by the signs of ``shard_bits`` random projections; speakers of different shards are never joined, and more than
    ``MOST_CENTROIDS`` in one shard are refused. Vectors that are near a centroid of the state are placed by one matrix product a
    batch; only those that found or follow new speakers are gone through one by one.
    """

    def shard(vectors: pd.Series) -> pd.Series:
        planes = np.random.default_rng(11)
        rows = [np.zeros(0) if v is None else np.asarray(v, float) for v in vectors]
        size = max((len(r) for r in rows), default=0)
        m = planes.standard_normal((4096, shard_bits))[:size] if shard_bits else np.zeros((size, 0))
        return pd.Series([int(((r @ m[: len(r)]) > 0) @ (1 << np.arange(shard_bits))) if len(r) and shard_bits else 0 for r in rows], dtype="int32")

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        counts, flat = state.get if state.exists else ([], [])
        counts = list(counts)
        sums = np.asarray(flat, float).reshape(len(counts), -1) if counts else np.zeros((0, 0))
        for frame in frames:
            frame = frame.sort_values("id", kind="stable")
            rows = [np.zeros(0) if v is None else np.asarray(v, float) for v in frame["v"]]
            out = np.zeros(len(rows), int)
            size = sums.shape[1] or next((len(r) for r in rows if len(r)), 0)
            good = [i for i, r in enumerate(rows) if len(r) == size and np.isfinite(r).all() and r.any()]
            if good:
                unit = np.stack([rows[i] / np.linalg.norm(rows[i]) for i in good])
                if not len(sums):
                    sums = np.zeros((0, size))
                near = unit @ (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-300)).T if len(sums) else np.zeros((len(unit), 0))
                known = near.max(1, initial=-1) > least
                best = near.argmax(1) if near.shape[1] else np.zeros(len(unit), int)
                np.add.at(sums, best[known], unit[known])
                out[np.array(good)[known]] = best[known] + 1
                for i in best[known]:
                    counts[i] += 1
                for j in np.flatnonzero(~known):
                    value = sums @ unit[j] / np.maximum(np.linalg.norm(sums, axis=1), 1e-300) if len(sums) else np.zeros(0)
                    at = int(value.argmax()) if len(value) and value.max() > least else len(sums)
                    if at == len(sums):
                        if at >= MOST_CENTROIDS:
                            raise ValueError("too many speakers in one shard: use more shard bits")
                        sums, counts = np.vstack([sums, np.zeros((1, size))]), [*counts, 0]
                    sums[at] += unit[j]
                    counts[at] += 1
                    out[good[j]] = at + 1
            yield pd.DataFrame({"g": [k[0]] * len(frame), "shard": [k[1]] * len(frame), "id": frame["id"], "speaker": out})
        state.update((counts, sums.ravel().tolist()))

    rows = stream.select(F.col(group).cast("string").alias("g"), F.col(key).cast("string").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("g is not null")
    rows = rows.withColumn("shard", F.pandas_udf(shard, "int")("v") if shard_bits else F.lit(0))
    made = rows.groupBy("g", "shard").applyInPandasWithState(update, "g string, shard int, id string, speaker int", "n array<int>, sums array<double>", "append", GroupStateTimeout.NoTimeout)
    return made.withColumnsRenamed({"g": group, "id": key})


def running_means(stream: DataFrame, key: str, vector: str) -> DataFrame:
    """After each batch the mean of all vectors of each key so far, from their sum and number: ``key``, ``n``, ``mean``.

    Null keys and null vectors, and vectors of another size than a key's first, don't count.
    """

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, [])
        total = np.asarray(total, float)
        for frame in frames:
            for v in frame["v"]:
                if n == 0 or len(v) == len(total):
                    total, n = (np.asarray(v, float) if n == 0 else total + v), n + 1
        state.update((int(n), total.tolist()))
        yield pd.DataFrame({"k": [k[0]], "n": [n], "mean": [(total / max(n, 1)).tolist()]})

    rows = stream.select(F.col(key).cast("string").alias("k"), F.col(vector).cast("array<double>").alias("v")).where("k is not null and v is not null and size(v) > 0")
    return rows.groupBy("k").applyInPandasWithState(update, "k string, n bigint, mean array<double>", "n bigint, total array<double>", "update", GroupStateTimeout.NoTimeout).withColumnRenamed("k", key)


def running_totals(stream: DataFrame, keys: Sequence[str], amount: Column, output: str) -> DataFrame:
    """After each batch the number of rows and the sum of ``amount`` of each key so far; take the largest for dominance."""
    return stream.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(amount).alias(output))


def sliding_majority(stream: DataFrame, time: str, key: str, label: str, length: str, slide: str, late: str) -> DataFrame:
    """The most frequent label of each key in every sliding window, the smallest of several, once no late row can change it."""
    w = F.window(time, length, slide)
    return stream.withWatermark(time, late).groupBy(w.alias("w"), key).agg(F.count("*").alias("n"), F.mode(label, True).alias(label)).select(F.col("w.start").alias("window_start"), key, "n", label)


def streamed_hysteresis(stream: DataFrame, key: str, order: str, row: str, value: str, on: float, off: float) -> DataFrame:
    """Whether each row is on: from a value over ``on`` until one under ``off``, with the flag kept across batches.

    Rows of a batch go by ``order``; batches are expected in order. Gives ``key``, ``row`` and ``on``.
    """

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else False
        rows = pd.concat(list(frames)).sort_values(["t", "r"], kind="stable")
        event = np.where(rows["v"] > on, 1.0, np.where(rows["v"] < off, 0.0, np.nan))
        flags = pd.Series(event).ffill().fillna(float(last)) > 0
        state.update((bool(flags.iloc[-1]) if len(flags) else last,))
        yield pd.DataFrame({"k": [k[0]] * len(rows), "r": rows["r"].to_numpy(), "on": flags.to_numpy()})

    rows = stream.select(F.col(key).cast("string").alias("k"), F.col(order).cast("double").alias("t"), F.col(row).cast("string").alias("r"), F.col(value).cast("double").alias("v")).where("k is not null")
    made = rows.groupBy("k").applyInPandasWithState(update, "k string, r string, on boolean", "last boolean", "append", GroupStateTimeout.NoTimeout)
    return made.withColumnsRenamed({"k": key, "r": row})


class Progress(StreamingQueryListener):
    """Rows done, rows a second and, with a known total, the seconds left (a tenth is added to the mean's forecast)."""

    def __init__(self, total: int | None = None, clock: Callable[[], float] = time.time) -> None:
        self.total, self.done, self.clock, self.began = total, 0, clock, clock()

    def onQueryStarted(self, event: object) -> None:
        self.began = self.clock()

    def onQueryProgress(self, event: object) -> None:
        self.add(int(event.progress.numInputRows))

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        pass

    def add(self, rows: int) -> None:
        self.done += rows

    def rate(self) -> float:
        return self.done / max(self.clock() - self.began, 1e-9)

    def seconds_left(self) -> float | None:
        return None if self.total is None or not self.done else max(0, self.total - self.done) / self.rate() * 1.1


def upgraded_checkpoint(text: str) -> dict:
    """Where an older run stopped, in one form, from what any of its checkpoint formats holds (JSON).

    ``samples_processed``, ``current_split``, ``split_index``, ``shard_num``, ``last_sample_id``, ``processed_ids`` and ``dataset_specific``;
    what a format lacks has the value of a run that has not begun.
    """
    # Fields of the unified form with the older names that they go by and their values at the start of a run.
    fields = {
        "samples_processed": (["processed_count"], 0), "current_split": ([], "train"), "split_index": (["current_index"], 0), "shard_num": ([], 0),
        "last_sample_id": ([], None), "processed_ids": ([], []), "dataset_specific": ([], {}),
    }
    old = json.loads(text)
    out = {name: next((old[n] for n in (name, *older) if n in old), start) for name, (older, start) in fields.items()}
    return {"mode": "unified", **out}


def drained(stream: DataFrame, folder: str, checkpoint: str, mode: str = "append", keys: Sequence[str] = ()) -> DataFrame:
    """Run a stream over all that is there now and read what it wrote.

    In ``complete`` mode each batch replaces the rows written before. In ``update`` mode every batch is kept under its number, and
    the row of the last batch that has a key (``keys``) counts; a batch that is run again replaces itself.
    """
    spark = stream.sparkSession
    if mode == "append":
        stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(folder)
    if mode == "update" and not keys:
        raise ValueError("update mode needs the keys of its rows")
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(f"{folder}/batch=-1" if mode == "update" else folder)
    place = lambda number: f"{folder}/batch={number}" if mode == "update" else folder
    done = lambda batch, number: batch.write.mode("overwrite").parquet(place(number))
    stream.writeStream.outputMode(mode).foreachBatch(done).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if mode == "complete":
        return spark.read.schema(stream.schema).parquet(folder)
    rows = spark.read.option("basePath", folder).parquet(f"{folder}/batch=*")
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), "batch").alias("row"))
    return last.select("row.*").select(*stream.columns)
