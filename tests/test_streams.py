"""Streams of several batches: update mode, late rows, state across batches, checkpoints."""

import json
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.session import table_folder
from voxloom.sources.sinks import read_shards
from voxloom.streaming import jobs as J


def batches(spark, schema, *parts):
    """A stream that takes one part in every batch, in this order."""
    import os
    import time

    folder = table_folder(spark, "test-stream")
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        for f in os.listdir(folder.removeprefix("file://")):
            path = os.path.join(folder.removeprefix("file://"), f)
            if f.endswith(".parquet") and os.path.getmtime(path) > time.time() - 500_000:
                os.utime(path, (1_700_000_000 + k * 100, 1_700_000_000 + k * 100))
    return J.file_stream(spark, folder, spark.createDataFrame([], schema).schema, 1)


def out(spark):
    return table_folder(spark, "test-out"), table_folder(spark, "test-state")


def test_update_mode_keeps_keys_of_earlier_batches(spark):
    stream = batches(spark, "k string, t double, v double", [("a", 1.0, 1.0), ("b", 1.0, 5.0)], [("a", 2.0, 3.0)], [("c", 1.0, 7.0), ("a", 3.0, 8.0)])
    done = J.drained(J.last_values(stream, "k", "t", "v", 2), *out(spark), "update", ["k"]).collect()
    assert {(r.k, r.n, r["mean"]) for r in done} == {("a", 2, 5.5), ("b", 1, 5.0), ("c", 1, 7.0)}
    with pytest.raises(ValueError):
        J.drained(stream, *out(spark), "update")


def test_late_rows_are_dropped(spark):
    day = lambda d, v: ("x", datetime(2024, 1, 1) + timedelta(days=d), v)
    stream = batches(spark, "k string, ts timestamp, v double", [day(0, 1.0), day(1, 2.0)], [day(10, 3.0)], [day(10, 3.0)], [day(0, 50.0), day(9, 4.0)], [day(40, 5.0)])
    done = J.drained(J.windowed_counts(stream, "ts", ["k"], "v", "1 day", None, "2 days"), *out(spark)).orderBy("window_start").collect()
    assert [(r.window_start.day, r.n, r["mean"]) for r in done] == [(1, 1, 1.0), (2, 1, 2.0), (10, 1, 4.0), (11, 2, 3.0)]


def test_shards_hold_every_id_once(spark):
    stream = batches(spark, "id string, transcript string", [("S1", "a"), ("S2", "b")], [("S2", "c"), ("S3", "d")], [("S1", "e"), ("S9", "f"), (None, "g")])
    folder, state = out(spark)
    J.into_shards(stream, folder, "train", state).awaitTermination()
    assert sorted(tuple(r) for r in read_shards(spark, folder, "train").select("id", "transcript").collect()) == [("S1", "a"), ("S2", "b"), ("S3", "d"), ("S9", "f")]


@pytest.mark.parametrize("bits", [0, 3])
def test_speakers_keep_their_numbers(spark, bits):
    g = np.random.default_rng(2)
    voices = g.standard_normal((4, 16)) * 3
    row = lambda k, v: (f"{k:03d}", "d", (voices[v] + 0.1 * g.standard_normal(16)).tolist())
    parts = [[row(b * 20 + k, (b + k) % 4) for k in range(20)] + [(f"z{b}", "d", None)] for b in range(3)]
    stream = batches(spark, "id string, g string, v array<double>", *parts)
    got = J.drained(J.stateful_speakers(stream, "g", "id", "v", shard_bits=bits), *out(spark)).collect()
    assert len(got) == 63 and all(r.speaker == 0 for r in got if r.id.startswith("z"))
    of = {}
    for r in got:
        if not r.id.startswith("z"):
            of.setdefault((int(r.id) // 20 + int(r.id) % 20) % 4, set()).add((r.shard, r.speaker))
    assert len(of) == 4 and sum(map(len, of.values())) == len(set().union(*of.values()))
    assert bits or all(len(s) == 1 for s in of.values())


def test_means_totals_and_flags_run_on(spark):
    stream = batches(spark, "k string, v array<double>", [("a", [1.0, 2.0]), ("b", None)], [("a", [3.0, 4.0]), ("a", [9.0])])
    assert [(r.k, r.n, r["mean"]) for r in J.drained(J.running_means(stream, "k", "v"), *out(spark), "update", ["k"]).collect()] == [("a", 2, [2.0, 3.0])]
    stream = batches(spark, "k string, x double", [("a", 1.0), ("b", 2.0)], [("a", 5.0)])
    assert {(r.k, r.n, r.x) for r in J.drained(J.running_totals(stream, ["k"], F.col("x"), "x"), *out(spark), "update", ["k"]).collect()} == {("a", 2, 6.0), ("b", 1, 2.0)}
    stream = batches(spark, "k string, t double, r string, v double", [("a", 1.0, "1", 9.0), ("a", 2.0, "2", 5.0)], [("a", 3.0, "3", 5.0), ("a", 4.0, "4", 0.0), ("a", 5.0, "5", 5.0)])
    flags = J.drained(J.streamed_hysteresis(stream, "k", "t", "r", "v", 8, 2), *out(spark)).collect()
    assert {r.r: r.on for r in flags} == {"1": True, "2": True, "3": True, "4": False, "5": False}


def test_checkpoints_of_older_forms():
    regular = J.upgraded_checkpoint(json.dumps({"processed_count": 7, "current_index": 3, "processed_ids": ["S1"], "name": "x"}))
    assert (regular["mode"], regular["samples_processed"], regular["split_index"], regular["current_split"], regular["processed_ids"]) == ("unified", 7, 3, "train", ["S1"])
    streaming = J.upgraded_checkpoint(json.dumps({"shard_num": 5, "samples_processed": 1000, "last_sample_id": "S1000", "dataset_specific": {"custom": "data"}}))
    assert (streaming["shard_num"], streaming["samples_processed"], streaming["last_sample_id"], streaming["dataset_specific"]) == (5, 1000, "S1000", {"custom": "data"})
    assert J.upgraded_checkpoint(json.dumps(streaming)) == streaming


def test_progress():
    now = [0.0]
    p = J.Progress(100, lambda: now[0])
    assert p.seconds_left() is None
    now[0] = 10.0
    p.add(20)
    assert p.rate() == 2 and p.seconds_left() == pytest.approx(44)
