"""Source corpora in the target schema, segments and vectors on edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.operators import segments as G
from voxloom.operators import vectors as V
from voxloom.operators.records import quota
from voxloom.sources import corpora


def test_corpora(spark):
    side = spark.createDataFrame([("train", "0-685-9", "from the side"), ("train", "0-685-9", "a"), ("test", "0-1-1", "other")], "split string, segment_id string, transcript string")
    rows = [(1, "0/685/0-685-9", None, "own", None), (2, None, "x/0-1-1.wav", "own", "train"), (3, None, "x/0-1-1.wav", "own", "test"), (4, None, None, "", None), (5, "a/b", None, None, None)]
    df = spark.createDataFrame(rows, "number bigint, key string, path string, text string, split string").withColumns({"id": F.lit("z"), "language": F.lit("z")})
    got = {r.id: r for r in corpora.from_segments(df, side).collect()}
    assert [(got[f"S{k}"].transcript, got[f"S{k}"].confidence_score) for k in range(1, 6)] == [("from the side", 1.0), ("own", 1.0), ("other", 1.0), ("", 0.0), ("", 0.0)]
    assert got["S1"].speaker_id == "SPK_00685" and got["S3"].speaker_id == "SPK_00001" and got["S4"].speaker_id.startswith("SPK_") and got["S1"].audio is None and got["S1"].language == "th"
    read = corpora.from_sentences(spark.createDataFrame([(1, "hi", "c1"), (2, None, ""), (3, "x", None)], "number bigint, sentence string, client_id string"), "MozillaCommonVoice", "mozilla_cv").collect()
    assert [r.transcript for r in read] == ["hi", "", "x"] and all(len(r.speaker_id) == 9 for r in read) and {r.confidence_score for r in read} == {1.0}
    temp = corpora.stream_samples(spark.createDataFrame([(0, None, None)], "number bigint, length double, transcript string"), "GigaSpeech2").first()
    assert (temp.id, temp.length, temp.transcript) == ("temp_0", 1.0, "")
    assert [r.speaker_id for r in corpora.own_speakers(spark.createDataFrame([("S7",), ("temp_1",), (None,)], "id string")).collect()] == ["SPK_00007", None, None]
    assert corpora.from_segments(df.limit(0), side).count() == 0


def test_error_rate_of_long_and_odd_segments(spark):
    form = "r string, s double, e double, w int"
    ref = spark.createDataFrame([("a", 0.0, 1000.0, 1), ("b", 0.0, 1.0, 1), ("c", None, 1.0, 1), ("c", math.nan, 1.0, 1), (None, 0.0, 1.0, 1)], form)
    hyp = spark.createDataFrame([("a", 0.0, 400.0, 1), ("a", 300.0, 400.0, 2), ("d", 0.0, 1.0, 3)], form)
    got = {r.r: (r.missed, r.false_alarm, r.confused, r.speech, r.der) for r in G.diarisation_error(hyp, ref, "r", "s", "e", "w").collect()}
    assert got == {"a": (60_000, 0, 10_000, 100_000, 0.7), "b": (100, 0, 0, 100, 1.0), "d": (0, 100, 0, 0, 1.0)}


def test_tiles_and_turns(spark):
    tiles = G.fixed_segments(spark.createDataFrame([("a", 10.0), ("b", 7.5), ("c", None), ("d", math.nan), ("e", -1.0), ("f", math.inf)], "k string, l double"), "k", "l", 5.0).collect()
    assert [(t.k, t.segment, t.start, t.end) for t in tiles] == [("a", 0, 0.0, 5.0), ("a", 1, 5.0, 10.0), ("b", 0, 0.0, 5.0), ("b", 1, 5.0, 7.5)]
    rows = [("a", 0.0, 1.0, 1, 0.9), ("a", 1.1, 1.2, 2, 0.9), ("a", 1.25, 3.0, 1, 0.5)]
    got = G.resegmented(spark.createDataFrame(rows, "k string, s double, e double, w int, c double"), "k", "s", "e", "w", "c", 0.5, 0.3).collect()
    assert [(r.w, r.s, r.e, r.c, r.duration) for r in got] == [(1, 0.0, 3.0, 0.5, 3.0)]


def test_centroids_of_ragged_vectors(spark):
    rows = [("a", [1.0, 2.0]), ("a", [3.0, None]), ("a", [5.0, 4.0, 9.0]), ("b", [1.0]), (None, [1.0]), ("c", None), ("d", [])]
    got = {r.g: r.centroid for r in V.centroids(spark.createDataFrame(rows, "g string, v array<double>"), "g", "v").collect()}
    assert got == {"a": [3.0, 3.0, 9.0], "b": [1.0]}
    assert V.centroids(spark.createDataFrame([], "g string, v array<float>"), "g", "v").count() == 0


def test_all_rows_may_ask(spark):
    x = np.random.default_rng(1).standard_normal((300, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>")
    got = {(r.q, r.id) for r in V.nearest(df, "id", "v", F.lit(True), 2, block=64).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    assert got == {(i, int(j)) for i in range(300) for j in np.argsort(-s[i])[:2]}


def test_quota_takes_the_first_of_each_split(spark):
    rows = [(f"{k:04d}", "train" if k % 2 else "test") for k in range(3000)] + [("x", None)]
    got = sorted(tuple(r) for r in quota(spark.createDataFrame(rows, "id string, split string"), "split", ["id"], 7, ["train", "test"]).collect())
    assert got == sorted([(f"{k:04d}", "train") for k in (1, 3, 5, 7)] + [(f"{k:04d}", "test") for k in (0, 2, 4)])


@pytest.mark.parametrize("master", ["spark://x:7077", "yarn"])
def test_no_machine_local_folder_on_a_cluster(master):
    from types import SimpleNamespace

    from voxloom.session import shared_folder

    none = SimpleNamespace(get=lambda *a: None)
    fake = SimpleNamespace(conf=none, sparkContext=SimpleNamespace(master=master, getConf=lambda: none))
    with pytest.raises(ValueError):
        shared_folder(fake)


def _wav(path, x, rate=8000, width=2, channels=1):
    import wave

    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes((np.asarray(x) * 32767).astype("<i2").tobytes())


def test_audio_in_chunks(spark, tmp_path):
    from voxloom.sources import formats as O

    x = np.sin(np.arange(20_000) / 10)
    _wav(tmp_path / "a.wav", x)
    _wav(tmp_path / "b.wav", np.repeat(x[:3000], 2), channels=2)
    (tmp_path / "c.wav").write_bytes(b"RIFF????WAVEjunk")
    (tmp_path / "d.wav").write_bytes(b"")
    got = {}
    for r in O.audio_chunks(spark, f"{tmp_path}/*.wav", 1.0).collect():
        got.setdefault(r.path[-5:], []).append(r)
    assert set(got) == {"a.wav", "b.wav"}
    parts = sorted(got["a.wav"], key=lambda r: r.chunk)
    assert [(p.chunk, p.start_time, len(p.audio.array)) for p in parts] == [(0, 0.0, 8000), (1, 1.0, 8000), (2, 2.0, 4000)]
    assert np.allclose(np.concatenate([p.audio.array for p in parts]), x, atol=1e-3) and len(got["b.wav"][0].audio.array) == 3000


def test_embeddings_are_written_by_data_set(spark, tmp_path):
    from voxloom.sources.sinks import embedding_export

    df = spark.createDataFrame([("a", "x", [1.0, 2.0]), ("b", "y", None), ("c", "x", [3.0])], "id string, dataset string, v array<double>")
    embedding_export(df, f"{tmp_path}/out", "id", "v", "dataset")
    assert {(r.id, tuple(r.vector), r.size, r.dataset) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {("a", (1.0, 2.0), 2, "x"), ("c", (3.0,), 1, "x")}


def test_steps_that_are_left_out_are_named(spark):
    from voxloom.functions import extensions as X

    out = []
    assert X.chain(spark.range(3), [(lambda d: d.select("nothing"), True)], out).count() == 3 and len(out) == 1 and "nothing" in out[0][1]


def test_weights_sizes_and_patterns(spark):
    from voxloom.operators import statistics as T

    g = np.random.default_rng(1)
    x = g.standard_normal((400, 3))
    rows = [(*map(float, v), float(v @ [0.7, 0.0, 0.3])) for v in x] + [(None, 1.0, 1.0, 1.0)]
    w = T.learned_weights(spark.createDataFrame(rows, "a double, b double, c double, y double"), ["a", "b", "c"], "y")
    assert [round(v, 3) for v in w.values()] == [0.7, 0.0, 0.3]
    worse = T.learned_weights(spark.createDataFrame([(*r[:3], (r[3] or 0) - 2 * (r[1] or 0)) for r in rows[:400]], "a double, b double, c double, y double"), ["a", "b", "c"], "y")
    assert min(worse.values()) == 0 and sum(worse.values()) == pytest.approx(1)
    one = spark.range(1).select(T.required_size(F.lit(0.5)).alias("n"), T.required_size(F.lit(0.0)).alias("none"), T.achieved_power(F.lit(63), F.lit(0.5)).alias("p")).first()
    assert one.n == 63 and one.none is None and one.p == pytest.approx(0.8, abs=0.01)
    base = spark.createDataFrame([("k", "p", 1.0, 10.0), ("k", "q", 2.0, 20.0), ("other", "r", 1.0, 10.0)], "kind string, name string, u double, v double")
    data = spark.createDataFrame([(1, "k", 1.9, 19.0), (2, "k", 1.0, None), (3, "z", 1.0, 1.0), (4, None, 1.0, 1.0)], "id int, kind string, u double, v double")
    got = {r.id: (r.name, round(r.similarity, 3)) for r in T.matched_patterns(data, "id", "kind", ["u", "v"], base, "name").collect()}
    assert got == {1: ("q", 0.95), 2: ("p", 0.5)}


def test_reports_bytes_and_results(spark, tmp_path):
    from voxloom.sources import formats as O
    from voxloom.sources.sinks import html_report

    page = html_report({"a <b>": spark.createDataFrame([("<x>", None), ("y", 2)], "k string, n int")}, "T&C")
    assert "&lt;x&gt;" in page and "<td></td>" in page and "T&amp;C" in page and page.count("<tr>") == 3
    df = spark.createDataFrame([(1, [0.0, 0.5, -0.5], 8000, None), (2, None, 8000, bytearray(b"given")), (3, None, 8000, None), (4, [0.1], None, None)], "id int, x array<float>, rate int, bytes binary")
    got = {r.id: r.bytes for r in O.with_bytes(df, "x", "rate").collect()}
    assert got[2] == b"given" and got[3] is None and got[4] is None
    rate, x = O.decode_wav(bytes(got[1]))
    assert rate == 8000 and np.allclose(x, [0, 0.5, -0.5], atol=1e-4)
    assert O.head_of(df, 2, F.col("id") > 1).count() == 2
    df.select("id", "rate").coalesce(1).write.json(f"{tmp_path}/r.json")
    df.select("id", "rate").coalesce(1).write.option("header", True).csv(f"{tmp_path}/r.csv")
    assert O.results(spark, f"{tmp_path}/r.json").count() == 4 == O.results(spark, f"{tmp_path}/r.csv").count()


def test_exclusions_and_resumption(spark):
    from voxloom.operators import records as R

    df = spark.createDataFrame([(k, k % 7 if k % 5 else None, "old") for k in range(100)], "k int, v int, reason string")
    kept, out = R.excluded(df, {"big": F.col("v") > 4, "odd": F.col("k") % 2 == 1})
    assert kept.count() + out.count() == 100 and {r.reason for r in out.collect()} == {"big", "odd"} and kept.where("v is null").count() > 0
    assert [r.k for r in R.skipped(df, ["k"], F.floor(F.col("k") / 10), 40, 3).orderBy("k").collect()] == [40, 41, 42]


def test_tasks_end_in_time_and_say_so(tmp_path, monkeypatch):
    import time
    from threading import Event

    from voxloom.functions import extensions as X

    heard, stop = [], Event()
    tasks = [X.Task("slow", lambda r: time.sleep(2), timeout=0.1, tries=2), X.Task("after", lambda r: 1, ["slow"]), X.Task("quick", lambda r: stop.set() or 7, timeout=5), X.Task("late", lambda r: 8, ["quick"])]
    done = X.run_tasks(tasks, on_event=lambda *e: heard.append(e), cancel=None)
    assert done["slow"][0] == "failed" and isinstance(done["slow"][1], TimeoutError) and done["after"][0] == "skipped" and done["quick"] == ("done", 7) and done["late"] == ("done", 8)
    assert ("slow", "retried") in heard and ("after", "skipped") in heard
    assert X.run_tasks([X.Task("a", lambda r: 1)], cancel=stop)["a"][0] == "cancelled"
    (tmp_path / "plugs").mkdir()
    (tmp_path / "plugs" / "__init__.py").write_text("")
    (tmp_path / "plugs" / "one.py").write_text("from voxloom.functions.extensions import METRICS\ndef register():\n    METRICS.add('from_plugin', len)\n")
    (tmp_path / "plugs" / "two.py").write_text("x = 1\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    assert X.load_plugins("plugs") == ["plugs.one"] and X.METRICS.get("from_plugin") is len
