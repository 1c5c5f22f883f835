"""Records, series, signals, sources and sinks, streams and tasks on small fixtures."""

import io
import tarfile
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import extensions as X
from voxloom.functions import scalars as S
from voxloom.functions import scores as C
from voxloom.functions import signals as A
from voxloom.operators import records as R
from voxloom.operators import series as W
from voxloom.operators import statistics as T
from voxloom.operators import vectors as V
from voxloom.sources import formats as O
from voxloom.sources import sinks as K
from voxloom.streaming import jobs as J

SAMPLE = "id string, speaker_id string, language string, audio struct<path:string,sampling_rate:int>, transcript string, length float, dataset_name string, confidence_score float"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_validation(spark):
    good = ("S1", "SPK_00001", "th", ("a.wav", 16000), "x", 1.5, "d", 1.0)
    bad = [("X", "UNKNOWN", "en", None, "y" * 10_001, 0.0, "", 1.1), (None, None, None, None, None, None, None, None), ("temp_3", "SPK_00001", "th", ("a", 1), "", 3601.0, "d", float("nan"))]
    e = [r.e for r in spark.createDataFrame([good, *bad], SAMPLE).select(R.validation_errors().alias("e")).collect()]
    assert e[0] == [] and len(e[1]) == 8 and len(e[2]) == 8 and set(e[3]) == {"length:range", "confidence_score:range", "transcript:short"}


def test_scalars(spark):
    none, lit = F.lit(None).cast("string"), F.lit
    assert one(spark, S.segment_id(lit("0/685/0-685-9"), none, none, none)) == "0-685-9"
    assert one(spark, S.segment_id(lit(""), none, lit("/a/b.c.wav"), none)) == "b.c"
    assert one(spark, S.segment_id(none, none, none, lit("http://h/x.tar.gz"))) == "x"
    assert one(spark, S.speaker_of_segment(lit("0-685-9"))) == "SPK_00685" and one(spark, S.speaker_of_segment(lit("a"))) is None
    import hashlib

    assert one(spark, S.hashed_speaker(lit("u"), "cv")) == f"SPK_{int(hashlib.md5(b'cv_u').hexdigest()[:8], 16) % 100000:05d}"
    assert one(spark, S.error_kind(lit("Connection reset"))) == "network_error" and one(spark, S.error_kind(none)) == "unknown_error"
    assert one(spark, S.error_kind(lit("unknown codec"))) == "unsupported_format" and one(spark, S.error_kind(lit("broken header"))) == "metadata_error"
    assert one(spark, S.hours_minutes(lit(3725.0))) == "1h 2m" and one(spark, S.hours_minutes(lit(59.0))) == "0m"
    assert one(spark, S.plain_name(lit(" Giga_Speech-2 "))) == "gigaspeech2" and one(spark, S.plain_name(lit(" "))) is None


def test_scores(spark):
    m = {k: F.lit(None).cast("double") for k in C.SCALES}
    assert one(spark, C.score(m, C.PROFILES["balanced"])) == pytest.approx(50)
    assert one(spark, C.grade(F.lit(90.0))) == "A" and one(spark, C.grade(F.lit(59.9))) == "F" and one(spark, C.grade(F.lit(None).cast("double"))) is None
    assert one(spark, C.attainment(F.lit(3.25), 3, 3.5, 5)) == 0.5 and one(spark, C.attainment(F.lit(6.0), 3, 3.5, 5)) == 0.8
    assert one(spark, C.relative_change(F.lit(1.0), F.lit(0.0), 0.1)) is None


def test_first_of_each_and_ids(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, None), (None, 1, "n")], "k string, t int, v string")
    assert {(r.k, r.v) for r in R.first_of_each(df, ["k"], ["t"]).collect()} == {("a", "x"), ("b", None), (None, "n")}
    ids = R.sequential(df, ["t", "k", "v"], F.col("t"), 5, "id").collect()
    assert sorted(r.id for r in ids) == ["S5", "S6", "S7", "S8"]
    assert R.sequential(df.limit(0), ["t"], F.col("t"), 1, "id").count() == 0


def test_frames_cross_blocks(spark):
    df = spark.range(1, 101).select(F.lit("s").alias("k"), F.col("id").alias("rn"), (F.col("id") * F.col("id")).cast("double").alias("v"))
    rows = W.framed(df, ["k"], 6, 0, block=16)
    got = {r.rn: r.m for r in W.home(rows.withColumn("m", F.avg("v").over(W.frame(["k"], 6, 0)))).collect()}
    assert got == {n: pytest.approx(np.mean([float(i * i) for i in range(max(1, n - 6), n + 1)])) for n in range(1, 101)}
    z = W.centred_zscore(df, ["k"], "v", 4, "z").where("z is not null").count()
    assert z == 97


def test_corrections(spark):
    p = [0.01, 0.04, 0.03, 0.2]
    df = spark.createDataFrame([(f"t{i}", x) for i, x in enumerate(p)], "name string, p double")
    got = {r["name"]: r for r in T.corrected(df, "p", "name").collect()}
    assert got["t0"].bonferroni == 0.04 and got["t1"].holm == 0.09 and got["t2"].holm == 0.09
    assert got["t1"].fdr_bh == pytest.approx(0.053333, abs=1e-6) and got["t3"].fdr_bh == 0.2


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [0.0, 2.0], "b"), (3, None, "a"), (4, [0.0, 0.0], None), (5, [1.0, 0.1], "a")], "i bigint, v array<double>, g string")
    near = {r.i: r.g for r in V.nearest_centroid(df, "i", "v", V.centroids(df, "g", "v"), "g").collect()}
    assert near == {1: "a", 2: "b", 3: None, 4: None, 5: "a"}
    top = V.nearest(df, "i", "v", F.col("i") == 1, 1, block=2).collect()
    assert [(r.q, r.id) for r in top] == [(1, 5)]


def tone(hz=440.0, seconds=1.0, rate=8000):
    return 0.5 * np.sin(2 * np.pi * hz * np.arange(int(seconds * rate)) / rate)


def test_signal_measures(spark):
    x, noise = tone(), np.random.default_rng(1).normal(0, 0.05, 8000)
    df = spark.createDataFrame([("a", x.tolist(), (x + noise).tolist()), ("b", x.tolist(), (3 * x).tolist()), ("c", None, [1.0]), ("d", [0.0, 0.0], [1.0, 2.0])], "k string, r array<double>, e array<double>")
    got = {r.k: r for r in A.with_ratios(df, "r", "e").collect()}
    assert got["a"].snr == pytest.approx(10 * np.log10((x**2).sum() / (noise**2).sum()), abs=1e-6) and got["b"].si_sdr == 100
    levels = {r.k: r for r in A.with_levels(df.drop("e"), "r").collect()}
    assert levels["a"].peak == pytest.approx(0.5, abs=1e-3) and levels["c"].rms is None and levels["d"].db == -100
    columns = df.select("k", A.rms(F.col("r")).alias("rms"), A.energy_db(F.col("r")).alias("db"), A.peak(F.col("r")).alias("peak"), A.zero_crossings(F.col("r")).alias("z"), A.snr_db(F.col("r"), F.col("e")).alias("snr")).where("k = 'a'").first()
    assert (columns.rms, columns.peak, columns.snr) == pytest.approx((levels["a"].rms, levels["a"].peak, got["a"].snr)) and 0.1 < columns.z < 0.12
    assert got["c"].snr is None and got["d"].si_sdr is None
    assert A.blind_snr(np.r_[noise[:4000] * 0.01, x], 8000) > 30 and A.percentile_snr(np.zeros(100)) == 40
    assert A.spectral_shape(x, 8000)["centroid"] == pytest.approx(440, abs=30)
    assert A.voice_similarity(x, x, 8000) == pytest.approx(1) and A.log_spectral_distance(x, x) == 0 and A.spectral_divergence(x, x) == 0
    assert A.noise_kind(np.random.default_rng(2).normal(size=40000), 8000) == "white"
    assert A.noise_kind(np.cumsum(np.random.default_rng(2).normal(size=40000)), 8000) in ("brown", "periodic", "non_stationary")


def test_signal_detectors():
    x = tone(seconds=2)
    x[8000:12000] = 0
    flags, p = A.energy_vad(x + np.random.default_rng(0).normal(0, 1e-4, len(x)), 8000)
    (a, b), (c, d) = A.speech_segments(flags, 0.02, 2.0)
    assert (a, d) == (0, 2.0) and abs(b - 1.05) < 0.05 and abs(c - 1.45) < 0.05 and ((p >= 0) & (p <= 1)).all()
    assert A.dropouts(x, 8000) == [(200, 300)]
    y = tone()
    y[100:110] = 1.0
    assert A.clipped_runs(y) == [(100, 110)]
    z = tone() * 0.01
    z[4000:4004] = 0.9
    assert [k for *_, k in A.clicks(z, 8000)] == ["click"]
    assert A.runs(np.array([], bool)) == []


def test_signal_filters():
    x, rng = tone(seconds=2), np.random.default_rng(5)
    noisy = x + rng.normal(0, 0.05, len(x))
    assert np.sqrt((A.normalised(x) ** 2).mean()) == pytest.approx(0.1) and not A.normalised(np.zeros(5)).any()
    assert len(A.resampled(x, 8000, 16000)) == 32000 and A.resampled(A.resampled(x, 8000, 16000), 16000, 8000) == pytest.approx(x, abs=1e-6)
    assert A.suppressed(x, 8000, [(0.5, 0.6)])[4200] == pytest.approx(0.15 * x[4200])
    quiet = np.r_[noisy, rng.normal(0, 0.05, 8000)]
    for f in (A.gated, A.wiener, A.subtracted):
        out = f(quiet)
        assert len(out) == len(quiet) and (out[-6000:] ** 2).mean() < 0.5 * (quiet[-6000:] ** 2).mean()
    assert A._gained(x, lambda p: np.ones_like(p)) == pytest.approx(x, abs=1e-9)
    assert len(A.trimmed(np.r_[np.zeros(4000), x, np.zeros(4000)], 8000)) < len(x) + 400


def test_measured_and_filtered(spark):
    df = spark.createDataFrame([(1, tone().tolist(), 8000), (2, None, 8000), (3, [1.0], 0), (4, [float("nan")], 8000)], "i int, x array<double>, rate int")
    got = {r.i: r.measures for r in A.measured(df, "x", "rate").collect()}
    assert got[1]["centroid"] > 0 and got[2] is None and got[3] is None and got[4] is None
    assert A.filtered(df.where("i < 3"), "x", "rate", lambda x, r: x * 2).where("i = 1").first().x[1] == pytest.approx(2 * tone()[1])


def test_files(spark, tmp_path):
    data = io.BytesIO()
    with wave.open(data, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes((np.repeat(tone(), 2) * 32767).astype("<i2").tobytes())
    folder = tmp_path / "th" / "train"
    folder.mkdir(parents=True)
    with tarfile.open(folder / "a.tar.gz", "w:gz") as t:
        for name, content in (("x.wav", data.getvalue()), ("x.txt", b"no")):
            info = tarfile.TarInfo(name)
            info.size = len(content)
            t.addfile(info, io.BytesIO(content))
    (folder / "b.tar.gz").write_bytes(b"broken")
    rows = O.archive_members(spark, f"{tmp_path}/th/train/*.tar.gz", r".*\.wav").collect()
    assert sorted((r.member or "") for r in rows) == ["", "x.wav"]
    sound = O.with_audio(O.archive_members(spark, f"{tmp_path}/th/train/*.tar.gz", r".*\.wav").where("member is not null"), "content").first().audio
    assert sound.sampling_rate == 8000 and np.array(sound.array) == pytest.approx(tone(), abs=1e-3)
    assert O.decode_wav(b"nothing") is None and O.available_splits(spark, f"{tmp_path}/th") == ["train"]
    (tmp_path / "raw.tsv").write_text("a\told\nb\t x \nc\n")
    (tmp_path / "refined.tsv").write_text("a\tnew\na\tlast\n")
    side = O.side_table(spark, [str(tmp_path / "raw.tsv"), str(tmp_path / "refined.tsv")])
    assert {(r.segment_id, r.transcript) for r in side.collect()} == {("a", "last"), ("b", "x")}
    df = spark.createDataFrame([("a", "own"), ("z", " "), ("y", "own")], "s string, text string")
    assert {(r.s, r.transcript) for r in O.looked_up(df, "s", ["text"], side).collect()} == {("a", "last"), ("z", None), ("y", "own")}


def test_settings():
    assert O.settings({"n": 1, "on": False}, {"n": "3"}, {"V_ON": "true"}, "V") == {"n": 3, "on": True}
    with pytest.raises(KeyError):
        O.settings({}, {"x": 1}, {}, "V")


def test_shards_are_written_once(spark, tmp_path):
    row = lambda *ids: spark.createDataFrame([(i, "s", "th", ("p", 1), "t", 1.0, "d", 1.0) for i in ids], SAMPLE)
    folder = str(tmp_path / "out")
    assert K.next_number(spark, folder, "train") == 1
    assert K.append_shard(row("S1", "S2", "S2", None), folder, "train") == 0 and K.append_shard(row("S2", "S7"), folder, "train") == 1
    K.write_shard(row("S2", "S9"), folder, "train", 1)
    assert sorted(r.id for r in K.read_shards(spark, folder, "train").collect()) == ["S1", "S2", "S9"]
    assert K.next_number(spark, folder, "train") == 10
    K.wide_export(spark.createDataFrame([("a", "m", 1.0), ("a", "n", 2.0), ("b", "n", 3.0)], "k string, metric string, v double"), "k", "metric", "v", ["n", "m"], str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["k", "m", "n"]
    assert "2 samples" in K.card(spark.createDataFrame([("d", 2, 0.5)], "dataset string, n int, hours double"), "Card")


def test_streams(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([("d", f"{k}{i}", float(10 * k + i), [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(4)], "g string, id string, t double, v array<double>").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = lambda: J.file_stream(spark, str(tmp_path / "in"), schema, 1)
    out = J.drained(J.stateful_speakers(stream(), "g", "id", "v"), str(tmp_path / "o1"), str(tmp_path / "c1"))
    assert {(int(r.id[-1]) % 2, r.speaker) for r in out.collect()} == {(0, 1), (1, 2)} and out.count() == 12
    last = J.drained(J.last_values(stream(), "g", "t", "t", 4), str(tmp_path / "o2"), str(tmp_path / "c2"), "update", ["g"])
    assert [(r.n, r["mean"]) for r in last.collect()] == [(4, 21.5)]


def test_extensions(spark):
    df = spark.createDataFrame([(1, None), (5, "a")], "x int, y string")
    assert [r.h for r in df.select(X.rule_hits({"big": "x > 2", "named": "y = 'a'"}).alias("h")).collect()] == [[], ["big", "named"]]
    t, c = X.better_transcript(F.lit("a b"), F.lit(0.5), F.lit("c"), F.lit(0.5))
    assert one(spark, t) == "ab" and one(spark, c) == 0.5
    none = F.lit(None).cast("string")
    t, c = X.better_transcript(none, F.lit(0.9), none, F.lit(0.9))
    assert one(spark, t) == "[INAUDIBLE]" and one(spark, c) == 0.1
    with pytest.warns(UserWarning, match="left out"):
        assert X.chain(df, [lambda d: d.where("x > 2"), (lambda d: d.select("nothing"), True)]).count() == 1
    tries = []
    done = X.run_tasks([X.Task("a", lambda r: tries.append(1) or 1 / (len(tries) - 1), tries=2), X.Task("b", lambda r: r["a"] + 1, ["a"]), X.Task("c", lambda r: 1 / 0), X.Task("d", lambda r: 0, ["c"])])
    assert done["b"] == ("done", 2.0) and done["c"][0] == "failed" and done["d"][0] == "skipped"
    with pytest.raises(ValueError):
        X.run_tasks([X.Task("a", lambda r: 0, ["b"]), X.Task("b", lambda r: 0, ["a"])])
    m = X.Named("metric")
    m.add("a", 1)
    with pytest.raises(ValueError):
        m.add("a", 2)
