"""Clusters and mixes without what blocks or the order of records would leave out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm.clusters import similarity_clusters
from voxloom.llm.mixing import PERIOD, mixed, period_schedule, whole_weights


def test_no_near_clusters_are_left_apart(spark, monkeypatch):
    from voxloom.llm import clusters

    monkeypatch.setattr(clusters, "BLOCK", 16)
    g = np.random.default_rng(7)
    x = np.concatenate([c + 0.35 * g.standard_normal((3, 32)) for c in g.standard_normal((60, 32))])
    df = spark.createDataFrame([(i + 1, v.tolist()) for i, v in enumerate(x)], "emb bigint, vector array<double>")
    members, found = similarity_clusters(df, "emb", "vector", 32, recall=0.99999)
    of, rows = {r.emb: r.cluster for r in members.collect()}, found.collect()
    mean = np.array([r.vector for r in rows]) / np.array([r.n_members for r in rows])[:, None]
    assert np.triu(mean @ mean.T, 1).max() < 0.7 and len(rows) == len(set(of.values())) and len(of) == len(x)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    for r in rows:
        own = [k for k, c in of.items() if c == r.cluster]
        assert min(own) == r.cluster and len(own) == r.n_members and np.allclose(unit[[k - 1 for k in own]].sum(0), r.vector, atol=1e-4)


def test_lone_pairs_meet_at_any_number_of_blocks(spark, monkeypatch):
    from voxloom.llm import clusters

    monkeypatch.setattr(clusters, "BLOCK", 128)
    g = np.random.default_rng(3)
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in g.standard_normal((2, 600, 128)))
    b = b - (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = np.linspace(0.7005, 0.75, 600)[:, None]
    x = np.concatenate([a, near * a + np.sqrt(1 - near**2) * b, g.standard_normal((3000, 128))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "emb bigint, vector array<float>")
    of = {r.emb: r.cluster for r in similarity_clusters(df, "emb", "vector", 128)[0].collect()}
    assert np.mean([of[i] == of[i + 600] for i in range(600)]) >= 0.97 and len(set(of.values())) >= len(x) - 600
    chances = [clusters.meeting_chance(k, 0.7) for k in (1, 2, 30, 1000, 10**5)]
    assert chances[0] == 1 and chances == sorted(chances, reverse=True) and chances[-1] > 0


@pytest.mark.parametrize(
    "weights",
    [{"a": 0.5, "b": 0.3, "c": 0.2}, {"h": 0.5, **{f"s{k}": 0.01 for k in range(50)}}, {"h": 0.9, **{f"s{k}": 0.01 for k in range(10)}}, {"a": 0.35, "b": 0.27, "c": 0.2, "d": 0.1, "e": 0.08}, {"a": 1 / 3, "b": 0.7, "c": 0.01234567}],
)
def test_every_slot_is_within_a_block(weights):
    whole = whole_weights(weights)
    period = sum(whole.values())
    assert period <= PERIOD and all(abs(whole[s] / period - w / sum(weights.values())) < 2e-6 for s, w in weights.items())
    order = np.full(period, "", dtype=object)
    for s, x in period_schedule(whole).items():
        order[x] = s
        k = np.arange(1, len(x) + 1)
        assert (x >= (k - 1) * period // whole[s]).all() and (x < -(-k * period // whole[s])).all()
    at = np.arange(1, period + 1)
    assert all(np.abs(np.cumsum(order == s) - at * (n / period)).max() < 1 for s, n in whole.items())


def test_mix_serves_released_blocks_by_deadline(spark):
    weights = {"h": 0.9, **{f"s{k}": 0.01 for k in range(10)}}
    df = spark.createDataFrame([(f"{s}{k}", s, 1000) for s, w in weights.items() for k in range(round(w * 2000) + 3)], "id string, s string, ms bigint")
    targets = spark.createDataFrame([(s, w, 1) for s, w in weights.items()], "name string, share double, most int")
    got = sorted(mixed(df, "id", F.col("s"), F.col("ms"), targets, "name", "share", "most", 1000.0).collect(), key=lambda x: x.position)
    assert [x.position for x in got] == list(range(1, len(got) + 1)) and len(got) >= 2000
    assert all(x.release <= x.slot <= x.deadline for x in got) and all(p.slot < q.slot for p, q in zip(got, got[1:], strict=False))
    by = dict.fromkeys(weights, 0)
    for n, x in enumerate(got[:2000], 1):
        by[x.source] += 1
        assert all(abs(by[s] - w * n) < 1 for s, w in weights.items())


def test_torn_speakers_come_out_of_the_star_steps(spark, sf, monkeypatch):
    from voxloom.llm import queries, splits

    seen, star = [], splits.connected
    monkeypatch.setattr(splits, "connected", lambda edges: seen.append(edges.count()) or star(edges))
    assert queries.p3_found(spark, sf).count() > 0 and seen and seen[0] > 0


def test_speakers_in_digits_of_any_script_are_linked(spark, tmp_path):
    from voxloom.llm import queries

    zeros = [ord(z) for z in "０٠۰०০๐໐༠၀០᠐𝟎"]
    rows = [row for k, z in enumerate(zeros) for row in ((f"a{k}", f"SPK_{100 + k:05d}", "train"), (f"b{k}", "spk-" + "".join(chr(z + int(c)) for c in str(100 + k)), "test"))]
    rows += [("c1", "SPK_²", "train"), ("c2", "SPK_00002", "test"), ("d1", "SPK_00003", "train"), ("d2", "SPK_٣", None)]
    spark.createDataFrame(rows, "id string, speaker_id string, split string").write.parquet(f"{tmp_path}/samples.parquet")
    assert sorted(x.speaker_id for x in queries.p3_found(spark, str(tmp_path)).collect()) == [f"SPK_{100 + k:05d}" for k in range(len(zeros))]
    spark.createDataFrame([("train", 0.5), ("test", 0.5)], "split string, target_share double").write.parquet(f"{tmp_path}/split_targets.parquet")
    of = {x.id: x.component for x in queries.p3_assigned(spark, str(tmp_path)).collect()}
    assert all(of[f"a{k}"] == of[f"b{k}"] for k in range(len(zeros))) and of["c1"] != of["c2"] and of["d1"] == of["d2"]
