"""Run bitmaps against brute force, with long, nested, touching and senseless intervals."""

import math
import random

import pytest

from voxloom.operators import segments as G
from voxloom.operators.runbitmaps import periods_and_gaps

SCHEMA = "rec string, who int, s double, e double, shard string"


def brute(rows):
    by = {}
    for rec, who, s, e, _ in rows:
        if rec is None or who is None or s is None or e is None or math.isnan(s) or math.isnan(e) or math.isinf(s) or math.isinf(e):
            continue
        a, b = round(s * 1000), round(e * 1000)
        if a < b:
            by.setdefault((rec, who), []).append((a, b))
    out = set()
    for key, spans in by.items():
        merged = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out |= {(*key, "period", a, b) for a, b in merged}
        out |= {(*key, "gap", p[1], q[0]) for p, q in zip(merged, merged[1:], strict=False)}
    return out


def found(spark, rows):
    out = periods_and_gaps(spark.createDataFrame(rows, SCHEMA), ["rec", "who"], "s", "e").collect()
    assert len(out) == len(set(out))
    return {tuple(r) for r in out}


def test_against_brute_force(spark):
    r = random.Random(3)
    rows = []
    for _ in range(400):
        s = round(r.uniform(-100, 4000), 3)
        rows.append((r.choice("ab"), r.choice([0, 1]), s, round(s + r.choice([0.001, 0.5, 3, 40, 700, 5000]) * r.random(), 3), "x"))
    rows += [("c", 1, 0.0, 1e6, None), ("c", 1, 2e6, 2.1e6, None), ("c", 1, 2.1e6, 2.1e6 + 1, None), ("c", 1, 50.0, 51.0, None), ("c", 1, 3e9, 3e9 + 5, None)]
    rows += [("d", 2, 32.767, 32.768, None), ("d", 2, 32.769, 65.536, None), ("d", 2, 65.536, 70.0, None), ("d", 2, 131.072, 196.608, None)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize(("shard_bits", "block_bits"), [(2, 1), (3, 2), (6, 1), (4, 5)])
def test_small_shards_and_blocks(spark, monkeypatch, shard_bits, block_bits):
    from voxloom.operators import runbitmaps

    monkeypatch.setattr(runbitmaps, "SHARD_BITS", shard_bits)
    monkeypatch.setattr(runbitmaps, "BLOCK_BITS", block_bits)
    r = random.Random(shard_bits * 10 + block_bits)
    rows = []
    for _ in range(1500):
        s = r.randint(-300, 900)
        rows.append((r.choice("abcdefghijkl"), r.randint(0, 5), s / 1000, (s + int(r.choice([1, 3, 9, 60, 400]) * r.random()) + 1) / 1000, "x"))
    assert found(spark, rows) == brute(rows)


def test_rows_that_do_not_count(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, 1, 0.0, 1.0, "a"), ("a", None, 0.0, 1.0, "a"), ("a", 1, None, 1.0, "a"), ("a", 1, nan, 1.0, "a"), ("a", 1, 0.0, inf, "a"), ("a", 1, 2.0, 1.0, "a"), ("a", 1, 1.0, 1.0002, "a")]
    assert found(spark, rows) == set()
    assert found(spark, []) == set()
    rows += [("a", 1, 0.0, 1.0, "a")] * 3
    assert found(spark, rows) == {("a", 1, "period", 0, 1000)}


def test_one_hot_entity_over_many_blocks(spark):
    rows = [("hot", 7, k * 40.0, k * 40.0 + 20.0, "x") for k in range(3000)]
    got = found(spark, rows)
    assert len(got) == 2 * 3000 - 1 and ("hot", 7, "gap", 20_000, 40_000) in got


def test_turns_and_frames(spark):
    rows = [("r", 1, 0.0, 1.0, 0.9), ("r", 1, 1.2, 2.0, 0.5), ("r", 2, 2.1, 3.0, 0.8), ("r", 1, 3.5, 4.0, 0.7), ("r", 1, None, 9.0, 0.1)]
    df = spark.createDataFrame(rows, "rec string, who int, s double, e double, c double")
    got = [(r.who, r.s, r.e, r.c, r.n) for r in G.speaker_turns(df, "rec", "s", "e", "who", "c", 0.3).orderBy("s").collect()]
    assert got == [(1, 0.0, 2.0, 0.5, 2), (2, 2.1, 3.0, 0.8, 1), (1, 3.5, 4.0, 0.7, 1)]
    same = G.diarisation_error(df, df, "rec", "s", "e", "who").collect()[0]
    assert same.der == 0.0 and same.speech > 0
