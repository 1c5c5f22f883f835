"""Splits, clusters, mixes, containers and pieces against brute force and their promises."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxloom.llm.chunking import RangeMaximum, pieces
from voxloom.llm.clusters import merge_block, similarity_clusters, typical_members
from voxloom.llm.mixing import mixed, shares_reached
from voxloom.llm.packing import packed, packing_plan, sweep, token_sizes
from voxloom.llm.splits import assign_splits, connected, speaker_name, speaker_number, with_components
from voxloom.llm.tokens import tokens_of


def test_components_against_union_find(spark):
    r = random.Random(2)
    edges = [(f"n{r.randint(0, 120)}", f"n{r.randint(0, 120)}") for _ in range(90)] + [(f"c{k}", f"c{k + 1}") for k in range(60)] + [("hub", f"h{k}") for k in range(80)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        up[max(root(a), root(b))] = min(root(a), root(b))
    want = {x: root(x) for a, b in edges if a != b for x in (a, b)}
    got = connected(spark.createDataFrame([*edges, ("a", None), ("a", "a")], "u string, v string")).collect()
    assert {x.node: x.component for x in got} == want and len(got) == len(want)
    assert connected(spark.createDataFrame([], "u string, v string")).count() == 0


def test_chains_of_links_are_one_component(spark):
    r = random.Random(3)
    # Record k shares its speaker with record k - 1 and its place with record k + 1, twenty links in a row; one hub has most records.
    rows = [(f"r{c}-{k}", f"s{c}-{k // 2}", f"p{c}-{(k + 1) // 2}") for c in range(30) for k in range(20)] + [(f"h{k}", "hub", f"q{k}") for k in range(3000)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "id string, speaker string, place string")
    of = {}
    for x in with_components(df, "id", {"speaker": F.col("speaker"), "place": F.col("place")}).collect():
        of.setdefault(x.component, set()).add(x.id)
    groups = {frozenset(v) for v in of.values()}
    assert groups == {frozenset(f"r{c}-{k}" for k in range(20)) for c in range(30)} | {frozenset(f"h{k}" for k in range(3000))}


def test_speakers(spark):
    names = ["SPK_00007", "spk-7", " SPK00007", "Spk_๗", "SPK_123456", "UNKNOWN", "", None, "SPK_0"]
    got = spark.createDataFrame([(n,) for n in names], "s string").select(speaker_name(speaker_number(F.col("s"))).alias("n")).collect()
    assert [x.n for x in got] == ["SPK_00007"] * 4 + ["SPK_123456", None, None, None, "SPK_00000"]


def test_splits_keep_entities_together(spark):
    r = random.Random(4)
    rows = [(f"r{k}", f"s{r.randint(0, 400)}" if k % 9 else None, f"p{r.randint(0, 900)}" if k % 5 else None, "train", "x") for k in range(2000)]
    rows += [(f"hot{k}", "hot", None, None, "y") for k in range(900)] + [(None, None, None, None, None)] * 3
    df = spark.createDataFrame(rows, "id string, speaker string, place string, split string, component string")
    targets = [("train", 0.8), ("validation", 0.1), ("test", 0.1)]
    one = assign_splits(df, "id", {"speaker": F.col("speaker")}, targets).collect()
    assert len(one) == len(rows) and {x.assigned for x in one} == {"train", "validation", "test"}
    for name in ("speaker", "component"):
        of = {}
        for x in one:
            of.setdefault(x[name], set()).add(x.assigned)
        assert all(len(v) == 1 for k, v in of.items() if k is not None)
    share = sum(x.assigned == "train" for x in one) / len(one)
    assert abs(share - 0.8) < 0.05
    two = with_components(df, "id", {"speaker": F.col("speaker"), "place": F.col("place")}).collect()
    for name in ("speaker", "place"):
        of = {}
        for x in two:
            of.setdefault(x[name], set()).add(x.component)
        assert all(len(v) == 1 for k, v in of.items() if k is not None)
    assert assign_splits(df.limit(0), "id", {"speaker": F.col("speaker")}, targets).count() == 0
    with pytest.raises(ValueError):
        assign_splits(df, "id", {"speaker": F.col("speaker")}, [])


def voices(n, per, seed):
    g = np.random.default_rng(seed)
    out = []
    for c in g.standard_normal((n, 32)):
        out += [c + 0.25 * g.standard_normal(32) for _ in range(per)]
    return np.array(out) * g.uniform(0.01, 50, (n * per, 1))


def test_clusters_against_all_pairs(spark, monkeypatch):
    from voxloom.llm import clusters

    monkeypatch.setattr(clusters, "BLOCK", 64)
    x = voices(60, 8, 1)
    rows = [(i + 1, v.tolist(), "x", 1) for i, v in enumerate(x)]
    rows += [(9001, None, "x", 1), (9002, [0.0] * 32, "x", 1), (9003, [1.0] * 31, "x", 1), (9004, [float("nan")] * 32, "x", 1), (None, x[0].tolist(), "x", 1)]
    df = spark.createDataFrame(rows, "emb bigint, vector array<double>, cluster string, n int")
    members, found = similarity_clusters(df, "emb", "vector", 32)
    got = {r.emb: r.cluster for r in members.collect()}
    assert set(got) == set(range(1, len(x) + 1))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near, label = np.argwhere(np.triu(u @ u.T >= 0.7, 1)), np.array([got[i + 1] for i in range(len(x))])
    assert (label[near[:, 0]] == label[near[:, 1]]).mean() >= 0.9
    assert all(min(k for k, c in got.items() if c == v) == v for v in set(got.values()))
    assert found.agg(F.sum("n_members")).first()[0] == len(x)
    top = typical_members(df, "emb", "vector", 32, members, found, 2).collect()
    assert {r.place for r in top} == {1, 2} and len(top) <= 2 * found.count()
    assert similarity_clusters(df.limit(0), "emb", "vector", 32)[0].count() == 0


def test_block_merges_by_average():
    v = np.array([[1, 0], [0.8, 0.6], [0.28, 0.96], [-1, 0]], np.float32)
    into, n, _, lead = merge_block(np.array([5, 3, 4, 1]), np.ones(4, np.int64), v, 0.7)
    assert into.tolist() == [3, 3, 4, 1] or into.tolist() == [5, 3, 3, 1]
    assert n[lead].sum() == 4


def test_mix_reaches_its_shares(spark):
    r = random.Random(6)
    rows = [(f"{s}{k}", s, r.randint(1, 40_000), "z") for s, n in (("a", 3000), ("b", 900), ("c", 90)) for k in range(n)] + [(None, "a", 5, "z"), ("q", "a", None, "z"), ("w", "other", 9, "z"), ("a1", "a", 7, "z")]
    df = spark.createDataFrame(rows, "id string, s string, ms bigint, source string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3), ("absent", 0.1, 9)], "name string, share double, most int")
    mix = mixed(df, "id", F.col("s"), F.col("ms"), targets, "name", "share", "most", 60_000.0)
    shares = {x.source: x for x in shares_reached(mix).collect()}
    for s, w, most in (("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3)):
        assert abs(shares[s].actual_share - w) < 0.01 and shares[s].most_used <= most
    got = mix.orderBy("position", "source").collect()
    assert len({(x.source, x.key, x.copy) for x in got}) == len(got)
    whole, by = 0, dict.fromkeys("abc", 0)
    for x in got:
        whole, by[x.source] = whole + x["size"], by[x.source] + x["size"]
        assert all(abs(by[s] - w * whole) <= 60_000 + 40_000 for s, w in (("a", 0.5), ("b", 0.3), ("c", 0.2)))
        assert x.release <= x.slot <= x.deadline
    assert mixed(df.limit(0), "id", F.col("s"), F.col("ms"), targets, "name", "share", "most", 60_000.0).count() == 0


def best_fit_decreasing(sizes, capacity):
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = min((g for g in gaps if g >= s), default=None)
        if fit is None:
            gaps.append(capacity - s)
        else:
            gaps[gaps.index(fit)] -= s
    return sorted(gaps)


def gaps_of(placed, capacity):
    gaps = {}
    for size, _, number, first, each in placed:
        for k in range(number):
            c = first + k // each
            gaps[c] = gaps.get(c, capacity) - size
            assert gaps[c] >= 0
    return gaps


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_a_sweep_is_best_fit_decreasing(sizes):
    placed, none, left, opened = sweep([(s, 0, sizes.count(s)) for s in set(sizes)], [], 50, 0)
    gaps = gaps_of(placed, 50)
    assert sum(p[2] for p in placed) == len(sizes) and not none
    assert sorted(gaps.values()) == best_fit_decreasing(sizes, 50) and len(gaps) == opened
    assert sum(n for _, _, n in left) == sum(g > 0 for g in gaps.values())


def test_rounds_are_best_fit_decreasing(spark, monkeypatch):
    from voxloom.llm import packing

    g = np.random.default_rng(5)
    for k, (ranges, capacity) in enumerate([(512, 50), (512, 300), (16, 300), (40, 1000)]):
        monkeypatch.setattr(packing, "RANGE", ranges)
        sizes = np.clip(np.exp(g.normal(np.log(capacity / 6), 1.0, 2500)), 1, capacity).astype(int)
        counts = spark.createDataFrame([(int(s), int(n)) for s, n in zip(*np.unique(sizes, return_counts=True), strict=True)], "size bigint, n bigint")
        plan = [tuple(r) for r in packing_plan(counts, capacity).select("size", "rank", "number", "first", "each").collect()]
        assert sum(p[2] for p in plan) == len(sizes)
        got, want = gaps_of(plan, capacity), best_fit_decreasing(sizes.tolist(), capacity)
        if ranges == 512:
            assert sorted(got.values()) == want
        else:  # several ranges are swept at once
            assert len(got) <= 1.01 * len(want) + 1


def test_a_size_that_most_items_share(spark):
    rows = spark.range(0, 300_000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 97 + 1).otherwise(100).alias("tokens"), F.lit("x").alias("size"))
    got = packed(rows, "id", "tokens", 100)
    whole = got.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.sum("size").alias("tokens"), F.count_distinct("container").alias("containers")).first()
    each = got.groupBy("container").agg(F.sum("size").alias("held")).agg(F.max("held").alias("most"), F.count("*").alias("n")).first()
    sizes = [(s, int(((np.arange(0, 300_000, 3) % 97 + 1) == s).sum())) for s in range(1, 98)]
    placed, _, _, opened = sweep([(s, 0, n) for s, n in sizes] + [(100, 0, 200_000)], [], 100, 0)
    assert (whole.n, whole.ids) == (300_000, 300_000) and each.most == 100 and whole.containers == each.n == opened
    assert got.where("fill > 1 or fill <= 0").count() == 0


def test_containers(spark, sf):
    sizes = token_sizes(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text")
    extra = spark.createDataFrame([(-1, 0), (-2, 10_000), (-3, 4096), (None, 5), (-4, None)], "doc_id bigint, tokens bigint")
    rows = sizes.unionByName(extra)
    got = packed(rows, "doc_id", "tokens", 4096).collect()
    want = {r.doc_id: r.tokens for r in rows.where("doc_id is not null and tokens is not null").collect()}
    total, fill, pieces_ = {}, {}, {}
    for x in got:
        total[x.doc_id] = total.get(x.doc_id, 0) + x["size"]
        pieces_.setdefault(x.doc_id, []).append(x)
        if x.container is not None:
            fill[x.container] = fill.get(x.container, 0) + x["size"]
    assert total == want and all(f <= 4096 for f in fill.values())
    assert all(len(p) == max(1, -(-want[k] // 4096)) == p[0].n_pieces for k, p in pieces_.items())
    assert all(x.container is None for x in got if x["size"] == 0)
    assert len(fill) <= 1.05 * sum(want.values()) / 4096 + 1
    assert all(abs(x.fill - fill[x.container] / 4096) < 1e-6 for x in got if x.container is not None)
    assert packed(rows.limit(0), "doc_id", "tokens", 10).count() == 0
    with pytest.raises(ValueError):
        packed(rows, "doc_id", "tokens", 0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-1, 5), min_size=1, max_size=60), st.data())
def test_range_maximum(values, data):
    table = RangeMaximum(np.array(values, np.int8), data.draw(st.integers(1, 80)))
    a = data.draw(st.integers(0, len(values) - 1))
    b = data.draw(st.integers(a, len(values) - 1))
    best = max(values[a : b + 1])
    want = -1 if best < 0 else max(k for k in range(a, b + 1) if values[k] == best)
    assert table.best(a, b) == want


def test_pieces_keep_their_promises(spark, sf):
    odd = ["中" * 3000, "ก" * 2000, "a" * 4000, "x " * 2000, "ั" * 900, "字\n\n" * 500, "", " " * 3000, "😀" * 900, "it's " * 900, "one. two.\n\n" + "three " * 600]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit(1).alias("piece"))
    docs = docs.unionByName(spark.createDataFrame([(10_000 + k, t, 2) for k, t in enumerate(odd)] + [(None, "x", 3), (1, None, 3)], "doc_id bigint, text string, piece int"))
    texts = {r.doc_id: r.text for r in docs.where("doc_id is not null and text is not null").collect()}
    counter, by = tokens_of(), {}
    for x in pieces(docs, "doc_id", "text", 256, 32).collect():
        by.setdefault(x.doc_id, []).append(x)
    assert set(by) == set(texts)
    cut = shared = 0
    for k, ps in by.items():
        t, ps = texts[k], sorted(ps, key=lambda x: x.piece)
        assert [p.piece for p in ps] == list(range(len(ps))) and ps[0].begin == 0 and ps[-1].end == len(t)
        for a, b in zip(ps, ps[1:], strict=False):
            assert a.begin < b.begin <= a.end < b.end
            cut, shared = cut + 1, shared + (24 <= b.shared_tokens <= 64)
        for p in ps:
            assert p.piece_text == t[p.begin : p.end] and p.tokens == len(counter.encode(p.piece_text)) <= 256
    assert shared >= 0.9 * cut > 0
    assert pieces(docs.limit(0), "doc_id", "text", 256, 32).count() == 0
    with pytest.raises(ValueError):
        pieces(docs, "doc_id", "text", 10, 5)
