"""Look-alike text, languages, leaks and tokens against brute force and held-out rows."""

import random
import unicodedata

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voxloom.llm.fold import folded, window_hashes
from voxloom.llm.langid import fit_on, label_names, language_passages, readable, unnamed_languages
from voxloom.llm.leaks import leaked, leaked_items, passage, seed_tables, tiles
from voxloom.llm.lookalike import Lattice, bigrams, consistent_text, lookalike_members, lookalike_pairs
from voxloom.llm.tokens import tokens_of
from voxloom.llm.visible import skeleton, visible


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("Ｗｉ－Ｆｉ　１２", "Wi-Fi 12"), ("Роdсаst", "Podcast"), ("น้ี", "นี้"), ("เเล้ว", "แล้ว"), ("นํ้า", "น้ำ"), ("นำ", "นํา"), ("ເເລະ", "ແລະ"),
        ("cáfé", "cáfé"), ("ﬁn oﬃce", "fin office"), ("a​b­﻿", "ab"), ("a b c", "a b c"), ("⽔⾳", "水音"), ("你，好", "你,好"), ("ὸ", "ò"), ("  a  b ", "a b"), ("a\r\nb", "a\nb"),
    ],
)
def test_same_look(a, b):
    assert skeleton(a) == skeleton(b)


@pytest.mark.parametrize(("a", "b"), [("m²", "m2"), ("Abc", "abc"), ("cafe", "café"), ("น้ำ", "น่ำ"), ("๑๒", "12"), ("l1", "I1"), ("a b", "ab"), ("a,b", "a.b")])
def test_other_look(a, b):
    assert skeleton(a) != skeleton(b)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(blacklist_categories=["Cs"]), max_size=30))
def test_skeleton_is_stable(text):
    once = skeleton(text)
    assert skeleton(once) == once == skeleton(unicodedata.normalize("NFC", once))


def test_lattice_reads_the_script_of_the_corpus():
    counts = bigrams(__import__("collections").Counter({"привет": 50, "море": 80, "рука": 40, "мама": 60, "сосна": 20, "the": 90, "hotel": 50, "cop": 30, "hop": 30}))
    form = Lattice(counts)
    assert form("мope pyкa") == "море рука" and form("hоtel сор") == "hotel cop"
    for word in ("мope", "pyкa", "сор", "hоtel", "xyz"):
        assert form(form(word)) == form(word) == form(skeleton(word))


def test_the_path_decides_the_form():
    counts = bigrams(__import__("collections").Counter({"привет": 50, "море": 80, "рука": 40, "podcast": 90, "paypal": 50, "hotel": 30}))
    form = Lattice(counts)
    for a, b, best in (("Роdсаst", "Podcast", "Podcast"), ("pаypаl", "paypal", "paypal"), ("рyкa", "pука", "рука"), ("ｍοре", "mope", None)):
        assert visible(a) != visible(b) and form(a) == form(b) and best in (None, form(a))
    assert form("hоtеl").isascii()
    # Without the search these would be different strings: nothing else brings them together.
    assert form("ᎠᎡ") == form("DR") and form("օոս") == form("onu") and form("ſo") != form("so") and form("ɡo") == form("go")


def test_members_name_what_pairs_name(spark):
    rows = [(f"a{k:04d}", "Hi") for k in range(1500)] + [("b1", "Ｈi"), ("b2", "Ｈi"), ("c", "Нi"), ("d", "other"), ("d", "other")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "id string, transcript string, class string")
    pairs = lookalike_pairs(df, "id", "transcript").collect()
    members = {r.id: r for r in lookalike_members(df, "id", "transcript").collect()}
    links = {}
    for p in pairs:
        for x in (p.id_a, p.id_b):
            links[x] = links.get(x, 0) + 1
    assert len(pairs) == 1500 * 3 + 2 == len({tuple(p) for p in pairs}) and {k: m.n_links for k, m in members.items()} == links
    assert {(m["class"], m.n_strings) for m in members.values()} == {("a0000", 3)}
    assert lookalike_members(df.limit(0), "id", "transcript").count() == 0


def test_pairs_against_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/samples.parquet").select("id", "transcript").toPandas().drop_duplicates()
    texts = [(r.id, r.transcript, skeleton(r.transcript)) for r in rows.itertuples() if r.transcript]
    texts += [(f"X{k}", t, skeleton(t)) for k, t in enumerate(["Ｈi", "Hi", "Hi", "Нi", "", " ", "​"])]
    by = {}
    for i, t, s in texts:
        by.setdefault(s, []).append((i, t))
    want = {(min(a, b), max(a, b)) for s, g in by.items() if s for a, x in g for b, y in g if x != y and a != b}
    got = lookalike_pairs(spark.createDataFrame([(i, t, 1) for i, t, _ in texts] + [(None, "Hi", 2), ("Z", None, 3), ("X1", "Hi", 9)], "id string, transcript string, h int"), "id", "transcript")
    assert {tuple(r) for r in got.collect()} == want and len(want) >= 5
    empty = spark.createDataFrame([], "id string, transcript string")
    assert lookalike_pairs(empty, "id", "transcript").count() == 0
    out = consistent_text(spark.createDataFrame([("a", " Ｈi "), ("b", None), ("c", "")], "id string, transcript string"), "transcript", "form").collect()
    assert [(r.id, r.form) for r in out] == [("a", "Hi"), ("b", None), ("c", "")]


@pytest.fixture(scope="module")
def examples(sf):
    return pd.read_parquet(f"{sf}/lang_examples.parquet")


def test_held_out_languages(examples):
    half = examples[examples.example_id % 2 == 0]
    model = fit_on(list(zip(half.text, half.lang, strict=True)))
    rest = examples[examples.example_id % 2 == 1]
    langs, sure, far = model.decode([readable(t) for t in rest.text])
    assert (np.array(langs) == rest.lang.to_numpy()).mean() > 0.97 and sure.min() > 0 and far.mean() < 0.05


def test_unknown_languages_are_flagged(spark, examples):
    model = fit_on(list(zip(examples.text, examples.lang, strict=True)))
    rows = [
        ("ru", "Сегодня хорошая погода, и мы идём гулять в парк"), ("ja", "日本語の文章は漢字と仮名で書かれています"), ("ko", "오늘은 날씨가 정말 좋네요 산책 갈까요"),
        ("de", "Der Hund läuft schnell über die Straße und bellt laut"), ("en", "she carefully opened the old book ก " + "8" * 88), ("la", "Роdсаst about the weather and nothing else"), ("zh", "今天天气很好我们去公园散步吧"),
    ]
    got = {x.id: x for x in language_passages(spark.createDataFrame(rows, "id string, t string"), "id", "t", model).collect()}
    assert len(got) == len(rows)
    assert all(got[k].lang == "und" and got[k].ambiguous and got[k].confidence < 0.2 for k in ("ru", "ja", "ko"))
    assert got["de"].ambiguous and got["de"].confidence <= 0.5
    assert (got["en"].lang, got["la"].lang, got["zh"].lang) == ("en", "en", "zh") and not got["en"].ambiguous and not got["zh"].ambiguous
    assert unnamed_languages(spark.createDataFrame([(*r, None) for r in rows[:3]], "id string, t string, l string"), "id", "t", "l", model).count() == 0


def test_any_number_of_words(examples):
    model = fit_on(list(zip(examples.text, examples.lang, strict=True)))
    few = "old books about the weather and the sea".split()
    first = model.passages(" ".join(few))
    alone = model.scores[[model.index[w] for w in few]]
    model.learn({f"{a}{b}{c}{d}" for a in "bcdfghjklmnpqrstvwxz" for b in "aeioubcdfghjklmnpqrst" for c in "bcdfghjklmnpqrstvwxzaeiou" for d in "abcdefghijklmnopqrstuvwxyz"} | {f"word{'abcdefghij'[k % 10]}{k}" for k in range(150_000)})
    assert len(model.index) > 400_000
    model.forget()
    assert model.passages(" ".join(few)) == first and np.allclose(model.scores[[model.index[w] for w in few]], alone, atol=1e-6)


def test_mixed_passages(spark, examples):
    half, rest = examples[examples.example_id % 2 == 0], examples[examples.example_id % 2 == 1]
    model = fit_on(list(zip(half.text, half.lang, strict=True)))
    r, rows, truth = random.Random(1), [], {}
    parts = {k: [t for t in g.text if len(t) > 25] or list(g.text) for k, g in rest.groupby("lang")}
    for n in range(120):
        a, b = r.sample(sorted(parts), 2)
        rows.append((str(n), r.choice(parts[a]) + r.choice([" ", ", ", " / "]) + r.choice(parts[b]), a))
        truth[str(n)] = {b}
    got = {}
    for x in unnamed_languages(spark.createDataFrame(rows, "id string, t string, l string"), "id", "t", "l", model).collect():
        got.setdefault(x.id, set()).add(x["lang"])
    assert sum(got.get(k) == v for k, v in truth.items()) >= 114


def test_texts_without_language(spark, examples):
    model = fit_on(list(zip(examples.text, examples.lang, strict=True)))
    rows = [("1", None, "th"), ("2", "  ", None), ("3", "[INAUDIBLE]", None), ("4", "12 30", None), ("5", "โอเคครับ", "th_TH"), ("6", "โอเคครับ", None), ("7", "ก" * 50_000, "en"), (None, "โอเคครับ", "")]
    df = spark.createDataFrame(rows, "id string, t string, l string")
    assert {tuple(x) for x in unnamed_languages(df, "id", "t", "l", model).collect()} == {("6", "th"), ("7", "th"), (None, "th")}
    loans = [("8", "she carefully opened the old book with a friend last week เธออ่าน Podcast ริมคลอง", "en"), ("9", "เธออ่าน noise floor ริมคลองกับเพื่อน", "th")]
    assert {tuple(x) for x in unnamed_languages(spark.createDataFrame(loans, "id string, t string, l string"), "id", "t", "l", model).collect()} == {("8", "th")}
    assert language_passages(df.limit(0), "id", "t", model).count() == 0
    from pyspark.sql import functions as F

    named = spark.createDataFrame([(x,) for x in ["th-TH", "TH", "Thai", "tha", "ไทย", "en/th", "vi-VN", "-", "", None]], "l string").select(label_names(F.col("l"), F.lit("th")).alias("n"))
    assert [x.n for x in named.collect()] == [True] * 6 + [False] * 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"]) | st.sampled_from(" '\nนี้ก็asдcmt12中，"), max_size=25), max_size=4))
def test_token_counts_are_exact(texts):
    counter = tokens_of()
    assert counter.count(texts).tolist() == [len(counter.encode(t)) for t in texts]


def test_folding():
    letters, offsets = folded(["Ｃáfé, แล้ว", "", "CAFE เเลว!"])
    a, b = letters[offsets[0] : offsets[1]], letters[offsets[2] : offsets[3]]
    assert a.tolist() == b.tolist() and offsets[1] == offsets[2]
    h = window_hashes(np.array([1, 2, 3, 1, 2, 3], np.uint32), 3)
    assert h[0] == h[3] and len(set(h.tolist())) == 3 and len(window_hashes(letters, 99)) == 0


@pytest.mark.parametrize("block", [1_000_000, 300])
def test_tiling_finds_order_and_not_shuffles(spark, monkeypatch, block):
    from voxloom.llm import leaks

    monkeypatch.setattr(leaks, "BLOCK", block)
    r = random.Random(7)
    word = lambda: "".join(r.choice("bcdfghjklmnpqrstvwxz") + r.choice("aeiou") for _ in range(r.randint(1, 4)))
    items = [[word() for _ in range(90)] for _ in range(6)]
    filler = lambda n: [word() for _ in range(n)]
    half, slipped = items[1][20:72], list(items[2])
    for k in range(0, 90, 14):
        slipped[k] = word()
    blocks = [items[3][k : k + 10] for k in range(0, 90, 10)]
    r.shuffle(blocks)
    docs = [
        (1, " ".join(filler(200) + items[0] + filler(50))), (2, "\n".join(filler(30) + half).upper()), (3, "".join(slipped)), (4, " ".join(sum(blocks, []))), (5, " ".join(filler(50) + items[4][:25])),
        (6, None), (7, ""), (8, " ".join(filler(400))), (9, " ".join(items[0] + filler(9) + items[5])), (9, " ".join(items[0])),
    ]
    held = spark.createDataFrame([(i, " ".join(t), 0) for i, t in enumerate(items)] + [(77, "", 0), (78, None, 0), (79, "a", 0)], "item int, text string, k int")
    got = leaked_items(spark.createDataFrame(docs, "doc bigint, text string"), "doc", "text", held, "item", "text").collect()
    assert {(x.doc, x.item) for x in got} == {(1, 0), (2, 1), (3, 2), (9, 0), (9, 5)}
    assert all(0.5 <= x.coverage <= 1 for x in got)
    assert leaked_items(spark.createDataFrame(docs, "doc bigint, text string"), "doc", "text", held.limit(0), "item", "text").count() == 0


def _letters(r, n):
    return "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))


def test_slips_at_any_distance_that_leaves_seeds():
    r = random.Random(1)
    for every in (18, 20, 24, 32):
        for _ in range(10):
            item = _letters(r, 400)
            part = list(item[50:350])
            for k in range(0, 300, every):
                part[k] = r.choice([c for c in "abcdefgh" if c != part[k]])
            letters, offsets = folded([item])
            doc = _letters(r, 5000) + "".join(part) + _letters(r, 900)
            assert [x[:2] for x in leaked(*folded([_letters(r, 99), doc]), seed_tables(letters, offsets), np.diff(offsets), 0.5)] == [(1, 0)]


def test_what_many_items_share_is_looked_up_once():
    import tracemalloc

    r = random.Random(2)
    shared = _letters(r, 80)
    items = [_letters(r, 220) + shared for _ in range(2000)] + [shared + shared[:40]]
    letters, offsets = folded(items)
    tables, length = seed_tables(letters, offsets), np.diff(offsets)
    doc = "".join(_letters(r, 40) + shared for _ in range(100)) + items[7]
    tracemalloc.start()
    got = leaked(*folded([doc]), tables, length, 0.5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {x[1] for x in got} == {7, 2000} and peak < 200_000_000


def test_periodic_texts_end():
    letters, offsets = folded(["ab" * 400, "xyz" * 100])
    got = leaked(*folded(["ab" * 30_000 + "xyz" * 90]), seed_tables(letters, offsets), np.diff(offsets), 0.5)
    assert {x[1] for x in got} == {0, 1}


def test_letters_beyond_the_basic_plane():
    letters, offsets = folded(["𝐀𝐛𝐜 𠀀", "abc"])
    assert letters[: offsets[1]].tolist() == [ord("a"), ord("b"), ord("c"), 0x20000] and letters[offsets[1] :].tolist() == letters[:3].tolist()


def test_tiles_do_not_overlap():
    a = "abcdefghij" * 3
    at, place = zip(*[(i, j) for i in range(len(a) - 3) for j in range(len(a) - 3) if a[i : i + 4] == a[j : j + 4]], strict=True)
    marked = tiles(np.array(at), np.array(place), 4)
    assert marked == [(0, 0, 30)] and passage(marked) == 30
