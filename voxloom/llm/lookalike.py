"""One consistent form for text that looks the same in different characters.

Ignorable characters are deleted and compatibility forms that look alike are mapped; what is
left ambiguous is the script of look-alike letters. Each token is a lattice with, at every place,
the letters of all scripts that look like the one written there, and the best path under character
bigram scores that are kept apart by script (a change of script within a token is penalised) is
the token's form: the path alone decides in which script a letter comes out. Equal-looking tokens have
equal lattices, so they get one form, and a path never leaves the looks of its places, so others don't.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.visible import ARMENIAN, CHEROKEE, CYRILLIC, GREEK, LOOKS_LIKE, visible
from voxloom.session import cut_lineage, drop_table

SWITCH = -8.0
SMOOTHING = 0.5
PART = 1024  # rows of one string that meet the rows of another in one group
_FOREIGN = "Ͱ-ϿЀ-ԯԱ-֏Ꭰ-Ᏼἀ-῿"
_TOKEN = re.compile(f"[A-Za-zÀ-ɏɑɡḀ-ỿ{_FOREIGN}\u0300-\u036f]+")
_OTHER = re.compile(f"[ɑɡ{_FOREIGN}]")


def script(char: str) -> str | None:
    """The script of a letter of a token; None for a mark, which belongs to any."""
    point = ord(char)
    if point < 0x370:
        return None if 0x300 <= point else "Latn"
    if point < 0x400 or 0x1F00 <= point < 0x2000:
        return "Grek"
    return "Cyrl" if point < 0x530 else "Armn" if point < 0x590 else "Cher" if 0x13A0 <= point < 0x1400 else "Latn"


# By look, the letter of each script that is drawn so.
_READINGS: dict[str, dict[str, str]] = defaultdict(dict)
for _letter in GREEK + CYRILLIC + ARMENIAN + CHEROKEE:
    _READINGS[LOOKS_LIKE[_letter]].setdefault(script(_letter), _letter)
for _latin in set(LOOKS_LIKE.values()):
    _READINGS[_latin]["Latn"] = _latin


def bigrams(tokens: Counter[str]) -> Counter[tuple[str, str, str]]:
    """Bigrams of the tokens that are written in one script, with their counts."""
    out: Counter[tuple[str, str, str]] = Counter()
    for token, n in tokens.items():
        scripts = {script(c) for c in token} - {None}
        if len(scripts) == 1:
            s = scripts.pop()
            for x, y in zip(f"^{token}", f"{token}$", strict=True):
                out[s, x, y] += n
    return out


class Lattice:
    """Viterbi decoding of look-alike letters under per-script bigram scores."""

    def __init__(self, counts: dict[tuple[str, str, str], int]) -> None:
        self.counts = counts
        self.total: Counter[str] = Counter()
        self.script: Counter[str] = Counter()
        for (s, x, _), n in counts.items():
            self.total[LOOKS_LIKE.get(x, x)] += n
            self.script[s] += n
        everything = sum(self.script.values())
        self.prior = {s: math.log((self.script[s] + 1) / (everything + 5)) for s in ("Latn", "Grek", "Cyrl", "Armn", "Cher")}
        self.foreign = any(n for s, n in self.script.items() if s != "Latn")
        self.known: dict[str, str] = {}
        self.scores: dict[tuple[str, str, str], float] = {}

    def score(self, s: str, x: str, y: str) -> float:
        """Log of the bigram's share among all spellings that look like ``x`` and a next letter."""
        at = (s, x, y)
        if at not in self.scores:
            self.scores[at] = math.log((self.counts.get(at, 0) + SMOOTHING) / (self.total[LOOKS_LIKE.get(x, x)] + 100 * SMOOTHING))
        return self.scores[at]

    def token(self, token: str) -> str:
        """The best spelling of a token, whichever of its spellings is given."""
        parts = [LOOKS_LIKE.get(c, c) for c in unicodedata.normalize("NFD", token)]
        look = "".join(parts)
        if look in self.known:
            return self.known[look]
        marks, places = [""], []
        for c in parts:
            s = script(c)
            if s is None:
                marks[-1] += c
            else:
                places.append(_READINGS.get(c) or {s: c})
                marks.append("")
        best = ""
        if places:
            # Latin is tried first, so that it wins where scripts score alike.
            paths = {s: (self.prior[s] + self.score(s, "^", c), c) for s, c in sorted(places[0].items(), key=lambda x: (x[0] != "Latn", x[0]))}
            for place in places[1:]:
                paths = {
                    s: max(
                        ((w + (self.score(s, path[-1], c) if s == before else SWITCH + self.score(s, "^", c)), path + c) for before, (w, path) in paths.items()),
                        key=lambda x: x[0],
                    )
                    for s, c in sorted(place.items(), key=lambda x: (x[0] != "Latn", x[0]))
                }
            best = max((w + self.score(s, path[-1], "$"), s == "Latn", path) for s, (w, path) in paths.items())[2]
        out = self.known[look] = unicodedata.normalize("NFC", marks[0] + "".join(c + m for c, m in zip(best, marks[1:], strict=True)))
        return out

    def __call__(self, text: str) -> str:
        t = visible(text)
        # With letters and counts of Latin only, the path through Latin is the best: the others have its looks, but no counts.
        if not self.foreign and not _OTHER.search(t):
            return t
        if len(self.known) > 500_000:
            self.known.clear()
        return _TOKEN.sub(lambda m: self.token(m[0]), t)


def fit_bigrams(df: DataFrame, text: str) -> dict[tuple[str, str, str], int]:
    """Counts of per-script character bigrams over all rows.

    Each task sends one row for each distinct bigram, and so does the result: three alphabets
    of under 1,500 letters in all bound it, whatever the number of texts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[tuple[str, str, str]] = Counter()
        for batch in batches:
            tokens: Counter[str] = Counter()
            for t in batch.column(0).to_pylist():
                if t:
                    tokens.update(_TOKEN.findall(t))
            total.update(bigrams(tokens))
        s, x, y = zip(*total, strict=True) if total else ((), (), ())
        yield pa.RecordBatch.from_pydict({"s": pa.array(s, pa.string()), "x": pa.array(x, pa.string()), "y": pa.array(y, pa.string()), "n": pa.array(total.values(), pa.int64())})

    parts = df.select(df[text]).mapInArrow(count, "s string, x string, y string, n bigint")
    return {(r.s, r.x, r.y): r.n for r in parts.groupBy("s", "x", "y").sum("n").withColumnRenamed("sum(n)", "n").toLocalIterator()}


def consistent_text(df: DataFrame, text: str, output: str) -> DataFrame:
    """Add ``output``: the column ``text`` in its one consistent form.

    Null stays null and blank text becomes empty. All other columns are passed on; an existing
    column ``output`` is replaced. Equal rows give equal rows, and an empty table an empty one.
    """
    counts = fit_bigrams(df, text)
    plain = df.drop(output) if output != text else df

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = Lattice(counts)
        for batch in batches:
            new = pa.array([None if t is None else form(t) for t in batch.column(text).to_pylist()], pa.string())
            names = [n for n in batch.schema.names if n != output]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), new], [*names, output])

    kept = [f for f in plain.schema.fields if f.name != output]
    return plain.select(*[f"`{f.name}`" for f in kept], *([f"`{output}`"] if output == text else [])).mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{output}` string"]))


def lookalike_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """For each row with a visible text: ``id``, its class (``k1``, ``k2``) and its exact string (``h``).

    The class is a hash of the text's consistent form, so rows share a class if and only if the lattice gives
    their texts one form. Null and blank texts have no class: nothing is to be seen of them.
    """
    counts = fit_bigrams(df, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        form = Lattice(counts)
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for batch in batches:
            ids, k1, k2, hs = [], [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i is not None and t and (f := form(t)):
                    k = xxhash.xxh3_128_intdigest(f.encode())
                    ids.append(i)
                    k1.append(signed(k >> 64))
                    k2.append(signed(k & (1 << 64) - 1))
                    hs.append(signed(xxhash.xxh3_64_intdigest(t.encode())))
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.string()), "k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int64()), "h": pa.array(hs, pa.int64())})

    return df.select(df[key].cast("string").alias("id"), df[text].alias("text")).mapInArrow(run, "id string, k1 bigint, k2 bigint, h bigint")


def _of_mixed_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows, once each, of the classes that hold more than one string."""
    rows = cut_lineage(lookalike_classes(df, key, text), "lookalike")
    mixed = rows.groupBy("k1", "k2").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo < hi").select("k1", "k2")
    kept = cut_lineage(rows.join(mixed, ["k1", "k2"], "left_semi").distinct(), "lookalike-mixed")
    drop_table(rows)
    return kept


def lookalike_members(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each id and string that looks like another: ``id``, ``class`` (its smallest id), ``n_strings``, ``n_links``.

    ``n_links`` is the number of other rows of the class whose string is a different one. It is as long as the
    table at most, however many copies a string has. Null ids, and null or blank texts, give nothing.
    """
    rows = _of_mixed_classes(df, key, text)
    strings = rows.groupBy("k1", "k2", "h").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    classes = strings.groupBy("k1", "k2").agg(F.sum("n").alias("whole"), F.count("*").alias("n_strings"), F.min("first").alias("class"))
    counted = strings.join(classes, ["k1", "k2"]).select("k1", "k2", "h", "class", "n_strings", (F.col("whole") - F.col("n")).alias("n_links"))
    return rows.join(counted, ["k1", "k2", "h"]).select("id", "class", "n_strings", "n_links")


def lookalike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """Pairs of rows whose texts are different strings that look the same: ``id_a`` < ``id_b``.

    Only strings are compared with each other, one for each group of exact copies. The rows of two strings
    that look the same meet in groups of at most about ``PART`` by ``PART``, so no task gets all copies of a string.
    Classes of a single string, however many copies it has, are left out before anything is joined. Repeated rows of
    an id give no pair and no second row. Null ids, and null or blank texts, give nothing. For data with many
    copies of equal-looking strings, :func:`lookalike_members` says the same in one row an id.
    """
    rows = _of_mixed_classes(df, key, text)
    strings = rows.groupBy("k1", "k2", "h").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    rows = rows.join(strings, ["k1", "k2", "h"]).select("k1", "k2", "h", "id", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))
    a = strings.select("k1", "k2", F.col("h").alias("ha"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("pa"))
    b = strings.select("k1", "k2", F.col("h").alias("hb"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("pb"))
    links = a.join(b, ["k1", "k2"]).where("ha < hb")
    links = links.join(rows.select("k1", "k2", F.col("h").alias("ha"), F.col("part").alias("pa"), F.col("id").alias("ia")), ["k1", "k2", "ha", "pa"])
    links = links.join(rows.select("k1", "k2", F.col("h").alias("hb"), F.col("part").alias("pb"), F.col("id").alias("ib")), ["k1", "k2", "hb", "pb"])
    return links.where("ia <> ib").select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b")).distinct()
