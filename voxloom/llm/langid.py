"""Language of each document and of each passage, by error-correcting output codes.

Every language has a codeword; for each bit a binary n-gram classifier is fitted that tells the
languages with a one from those with a zero. A passage's bits are predicted, and the codeword of
least weighted loss names its language; how far the next one is gives the confidence. A passage that
is far from every codeword is flagged, and one in a script of which there is no example is ``und``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.visible import LOOKS_LIKE, visible

ORDERS = (1, 2, 3)
TABLE_BITS = 16
LIMIT_EXAMPLES = 5_000  # labelled rows for each language that the classifiers are fitted on
WORDS_HELD = 300_000  # words whose scores a task keeps between batches
SWITCH = 10.0  # what a change of language within Latin script costs, in the words' units
AMBIGUOUS = 0.6
FAR = 1.5  # times the loss that held-out examples of the same length stay under, from which a passage is of no known language
UNKNOWN = "und"

# The least passage of each script that can be a clause, as letters and as words.
CLAUSE = {"Thai": (9, 1), "Laoo": (9, 1), "Hani": (5, 1), "Jpan": (9, 1), "Latn": (11, 3), "Zyyy": (9, 1)}
# Code points of the scripts that are told apart; all others with letters are taken together.
_THAI, _LAO, _LATN = "\u0e00-\u0e7f", "\u0e80-\u0eff", "A-Za-zÀ-ɏḀ-ỿ"
_HAN = "\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff"
_REST = "\u0370-\u0dff\u0f00-\u1dff\u1f00-\u1fff\u2c00-\u2dff\u3105-\u318f\ua000-\ua71f\ua800-\ud7ff\ufb1d-\ufdff\ufe70-\ufefc\U00010000-\U0001cfff\U0001e800-\U0001efff"
_CLASSES = {"Thai": _THAI, "Laoo": _LAO, "Hani": _HAN, "Latn": _LATN, "Zyyy": _REST}
_RUNS = re.compile("|".join(f"(?P<{k}>[{own}][^{''.join(c for n, c in _CLASSES.items() if n != k)}]*)" for k, own in _CLASSES.items()))
_WORD = re.compile("[^\\W\\d_]+(?:[’'-][^\\W\\d_]+)*")
_LATIN = re.compile("[a-zß-ɏḁ-ỿ]+(?:[’'-][a-zß-ɏḁ-ỿ]+)*")
_LETTER = {
    "Thai": re.compile("[฀-๎]"), "Laoo": re.compile("[຀-໅່-ໍໜ-ໟ]"), "Hani": re.compile(f"[{_HAN}]"), "Jpan": re.compile(f"[{_HAN}]"),
    "Latn": re.compile(f"[{_LATN}]"), "Zyyy": re.compile("[^\\W\\d_]"),
}
_KANA = re.compile("[\u3041-\u30ff]")
_MIXABLE = re.compile("[Ͱ-ϿЀ-ԯԱ-֏Ꭰ-Ᏼἀ-῿ɑɡ]")
_TOKEN = re.compile("[A-Za-zÀ-ɏḀ-ỿɑɡͰ-ϿЀ-ԯԱ-֏Ꭰ-Ᏼἀ-῿]+")
_MARKER = re.compile(r"\s*[\[(<{][A-Za-z_ ]+[\])>}]\s*")


def readable(text: str) -> str:
    """The text as it is seen, with look-alike letters of other scripts in words of Latin script taken for Latin ones.

    A word that has a Latin letter is Latin; one of look-alikes alone is, unless another word of the text has
    letters that only its own script has.
    """
    t = visible(text)
    if not _MIXABLE.search(t):
        return t
    own = any(c not in LOOKS_LIKE and _MIXABLE.match(c) for c in t)

    def word(m: re.Match[str]) -> str:
        w = m[0]
        latin = any(not _MIXABLE.match(c) for c in w)
        alike = all(c in LOOKS_LIKE for c in w if _MIXABLE.match(c))
        return "".join(LOOKS_LIKE.get(c, c) for c in w) if alike and (latin or not own) else w

    return _TOKEN.sub(word, t)


def script_runs(text: str) -> list[list]:
    """Runs of one script: begin, end, script, letters, and whether the run may be a clause."""
    runs = []
    for m in _RUNS.finditer(text):
        kind = m.lastgroup
        letters = len(_LETTER[kind].findall(m[0]))
        if kind == "Hani" and 10 * len(_KANA.findall(m[0])) >= letters:  # as much kana as no Chinese text has
            kind = "Jpan"
        runs.append([m.start(), m.end(), kind, letters, letters >= CLAUSE[kind][0] and (kind != "Latn" or len(_WORD.findall(m[0])) >= CLAUSE[kind][1])])
    return runs


def main_script(runs: Sequence[Sequence]) -> str | None:
    """The script of most letters, of which Chinese ones say as much as two others."""
    kinds: Counter[str] = Counter()
    for r in runs:
        kinds[r[2]] += r[3] * (2 if r[2] in ("Hani", "Jpan") else 1)
    return max(kinds, key=kinds.__getitem__) if kinds else None


def codewords(n: int) -> np.ndarray:
    """``n`` codewords of +1 and -1, rows of a Hadamard matrix that differ in half their bits."""
    size = 8
    while size < 2 * n + 1:
        size *= 2
    m = np.array([[1]])
    while len(m) < size:
        m = np.block([[m, m], [m, -m]])
    powers = [1 << k for k in range(size.bit_length() - 1)]
    rows = [*powers, *[r for r in range(size - 1, 0, -1) if r not in powers]][:n]
    code = m[rows][:, 1:]
    return code[:, np.abs(code.sum(1 - 1)) < n]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashes(points: np.ndarray) -> list[np.ndarray]:
    """For each order, the table slot of the n-gram that begins at every place."""
    out, h = [], np.zeros(len(points), np.uint64)
    for n in ORDERS:
        if n > len(points):
            out.append(np.zeros(0, np.int64))
            continue
        h = (h[: len(points) - n + 1] + points[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        out.append((h >> np.uint64(64 - TABLE_BITS)).astype(np.int64))
    return out


@dataclass
class LanguageModel:
    """Codewords, bit weights of every n-gram slot, and the weight of each bit."""

    languages: list[str]
    code: np.ndarray
    table: np.ndarray
    weight: np.ndarray
    scripts: frozenset[str] = frozenset()
    tolerance: tuple[float, float] = (np.inf, 0.0)
    index: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray | None = None

    def bits(self, texts: Sequence[str]) -> np.ndarray:
        """Mean evidence for every bit, a row for each text; above zero means a one."""
        out = np.zeros((len(texts), self.table.shape[1]), np.float32)
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (size == 0 or size + len(texts[end]) < 150_000):
                size += len(texts[end]) + 2
                end += 1
            self._bits(texts[start:end], out[start:end])
            start = end
        return out

    def _bits(self, texts: Sequence[str], out: np.ndarray) -> None:
        lower = [f" {t.lower()} " for t in texts]
        points = _points("".join(lower))
        lengths = np.array([len(t) for t in lower])
        ends = np.cumsum(lengths)
        counted = np.zeros(len(texts))
        for n, slots in zip(ORDERS, _hashes(points), strict=True):
            # N-grams that run over a text's end don't count, so that a text's evidence is its own.
            values = np.zeros((len(points), self.table.shape[1]), np.float32)
            values[: len(slots)] = self.table[slots]
            for k in range(1, n):
                values[ends - k] = 0
            out += np.add.reduceat(values, ends - lengths, axis=0)
            counted += np.maximum(lengths - n + 1, 0)
        out /= np.maximum(counted, 1)[:, None].astype(np.float32)

    def losses(self, bits: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of every codeword, a row for each row of ``bits``."""
        return np.stack([(self.weight * np.logaddexp(0, -4 * bits * word)).sum(1) for word in self.code], 1)

    def decode(self, texts: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Nearest codeword's language, confidence, and whether no codeword is near, of each text."""
        if not len(texts):
            return [], np.zeros(0), np.zeros(0, bool)
        loss = self.losses(self.bits(texts))
        size = np.sqrt(np.array([len(t) for t in texts]) + 1)
        p = np.exp(-(loss - loss.min(1, keepdims=True)) * size[:, None] * 2)
        best = loss.argmin(1)
        far = loss.min(1) > FAR * (self.tolerance[0] + self.tolerance[1] / size)
        return [self.languages[k] for k in best], np.where(far, 0.5, 1.0) / p.sum(1), far

    def learn(self, words: set[str]) -> None:
        """Keep the linear score for each language of every word, in one pass."""
        new = [w for w in words if w not in self.index]
        if new:
            size = np.array([len(w) + 1 for w in new])[:, None]
            rows = (self.bits(new) * self.weight) @ self.code.T * size / self.code.shape[1]
            begin, end = len(self.index), len(self.index) + len(new)
            if self.scores is None or len(self.scores) < end:  # room for as many again, so that a few words at a time cost little
                room = np.zeros((2 * end, rows.shape[1]))
                room[:begin] = self.scores[:begin] if self.scores is not None else 0
                self.scores = room
            self.scores[begin:end] = rows
            self.index.update(zip(new, range(begin, end), strict=True))

    def forget(self, most: int = WORDS_HELD) -> None:
        """Drop all words if there are more than ``most``: called between batches, so a batch always has its own."""
        if len(self.index) > most:
            self.index, self.scores = {}, None

    def passages(self, text: str) -> list[tuple[int, int]]:
        """Bounds of the stretches of one language in a text of Latin script.

        Viterbi over words: a change of language must earn what it costs.
        """
        words = list(_WORD.finditer(text))
        if len(words) < 6:
            return [(0, len(text))]
        keys = [m[0].lower() for m in words]
        self.learn({w for w in keys if w not in self.index})
        scores = self.scores[[self.index[w] for w in keys]]
        main = scores.sum(0).argmax()
        if (scores.max(1) - scores[:, main]).sum() < SWITCH:  # no change can earn its cost
            return [(0, len(text))]
        best, back = scores[0], []
        for row in scores[1:]:
            top = best.argmax()
            stay = best >= best[top] - SWITCH
            back.append(np.where(stay, np.arange(len(best)), top))
            best = np.where(stay, best, best[top] - SWITCH) + row
        path = [best.argmax()]
        for step in reversed(back):
            path.append(step[path[-1]])
        path.reverse()
        cuts = [0, *(words[i].start() for i in range(1, len(path)) if path[i] != path[i - 1]), len(text)]
        return list(zip(cuts, cuts[1:], strict=False))


def fit_language_model(examples: DataFrame, text: str, lang: str) -> LanguageModel:
    """Fit the bit classifiers on at most ``LIMIT_EXAMPLES`` labelled rows of each language.

    Rows with a null or blank text or language don't count. The sample is the rows with the
    smallest hashes, so it is the same however the table is laid out.
    """
    from pyspark.sql import Window

    rows = examples.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("t is not null and l is not null").distinct()
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("l").orderBy(F.xxhash64("t"), "t"))).where(F.col("n") <= LIMIT_EXAMPLES)
    return fit_on([(r.t, r.l) for r in rows.select("t", "l").collect()])


def fit_on(rows: Sequence[tuple[str, str]]) -> LanguageModel:
    """Binary classifiers of smoothed log odds over hashed n-grams, languages weighing alike.

    How great the loss of a known language gets at a given length is measured on every other example by the classifiers of the
    rest; with too few examples nothing is far.
    """
    clean = sorted((c, l) for t, l in rows if (c := readable(t).lower()))
    if not clean:
        raise ValueError("no labelled examples")
    model = _classifiers(clean)
    model.scripts = frozenset(k for t, _ in clean if (k := main_script(script_runs(t))))
    # Halves within each language, by place in the sorted order.
    half = {k: (clean[k::2], clean[1 - k :: 2]) for k in (0, 1)}
    if all({l for _, l in a} == set(model.languages) for a, _ in half.values()):
        loss, size = [], []
        for ours, rest in half.values():
            other = _classifiers(ours)
            loss.append(other.losses(other.bits([t for t, _ in rest])).min(1))
            size.append(1 / np.sqrt(np.array([len(t) for t, _ in rest]) + 1))
        y, x = np.concatenate(loss), np.concatenate(size)
        if len(y) >= 20:
            slope = max(0.0, float(np.polyfit(x, y, 1)[0]))
            model.tolerance = (float(np.quantile(y - slope * x, 0.995)), slope)
    return model


def _classifiers(clean: Sequence[tuple[str, str]]) -> LanguageModel:
    languages = sorted({l for _, l in clean})
    counts = np.zeros((len(languages), 1 << TABLE_BITS))
    for t, l in clean:
        for slots in _hashes(_points(f" {t} ")):
            np.add.at(counts[languages.index(l)], slots, 1)
    share = (counts + 0.02) / (counts.sum(1, keepdims=True) + 0.02 * counts.shape[1])
    code = codewords(len(languages))
    table = np.stack([np.log(share[c > 0].mean(0)) - np.log(share[c < 0].mean(0)) for c in code.T], 1).astype(np.float32)
    model = LanguageModel(languages, code, np.clip(table, -4, 4), np.ones(code.shape[1]))
    bits = model.bits([t for t, _ in clean])
    truth = code[[languages.index(l) for _, l in clean]]
    right = (bits * truth > 0).mean(0)
    model.weight = np.clip(np.log((right + 1e-3) / (1 - right + 1e-3)), 0.1, 6) / 6
    return model


def _join_around_loans(runs: list[list]) -> None:
    """Runs of one script with nothing but short Latin runs between them are a clause if they are one together."""
    for kind in ("Thai", "Laoo", "Hani", "Jpan", "Zyyy"):
        group: list[list] = []
        for r in [*runs, [0, 0, "", 0, True]]:
            if r[2] == kind:
                group.append(r)
            elif r[2] != "Latn" or r[4]:
                if sum(g[3] for g in group) >= CLAUSE[kind][0]:
                    for g in group:
                        g[4] = True
                group = []


def _pieces(model: LanguageModel, text: str) -> list[tuple[int, int, str]]:
    """Passages of a readable text that may be of different languages, as bounds and script.

    Runs of a script that are too short for a clause belong to the passage around them, as
    borrowed words do, unless the whole text is no longer.
    """
    runs = script_runs(text)
    if not runs:
        return []
    if not all(r[4] for r in runs):
        _join_around_loans(runs)
    full = [r for r in runs if r[4]]
    if not full:
        main = main_script(runs)
        full = [r for r in runs if r[2] == main]
    out: list[list] = []
    for r in full:
        if out and out[-1][2] == r[2]:
            out[-1][1] = r[1]
        else:
            out.append([r[0], r[1], r[2]])
    bounds = []
    for start, end, kind in out:
        if kind != "Latn":
            bounds.append((start, end, kind))
            continue
        inner = [r for r in full if r[2] == "Latn" and start <= r[0] < end]
        for a, b, *_ in inner:
            cut = [(a + x, a + y) for x, y in model.passages(text[a:b])]
            if len(cut) > 1:
                big = [c for c in cut if len(_WORD.findall(text[c[0] : c[1]])) >= 3 and len(_LETTER["Latn"].findall(text[c[0] : c[1]])) >= 11]
                cut = big or [(a, b)]
            bounds.extend((x, y, kind) for x, y in cut)
    return bounds


def language_passages(df: DataFrame, key: str, text: str, model: LanguageModel) -> DataFrame:
    """The languages of each text: ``key``, ``passage``, ``lang``, ``confidence``, ``ambiguous``, ``n_letters``, ``passage_text``.

    One row for each passage, numbered from 0 in the text's order. Null and blank texts, bracketed
    markers and bare numbers have no language and give no row. The passage is in the text's
    readable form. A passage in a script of which the model has no example is ``und``, with the confidence of
    chance; one that no codeword is near keeps the nearest, at half the confidence. Both are ``ambiguous``.
    Repeated rows give repeated passages; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chance = 1 / (len(model.languages) + 1)
        for batch in batches:
            ids, numbers, texts, known = [], [], [], []
            rows = [(i, readable(t)) for i, t in enumerate(batch.column(1).to_pylist()) if t and not _MARKER.fullmatch(t)]
            model.forget()
            model.learn({w for _, t in rows for w in _LATIN.findall(t.lower())})
            for i, t in rows:
                for n, (a, b, script) in enumerate(_pieces(model, t)):
                    ids.append(i)
                    numbers.append(n)
                    texts.append(t[a:b])
                    known.append(script in model.scripts)
            langs, sure, far = model.decode(texts)
            known = np.array(known, bool)
            langs = [lang if k else UNKNOWN for lang, k in zip(langs, known, strict=True)]
            sure = np.where(known, sure, chance)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(ids, pa.int64())), pa.array(numbers, pa.int32()), pa.array(langs, pa.string()), pa.array(sure, pa.float64()),
                    pa.array((sure < AMBIGUOUS) | far, pa.bool_()), pa.array([sum(map(str.isalpha, t)) for t in texts], pa.int32()), pa.array(texts, pa.string()),
                ],
                ["key", "passage", "lang", "confidence", "ambiguous", "n_letters", "passage_text"],
            )

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, passage int, lang string, confidence double, ambiguous boolean, n_letters int, passage_text string"
    )
    return out.withColumnRenamed("key", key)


# Codes and names by which a label names a language, in lower case.
NAMES = {
    "th": ["th", "tha", "thai", "siamese", "ไทย", "ภาษาไทย"],
    "en": ["en", "eng", "english", "anglais", "อังกฤษ", "ภาษาอังกฤษ"],
    "vi": ["vi", "vie", "vn", "viet", "vietnamese", "việt"],
    "id": ["id", "ind", "in", "indonesian", "indonesia", "bahasa"],
    "lo": ["lo", "lao", "laotian", "laos", "ລາວ", "ພາສາລາວ"],
    "zh": ["zh", "zho", "chi", "cmn", "chinese", "mandarin", "中文", "汉语", "普通话"],
    "fr": ["fr", "fra", "fre", "french", "français", "francais"],
}


def label_names(label: Column, lang: Column) -> Column:
    """Whether a label, in any code or name, names the language ``lang``; null names none."""
    words = F.split(F.lower(F.coalesce(label, F.lit(""))), r"[^\p{L}\p{M}]+")
    main = F.filter(words, lambda w: w != "")
    # After a language, what follows is a region or a script ("th-TH", "vi_VN"), unless it is a list.
    region = F.coalesce(label, F.lit("")).rlike(r"^\s*\p{L}+[-_]\p{L}+\s*$")
    main = F.when(region, F.slice(main, 1, 1)).otherwise(main)
    out = F.lit(False)
    for code, names in NAMES.items():
        out = out | ((lang == code) & F.arrays_overlap(main, F.array(*map(F.lit, names))))
    return out


def unnamed_languages(df: DataFrame, key: str, text: str, label: str, model: LanguageModel) -> DataFrame:
    """``key`` and ``lang``: each known language of a text that its label doesn't name, once."""
    rows = df.select(F.struct(F.col(key).alias("k"), F.col(label).alias("l")).alias("row"), F.col(text).alias("text"))
    found = language_passages(rows, "row", "text", model)
    return found.where(F.col("lang") != UNKNOWN).where(~label_names(F.col("row.l"), F.col("lang"))).select(F.col("row.k").alias(key), "lang").distinct()
