"""Texts cut into pieces within a limit of tokens, at the strongest boundaries.

Every place where a text may be cut has a strength: paragraph, line or turn, sentence, clause, word,
and last any place between two characters that keeps marks with their letters. A sparse table of
range maxima over these strengths, one for a whole batch of texts, gives the strongest cut of each
permissible window in constant time, the rightmost if several are as strong. The next piece begins
``overlap`` tokens before the cut.

Only places at which the vocabulary splits a text anyway are taken where there are such: what lies
between two of them has the same tokens in the piece as in the text, so the piece's size is known
without encoding it. Where a window has none, its characters are tried and the piece is measured.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.tokens import TOKENIZERS, VOCABULARY, Sized, Tokens, tokens_of

PARAGRAPH, LINE, SENTENCE, CLAUSE, WORD, ANYWHERE = 5, 4, 3, 2, 1, 0
STRENGTHS = ["anywhere", "word", "clause", "sentence", "line", "paragraph"]
# Characters that end sentences and clauses.
_SENTENCE = ".!?…。！？｡ฯ៕।"
_CLAUSE = ",;:，；：、､"
BATCH_CHARS = 1_000_000


@cache
def _glued() -> np.ndarray:
    """Characters that may not begin a piece: they change the one before them."""
    return np.array([unicodedata.category(chr(p)) in ("Mn", "Mc", "Me") or p in (0x200D, 0x0E33, 0x0EB3) or 0xFE00 <= p < 0xFE10 for p in range(1 << 16)])


def strengths(points: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Strength of a cut before each place, -1 where none is allowed; places are inside the texts."""
    n = len(points)
    out = np.full(len(places), ANYWHERE, np.int8)
    if not n:
        return out
    here, before = points[np.minimum(places, n - 1)], points[np.maximum(places - 1, 0)]
    blank = (here == 32) | (here == 9) | (here == 0x3000) | (here == 0xA0)
    # What stands before the blanks decides: a stretch carries its blank in front.
    out[blank | (before == 32) | (before == 0x3000)] = WORD
    ahead = points[np.minimum(places + 1, n - 1)]
    thai = blank & ((ahead >= 0x0E00) & (ahead < 0x0F00)) & ((before >= 0x0E00) & (before < 0x0F00))
    out[thai] = CLAUSE  # a blank between two words of a script without word spaces parts clauses
    ends = lambda chars: np.isin(before, np.array([ord(c) for c in chars], np.uint32))
    full = np.isin(before, np.array([ord(c) for c in "。！？｡，；：、､"], np.uint32))
    out[ends(_CLAUSE) & (blank | full)] = CLAUSE
    out[ends(_SENTENCE) & (blank | full)] = SENTENCE
    newline = (before == 10) & (here != 10)
    out[newline] = LINE
    second = points[np.maximum(places - 2, 0)]
    third = points[np.maximum(places - 3, 0)]
    out[newline & (places >= 2) & ((second == 10) | ((second == 13) & (third == 10)))] = PARAGRAPH
    out[_glued()[np.minimum(here, 0xFFFF)] | ((here == 10) & (before == 13))] = -1
    return out


class RangeMaximum:
    """Sparse table: the rightmost place of the largest value in any range up to ``longest`` places."""

    def __init__(self, values: np.ndarray, longest: int) -> None:
        n = len(values)
        self.n = n
        key = values.astype(np.int64) * (n + 1) + np.arange(n)
        self.levels = [key]
        width = 1
        while 2 * width <= min(longest, n):
            last = self.levels[-1]
            self.levels.append(np.maximum(last[: n - 2 * width + 1], last[width : n - width + 1]))
            width *= 2

    def best(self, first: int, last: int) -> int:
        """Place of the largest value in ``first`` to ``last``, both included."""
        level = min((last - first + 1).bit_length() - 1, len(self.levels) - 1)
        width = 1 << level
        key = max(int(self.levels[level][at]) for at in (*range(first, last - width + 2, width), last - width + 1))
        return key % (self.n + 1) if key >= 0 else -1


def _cuts(counter: Tokens, sized: Sized, texts: list[str], limit: int, overlap: int) -> Iterator[tuple[int, int, int, int, int, int, int]]:
    """(text, piece, begin, end, tokens, shared tokens, strength) of all pieces of the batch."""
    starts, tokens, offsets, points = sized.starts, sized.tokens, sized.offsets, sized.points
    inside = strengths(points, starts)
    inside[np.searchsorted(starts, offsets[:-1][offsets[:-1] < len(points)])] = PARAGRAPH
    inside[-1] = PARAGRAPH
    table = RangeMaximum(inside, limit + 1)
    low = np.searchsorted(starts, offsets)
    sizes = sized.totals()
    for k in range(len(texts)):
        base, end = int(offsets[k]), int(offsets[k + 1])
        if sizes[k] <= limit:
            yield k, 0, 0, end - base, int(sizes[k]), 0, PARAGRAPH
            continue
        at, stop, piece, shared, done = int(low[k]), int(low[k + 1]), 0, 0, int(low[k])
        begin = base  # a place of the batch; `at` is the stretch that begins there, or -1 inside of one
        while True:
            if at >= 0:
                have = int(tokens[at])
                if tokens[stop] - have <= limit:
                    yield k, piece, begin - base, end - base, int(tokens[stop] - have), shared, PARAGRAPH
                    break
                most = int(np.searchsorted(tokens[at : stop + 1], have + limit, side="right")) - 1 + at
                least = max(done + 1, int(np.searchsorted(tokens[at : stop + 1], have + max(limit // 2, overlap + 1), side="left")) + at)
                cut = table.best(least, most) if least <= most else -1
                if cut < 0:
                    least = max(done + 1, int(np.searchsorted(tokens[at : stop + 1], have + overlap + 1, side="left")) + at)
                    cut = table.best(least, most) if least <= most else -1
                if cut >= 0 and inside[cut] >= 0:
                    yield k, piece, begin - base, int(starts[cut]) - base, int(tokens[cut]) - have, shared, int(inside[cut])
                    back = int(np.searchsorted(tokens[at : cut + 1], int(tokens[cut]) - overlap, side="right")) - 1 + at
                    while back > at + 1 and inside[back] < 0:
                        back -= 1
                    done, piece = cut, piece + 1
                    if back <= at or inside[back] < 0 or tokens[cut] - tokens[back] > 2 * overlap:
                        # No split where the overlap should begin: measure it.
                        nxt, shared = _shared(counter, texts[k], begin - base, int(starts[cut]) - base, overlap)
                        begin = base + nxt
                        back = int(np.searchsorted(starts, begin))
                        at = back if starts[back] == begin else -1
                    else:
                        at, begin, shared = back, int(starts[back]), int(tokens[cut] - tokens[back])
                    continue
            finish, size, nxt, both = _measured(counter, texts[k], begin - base, limit, overlap)
            last = finish >= end - base
            yield k, piece, begin - base, finish, size, shared, PARAGRAPH if last else ANYWHERE
            if last:
                break
            begin, shared, piece = base + nxt, both, piece + 1
            done = int(np.searchsorted(starts, base + finish, side="right")) - 1
            where = int(np.searchsorted(starts, begin))
            at = where if starts[where] == begin else -1


def _measured(counter: Tokens, text: str, begin: int, limit: int, overlap: int) -> tuple[int, int, int, int]:
    """A piece cut between characters, measured by encoding it: its end, tokens, next begin and what they share."""
    glued = _glued()
    ok = lambda p: p >= len(text) or not glued[min(ord(text[p]), 0xFFFF)]
    size = lambda a, b: int(counter.count([text[a:b]])[0])
    low, high = begin + 1, min(len(text), begin + 64 * limit)
    while low < high:  # the longest end that fits; sizes grow with length but for a token or two
        middle = (low + high + 1) // 2
        low, high = (middle, high) if size(begin, middle) <= limit else (low, middle - 1)
    end = low
    while end > begin + 1 and not (ok(end) and size(begin, end) <= limit):
        end -= 1
    if end == begin + 1 and not ok(end):  # nothing but marks: keep within the limit
        end = low
    if end >= len(text):
        return len(text), size(begin, end), len(text), 0
    return end, size(begin, end), *_shared(counter, text, begin, end, overlap)


def _shared(counter: Tokens, text: str, begin: int, end: int, overlap: int) -> tuple[int, int]:
    """Where the piece after one from ``begin`` to ``end`` begins, and the tokens that both hold."""
    glued = _glued()
    size = lambda a: int(counter.count([text[a:end]])[0])
    low, high = max(begin + 1, end - 64 * overlap - 1), end
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if size(middle) <= overlap else (middle + 1, high)
    while low < end and glued[min(ord(text[low]), 0xFFFF)]:
        low += 1
    return low, size(low) if low < end else 0


def pieces(
    df: DataFrame, key: str, text: str, limit: int, overlap: int, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, with_text: bool = True
) -> DataFrame:
    """The pieces of each text in order: ``key``, ``piece``, ``begin``, ``end``, ``tokens``, ``shared_tokens``, ``boundary``, ``piece_text``.

    ``begin`` and ``end`` are places in characters, so a piece is ``text[begin:end]``; pieces cover
    the whole text, and ``shared_tokens`` is how much of a piece repeats the one before it, as
    close to ``overlap`` as marks and stretches allow. ``boundary`` names what the piece ends at. A text within the limit is
    one piece, an empty one a piece of no tokens. Null keys and texts give nothing; a repeated row
    gives its pieces again; other columns are ignored.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("overlap must be under half the limit")
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = tokens_of(folder, vocabulary)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            start = 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (end == start or size + len(texts[end]) <= BATCH_CHARS):
                    size += len(texts[end])
                    end += 1
                own = texts[start:end]
                rows = list(_cuts(counter, counter.sized(own), own, limit, overlap))
                which, piece, begin, finish, tokens, shared, strong = zip(*rows, strict=True)
                out = [
                    batch.column(0).take(pa.array(which, pa.int64()).cast(pa.int64()) if not start else pa.array([w + start for w in which], pa.int64())),
                    pa.array(piece, pa.int32()), pa.array(begin, pa.int32()), pa.array(finish, pa.int32()), pa.array(tokens, pa.int32()), pa.array(shared, pa.int32()),
                    pa.array([STRENGTHS[s] for s in strong], pa.string()),
                ]
                if with_text:
                    out.append(pa.array([own[w][a:b] for w, a, b in zip(which, begin, finish, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names)
                start = end

    names = ["key", "piece", "begin", "end", "tokens", "shared_tokens", "boundary", *["piece_text"] * with_text]
    schema = f"key {kind}, piece int, begin int, end int, tokens int, shared_tokens int, boundary string" + ", piece_text string" * with_text
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null and text is not null")
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
