"""Sizes of texts in tokens of a public byte-level BPE, whole batches at a time.

The vocabulary splits a text by character class before it merges bytes, and what lies between two
splits is encoded by itself. The splits are found for a whole batch by array operations, each
distinct stretch is encoded once, and sums of the stretches' token counts size everything else.
"""

from __future__ import annotations

import base64
import os
import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np

#: Folder of the vocabulary files, and the file used; both may be set in the environment.
TOKENIZERS = os.environ.get("VOXLOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = os.environ.get("VOXLOOM_VOCABULARY", "byte_bpe_multi_50k.tiktoken")
# Fixed value: the pattern of this vocabulary family that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
_WHITE = {9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
_MOST_KNOWN = 2_000_000


def _class(point: int) -> int:
    if point in _WHITE:
        return SPACE
    kind = unicodedata.category(chr(point))[0]
    return LETTER if kind == "L" else NUMBER if kind == "N" else OTHER


@cache
def _classes() -> np.ndarray:
    return np.array([_class(p) for p in range(1 << 16)], np.uint8)


def classes(points: np.ndarray) -> np.ndarray:
    out = _classes()[np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points > 0xFFFF)
    if len(high):
        values, back = np.unique(points[high], return_inverse=True)
        out[high] = np.array([_class(int(p)) for p in values], np.uint8)[back]
    return out


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and the offsets of the texts (one more than texts)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]


def stretch_starts(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pattern (but for its apostrophes) splits the texts, as sorted places."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes(points)
    head = np.zeros(n + 1, bool)
    head[offsets] = True
    start = head.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    # White space before something else: its last character stands alone, or joins what follows if it is a blank.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~head[1:n])
    start[last] = True
    blank = last[points[last] == 32]
    start[blank + 1] = False
    return np.flatnonzero(start[:n])


@dataclass
class Sized:
    """Stretches of a batch: where they begin (with the end of all), and tokens up to each."""

    points: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    tokens: np.ndarray

    def totals(self) -> np.ndarray:
        return self.tokens[np.searchsorted(self.starts, self.offsets[1:])] - self.tokens[np.searchsorted(self.starts, self.offsets[:-1])]


class Tokens:
    """Token counts under one vocabulary file."""

    def __init__(self, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> None:
        import tiktoken

        with open(os.path.join(folder, vocabulary), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.powers, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers) < n:
            base = 0x9E3779B97F4A7C15
            size = 1 << n.bit_length()
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)], dtype=np.uint64)
            self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, pow(base, -1, 1 << 64), np.uint64)], dtype=np.uint64)
        return self.powers, self.inverse

    def sized(self, texts: Sequence[str]) -> Sized:
        """The stretches of all texts with their token counts."""
        points, offsets = code_points(texts)
        starts = stretch_starts(points, offsets)
        apostrophes = np.flatnonzero(points == 39)
        if len(apostrophes):
            starts = self._contractions(points, offsets, starts, apostrophes)
        n = len(points)
        powers, inverse = self._powers(n + 1)
        prefix = np.r_[np.uint64(0), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers[:n], dtype=np.uint64)]
        ends = np.r_[starts[1:], n].astype(np.int64) if len(starts) else starts
        h = (prefix[ends] - prefix[starts]) * inverse[starts]
        h ^= (ends - starts).astype(np.uint64) << np.uint64(56)
        known = np.minimum(np.searchsorted(self.hashes, h), max(len(self.hashes) - 1, 0))
        new = np.flatnonzero(self.hashes[known] != h) if len(self.hashes) else np.arange(len(h))
        if len(new):
            values, first = np.unique(h[new], return_index=True)
            whole = "".join(texts)
            at = new[first]
            counts = np.array([len(self.encoding.encode_ordinary(whole[s:e])) for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)], np.int64)
            if len(self.hashes) > _MOST_KNOWN:
                keep = np.isin(self.hashes, h)
                self.hashes, self.counts = self.hashes[keep], self.counts[keep]
            merged = np.concatenate([self.hashes, values])
            order = np.argsort(merged, kind="stable")
            self.hashes, self.counts = merged[order], np.concatenate([self.counts, counts])[order]
            known = np.searchsorted(self.hashes, h)
        each = self.counts[known]
        return Sized(points, offsets, np.r_[starts, n].astype(np.int64), np.r_[0, np.cumsum(each)])

    @staticmethod
    def _contractions(points: np.ndarray, offsets: np.ndarray, starts: np.ndarray, apostrophes: np.ndarray) -> np.ndarray:
        """An apostrophe that begins a stretch takes s, t, re, ve, m, ll or d with it; what follows begins anew."""
        first = apostrophes[np.isin(apostrophes, starts)]
        limit = offsets[np.searchsorted(offsets, first, side="right")]
        change = set(starts.tolist())
        for at, end in zip(first.tolist(), limit.tolist(), strict=True):
            pair = "".join(map(chr, points[at + 1 : min(at + 3, end)]))
            size = 1 if pair[:1] in ("s", "t", "m", "d") and pair else 2 if pair in ("re", "ve", "ll") else 0
            if size:
                change.discard(at + 1)
                if at + 1 + size < end:
                    change.add(at + 1 + size)
        return np.array(sorted(change), np.int64)

    def count(self, texts: Sequence[str]) -> np.ndarray:
        return self.sized(texts).totals()


@cache
def tokens_of(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Tokens:
    """One counter for each worker and vocabulary."""
    return Tokens(folder, vocabulary)
