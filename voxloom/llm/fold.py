"""Texts as arrays of folded characters, whole batches at a time."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import cache

import numpy as np

from voxloom.llm.visible import LOOKS_LIKE


@cache
def _letter(point: int) -> int:
    char = chr(point)
    if 0xD800 <= point < 0xF900 or not char.isalnum():
        return 0
    if char in "đĐ":
        return ord("d")
    if char in "แແ":
        return ord("เ" if char == "แ" else "ເ")
    parts = unicodedata.normalize("NFKD", LOOKS_LIKE.get(char, char)).lower()
    kept = [LOOKS_LIKE.get(c, c) for c in parts if c.isalnum()]
    if not kept:
        return 0
    c = kept[-1] if char in "ำຳ" else kept[0]
    digit = unicodedata.digit(c, None)
    return ord(c if digit is None else str(digit))


@cache
def letters_table() -> np.ndarray:
    """For every code point of the basic plane the letter or digit it counts as; 0 if it counts as none.

    Case, width, accents, tone marks, spaces, punctuation and invisible characters don't count,
    look-alike letters count as one letter, and native numerals as digits.
    """
    return np.fromiter(map(_letter, range(1 << 16)), np.uint32, 1 << 16)


def folded(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Folded letters of all texts in one array, and the offsets at which each text begins.

    A letter equal to the one before it in its text is left out.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    low = letters_table()[np.minimum(points, 0xFFFF).astype(np.uint16)]
    beyond = np.flatnonzero(points > 0xFFFF)
    if len(beyond):
        kinds, which = np.unique(points[beyond], return_inverse=True)
        low[beyond] = np.array([_letter(int(p)) for p in kinds], np.uint32)[which]
    keep = low != 0
    place = np.flatnonzero(keep)
    letters = low[place]
    text = np.searchsorted(bounds, place, side="right")
    same = np.r_[False, (letters[1:] == letters[:-1]) & (text[1:] == text[:-1])] if len(letters) else np.zeros(0, bool)
    letters, text = letters[~same], text[~same]
    return letters, np.searchsorted(text, np.arange(len(texts) + 1))


def window_hashes(letters: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``width`` letters, modulo 2**64.

    The hash of a double window is made of two single ones, so it takes log(width) passes.
    """
    h, size, factor = letters.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1, 0x2545F4914F6CDD1D
    parts, at, out = width, 0, None
    while parts:
        if parts & 1:
            n = len(letters) - width + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            piece = h[at : at + n]
            out = piece.copy() if out is None else out * np.uint64(factor) + piece
            at += size
        parts >>= 1
        if parts:
            h = h[: len(h) - size] * np.uint64(factor) + h[size:] if len(h) > size else np.zeros(0, np.uint64)
            factor, size = factor * factor % (1 << 64), size * 2
    return out ^ (out >> np.uint64(31))
