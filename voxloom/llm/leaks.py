"""Held-out passages inside a corpus, by greedy string tiling.

Windows of folded letters that a document shares with a test item are the seeds, found by
Karp-Rabin hashes; the longest common stretches are marked
one after the other so that none overlap, and the tiles that follow each other in the item's order
are summed. A document holds an item if such a passage covers at least a given share of it.

Equal windows of items are one seed, so what many items have in common is looked up once. Pairs are tiled one at a time, and
only if their seeds cover enough letters of the item for a passage of the share to be possible at all: no pair that tiling would
find is left out.

The items are few and are sent to every task in blocks of bounded size, some at a time; the documents are read
once for these and never shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from voxloom.llm.fold import folded, window_hashes

WINDOW = 16  # letters of a seed, and the least tile
SHORTEST = 4  # items of fewer letters don't count
GAP = 40  # letters between two tiles of one passage
SLIP = 16  # letters of such a gap that count as held, a slip of a word
BLOCK = 1_000_000  # letters of items in one block
TOGETHER = 4  # blocks that are sent together
CHUNK = 1_500_000  # characters of documents handled at once
EXPANDED = 1_000_000  # windows of items that are looked at at once
FILTER_BITS = 23


@dataclass
class Seeds:
    """Windows of one width of the items of a block: each hash once, with the items and places that have it."""

    width: int
    hashes: np.ndarray
    begin: np.ndarray  # of each hash, in item and place; one more at the end
    item: np.ndarray
    place: np.ndarray
    of_item: np.ndarray  # windows in the order of items
    bounds: np.ndarray  # of each item, in of_item; one more at the end
    sieve: np.ndarray


def seed_tables(letters: np.ndarray, offsets: np.ndarray) -> list[Seeds]:
    """A table of windows for each width: short items get narrower windows, under a third of them, and so do those
    in Han characters, of which each says as much as two letters."""
    length = np.diff(offsets)
    han = np.concatenate([[0], np.cumsum((letters >= 0x3400) & (letters < 0xA000))])
    most = np.where(2 * (han[offsets[1:]] - han[offsets[:-1]]) > length, WINDOW // 2, WINDOW)
    width = np.where(length >= 3 * most, most, np.maximum(length // 3, SHORTEST))
    out = []
    for w in np.unique(width[length >= SHORTEST]):
        h = window_hashes(letters, int(w))
        item = np.searchsorted(offsets, np.arange(len(h)), side="right") - 1
        place = np.arange(len(h)) - offsets[item]
        good = (width[item] == w) & (place + w <= length[item])
        order = np.argsort(h[good], kind="stable")
        hashes, begin = np.unique(h[good][order], return_index=True)
        sieve = np.zeros(1 << FILTER_BITS, bool)
        sieve[hashes >> np.uint64(64 - FILTER_BITS)] = True
        item, place = item[good][order], place[good][order]
        of_item = np.argsort(item, kind="stable")
        out.append(Seeds(int(w), hashes, np.r_[begin, len(item)], item, place, of_item, np.searchsorted(item[of_item], np.arange(len(length) + 1)), sieve))
    return out


def _spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of all ranges that begin so and are so long."""
    return np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())


def _most(covered: np.ndarray, width: int) -> np.ndarray:
    """The most letters that a passage may hold whose tiles lie in so many covered letters: every tile but one adds a slip."""
    return covered + SLIP * np.maximum(covered // width - 1, 0)


def _covered(sorted_places: np.ndarray, heads: np.ndarray, width: int) -> np.ndarray:
    """Letters under windows of the given width at sorted places, for each group that begins at one of ``heads``."""
    step = np.minimum(np.diff(sorted_places, append=0), width)
    step[np.r_[heads[1:] - 1, len(step) - 1]] = width
    return np.add.reduceat(step, heads)


def _candidates(seeds: Seeds, doc: np.ndarray, seed: np.ndarray, length: np.ndarray, share: float) -> list[tuple[int, int]]:
    """Documents and items whose shared windows may be enough; ``doc`` and ``seed`` are distinct pairs, in order."""
    counts = seeds.begin[seed + 1] - seeds.begin[seed]
    heads = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    sizes = np.cumsum(np.add.reduceat(counts, heads))
    ends, out, start = np.r_[heads[1:], len(doc)], [], 0
    longest = int(length.max()) + 1
    while start < len(heads):
        stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + EXPANDED, side="right")))
        rows = slice(heads[start], ends[stop - 1])
        which = _spread(seeds.begin[seed[rows]], counts[rows])
        key = (np.repeat(doc[rows], counts[rows]) * len(length) + seeds.item[which]) * longest + seeds.place[which]
        key.sort()
        pair, place = np.divmod(key, longest)
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        item = pair[first] % len(length)
        enough = _most(_covered(place, first, seeds.width), seeds.width) >= share * length[item]
        out += zip((pair[first[enough]] // len(length)).tolist(), item[enough].tolist(), strict=True)
        start = stop
    return out


def tiles(at: np.ndarray, place: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from seeds: (place in the document, place in the item, length), longest first.

    Seeds that follow each other on a diagonal are one match; what marked tiles have already
    taken of a match is cut off, and the rest is tried again if it is no shorter than a seed.
    """
    diagonal = at - place
    order = np.lexsort((at, diagonal))
    a, d = at[order], diagonal[order]
    head = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (a[1:] != a[:-1] + 1)])
    size = np.diff(np.r_[head, len(a)]) + width - 1
    heap = [(-int(n), int(a[k]), int(a[k] - d[k])) for k, n in zip(head, size, strict=True)]
    heapq.heapify(heap)
    low_a, low_b = int(at.min()), int(place.min())
    taken_a, taken_b = np.zeros(int(at.max()) - low_a + width, bool), np.zeros(int(place.max()) - low_b + width, bool)
    out = []
    while heap:
        n, x, y = heapq.heappop(heap)
        u, v, n = x - low_a, y - low_b, -n
        taken = taken_a[u : u + n] | taken_b[v : v + n]
        if not taken.any():
            taken_a[u : u + n] = taken_b[v : v + n] = True
            out.append((x, y, n))
            continue
        edges = np.flatnonzero(np.diff(np.r_[True, taken, True]))
        for start, end in edges.reshape(-1, 2).tolist():
            if end - start >= width:
                heapq.heappush(heap, (start - end, x + start, y + start))
    return out


def passage(marked: list[tuple[int, int, int]]) -> int:
    """Letters of the item that its best passage holds: tiles in the item's order, close together."""
    ordered = sorted(marked)
    best: list[int] = []
    for k, (x, y, n) in enumerate(ordered):
        value = n
        for j in range(k - 1, -1, -1):
            u, v, m = ordered[j]
            across, down = x - u - m, y - v - m
            if across > 3 * GAP + 200:
                break
            if 0 <= across <= GAP and 0 <= down <= GAP:
                value = max(value, best[j] + n + min(down, SLIP))
        best.append(value)
    return max(best, default=0)


def _held(seeds: Seeds, at: np.ndarray, seed: np.ndarray, item: int, length: int, share: float) -> float:
    """Share of the item's letters that its best passage in a document holds; ``at`` and ``seed`` are the document's hits by seed.

    Where the document has no seed for longer than a gap between tiles, no passage goes on, so the stretches between such places
    are tiled one by one, if they can hold enough at all. A passage is no longer than its tiles and the gaps between them, so of a
    longer stretch twice that length is tiled at a time, overlapping by half.
    """
    mine = seeds.of_item[seeds.bounds[item] : seeds.bounds[item + 1]]
    own = np.searchsorted(seeds.begin, mine, side="right") - 1
    once = own[np.r_[True, own[1:] != own[:-1]]]
    lo, hi = np.searchsorted(seed, once), np.searchsorted(seed, once, side="right")
    places = np.sort(at[_spread(lo, hi - lo)])
    heads = np.flatnonzero(np.r_[True, np.diff(places) > seeds.width + GAP])
    enough = _most(_covered(places, heads, seeds.width), seeds.width) >= share * length
    reach, best = length + GAP * (length // seeds.width + 1), 0
    for a, b in zip(places[heads[enough]], places[np.r_[heads[1:], len(places)][enough] - 1], strict=True):
        for start in range(int(a), max(int(a), int(b) - reach) + 1, reach):
            near = (at >= start) & (at <= b) & (at < start + 2 * reach)
            x, s = at[near], seed[near]
            lo, hi = np.searchsorted(s, own), np.searchsorted(s, own, side="right")
            best = max(best, passage(tiles(x[_spread(lo, hi - lo)], np.repeat(seeds.place[mine], hi - lo), seeds.width)) if (hi > lo).any() else 0)
    return best / length


def leaked(letters: np.ndarray, offsets: np.ndarray, tables: list[Seeds], length: np.ndarray, share: float) -> list[tuple[int, int, float]]:
    """Of these folded texts, (text, item, coverage) of each item held in one."""
    out = []
    for seeds in tables:
        h = window_hashes(letters, seeds.width)
        at = np.flatnonzero(seeds.sieve[h >> np.uint64(64 - FILTER_BITS)])
        seed = np.minimum(np.searchsorted(seeds.hashes, h[at]), len(seeds.hashes) - 1)
        doc = np.searchsorted(offsets, at, side="right") - 1
        real = (seeds.hashes[seed] == h[at]) & (at + seeds.width <= offsets[doc + 1])
        at, seed, doc = at[real], seed[real], doc[real]
        if not len(doc):
            continue
        by = np.argsort(doc * len(seeds.hashes) + seed, kind="stable")
        at, seed, doc = at[by] - offsets[doc[by]], seed[by], doc[by]
        new = np.r_[True, (doc[1:] != doc[:-1]) | (seed[1:] != seed[:-1])]
        edges = np.searchsorted(doc, np.arange(len(offsets)))
        for d, i in _candidates(seeds, doc[new], seed[new], length, share):
            held = _held(seeds, at[edges[d] : edges[d + 1]], seed[edges[d] : edges[d + 1]], i, int(length[i]), share)
            if held >= share:
                out.append((d, i, min(1.0, float(held))))
    return out


def leaked_items(
    documents: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, share: float = 0.5
) -> DataFrame:
    """``key``, ``item_key`` and ``coverage`` of each document that holds an item's passage.

    ``coverage`` is the share of the item's letters in the best passage, ``share`` at least. Case,
    punctuation, spaces, layout and encoding don't count. Null and blank texts, and items of fewer
    than ``SHORTEST`` letters, give nothing; repeated rows give one row; other columns are ignored.
    An item key that has several texts is found by any of them.
    """
    items = items.select(F.col(item_key).alias("i"), F.col(item_text).alias("t")).where("t is not null and i is not null").distinct()
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-size // BLOCK) or 1
    kind, item_kind = documents.schema[key].dataType.simpleString(), items.schema["i"].dataType.simpleString()
    docs = documents.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null and k is not null")
    out = None
    for first in range(0, blocks, TOGETHER):
        block = F.pmod(F.xxhash64("i", "t"), F.lit(blocks)).alias("block")
        sent: list[list[tuple]] = [[] for _ in range(min(TOGETHER, blocks - first))]
        for r in items.select("i", "t", block).where((F.col("block") >= first) & (F.col("block") < first + TOGETHER)).collect():
            sent[r.block - first].append((r.i, r.t))
        found = docs.mapInArrow(_search([sorted(b) for b in sent], share, to_arrow_type(items.schema["i"].dataType)), f"k {kind}, i {item_kind}, coverage double")
        out = found if out is None else out.unionByName(found)
    return out.groupBy(F.col("k").alias(key), F.col("i").alias(item_key)).agg(F.max("coverage").alias("coverage"))


def _search(blocks: list[list[tuple]], share: float, item_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = []
        for rows in blocks:
            letters, offsets = folded([t for _, t in rows])
            tables.append((rows, seed_tables(letters, offsets), np.diff(offsets)))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes, start = np.cumsum([len(t) for t in texts]), 0
            while start < len(texts):
                end = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + CHUNK, side="right")))
                letters, offsets = folded(texts[start:end])
                for rows, seeds, length in tables:
                    found = leaked(letters, offsets, seeds, length, share)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array([start + f[0] for f in found], pa.int64())),
                            pa.array([rows[f[1]][0] for f in found], item_type),
                            pa.array([f[2] for f in found], pa.float64()),
                        ],
                        ["k", "i", "coverage"],
                    )
                start = end

    return run
