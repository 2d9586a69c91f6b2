"""Passages of benchmark items in documents: SimHash of item-sized windows, Hamming blocks, exact similarity.

A window as similar as asked for shares three quarters of its item's shingles, so one of the rarest quarter at least, and
only windows around those are looked at. Of these, the fingerprints of all windows with as many shingles as the item are
held against the item's: the blocks of two fingerprints within ``RADIUS`` bits can't all differ in more than ``NEAR`` bits,
so a table of block values that near to each item's finds every fingerprint within the radius. What is found is checked on
the shingles themselves, weighted by how often they occur. Each repeat of a shingle votes with signs of its own, so that the
radius means the same for items that repeat themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.llm.tokens import MULTIPLIER, SHINGLE_WORDS, Words, mix, over_batches, shingles

PERCENT = 75
# Windows at the bound differ in 11 of 64 bits, give or take 3; with 8 blocks of 8 bits, 26 bits can't be 4 in each.
RADIUS = 26
NEAR = 3
# Items that a task holds at once, in a pass of its own over the documents.
ITEMS_PER_PASS = 4096
# Places of shared shingles, one per item that has them, and windows that are worked on at once.
PLACES_AT_ONCE = 1 << 18
WINDOWS_AT_ONCE = 1 << 12
# Lengths in words of items shorter than a shingle that are looked for within longer texts.
SHORT_ITEMS = range(2, SHINGLE_WORDS)
_FILTER_BITS = 22

_POPCOUNT = np.array([bin(x).count("1") for x in range(256)], np.uint8)
_NEAR_MASKS = [sum(1 << b for b in bits) for n in range(NEAR + 1) for bits in combinations(range(8), n)]
HIT_SCHEMA = "item_id long, similarity double, first_word long, last_word long"


def _signs(codes: np.ndarray) -> np.ndarray:
    """A row of 64 numbers, 1 or -1, per shingle code."""
    bits = np.unpackbits(codes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """Eight bytes per row of 64 sums: the bits whose sum is positive."""
    return np.packbits(sums > 0, axis=1, bitorder="little")


def _votes(codes: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """The signs of shingles, of their own for each repeat of a shingle."""
    again = repeats > 0
    if again.any():
        codes = codes.copy()
        codes[again] = mix(codes[again] + repeats[again].astype(np.uint64) * MULTIPLIER)
    return _signs(codes)


def _sum_of_votes(codes: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    total = np.zeros(64, np.int32)
    for a in range(0, len(codes), WINDOWS_AT_ONCE):
        total += _votes(codes[a : a + WINDOWS_AT_ONCE], repeats[a : a + WINDOWS_AT_ONCE]).sum(axis=0)
    return total


class _Places:
    """Where each shingle of a run of shingles occurs."""

    def __init__(self, codes: np.ndarray):
        distinct, self.group = np.unique(codes, return_inverse=True)
        order = np.argsort(self.group, kind="stable")
        self.width = len(codes) + 1
        self.keys = self.group[order] * self.width + order
        self.first = np.searchsorted(self.keys, np.arange(len(distinct)) * self.width)
        self.repeat = np.empty(len(codes), np.int64)
        self.repeat[order] = np.arange(len(codes)) - self.first[self.group[order]]

    def before(self, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often the shingles at some places occur before other places."""
        group = self.group[at]
        return np.searchsorted(self.keys, group * self.width + end) - self.first[group]


class Items:
    """The shingles and fingerprints of some benchmark items, and the table of near block values."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        words = Words(pa.array(texts, pa.string()))
        codes, bounds = shingles(words)
        kept = np.flatnonzero(np.diff(bounds))
        self.ids = [ids[i] for i in kept]
        self.size = np.diff(bounds)[kept]
        self.words = np.diff(words.bounds)[kept]
        self.codes, self.counts, prints = [], [], []
        for i in kept:
            own = codes[bounds[i] : bounds[i + 1]]
            distinct, counts = np.unique(own, return_counts=True)
            self.codes.append(distinct)
            self.counts.append(counts)
            prints.append(_fingerprints(_sum_of_votes(own, _Places(own).repeat)[None, :]))
        self.prints = np.concatenate(prints) if prints else np.zeros((0, 8), np.uint8)
        self._index_anchors()
        self.near = np.zeros((8, 256, len(kept)), bool)
        for block in range(8):
            for mask in _NEAR_MASKS:
                self.near[block, self.prints[:, block] ^ mask, np.arange(len(kept))] = True

    def _index_anchors(self) -> None:
        """The shingles that lead to an item. A window near enough shares at least 75 in 100 of the item's shingles, counted
        with repeats, so fewer than that may be left out: those that most items have."""
        flat = np.concatenate(self.codes) if self.codes else np.zeros(0, np.uint64)
        _, group, holders = np.unique(flat, return_inverse=True, return_counts=True)
        holders, at = holders[group], 0
        anchors, owner = [], []
        for item, (codes, counts) in enumerate(zip(self.codes, self.counts, strict=True)):
            common = np.argsort(-holders[at : at + len(codes)], kind="stable")
            at += len(codes)
            least_shared = -(-int(self.size[item]) * PERCENT // 100)
            rare = codes[common[np.cumsum(counts[common]) >= least_shared]]
            anchors.append(rare)
            owner.append(np.full(len(rare), item))
        flat = np.concatenate(anchors) if anchors else flat
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], owner[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.flat >> np.uint64(64 - _FILTER_BITS)] = True

    def anchors(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of shingles that lead to an item, and the item; a place comes once per item. In parts, so that shingles
        that very many items share need no more memory than others."""
        at = np.flatnonzero(self.filter[codes >> np.uint64(64 - _FILTER_BITS)])
        low = np.searchsorted(self.flat, codes[at], side="left")
        n = np.searchsorted(self.flat, codes[at], side="right") - low
        part = np.cumsum(n) // PLACES_AT_ONCE
        edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(n) else []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            many = n[a:b]
            first = np.repeat(low[a:b] - np.cumsum(many) + many, many)
            yield np.repeat(at[a:b], many), self.owner[first + np.arange(many.sum())]

    def windows(self, codes: np.ndarray, item: int, first: int, last: int) -> Iterator[tuple[float, int, int]]:
        """Similarity, first and last shingle of all windows near an item that begin between these places."""
        length = min(int(self.size[item]), len(codes))
        last = max(first, min(last, len(codes) - length))
        for a in range(first, last + 1, WINDOWS_AT_ONCE):
            region = codes[a : min(a + WINDOWS_AT_ONCE - 1, last) + length]
            for similarity, start in self._near_windows(region, item, length):
                yield similarity, a + start, a + start + length - 1

    def _near_windows(self, region: np.ndarray, item: int, length: int) -> Iterator[tuple[float, int]]:
        """A window that moves on by one shingle loses its last repeat of one shingle and gains one more of another."""
        places = _Places(region)
        lost = np.arange(len(region) - length)
        gained = lost + length
        n_lost = places.before(lost, gained) - places.repeat[lost] - 1
        n_gained = places.repeat[gained] - places.before(gained, lost + 1)
        sums = np.empty((len(lost) + 1, 64), np.int32)
        sums[0] = _sum_of_votes(region[:length], places.repeat[:length])
        sums[1:] = _votes(region[gained], n_gained) - _votes(region[lost], n_lost)
        prints = _fingerprints(np.cumsum(sums, axis=0, out=sums))
        near = np.zeros(len(prints), bool)
        for block in range(8):
            near |= self.near[block, prints[:, block], item]
        near &= _POPCOUNT[prints ^ self.prints[item]].sum(axis=1) <= RADIUS
        starts = np.flatnonzero(near)
        if not len(starts):
            return
        own = self.codes[item]
        place = np.minimum(np.searchsorted(own, region), len(own) - 1)
        wanted = np.where(own[place] == region, self.counts[item][place], 0)
        shared = np.empty(len(sums), np.int64)
        shared[0] = (places.repeat[:length] < wanted[:length]).sum()
        shared[1:] = (n_gained < wanted[gained]).astype(np.int64) - (n_lost < wanted[lost])
        shared = np.cumsum(shared)[starts]
        united = length + int(self.size[item]) - shared
        for k in np.flatnonzero(shared * 100 >= united * PERCENT):
            yield float(shared[k] / united[k]), int(starts[k])


def _regions(at: np.ndarray, item: np.ndarray, bounds: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """Text, item, first and last place of shared shingles that are no further apart than the item is long."""
    text = np.searchsorted(bounds, at, side="right") - 1
    order = np.lexsort((at, item, text))
    at, item, text = at[order], item[order], text[order]
    apart = np.ones(len(at), bool)
    apart[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (np.diff(at) > items.size[item[1:]])
    edges = np.append(np.flatnonzero(apart), len(at))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        row = int(text[a])
        yield row, int(item[a]), int(at[a] - bounds[row]), int(at[b - 1] - bounds[row])


def _short_items(words: Words, items: Items) -> Iterator[tuple[int, int, int]]:
    """Text, item and first word of items shorter than a shingle. Their windows are one shingle of as many words, which is
    its own fingerprint, so near enough means equal."""
    for length in SHORT_ITEMS:
        of_length = np.flatnonzero(items.words == length)
        if not len(of_length):
            continue
        codes, bounds = shingles(words, length)
        wanted = np.array([items.codes[i][0] for i in of_length])
        order = np.argsort(wanted, kind="stable")
        wanted, of_length = wanted[order], of_length[order]
        at = np.flatnonzero(np.isin(codes, wanted))
        text = np.searchsorted(bounds, at, side="right") - 1
        _, firsts = np.unique(np.stack([text.astype(np.uint64), codes[at]]), axis=1, return_index=True)
        for k in firsts:
            low, high = np.searchsorted(wanted, codes[at[k]], "left"), np.searchsorted(wanted, codes[at[k]], "right")
            for which in of_length[low:high]:
                yield int(text[k]), int(which), int(at[k] - bounds[text[k]])


def find(column: pa.Array, items: Items) -> Iterator[tuple[int, int, float, int, int]]:
    """Row, item, similarity, first and last word of the best window of each item in each text."""
    words = Words(column)
    codes, bounds = shingles(words)
    count = np.diff(words.bounds)
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for at, item in items.anchors(codes):
        for row, which, first, last in _regions(at, item, bounds, items):
            own = codes[bounds[row] : bounds[row + 1]]
            first = max(0, first - int(items.size[which]) + 1)
            for similarity, left, right in items.windows(own, which, first, last):
                # The last shingle of a window reaches four words further.
                found = (similarity, -left, min(right + SHINGLE_WORDS - 1, int(count[row]) - 1))
                best[row, which] = max(best.get((row, which), found), found)
    for row, which, left in _short_items(words, items):
        best[row, which] = (1.0, -left, left + int(items.words[which]) - 1)
    for (row, which), (similarity, left, right) in best.items():
        yield row, which, similarity, -left, right


def _passes(benchmark: DataFrame) -> Iterator[Items]:
    """All items with words, in groups of about ``ITEMS_PER_PASS``. The plan over the documents holds every group: a group of
    items of 100 words is some 12 MB."""
    known = benchmark.select("item_id", "text").where("text IS NOT NULL")
    passes = -(-known.count() // ITEMS_PER_PASS)
    for k in range(passes):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).collect()
        yield Items([r.item_id for r in rows], [r.text for r in rows])


def _hits(items: Items):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(find(batch["text"], items))
        rows = pa.array([f[0] for f in found], pa.int64())
        columns = {
            "item_id": pa.array([items.ids[f[1]] for f in found], pa.int64()),
            "similarity": pa.array([f[2] for f in found], pa.float64()),
            "first_word": pa.array([f[3] for f in found], pa.int64()),
            "last_word": pa.array([f[4] for f in found], pa.int64()),
        }
        return pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"].take(rows)} | columns)

    return over_batches(work)


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity, first_word, last_word``: a row per row of ``docs`` and benchmark item with a window
    at least 75 percent similar, with the best window (the first of equals; words count from 0).

    Texts of fewer than five words are one shingle, on both sides; a document shorter than an item is one window. Items of
    two to four words are found wherever their words stand together, items of one word in texts of that word alone. Texts
    and items without words are similar to nothing; items without an id are not reported. Equal items are reported each,
    rows that repeat an id too. Empty tables give no rows. Other columns of both tables are left out.
    """
    texts = docs.select("doc_id", "text")
    found = docs.sparkSession.createDataFrame([], f"doc_id {dict(docs.dtypes)['doc_id']}, {HIT_SCHEMA}")
    for items in _passes(benchmark.where("item_id IS NOT NULL")):
        found = found.unionByName(texts.mapInArrow(_hits(items), found.schema))
    return found


def _clean(items: Items):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = np.ones(batch.num_rows, bool)
        keep[[f[0] for f in find(batch["text"], items)]] = False
        return batch.filter(pa.array(keep))

    return over_batches(work)


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no passage of the benchmark, as ``contaminations`` finds
    them; items without an id count, too."""
    for items in _passes(benchmark):
        docs = docs.mapInArrow(_clean(items), docs.schema)
    return docs
