"""Phrases that stand out, mined from FM-indexes of shards of text.

A shard is a run of texts of one language. Its words become numbers and its pieces one sequence of them, which is indexed in
both directions: the rows of an index are the sequence's suffixes in order, of which the Burrows-Wheeler transform names
the word before. The rows that begin with a phrase are an interval, and the words before its rows are the phrase's extensions
to the left, each with its count and its own interval; the index of the reversed sequence extends to the right, and the two
intervals of a phrase are kept in step. Since phrases have a few words, rows are in order of as many words only.

Counts of shards are added up in Spark. Pairs of words come first; triples are then enumerated only from pairs that a bit
map of a fixed size holds as frequent. The bit map may hold too many pairs, never too few, so that counts are exact.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftlake.llm.batches import small_batches
from siftlake.llm.tokens import Words, mix, slices, utf8
from siftlake.workspace import Scratch

# Texts of one shard, in bytes, and up to one text more.
SHARD_BYTES = 3 << 19
LEAST_COUNT = 10
# A phrase goes when a longer one around it has at least this share of its occurrences, in hundredths.
COVERED = 50
TOP = 2000
# The bit map of frequent pairs has two to this power of bits, dealt out in slices of two to that power of bytes.
FILTER_BITS = 27
SLICE_BITS = 12
# Words are parts of many phrases, so that their counts are laid out this often, for phrases to join with one of them.
COPIES = 8

_WORD, _BLANK, _END = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_COUNTED = "lang string, words int, phrase string, n long"


def piece_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, A to Z lower-cased, and which of them begin a piece."""
    data, offsets = utf8(column)
    kind = _KIND[data]
    inside = kind == _WORD
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begins[firsts] = inside[firsts]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    ends[lasts] = inside[lasts]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    letters = np.ascontiguousarray(_LOWER[data][inside])
    bounds = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_string(), len(start), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(letters.tobytes())]
    )
    first = np.zeros(len(start), bool)
    of_texts = np.searchsorted(start, offsets[:-1])
    first[of_texts[of_texts < len(start)]] = True
    ended = np.cumsum(kind == _END, dtype=np.int32)
    if len(start):
        first[0] = True
        first[1:] |= ended[start[1:]] != ended[end[:-1] - 1]
    return words, first


def _order_by(symbols: np.ndarray) -> np.ndarray:
    """A stable order of numbers below 2**32, 16 bits at a time."""
    order = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    high = (symbols >> 16).astype(np.uint16)
    if high.any():
        order = order[np.argsort(high[order], kind="stable")]
    return order.astype(np.int32)


@dataclass
class Intervals:
    """Phrases and the rows that begin with them, in an index and in that of the reversed sequence: from ``low`` and from
    ``back``, ``n`` rows each. ``parent`` is the phrase that was extended, by ``symbol``."""

    low: np.ndarray
    back: np.ndarray
    n: np.ndarray
    parent: np.ndarray
    symbol: np.ndarray

    def only(self, chosen: np.ndarray) -> Intervals:
        return Intervals(*(a[chosen] for a in (self.low, self.back, self.n, self.parent, self.symbol)))

    def turned(self) -> Intervals:
        return Intervals(self.back, self.low, self.n, self.parent, self.symbol)


class Transform:
    """One direction of an index: the suffixes of a sequence, which goes on at its beginning, in order of ``depth`` symbols."""

    def __init__(self, sequence: np.ndarray, depth: int):
        n = len(sequence)
        order = _order_by(sequence)
        for _ in range(depth - 1):
            before = order - 1
            before[before < 0] = n - 1
            order = before[_order_by(sequence[before])]
        rank = np.empty(n, np.int32)
        rank[order] = np.arange(n, dtype=np.int32)
        after = order + 1
        after[after == n] = 0
        self.first = sequence[order]  # the symbol a row begins with: in order, the symbols of the transform
        self.next = rank[after]  # the row whose transform this symbol is

    def extended(self, found: Intervals) -> Intervals:
        """Every phrase by every symbol before it. Rows of one symbol whose next rows lie in one interval are an interval."""
        of = np.full(len(self.first), -1, np.int32)
        covered = np.repeat((found.low - np.cumsum(found.n) + found.n).astype(np.int32), found.n)
        covered += np.arange(len(covered), dtype=np.int32)
        of[covered] = np.repeat(np.arange(len(found.n), dtype=np.int32), found.n)
        parent = of[self.next]
        del of, covered
        fresh = np.ones(len(parent), bool)
        fresh[1:] = (parent[1:] != parent[:-1]) | (self.first[1:] != self.first[:-1])
        low = np.flatnonzero(fresh)
        n = np.diff(np.append(low, len(parent)))
        kept = parent[low] >= 0
        low, n = low[kept], n[kept]
        parent, symbol = parent[low], self.first[low]
        # In the other direction the extensions of a phrase divide its interval, in the order of their symbols.
        by_parent = np.argsort(parent, kind="stable")
        sums = np.cumsum(n[by_parent]) - n[by_parent]
        starts = np.searchsorted(parent[by_parent], np.arange(len(found.n)))
        back = np.empty_like(low)
        back[by_parent] = found.back[parent[by_parent]] + sums - sums[np.minimum(starts, len(sums) - 1)][parent[by_parent]]
        return Intervals(low, back, n, parent, symbol)


class Index:
    """Both directions of the pieces of some texts, as numbers of words from 1 on; 0 stands between pieces."""

    def __init__(self, words: np.ndarray, first: np.ndarray, vocabulary: int):
        place = np.arange(len(words)) + np.cumsum(first)
        sequence = np.zeros(len(words) + int(first.sum()) + 1, np.int32)
        sequence[place] = words + 1
        self.sequence, self.vocabulary = sequence, vocabulary
        self._turned: Transform | None = None
        self._straight: Transform | None = None

    def single(self) -> Intervals:
        """All words of the vocabulary."""
        n = np.bincount(self.sequence, minlength=self.vocabulary + 1)
        low = np.cumsum(n) - n
        return Intervals(low[1:], low[1:].copy(), n[1:], np.arange(self.vocabulary), np.arange(1, self.vocabulary + 1))

    def to_the_right(self, found: Intervals) -> Intervals:
        """Words by the words after them."""
        self._turned = self._turned or Transform(self.sequence[::-1].copy(), 2)
        longer = self._turned.extended(found.turned()).turned()
        return longer.only(longer.symbol > 0)

    def to_the_left(self, found: Intervals) -> Intervals:
        """Pairs by the words before them."""
        self._straight = self._straight or Transform(self.sequence, 3)
        longer = self._straight.extended(found)
        return longer.only(longer.symbol > 0)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Runs of texts of one language."""
    held, size = defaultdict(list), defaultdict(int)
    for batch in (part for whole in batches for part in slices(whole)):
        langs = batch["lang"].dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch["text"].filter(pc.equal(langs.indices, code)).cast(pa.large_string())
            held[lang].append(texts)
            size[lang] += texts.nbytes
            if size[lang] >= SHARD_BYTES:
                yield lang, pa.concat_arrays(held.pop(lang))
                size.pop(lang)
                pa.default_memory_pool().release_unused()
    while held:
        lang, texts = held.popitem()
        yield lang, pa.concat_arrays(texts)


def _joined(names: pa.Array, *numbers: np.ndarray) -> pa.Array:
    parts = [names.take(pa.array(n)) for n in numbers]
    return pc.binary_join_element_wise(*parts, pa.scalar(" ", names.type)) if len(parts) > 1 else parts[0]


def _counted(lang: str, words: int, phrases: pa.Array, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(n), 100_000):
        part = phrases.slice(at, 100_000).cast(pa.string())
        size = len(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * size, pa.string()), pa.array(np.full(size, words, np.int32)), part,
             pa.array(n[at : at + 100_000].astype(np.int64))],
            ["lang", "words", "phrase", "n"],
        )


def _indexed(texts: pa.Array) -> tuple[Index, pa.Array] | None:
    words, first = piece_words(texts)
    if not len(words):
        return None
    coded = words.dictionary_encode()
    return Index(coded.indices.to_numpy(), first, len(coded.dictionary)), coded.dictionary


def _singles_and_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, texts in _shards(batches):
        if (indexed := _indexed(texts)) is None:
            continue
        index, names = indexed
        single = index.single()
        yield from _counted(lang, 0, pa.array([""]), np.array([single.n.sum()]))
        yield from _counted(lang, 1, names, single.n)
        pairs = index.to_the_right(single)
        yield from _counted(lang, 2, _joined(names, pairs.parent, pairs.symbol - 1), pairs.n)


def _bits(lang: str, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The bit of a pair, from the codes of its words."""
    salt = np.uint64(zlib.crc32(lang.encode()))
    both = mix(first + salt) + second * np.uint64(0x9E3779B97F4A7C15)
    return (mix(both) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _map_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slices of a bit map that some pairs set bits in."""
    bits = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    for batch in batches:
        langs = batch["lang"].dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            codes = Words(batch["phrase"].filter(pc.equal(langs.indices, code))).code.reshape(-1, 2)
            at = _bits(lang, codes[:, 0], codes[:, 1])
            np.bitwise_or.at(bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
    slices = bits.reshape(-1, 1 << SLICE_BITS)
    used = np.flatnonzero(slices.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int64()), pa.array([slices[i].tobytes() for i in used], pa.binary())], ["slice", "bits"]
    )


def _united(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(v, np.uint8) for v in table["bits"].to_pylist()]
    return pa.table({"slice": table["slice"][:1], "bits": pa.array([np.bitwise_or.reduce(parts).tobytes()], pa.binary())})


def _frequent_pairs(counts: DataFrame) -> bytes:
    """A bit map of the pairs counted: two to the power of ``FILTER_BITS`` bits whatever their number."""
    pairs = counts.where("words = 2").select("lang", "phrase")
    slices = pairs.mapInArrow(_map_slices, "slice long, bits binary")
    slices = slices.groupBy("slice").applyInArrow(_united, "slice long, bits binary")
    bits = np.zeros((1 << FILTER_BITS >> 3 >> SLICE_BITS, 1 << SLICE_BITS), np.uint8)
    for row in slices.toLocalIterator():
        bits[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    return bits.tobytes()


def _triples(frequent) -> Callable:
    """For ``mapInArrow``: the triples whose two pairs are frequent by the bit map of a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(frequent.value, np.uint8)
        for lang, texts in _shards(batches):
            if (indexed := _indexed(texts)) is None:
                continue
            index, names = indexed
            codes = Words(names).code
            pairs = index.to_the_right(index.single())
            first, second = pairs.parent, pairs.symbol - 1
            at = _bits(lang, codes[first], codes[second])
            held = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            pairs, first, second = pairs.only(held), first[held], second[held]
            if not len(first):
                continue
            known = np.sort(first.astype(np.int64) * index.vocabulary + second)
            longer = index.to_the_left(pairs)
            one, two, three = longer.symbol - 1, first[longer.parent], second[longer.parent]
            key = one.astype(np.int64) * index.vocabulary + two
            both = known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key
            yield from _counted(lang, 3, _joined(names, one[both], two[both], three[both]), longer.n[both])

    return run


def _summed(counted: DataFrame, least: int) -> DataFrame:
    sums = counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return sums.where((F.col("n") >= least) | (F.col("words") == 0))


def counted_phrases(docs: DataFrame, scratch: Scratch, least: int = LEAST_COUNT) -> tuple[DataFrame, DataFrame]:
    """``lang, words, phrase, n`` of words and pairs, and of triples, that occur at least so often; a row of no words has the
    number of all words of a language."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    with small_batches(docs.sparkSession):
        counts = scratch.settle(_summed(texts.mapInArrow(_singles_and_pairs, _COUNTED), least), "pairs")
        frequent = docs.sparkSession.sparkContext.broadcast(_frequent_pairs(counts))
        triples = scratch.settle(_summed(texts.mapInArrow(_triples(frequent), _COUNTED), least), "triples")
    frequent.unpersist()
    return counts, triples


def _cut(phrases: DataFrame) -> DataFrame:
    """Each phrase at each place between its words, with the two parts and a copy of their counts to join with."""
    parts, copy = F.split("phrase", " "), F.pmod(F.xxhash64("phrase"), F.lit(COPIES)).cast("int")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    found = phrases.select("lang", "phrase", "words", "a", copy.alias("copy"), parts.alias("parts"), cut)
    found = found.select(
        "lang", "phrase", "words", "a", "k", "copy",
        F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"),
    )
    one = lambda part: F.when(F.contains(F.col(part), F.lit(" ")), 0).otherwise(F.col("copy"))
    return found.withColumns({"first_copy": one("first"), "rest_copy": one("rest")}).drop("copy")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of two or three words of each language by score.

    Of ``docs`` the columns ``text`` and ``lang`` are read; a null language is ``und``, and null and empty texts have no words.
    Repeated rows count each. An empty table gives no rows. Scores are worked out in whole numbers of 38 digits. A task holds
    one shard at a time, at least one whole text, in about 20 bytes for each of its own.
    """
    scratch = Scratch(docs.sparkSession, "phrases")
    counts, triples = counted_phrases(docs, scratch, least)
    pairs = counts.where("words = 2")
    around = triples.select("lang", F.split("phrase", " ").alias("w"), "n").select(
        "lang", "n", F.explode(F.array(F.array_join(F.slice("w", 1, 2), " "), F.array_join(F.slice("w", 2, 2), " "))).alias("phrase")
    )
    around = around.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    pairs = pairs.join(around, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {COVERED} * n")
    columns = ["lang", "phrase", "words", F.col("n").alias("a")]
    cut = _cut(pairs.select(*columns).unionByName(triples.select(*columns)))
    copies = F.explode(F.when(F.col("words") == 1, F.sequence(F.lit(0), F.lit(COPIES - 1))).otherwise(F.array(F.lit(0))))
    known = counts.where("words > 0").select("lang", "phrase", "n", copies.alias("copy"))
    for part, name in (("first", "l"), ("rest", "r")):
        side = known.select("lang", F.col("phrase").alias(part), F.col("copy").alias(f"{part}_copy"), F.col("n").alias(name))
        cut = cut.join(side, ["lang", part, f"{part}_copy"])
    long = lambda c: f"cast({c} AS decimal(19, 0))"
    score = F.expr(f"({long('a')} * {long('a')} * 1000000) div ({long('l')} * {long('r')})")
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("worst")
    scored = cut.groupBy("lang", "phrase", "a").agg(worst).select("lang", "phrase", "a", "worst.*")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(by_score).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x : x <> '') AS w FROM p),
g AS (SELECT lang, 1 AS words, unnest(w) AS phrase FROM w
      UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i : w[i] || ' ' || w[i + 1])) FROM w
      UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i : w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
      FROM w),
f AS (SELECT lang, words, phrase, count(*) AS n FROM g GROUP BY ALL),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND n >= 10),
o AS (SELECT lang, phrase, max(a) AS longer FROM (
        SELECT lang, a, w[1] || ' ' || w[2] AS phrase FROM c WHERE words = 3
        UNION ALL SELECT lang, a, w[2] || ' ' || w[3] FROM c WHERE words = 3) GROUP BY ALL),
k AS (SELECT c.*, unnest(range(1, words)) AS k FROM c LEFT JOIN o USING (lang, phrase)
      WHERE longer IS NULL OR 100 * longer < 50 * a),
s AS (SELECT k.lang, k.phrase, k.a, k.k, x.n AS l, y.n AS r,
             ((1000000 * a::HUGEINT * a::HUGEINT) // (x.n::HUGEINT * y.n::HUGEINT))::BIGINT AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1:k.k], ' ')
      JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT q.lang, rank, phrase, a, l, r, t.n, score FROM q JOIN t USING (lang) WHERE rank <= 2000
"""
