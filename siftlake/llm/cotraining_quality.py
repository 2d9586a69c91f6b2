"""Quality scores by co-training: a classifier of the text and one of the page's metadata teach each other.

Both start from labelled documents. In each round each of them names the unlabelled documents it is surest of, good ones and bad
ones in the proportion of the labels, and the other one learns these too. At the end both are calibrated on labelled
documents set aside, and a logistic function of both calibrated views scores every document.

All unlabelled documents are offered and judged where they lie. What a view teaches is a rule (weights and two bounds) that any
task can apply to a row, so that the driver holds weights, counts and sums only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.llm.tokens import Words, fixed_binary, mix, over_batches, unit, utf8
from siftlake.workspace import Scratch

# So many labelled documents are learned from at most, those with the smallest hash of their id; only their features reach
# the driver.
TRAIN_DOCUMENTS = 6000
ROUNDS = 5
# Of all unlabelled documents, one in so many is named by each view in each round.
ONE_IN = 30
# Logits from -30 to 30 are counted in so many bins.
BINS = 1 << 14
UNKNOWN = 0.5
SCORE_SCHEMA = "score double, text_score double, metadata_score double"

_MARKS = np.frombuffer(b"#$%&*|@+=_<>{}[]()/;:!?,.'\"-\n\t", np.uint8)
N_TEXT = 1 + len(_MARKS) + 8
_SOURCES, _LANGS, _LENGTHS = 64, 16, 24
N_METADATA = 1 + _SOURCES + _LANGS + _LENGTHS
_CELLS = _SOURCES * _LANGS * _LENGTHS


def text_features(column: pa.Array) -> np.ndarray:
    """Per text: 1, shares of marks (logarithms), shares of letters, digits, capitals and other bytes, mean length of
    words, share of distinct words, share of words that are the same as the one before, share of lines that repeat."""
    data, offsets = utf8(column)
    words = Words(column)
    rows, lengths = len(offsets) - 1, np.maximum(np.diff(offsets), 1)
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    counts = np.bincount(owner * 256 + data, minlength=rows * 256).reshape(rows, 256) / lengths[:, None]
    out = np.zeros((rows, N_TEXT))
    out[:, 0] = 1
    out[:, 1 : 1 + len(_MARKS)] = np.log1p(counts[:, _MARKS] * 1000)
    rest = out[:, 1 + len(_MARKS) :]
    rest[:, 0] = counts[:, 97:123].sum(axis=1)
    rest[:, 1] = counts[:, 48:58].sum(axis=1) * 10
    rest[:, 2] = counts[:, 65:91].sum(axis=1) * 10
    rest[:, 3] = counts[:, 128:].sum(axis=1)
    n = np.maximum(np.diff(words.bounds), 1)
    rest[:, 4] = np.bincount(words.text, weights=words.end - words.start, minlength=rows) / n / 10
    pairs = np.unique(mix(words.code ^ mix(words.text.astype(np.uint64))), return_index=True)[1]
    rest[:, 5] = np.bincount(words.text[pairs], minlength=rows) / n
    same = np.flatnonzero((words.code[1:] == words.code[:-1]) & (words.text[1:] == words.text[:-1]))
    rest[:, 6] = np.bincount(words.text[same], minlength=rows) / n * 10
    lines = Words(column, _IN_LINE, lower=False)
    distinct = np.unique(mix(lines.code ^ mix(lines.text.astype(np.uint64))), return_index=True)[1]
    rest[:, 7] = 1 - np.bincount(lines.text[distinct], minlength=rows) / np.maximum(np.diff(lines.bounds), 1)
    return out


_IN_LINE = np.ones(256, bool)
_IN_LINE[[10, 13]] = False


def _hashed(column: pa.Array, buckets: int) -> np.ndarray:
    """A bucket per value; null is a value of its own."""
    data, offsets = utf8(column)
    whole = Words(column, np.ones(256, bool), lower=False)
    codes = np.zeros(len(offsets) - 1, np.uint64)
    codes[whole.text] = whole.code
    codes[np.asarray(column.is_null())] = 1
    return (mix(codes) % np.uint64(buckets)).astype(int)


def metadata_cells(source: pa.Array, lang: pa.Array, n_chars: np.ndarray) -> np.ndarray:
    """Per document one number for its source and its language (hashed) and the size class of its length."""
    size = np.clip(np.log2(np.maximum(n_chars, 1)) * 1.5, 0, _LENGTHS - 1).astype(int)
    return (_hashed(source, _SOURCES) * _LANGS + _hashed(lang, _LANGS)) * _LENGTHS + size


def _places(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of a cell's source, language and size class among the features."""
    source, lang = cells // (_LANGS * _LENGTHS), cells // _LENGTHS % _LANGS
    return 1 + source, 1 + _SOURCES + lang, 1 + _SOURCES + _LANGS + cells % _LENGTHS


def metadata_features(cells: np.ndarray) -> np.ndarray:
    """Per cell: 1 and a 1 in each of its three places."""
    out = np.zeros((len(cells), N_METADATA))
    out[:, 0] = 1
    for place in _places(cells):
        out[np.arange(len(out)), place] = 1
    return out


def _cells(batch: pa.RecordBatch) -> np.ndarray:
    return metadata_cells(batch["source"], batch["lang"], batch["n_chars"].fill_null(0).to_numpy(zero_copy_only=False))


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return text_features(batch["text"]), metadata_features(_cells(batch))


def _probability(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))


def _sums(x: np.ndarray, y: np.ndarray, count: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Loss, gradient and Hessian, one after the other, of rows that stand for ``count`` documents each."""
    z = x @ weights
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    loss = count @ (np.logaddexp(0, z) - y * z)
    return np.concatenate([[loss], x.T @ (count * (p - y)), ((x * (count * p * (1 - p))[:, None]).T @ x).ravel()])


def _newton(sums: Callable[[np.ndarray], np.ndarray], weights: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Newton's method from these weights on, with a penalty on all weights but the first. A step that makes things worse
    is halved."""
    n = len(weights)
    ridge = np.full(n, penalty)
    ridge[0] = 1e-3
    found = sums(weights)
    for _ in range(30):
        step = np.linalg.solve(found[1 + n :].reshape(n, n) + np.diag(ridge), -found[1 : 1 + n] - ridge * weights)
        step *= min(1, 2 / max(np.abs(step).max(), 1e-300))
        worst = found[0] + (ridge * weights**2).sum() / 2
        while np.abs(step).max() >= 1e-6:
            ahead = sums(weights + step)
            if ahead[0] + (ridge * (weights + step) ** 2).sum() / 2 <= worst + 1e-9 * abs(worst):
                break
            step /= 2
        else:
            break
        weights, found = weights + step, ahead
    return weights


def fit_logistic(x: np.ndarray, y: np.ndarray, count: np.ndarray | None = None) -> np.ndarray:
    count = np.ones(len(y)) if count is None else count
    return _newton(lambda weights: _sums(x, y, count, weights), np.zeros(x.shape[1]))


@dataclass(frozen=True)
class Model:
    """The weights of both views, the calibration of each (offset and slope), and how they are combined."""

    views: tuple[np.ndarray, np.ndarray]
    calibration: tuple[np.ndarray, np.ndarray]
    combination: np.ndarray

    def scores(self, views: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        logits = [np.clip(x @ w, -30, 30) for x, w in zip(views, self.views, strict=True)]
        calibrated = [c[0] + c[1] * z for c, z in zip(self.calibration, logits, strict=True)]
        both = np.stack([np.ones(len(calibrated[0])), *calibrated], axis=1)
        return _probability(both, self.combination), *(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in calibrated)


@dataclass(frozen=True)
class _Lesson:
    """What one view (0: text, 1: metadata) teaches the other: documents whose logit lies below the bin ``low`` are bad, those
    above the bin ``high`` good, and so is a share, by hash, of those in the two bins."""

    teacher: int
    weights: np.ndarray
    low: int
    low_share: float
    high: int
    high_share: float


@dataclass(frozen=True)
class _Rows:
    """Unlabelled documents: text features, cells and a hash each."""

    text: np.ndarray
    cell: np.ndarray
    tie: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch) -> _Rows:
        column = batch["text_view"].cast(pa.large_binary())
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        text = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0] : bounds[-1]].view(np.float32)
        cell, tie = (batch[c].to_numpy(zero_copy_only=False) for c in ("cell", "tie"))
        return _Rows(text.reshape(-1, N_TEXT).astype(np.float64), cell, tie.astype(np.uint64))

    def bins(self, view: int, weights: np.ndarray) -> np.ndarray:
        """The bin of each row's logit; a row gets the same in every batch."""
        return _bins(_cell_logits(self.cell, weights) if view else (self.text * weights).sum(axis=1))

    def judged(self, lessons: list[_Lesson]) -> tuple[np.ndarray, np.ndarray]:
        """Who named each row first (0, 1, or -1 as long as nobody did) and the label it got."""
        teacher, label = np.full(len(self.cell), -1), np.zeros(len(self.cell), int)
        for number, lesson in enumerate(lessons):
            at = self.bins(lesson.teacher, lesson.weights)
            chance = unit(mix(self.tie + mix(np.array([number + 1]))))
            bad = (at < lesson.low) | ((at == lesson.low) & (chance <= lesson.low_share))
            good = (at > lesson.high) | ((at == lesson.high) & (chance > 1 - lesson.high_share))
            fresh = (teacher < 0) & (bad | good)
            teacher[fresh], label[fresh] = lesson.teacher, good[fresh]
        return teacher, label


def _cell_logits(cells: np.ndarray, weights: np.ndarray) -> np.ndarray:
    source, lang, size = _places(cells)
    return weights[0] + weights[source] + weights[lang] + weights[size]


def _bins(logits: np.ndarray) -> np.ndarray:
    return np.minimum((np.clip(logits, -30, 30) + 30) * (BINS / 60), BINS - 1).astype(int)


def _lesson(teacher: int, weights: np.ndarray, counts: np.ndarray, named: int, share: float) -> _Lesson:
    """``counts``: how many documents that nobody named yet are in each bin."""
    free = int(counts.sum())
    good = min(int(round(named * share)), free // 2)
    bad = min(named - good, free - good)

    def border(ascending: np.ndarray, n: int) -> tuple[int, float]:
        upto = np.cumsum(ascending)
        at = int(np.searchsorted(upto, n))
        return at, (n - (int(upto[at - 1]) if at else 0)) / int(ascending[at])

    low = border(counts, bad) if bad else (-1, 0.0)
    high = border(counts[::-1], good) if good else (-1, 0.0)
    return _Lesson(teacher, weights, *low, BINS - 1 - high[0], high[1])


class _Pool:
    """All unlabelled documents (``text_view, cell, tie``) as a table that is read once for each question."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def _added(self, work: Callable[[_Rows], np.ndarray], places: int) -> np.ndarray:
        """The sum over all rows of ``places`` numbers that ``work`` gives for a batch of them. Tasks add theirs first;
        sums of decimals are the same in any order."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(places)
            for batch in batches:
                if batch.num_rows:
                    total += work(_Rows.of(batch))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"place": at.astype(np.int32), "value": total[at]})

        parts = self.rows.select("text_view", "cell", "tie").mapInArrow(run, "place int, value double")
        added = parts.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,10)")).cast("double").alias("value"))
        out = np.zeros(places)
        for row in added.collect():
            out[row.place] = row.value
        return out

    def bins(self, view: int, weights: np.ndarray, lessons: list[_Lesson]) -> np.ndarray:
        """How many documents that nobody named yet are in each bin of a view."""

        def work(rows: _Rows) -> np.ndarray:
            return np.bincount(rows.bins(view, weights)[rows.judged(lessons)[0] < 0], minlength=BINS)

        return np.rint(self._added(work, BINS)).astype(np.int64)

    def cells(self, lessons: list[_Lesson]) -> np.ndarray:
        """How many documents of each cell (columns) nobody named yet, and how many the text names bad, and good."""

        def work(rows: _Rows) -> np.ndarray:
            teacher, label = rows.judged(lessons)
            kinds = (teacher < 0, (teacher == 0) & (label == 0), (teacher == 0) & (label == 1))
            return np.concatenate([np.bincount(rows.cell[kind], minlength=_CELLS) for kind in kinds])

        return np.rint(self._added(work, 3 * _CELLS)).astype(np.int64).reshape(3, _CELLS)

    def text_sums(self, weights: np.ndarray, lessons: list[_Lesson]) -> np.ndarray:
        """Loss, gradient and Hessian of the text's view over the documents that the metadata name."""

        def work(rows: _Rows) -> np.ndarray:
            teacher, label = rows.judged(lessons)
            named = teacher == 1
            return _sums(rows.text[named], label[named], np.ones(int(named.sum())), weights)

        return self._added(work, 1 + N_TEXT * (N_TEXT + 1))


def _taught(
    known: tuple[np.ndarray, np.ndarray], y: np.ndarray, weights: list[np.ndarray], pool: _Pool
) -> list[np.ndarray]:
    """The weights of both views after all rounds."""
    lessons: list[_Lesson] = []
    every, share = np.arange(_CELLS), y.mean()
    named = None
    for _ in range(ROUNDS):
        counts = pool.bins(0, weights[0], lessons)
        if not counts.sum():
            break
        # As many in each round as in the first.
        named = named or -(-int(counts.sum()) // ONE_IN)
        lessons.append(_lesson(0, weights[0], counts, named, share))
        free, bad, good = pool.cells(lessons)
        at = _bins(_cell_logits(every, weights[1]))
        lessons.append(_lesson(1, weights[1], np.bincount(at, weights=free, minlength=BINS).astype(np.int64), named, share))

        def sums(w: np.ndarray) -> np.ndarray:
            return _sums(known[0], y, np.ones(len(y)), w) + pool.text_sums(w, lessons)

        seen = [np.flatnonzero(bad), np.flatnonzero(good)]
        x = np.concatenate([known[1], *(metadata_features(cells) for cells in seen)])
        label = np.concatenate([y, np.zeros(len(seen[0])), np.ones(len(seen[1]))])
        weights = [
            _newton(sums, weights[0]),
            fit_logistic(x, label, np.concatenate([np.ones(len(y)), bad[seen[0]], good[seen[1]]])),
        ]
    return weights


def fit(labelled: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: Callable[[], _Pool]) -> Model | None:
    """Every fourth labelled document is set aside for the calibration. None unless both labels occur; the pool isn't asked for
    then."""
    if len(np.unique(y)) < 2:
        return None
    aside = np.zeros(len(y), bool)
    aside[::4] = len(y) >= 40
    learned = ~aside
    if len(np.unique(y[learned])) < 2:
        return None
    weights = [fit_logistic(view[learned], y[learned]) for view in labelled]
    weights = _taught(tuple(view[learned] for view in labelled), y[learned], weights, pool())
    judged = aside if len(np.unique(y[aside])) > 1 else learned
    ones = np.ones(int(judged.sum()))
    logits = [np.clip(labelled[v][judged] @ weights[v], -30, 30) for v in (0, 1)]
    calibration = tuple(fit_logistic(np.stack([ones, z], axis=1), y[judged]) for z in logits)
    calibrated = [c[0] + c[1] * z for c, z in zip(calibration, logits, strict=True)]
    combination = fit_logistic(np.stack([ones, *calibrated], axis=1), y[judged])
    return Model(tuple(weights), calibration, combination)


def _as_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    views = fixed_binary(text_features(batch["text"]).astype(np.float32))
    cells = pa.array(_cells(batch).astype(np.int32))
    return pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "text_view": views, "cell": cells})


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("long").alias("n_chars"),
    )


def _views(docs: DataFrame) -> DataFrame:
    """``doc_id, text_view, cell`` of each row: its features as floats, and its metadata."""
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, text_view binary, cell int"
    return _columns(docs).mapInArrow(over_batches(_as_rows), schema)


def unlabelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text_view, cell, tie`` of all documents without a label of their quality; rows that are equal in id and features are
    one."""
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    marked = marked.where("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", F.lit(0).cast("long").alias("spread"))
    # Rows without an id match no label; they go to as many tasks as the others.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text_view", "cell")).otherwise(F.lit(0).cast("long"))
    rows = _views(docs).withColumn("spread", spread).join(marked.distinct(), ["doc_id", "spread"], "left_anti").distinct()
    return rows.select("text_view", "cell", F.xxhash64("doc_id", "text_view", "cell").alias("tie"))


def learnable(labels: DataFrame) -> DataFrame:
    """``doc_id, quality`` of the labels that may be learned from: those whose crc32 of the id as text modulo 3 is not 1."""
    rows = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    rows = rows.where("doc_id IS NOT NULL AND quality IN (0, 1)")
    rows = rows.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)
    return rows.groupBy("doc_id").agg(F.min("quality").alias("quality"))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    chosen = learnable(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCUMENTS)
    known = _views(docs.join(F.broadcast(chosen.select("doc_id")), "doc_id")).dropDuplicates(["doc_id"])
    table = known.join(F.broadcast(chosen), "doc_id").withColumn("tie", F.lit(0).cast("long")).orderBy("doc_id").toArrow()
    if not table.num_rows:
        return None
    rows = _Rows.of(table.combine_chunks().to_batches()[0])
    scratch = Scratch(docs.sparkSession, "cotraining")
    try:
        return fit(
            (rows.text, metadata_features(rows.cell)),
            table["quality"].to_numpy().astype(float),
            lambda: _Pool(scratch.settle(unlabelled(docs, labels), "unlabelled")),
        )
    finally:
        scratch.close()


def qualities(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, score, text_score, metadata_score`` (0 to 1, higher: better) for every row of ``docs``
    (``doc_id, text, source, lang, n_chars``; other columns are left out).

    Null and empty texts have no marks and no words and are scored like any others; null metadata are values of their own.
    Rows that repeat an id are scored one by one. Without labels of both kinds every score is 0.5. An empty table gives
    no rows.
    """
    model = model or train(docs, labels)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = model.scores(_features(batch)) if model else [np.full(batch.num_rows, UNKNOWN)] * 3
        names = ("score", "text_score", "metadata_score")
        return pa.RecordBatch.from_pydict(
            {"doc_id": batch["doc_id"]} | {n: pa.array(v) for n, v in zip(names, found, strict=True)}
        )

    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    scored = _columns(docs).mapInArrow(over_batches(work), f"doc_id {dict(docs.dtypes)['doc_id']}, {SCORE_SCHEMA}")
    return scored.select("doc_id", held_out.alias("held_out"), "score", "text_score", "metadata_score")
