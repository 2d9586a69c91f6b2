"""Languages by sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters (letters in lower case, anything else as one blank) are hashed into buckets. Their
document frequencies are counted over all rows that may be learned from. The weights follow the regularised leader with an
elastic net, one document after the other, and a temperature fitted on documents set aside calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlake.llm.sampling import sample
from siftlake.llm.tokens import slices, utf8

# The classifier is fitted to this many documents at most, those with the smallest hash of their id.
TRAIN_DOCUMENTS = 4000
LONGEST = 3
BUCKETS = 1 << 14
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
EPOCHS = 2
SCALE = 100.0
UNKNOWN = "und"

_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_letters: np.ndarray | None = None


def _is_letter(codes: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _letters[codes]


def ngrams(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each n the bucket at each character (-1 where no n-gram of the text starts), the bounds of each text's
    characters, and which texts have a letter."""
    data, offsets = utf8(column)
    starts = (data & 0xC0) != 0x80
    bounds = np.concatenate([[0], np.cumsum(starts)])[offsets]
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter(codes)
    codes = codes.copy()
    upper = (codes >= 65) & (codes <= 90)
    codes[upper] += 32
    wide = np.flatnonzero(letter & (codes > 127))
    if len(wide):
        distinct, place = np.unique(codes[wide], return_inverse=True)
        codes[wide] = np.array([ord(chr(c).lower()[0]) for c in distinct], np.uint32)[place]
    codes[~letter] = 32
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    found, mixed = [], np.zeros(len(codes), np.uint32)
    for n in range(1, LONGEST + 1):
        if n > 1:
            mixed = mixed[:-1] if len(mixed) else mixed
        mixed = mixed + codes[n - 1 :] * _FACTORS[n - 1] if len(codes) >= n else mixed[:0]
        bucket = (((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(18)).astype(np.int32)
        if len(bucket):
            bucket[text[: len(bucket)] != text[n - 1 :]] = -1
        found.append(bucket)
    has_letter = np.zeros(len(bounds) - 1, bool)
    has_letter[text[letter]] = True
    return found, bounds, has_letter


def _counts(found: list[np.ndarray], bounds: np.ndarray, row: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of one text and how often each occurs."""
    own = np.concatenate([b[bounds[row] : bounds[row + 1]] for b in found])
    counts = np.bincount(own[own >= 0], minlength=BUCKETS)
    buckets = np.flatnonzero(counts)
    return buckets, counts[buckets]


@dataclass(frozen=True)
class Model:
    """``weights``: a row per bucket (with its inverse document frequency) and a column per language."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from; a row without an id is none of them, but isn't learned from either."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    rows = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    return rows.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of a task's documents each bucket occurs; bucket -1 counts the documents."""
    total, documents = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for part in slices(batch):
            found, bounds, _ = ngrams(part["text"])
            for row in range(part.num_rows):
                total[_counts(found, bounds, row)[0]] += 1
            documents += part.num_rows
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict(
        {"bucket": np.append(seen, -1).astype(np.int32), "documents": np.append(total[seen], documents)}
    )


def inverse_frequencies(rows: DataFrame) -> np.ndarray:
    """The weight of each bucket from its document frequency over all rows."""
    counted = rows.select("text").mapInArrow(_frequencies, "bucket int, documents long")
    known = {r.bucket: r.n for r in counted.groupBy("bucket").agg(F.sum("documents").alias("n")).collect()}
    documents = known.pop(-1, 0)
    found = np.zeros(BUCKETS)
    for bucket, n in known.items():
        found[bucket] = n
    return np.log((1 + documents) / (1 + found)) + 1


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return scores / scores.sum(axis=-1, keepdims=True)


def fit(texts: pa.Array, languages: list[str], idf: np.ndarray) -> Model:
    """Every fifth document is set aside for the temperature, unless there are fewer than ten."""
    names = sorted(set(languages))
    label = np.array([names.index(x) for x in languages])
    documents = []
    for part in slices(pa.RecordBatch.from_pydict({"text": texts})):
        found, bounds, _ = ngrams(part["text"])
        for row in range(part.num_rows):
            buckets, counts = _counts(found, bounds, row)
            documents.append((buckets, counts / max(1, counts.sum()) * idf[buckets] * SCALE))
    # The last row is the bias.
    z, n, w = (np.zeros((BUCKETS + 1, len(names))) for _ in range(3))
    everyone = np.arange(len(documents))
    aside = everyone[::5] if len(documents) >= 10 else everyone[:0]
    learned = np.setdiff1d(everyone, aside)
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(learned):
            buckets, values = documents[i]
            at, x = np.append(buckets, BUCKETS), np.append(values, 1.0)
            zi, ni = z[at], n[at]
            wi = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
            wi[np.abs(zi) <= L1] = 0
            error = _softmax(x @ wi)
            error[label[i]] -= 1
            gradient = x[:, None] * error[None, :]
            squared = gradient**2
            z[at] += gradient - (np.sqrt(ni + squared) - np.sqrt(ni)) / ALPHA * wi
            n[at] += squared
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    w[np.abs(z) <= L1] = 0
    temperature = 1.0
    if len(aside):
        scores = np.stack([np.append(v, 1.0) @ w[np.append(b, BUCKETS)] for b, v in (documents[i] for i in aside)])
        grid = np.exp(np.linspace(np.log(0.1), np.log(10), 81))
        losses = [-np.log(_softmax(scores / t)[np.arange(len(aside)), label[aside]] + 1e-12).mean() for t in grid]
        temperature = float(grid[int(np.argmin(losses))])
    weights = (w[:-1] * idf[:, None] * SCALE).astype(np.float32)
    return Model(names, weights, w[-1], temperature)


def train(docs: DataFrame, limit: int = TRAIN_DOCUMENTS) -> Model | None:
    """A model from at most ``limit`` documents and ``SAMPLE_BYTES``, whose texts the driver holds while it fits; None
    without any.

    Half of the places are shared evenly by the languages, so that rare ones are known, too, unless there are more than
    half as many languages as places; the other places go by a hash of the id over all documents.
    """
    rows = learnable(docs)
    names = rows.agg(F.count_distinct("lang").alias("n")).first().n
    in_order = [F.xxhash64("doc_id"), F.col("doc_id")]
    share = limit // 2 // max(names, 1)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*in_order))
    chosen = rows.select("doc_id").orderBy(*in_order).limit(limit - share * names)
    if share:
        of_each = rows.select("doc_id", "lang").withColumn("place", place).where(F.col("place") <= share)
        chosen = chosen.unionByName(of_each.select("doc_id"))
    chosen = chosen.distinct()
    table = sample(rows.join(F.broadcast(chosen), "doc_id"))
    if not table.num_rows:
        return None
    return fit(table["text"].combine_chunks(), table["lang"].to_pylist(), inverse_frequencies(rows))


def predict(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """The language of each text and its probability; ``und`` and 0 without a letter."""
    found, bounds, has_letter = ngrams(column)
    rows = len(bounds) - 1
    scores, total = np.zeros((rows, len(model.languages))), np.zeros(rows)
    filled = np.flatnonzero(np.diff(bounds))
    table = np.concatenate([model.weights, np.zeros((1, len(model.languages)), np.float32)])
    for bucket in found:
        known = np.full(int(bounds[-1]), -1, np.int32)
        known[: len(bucket)] = bucket
        if len(filled):
            scores[filled] += np.add.reduceat(table[known].astype(np.float64), bounds[filled], axis=0)
            total[filled] += np.add.reduceat((known >= 0).astype(np.int64), bounds[filled])
    scores = scores / np.maximum(total, 1)[:, None] + model.bias
    probability = _softmax(scores / model.temperature)
    best = probability.argmax(axis=1)
    names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, has_letter, strict=True)]
    return names, np.where(has_letter, probability.max(axis=1), 0.0)


def languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs`` (``doc_id, text, lang``; other columns are left out).

    Null and empty texts and texts without a letter are ``und`` with score 0; so is everything if no row can be learned
    from. Rows that repeat an id are predicted one by one. An empty table gives no rows.
    """
    model = model or train(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                if model is None:
                    names, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                else:
                    names, score = predict(part["text"], model)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part["doc_id"], "lang_pred": pa.array(names, pa.string()), "score": pa.array(score)}
                )

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double"
    found = docs.select("doc_id", "text").mapInArrow(work, schema)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
