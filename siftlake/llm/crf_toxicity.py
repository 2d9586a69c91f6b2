"""Toxic spans by a linear-chain conditional random field, and scores of documents from its marginals.

Labels exist for documents only. Words that stand in toxic documents in far more different surroundings than chance gives
are labelled toxic there, all other words are not; a chain with two states learns the words, their neighbours and the
transitions from these labelled tokens. Forward-backward marginals give each token's probability. A document's score is
a logistic function of them, fitted to the labels of documents.

Most tokens have no weight but the bias. A run of them is a power of one two-by-two matrix, so the chain is followed over
whole texts from one weighted token to the next, without leaving any out.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.llm.sampling import sample
from siftlake.llm.tokens import WORD_CHARS, Words, mix, over_batches, slices

# The classifier is fitted to this many labelled documents at most, those with the smallest hash of their id.
TRAIN_DOCUMENTS = 4000
THRESHOLD = 0.7
# Where a score stands without any labels to learn from.
UNKNOWN = 0.0
TOXIC_Z, WEIGHTED_Z, LEAST_CONTEXTS = 3.3, 2.5, 8
MOST_WORDS = 2000
# Words that make toxicity less than this likelier (in logarithms) are left out of the chain after it is fitted.
LEAST_WEIGHT = 1.0
MOST_WINDOWS = 20_000
REACH = 5
SCORE_SCHEMA = "score double, toxic_tokens double, toxic_spans string"


@dataclass(frozen=True)
class Model:
    """``words`` (codes, ascending) with a weight each, the weights of a weighted word before and after, the bias of the
    toxic state, log transitions (from, to), and the logistic function of a document."""

    words: np.ndarray
    weights: np.ndarray
    before: float
    after: float
    bias: float
    transitions: np.ndarray
    document: np.ndarray


def _place(words: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The number of each code among ``words``, or -1."""
    if not len(words):
        return np.full(len(codes), -1)
    at = np.minimum(np.searchsorted(words, codes), len(words) - 1)
    return np.where(words[at] == codes, at, -1)


def _associations(words: _Codes, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word codes, how surely each prefers toxic documents, and in how many different surroundings it stands there. Copies
    of a document bring no new surroundings."""
    same = np.zeros(len(words) + 1, bool)
    same[1:-1] = words.text[1:] == words.text[:-1]
    code = words.code
    previous = np.where(same[:-1], np.roll(code, 1), 0)
    following = np.where(same[1:], np.roll(code, -1), 0)
    label = toxic[words.text]
    context = mix(code + mix(previous + np.uint64(1)) + mix(mix(following + np.uint64(2))))
    counts = []
    distinct = np.unique(code)
    for value in (1, 0):
        _, first = np.unique(context[label == value], return_index=True)
        counts.append(np.bincount(np.searchsorted(distinct, code[label == value][first]), minlength=len(distinct)))
    in_toxic, in_clean = counts
    ratio = np.log((in_toxic + 0.5) / (in_toxic.sum() + 1)) - np.log((in_clean + 0.5) / (in_clean.sum() + 1))
    return distinct, ratio / np.sqrt(1 / (in_toxic + 0.5) + 1 / (in_clean + 0.5)), in_toxic


def _marginals_of_windows(
    emission: np.ndarray, transitions: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """Of windows whose places ``inside`` (one run each) hold tokens: the probability of the toxic state at each token, of each
    transition between neighbours (summed over all), and the log normaliser (summed). Places outside have no part."""
    n, length = emission.shape
    first = inside & ~np.concatenate([np.zeros((n, 1), bool), inside[:, :-1]], axis=1)
    scores = np.stack([np.zeros_like(emission), emission], axis=2)
    forward, backward = np.zeros((n, length, 2)), np.zeros((n, length, 2))
    forward[:, 0] = scores[:, 0] + transitions[0]
    for t in range(1, length):
        step = np.logaddexp.reduce(forward[:, t - 1, :, None] + transitions, axis=1) + scores[:, t]
        step = np.where(first[:, t, None], scores[:, t] + transitions[0], step)
        forward[:, t] = np.where(inside[:, t, None], step, forward[:, t - 1])
    for t in range(length - 2, -1, -1):
        step = np.logaddexp.reduce(transitions + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
        backward[:, t] = np.where(inside[:, t + 1, None], step, backward[:, t + 1])
    total = np.logaddexp.reduce(forward[:, -1], axis=1)
    marginal = np.where(inside, np.exp(np.minimum(forward[:, :, 1] + backward[:, :, 1] - total[:, None], 0)), 0.0)
    pairs = np.zeros((2, 2))
    for t in range(1, length):
        joint = forward[:, t - 1, :, None] + transitions + (scores[:, t] + backward[:, t])[:, None, :]
        both = inside[:, t] & inside[:, t - 1]
        pairs += np.exp(joint[both] - total[both, None, None]).sum(axis=0)
    row, place = np.nonzero(first)
    pairs[0] += np.exp(scores[row, place] + transitions[0] + backward[row, place] - total[row, None]).sum(axis=0)
    return marginal, pairs, float(total.sum())


def _train_chain(words: _Codes, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float, float, np.ndarray]:
    codes, z, contexts = _associations(words, toxic)
    weighted = np.flatnonzero((z > WEIGHTED_Z) & (contexts >= LEAST_CONTEXTS))
    weighted = np.sort(weighted[np.argsort(-z[weighted], kind="stable")[:MOST_WORDS]])
    vocabulary, sure = codes[weighted], z[weighted] > TOXIC_Z
    place = _place(vocabulary, words.code)
    known = np.flatnonzero(place >= 0)
    if not len(known):
        return vocabulary, np.zeros(0), 0.0, 0.0, -8.0, np.zeros((2, 2))
    # Windows around weighted words, clipped at the bounds of their text, and some spread over all texts.
    around = known[np.linspace(0, len(known) - 1, num=min(len(known), MOST_WINDOWS)).astype(int)]
    spread = np.linspace(0, len(words) - 1, num=MOST_WINDOWS // 4).astype(int)
    centres = np.concatenate([around, spread])
    at = centres[:, None] + np.arange(-REACH, REACH + 1)
    opens, closes = (words.bounds[words.text[centres] + k][:, None] for k in (0, 1))
    inside = (at >= opens) & (at < closes)

    def places(shift: int) -> np.ndarray:
        """The numbers of the words there, -1 outside of the text."""
        there = at + shift
        return np.where((there >= opens) & (there < closes), place[np.clip(there, 0, len(words) - 1)], -1)

    previous, following, place = places(-1), places(1), places(0)
    truth = (place >= 0) & np.append(sure, False)[place] & (toxic[words.text[centres]] == 1)[:, None]
    near = ((previous >= 0) & inside).astype(float), ((following >= 0) & inside).astype(float)
    pairs = np.zeros((2, 2))
    # Outside of the text the state is 0, as it is before the first token.
    states = np.concatenate([np.zeros((len(at), 1), int), truth.astype(int)], axis=1)
    np.add.at(pairs, (states[:, :-1][inside], states[:, 1:][inside]), 1)
    seen = place >= 0
    observed = np.concatenate(
        [
            np.bincount(place[seen], weights=truth[seen].astype(float), minlength=len(vocabulary)),
            [(truth * near[0]).sum(), (truth * near[1]).sum(), truth.sum()],
        ]
    )
    parameters, transitions = np.zeros(len(vocabulary) + 3), np.zeros((2, 2))
    squares, transition_squares = np.full_like(parameters, 1e-8), np.full((2, 2), 1e-8)
    for _ in range(100):
        own = np.where(seen, np.append(parameters[:-3], 0.0)[place], 0.0)
        emission = own + parameters[-3] * near[0] + parameters[-2] * near[1] + parameters[-1]
        marginal, joint, _ = _marginals_of_windows(emission, transitions, inside)
        expected = np.concatenate(
            [
                np.bincount(place[seen], weights=marginal[seen], minlength=len(vocabulary)),
                [(marginal * near[0]).sum(), (marginal * near[1]).sum(), marginal.sum()],
            ]
        )
        gradient = observed - expected - 0.1 * parameters
        squares += gradient**2
        parameters += 0.5 * gradient / np.sqrt(squares)
        gradient = pairs - joint - 0.1 * transitions
        transition_squares += gradient**2
        transitions += 0.5 * gradient / np.sqrt(transition_squares)
    strong = parameters[:-3] >= LEAST_WEIGHT
    return vocabulary[strong], parameters[:-3][strong], *map(float, parameters[-3:]), transitions


def _powers(bias: float, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """A step over a token with the bias only: its scaled powers are ``first + ratio ** n * second``."""
    step = np.exp(transitions) * np.array([1.0, np.exp(bias)])
    values, vectors = np.linalg.eig(step)
    values, vectors = values.real, vectors.real
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    inverse = np.linalg.inv(vectors)
    return np.outer(vectors[:, 0], inverse[0]), np.outer(vectors[:, 1], inverse[1]), float(values[1] / values[0])


def token_marginals(words: Words | _Codes, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Tokens with a weight of their own or of a neighbour, and the probability of each to be toxic."""
    place = _place(model.words, words.code)
    seen = np.flatnonzero(place >= 0)
    if not len(seen):
        return seen, np.zeros(0)
    emission = np.zeros(len(words) + 2)
    emission[seen] += model.weights[place[seen]]
    touched = np.zeros(len(words) + 2, bool)
    touched[seen] = True
    for shift, weight in ((1, model.before), (-1, model.after)):
        other = seen + shift
        inside = (other >= 0) & (other < len(words))
        other = other[inside][words.text[other[inside]] == words.text[seen[inside]]]
        emission[other] += weight
        touched[other] = True
    sites = np.flatnonzero(touched)
    text = words.text[sites]
    # Sites by their number within the text: all texts go one site on at once.
    first = np.searchsorted(text, text)
    number = np.arange(len(sites)) - first
    opens = words.bounds[text]
    closes = words.bounds[text + 1]
    gap_before = np.where(number > 0, sites - np.roll(sites, 1) - 1, sites - opens)
    is_last = np.append(text[1:] != text[:-1], True)
    gap_after = np.where(is_last, closes - sites - 1, np.roll(sites, -1) - sites - 1)
    stay, fade, ratio = _powers(model.bias, model.transitions)
    move = np.exp(model.transitions)
    own = np.stack([np.ones(len(sites)), np.exp(np.clip(emission[sites] + model.bias, -60, 60))], axis=1)

    def across(gap: np.ndarray) -> np.ndarray:
        return stay + (ratio ** gap.astype(float))[:, None, None] * fade

    forward, backward = np.zeros((len(sites), 2)), np.ones((len(sites), 2))
    order = np.argsort(number, kind="stable")
    cuts = np.searchsorted(number[order], np.arange(number.max() + 2))
    for k in range(number.max() + 1):
        here = order[cuts[k] : cuts[k + 1]]
        came = forward[here - 1] if k else np.tile([1.0, 0.0], (len(here), 1))
        vector = (np.einsum("ni,nij->nj", came, across(gap_before[here])) @ move) * own[here]
        forward[here] = vector / vector.sum(axis=1, keepdims=True)
    for k in range(number.max(), -1, -1):
        here = order[cuts[k] : cuts[k + 1]]
        ahead = np.ones((len(here), 2))
        going = ~is_last[here]
        following = here[going] + 1
        ahead[going] = (own[following] * backward[following]) @ move.T
        vector = np.einsum("nij,nj->ni", across(gap_after[here]), ahead)
        backward[here] = vector / vector.sum(axis=1, keepdims=True)
    joint = forward * backward
    return sites, joint[:, 1] / joint.sum(axis=1)


def _document_features(words: Words | _Codes, sites: np.ndarray, marginal: np.ndarray) -> np.ndarray:
    """Per text: 1, expected toxic tokens (logarithm), the surest token, and expected toxic tokens per root of words."""
    expected = np.bincount(words.text[sites], weights=marginal, minlength=words.rows)
    surest = np.zeros(words.rows)
    np.maximum.at(surest, words.text[sites], marginal)
    length = np.maximum(np.diff(words.bounds), 1)
    return np.stack([np.ones(words.rows), np.log1p(expected), surest, expected / np.sqrt(length)], axis=1)


def _fit_logistic(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Newton's method with a small penalty."""
    weights = np.zeros(features.shape[1])
    penalty = np.full(features.shape[1], 0.5)
    penalty[0] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        gradient = features.T @ (labels - p) - penalty * weights
        hessian = (features * (p * (1 - p))[:, None]).T @ features + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        weights = weights + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _probability(features: np.ndarray, model: Model) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ model.document, -30, 30)))


@dataclass(frozen=True)
class _Codes:
    """What is needed of the words of many texts to learn from them."""

    code: np.ndarray
    text: np.ndarray
    bounds: np.ndarray
    rows: int

    def __len__(self) -> int:
        return len(self.code)


def _codes_of(texts: pa.Array) -> _Codes:
    """The words of all texts, worked out a slice at a time."""
    code, counts = [], []
    for part in slices(pa.RecordBatch.from_pydict({"text": texts})):
        words = Words(part["text"], WORD_CHARS)
        code.append(words.code)
        counts.append(np.diff(words.bounds))
    n = np.concatenate(counts)
    bounds = np.concatenate([[0], np.cumsum(n)])
    return _Codes(np.concatenate(code), np.repeat(np.arange(len(n), dtype=np.int32), n), bounds, len(n))


def fit(texts: pa.Array, toxic: np.ndarray) -> Model | None:
    """A model of these texts and their labels; None unless both labels occur."""
    if len(np.unique(toxic)) < 2:
        return None
    words = _codes_of(texts)
    if not len(words):
        return None
    chain = Model(*_train_chain(words, toxic), np.zeros(4))
    features = _document_features(words, *token_marginals(words, chain))
    return replace(chain, document=_fit_logistic(features, toxic.astype(float)))


def learnable(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the labels that may be learned from: those whose crc32 of the id as text modulo 3 is not 1."""
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    rows = rows.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)
    return rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCUMENTS) -> Model | None:
    """A model from at most ``limit`` labelled documents and ``SAMPLE_BYTES``, whose texts the driver holds while it
    fits."""
    chosen = learnable(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    table = sample(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    return fit(table["text"].combine_chunks(), table["toxic"].to_numpy()) if table.num_rows else None


def _code_points(words: Words) -> np.ndarray:
    """The number of characters before each byte of the batch."""
    return np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])


def _spans(words: Words, sites: np.ndarray, marginal: np.ndarray) -> list[str]:
    """Per text the toxic spans as ``start:end`` in characters; toxic tokens in a row are one span."""
    toxic = sites[marginal >= 0.5]
    out = [""] * words.rows
    if not len(toxic):
        return out
    breaks = np.append(True, (np.diff(toxic) > 1) | (words.text[toxic[1:]] != words.text[toxic[:-1]]))
    first, last = toxic[breaks], toxic[np.append(breaks[1:], True)]
    at = _code_points(words)
    base = at[words.offsets[words.text[first]]]
    spans: dict[int, list[str]] = {}
    for row, a, b in zip(words.text[first], at[words.start[first]] - base, at[words.end[last]] - base, strict=True):
        spans.setdefault(int(row), []).append(f"{a}:{b}")
    for row, found in spans.items():
        out[row] = ",".join(found)
    return out


def _score(model: Model | None):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        if model is None:
            score, expected, spans = np.full(n, UNKNOWN), np.zeros(n), [""] * n
        else:
            words = Words(batch["text"], WORD_CHARS)
            sites, marginal = token_marginals(words, model)
            features = _document_features(words, sites, marginal)
            score = _probability(features, model)
            expected, spans = np.expm1(features[:, 1]), _spans(words, sites, marginal)
        added = {"score": pa.array(score), "toxic_tokens": pa.array(expected), "toxic_spans": pa.array(spans, pa.string())}
        return pa.RecordBatch.from_pydict({name: batch[name] for name in batch.schema.names} | added)

    return over_batches(work)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``toxic_tokens`` (how many are expected) and ``toxic_spans`` (``start:end`` in
    characters, comma-joined) for its column ``text``.

    Null and empty texts have no tokens and score as any text without toxic tokens. Every row counts by itself. Without a
    model all score 0. Columns of ``docs`` with those names are replaced. An empty table gives no rows.
    """
    docs = docs.drop("score", "toxic_tokens", "toxic_spans")
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_score(model), f"{fields}, {SCORE_SCHEMA}")


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the spans for every row of ``docs``. A row without an id is not held out."""
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "toxic_tokens", "toxic_spans",
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, that score below the threshold."""
    model = train(docs, labels)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if model is None:
            return batch
        words = Words(batch["text"], WORD_CHARS)
        features = _document_features(words, *token_marginals(words, model))
        return batch.filter(pa.array(_probability(features, model) < THRESHOLD))

    return docs.mapInArrow(over_batches(work), docs.schema)
