"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans. A field over tokens with a digit or an ``@`` (all others can't be of any kind: they are
observed to be of none, which cuts the chain exactly there) ties neighbours by a chain and distant tokens that repeat by
skip edges: the same token without its punctuation, or the same seven digits or more. Loopy sum-product messages make
equal tokens of a document agree. Tokens that the field is sure of and no base span touches become further spans.

Weights are fitted piecewise (tokens, chain edges, skip edges) to the base spans of a bounded sample.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlake.llm.sampling import sample
from siftlake.llm.tokens import slices

KINDS = ("email", "ip", "card", "phone")
# The field is fitted to this many documents at most, those with the smallest hash of their id.
TRAIN_DOCUMENTS = 3000
SURE = 0.9
ROUNDS = 8
DAMPING = 0.5
# How strongly a base span speaks for its kind, in logarithms.
EVIDENCE = 12.0
# Repeated tokens are rare in a sample: so many pairs of each label speak for agreement from the start.
SKIP_PRIOR = 20.0
SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

# The base patterns. A run of digits can only begin an address at its start, so others are not tried.
_LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
_DIGITS = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield 0, start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """``kind number, start, end`` of the base patterns, by kind and start."""
    found = list(_emails(text))
    if _ANY.search(text) is None:
        return found
    for match in _IP.finditer(text):
        parts = [p.lstrip("0") for p in match[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((1, *match.span()))
    for match in _CARD.finditer(text):
        digits = _DIGITS.sub("", match[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", match[0])) <= 15:
                found.append((3, *match.span()))
    return found


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= e for e in edges)


_DIGIT_EDGES, _DOT_EDGES = (1, 4, 9, 13, 20), (1, 2, 3, 4)
N_FEATURES = 24


def _features(token: str, digits: str, before: bool, after: bool) -> list[int]:
    """The numbers of the features a token has."""
    core = token.strip(".,;:!?()[]{}<>\"'")
    found = [0, 1 + _bucket(len(digits), _DIGIT_EDGES), 7 + _bucket(token.count("."), _DOT_EDGES)]
    tests = (
        "@" in token, token.startswith("+"), any(c.isalpha() for c in token), len(core) == len(digits),
        13 <= len(digits) <= 19 and _luhn(digits), _IP.fullmatch(core) is not None, before, after,
        "@" in token and "." in token.rpartition("@")[2], "(" in token or ")" in token, "-" in token, "_" in token,
    )
    return found + [12 + k for k, yes in enumerate(tests) if yes]


@dataclass
class Nodes:
    """The nodes of some documents: their features, the base kind (0: none), place, and edges of both sorts."""

    features: list[list[int]]
    base: list[int]
    document: list[int]
    start: list[int]
    end: list[int]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def nodes_of(texts: list[str | None], spans: list[list[Span]]) -> Nodes:
    out = Nodes([], [], [], [], [], [], [])
    for document, (text, found) in enumerate(zip(texts, spans, strict=True)):
        if not text or _ANY.search(text) is None:
            continue
        found = sorted(found, key=lambda s: s[1])
        at, last_end, seen = 0, -2, {}
        tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        is_node = [_ANY.search(text, a, b) is not None for a, b in tokens]
        for k, (start, end) in enumerate(tokens):
            if not is_node[k]:
                continue
            token, number = text[start:end], len(out.base)
            digits = _DIGITS.sub("", token)
            before, after = k > 0 and is_node[k - 1], k + 1 < len(tokens) and is_node[k + 1]
            while at < len(found) and found[at][2] <= start:
                at += 1
            kinds = [s[0] + 1 for s in found[at : at + 4] if s[1] < end and s[2] > start]
            out.features.append(_features(token, digits, before, after))
            out.base.append(min(kinds, default=0))
            out.document.append(document)
            out.start.append(start)
            out.end.append(end)
            if before and last_end == k - 1:
                out.chain.append((number - 1, number))
            last_end = k
            keys = [token.strip(".,;:!?()[]{}<>\"'+").lower()]
            if len(digits) >= 7:
                keys.append(f"#{digits}")
            tied = set()
            for key in keys:
                # Each occurrence is tied to the one before: as many edges as tokens, however often one repeats.
                if len(key) > 2 and key in seen and seen[key] not in tied:
                    out.skip.append((seen[key], number))
                    tied.add(seen[key])
                if len(key) > 2:
                    seen[key] = number
    return out


@dataclass(frozen=True)
class Field:
    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


_K = len(KINDS) + 1


def _incidence(features: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(features), N_FEATURES), np.float32)
    for row, own in enumerate(features):
        out[row, own] = 1
    return out


def _edge_table(edges: list[tuple[int, int]], label: np.ndarray, alike: float = 0.0) -> np.ndarray:
    """How much likelier each pair of labels is than by their shares, in logarithms, smoothed and symmetric. ``alike``
    pairs of each label are taken for seen beforehand."""
    joint = np.full((_K, _K), 0.5) + alike * np.eye(_K)
    for a, b in edges:
        joint[label[a], label[b]] += 1
        joint[label[b], label[a]] += 1
    joint /= joint.sum()
    share = joint.sum(axis=1)
    return np.clip(np.log(joint / np.outer(share, share)), -3, 3)


def fit(texts: list[str | None]) -> Field:
    spans = [base_spans(t or "") for t in texts]
    nodes = nodes_of(texts, spans)
    label = np.array(nodes.base, int)
    x = _incidence(nodes.features)
    weights = np.zeros((N_FEATURES, _K))
    if len(label):
        truth = np.eye(_K)[label]
        squares = np.full_like(weights, 1e-6)
        for _ in range(200):
            scores = x @ weights
            p = np.exp(scores - scores.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            gradient = x.T @ (truth - p) - 0.05 * weights
            squares += gradient**2
            weights += 0.5 * gradient / np.sqrt(squares)
    else:
        weights[0, 0] = 5.0
    return Field(weights, _edge_table(nodes.chain, label), _edge_table(nodes.skip, label, SKIP_PRIOR))


def marginals(nodes: Nodes, field: Field) -> np.ndarray:
    """Sum-product messages along all edges at once, damped, for a fixed number of rounds."""
    base = np.array(nodes.base, int)
    unary = _incidence(nodes.features) @ field.unary
    unary[base > 0] = 0
    unary[base > 0, base[base > 0]] = EVIDENCE
    edges = nodes.chain + nodes.skip
    if edges:
        a, b = np.array(edges).T
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        tables = np.concatenate(
            [np.repeat(t[None], n, axis=0) for t, n in ((field.chain, len(nodes.chain)), (field.skip, len(nodes.skip)))]
        )
        tables = np.exp(np.concatenate([tables, tables.transpose(0, 2, 1)]))
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        message = np.zeros((len(source), _K))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = belief[source] - message[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            sent = np.log(np.einsum("ei,eij->ej", out, tables))
            sent -= sent.max(axis=1, keepdims=True)
            message = DAMPING * message + (1 - DAMPING) * sent
        np.add.at(unary, target, message)
    p = np.exp(unary - unary.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def all_spans(texts: list[str | None], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """Of each text the base spans and those the field adds, by kind and start."""
    spans = [base_spans(t or "") for t in texts]
    nodes = nodes_of(texts, spans)
    added: list[list[Span]] = [[] for _ in texts]
    if nodes.base:
        p = marginals(nodes, field)
        kind = p.argmax(axis=1)
        for i in np.flatnonzero((kind > 0) & (p.max(axis=1) >= SURE) & (np.array(nodes.base) == 0)):
            text = texts[nodes.document[i]]
            token = text[nodes.start[i] : nodes.end[i]]
            start = nodes.start[i] + len(token) - len(token.lstrip(".,;:!?()[]{}<>\"'"))
            end = nodes.end[i] - (len(token) - len(token.rstrip(".,;:!?()[]{}<>\"'")))
            if start < end:
                added[nodes.document[i]].append((int(kind[i]) - 1, start, end))
    return [(sorted(a), sorted(b)) for a, b in zip(spans, added, strict=True)]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def train(docs: DataFrame, limit: int = TRAIN_DOCUMENTS) -> Field:
    """A field from at most ``limit`` documents and ``SAMPLE_BYTES``, whose texts the driver holds while it fits."""
    chosen = docs.select("doc_id").where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select("doc_id", "text").where("text RLIKE '[0-9@]'")
    return fit(sample(rows.join(F.broadcast(chosen.distinct()), "doc_id"))["text"].to_pylist())


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id``, how many base spans of each kind, the hash of the base spans, all ``spans`` and how many the field
    added, for every row of ``docs`` (``doc_id, text``; other columns are left out).

    Null and empty texts have no spans. Rows that repeat an id are read one by one. An empty table gives no rows.
    """
    field = field or train(docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = all_spans(part["text"].to_pylist(), field)
                columns = {"doc_id": part["doc_id"]}
                for k, kind in enumerate(KINDS):
                    columns[f"n_{kind}"] = pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64())
                digests = [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found]
                columns["base_sha256"] = pa.array(digests, pa.string())
                columns["spans"] = pa.array([_joined(sorted(base + more)) for base, more in found], pa.string())
                columns["n_added"] = pa.array([len(more) for _, more in found], pa.int64())
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {dict(docs.dtypes)['doc_id']}, {SCHEMA}")
