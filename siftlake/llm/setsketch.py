"""SetSketch registers: exponentially spaced truncated minima over a set, and the joint estimate from two sketches.

Element ``d`` gives every register ``i`` an exponential value with rate ``A``; register ``i`` keeps the smallest value
``x`` over the set as ``floor(1 - log_B(x))``, held between 0 and ``LIMIT + 1``. The sketch of a union is the larger of the
registers, and equal registers are as likely as shingles in common, so registers can be banded like minhashes.

The values of one element are the arrivals of a Poisson process with rate ``A * REGISTERS``, each at a random register:
the first arrival at a register is exponential with rate ``A``, and only arrivals early enough to matter are made.
"""

from __future__ import annotations

import numpy as np

from siftlake.llm.tokens import MULTIPLIER, U64, mix, unit

REGISTERS = 160
BASE = 1.001
RATE = 20.0
LIMIT = 2**16 - 2
BAND = 4
BANDS = REGISTERS // BAND
_SPREAD = np.log(REGISTERS) + 4.0
_CELLS = 1 << 18


def _registers(minima: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(1.0 - np.log(minima) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def _arrivals(owner: np.ndarray, codes: np.ndarray, until: np.ndarray, minima: np.ndarray) -> None:
    """Lower ``minima`` (owner by register) by all arrivals up to ``until`` (by owner)."""
    flat = minima.reshape(-1)
    when, step = np.zeros(len(codes)), 0
    while len(codes):
        ahead = float(np.median(until[owner])) * RATE * REGISTERS
        width = int(np.clip(ahead / 2 + 1, 1, max(1, _CELLS // len(codes))))
        numbers = mix(codes[:, None] + (np.arange(step + 1, step + width + 1, dtype=U64) * MULTIPLIER)[None, :])
        at = when[:, None] - np.cumsum(np.log(unit(numbers)), axis=1) / (RATE * REGISTERS)
        row, column = np.nonzero(at <= until[owner][:, None])
        register = (mix(numbers[row, column]) % U64(REGISTERS)).astype(np.int64)
        np.minimum.at(flat, owner[row] * REGISTERS + register, at[row, column])
        going = at[:, -1] <= until[owner]
        owner, codes, when = owner[going], codes[going], at[going, -1]
        step += width


def sketch(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of registers per set; the codes of set ``i`` are ``bounds[i]`` up to ``bounds[i + 1]``. An empty set has
    zeros."""
    counts = np.diff(bounds)
    out = np.zeros((len(counts), REGISTERS), np.uint16)
    sizes = np.where(counts > 0, np.ceil(np.log2(np.maximum(counts, 1))).astype(int), -1)
    for size in np.unique(sizes[sizes >= 0]):
        rows = np.flatnonzero(sizes == size)
        minima = np.full((len(rows), REGISTERS), np.inf)
        spread, open_rows = _SPREAD, np.arange(len(rows))
        while len(open_rows):
            # A register that saw no arrival needs later ones; the same arrivals are made again up to a later time.
            until = np.zeros(len(rows))
            until[open_rows] = spread / (counts[rows[open_rows]] * RATE)
            lengths = counts[rows[open_rows]]
            owner = np.repeat(open_rows, lengths)
            first = np.repeat(bounds[rows[open_rows]] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
            chosen = codes[first + np.arange(len(owner))]
            for a in range(0, len(owner), _CELLS):
                _arrivals(owner[a : a + _CELLS], chosen[a : a + _CELLS], until, minima)
            open_rows = open_rows[~np.isfinite(minima[open_rows]).all(axis=1)]
            spread *= 1.6
        out[rows] = _registers(minima)
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band: its four registers side by side."""
    return np.ascontiguousarray(registers).view(np.int64)


def _log_likelihood(similarity, above, below, share_a, share_b):
    def ahead(x):
        return -np.log1p(-x * (BASE - 1.0) / BASE) / np.log(BASE)

    up = np.maximum(ahead(np.maximum(share_a - share_b * similarity, 0.0)), 1e-12)
    down = np.maximum(ahead(np.maximum(share_b - share_a * similarity, 0.0)), 1e-12)
    same = np.maximum(1.0 - up - down, 1e-12)
    return above * np.log(up) + below * np.log(down) + (REGISTERS - above - below) * np.log(same)


def similarity(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches, from the registers that are larger on the one side,
    larger on the other, or equal, and the known sizes of both sets."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    total = (size_a + size_b).astype(np.float64)
    share_a, share_b = size_a / total, size_b / total
    low = np.zeros(len(a))
    high = np.minimum(share_a / share_b, share_b / share_a)
    # The likelihood has one peak: a golden-section search closes in on it.
    ratio = (np.sqrt(5.0) - 1.0) / 2.0
    for _ in range(24):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        rising = _log_likelihood(left, above, below, share_a, share_b) < _log_likelihood(
            right, above, below, share_a, share_b
        )
        low, high = np.where(rising, left, low), np.where(rising, high, right)
    return (low + high) / 2.0
