"""A semi-Markov conditional random field over short token sequences, in numpy.

A sequence is cut into segments: single tokens outside any entity, and entities of at most
``LONGEST`` tokens. Every candidate entity has features of the whole span; its score under
each type is the sum of their weights, a token outside scores 0. Sums over all ways to cut
(training) and the best way (decoding) go left to right over the candidates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

LONGEST = 16  # tokens of an entity
EPOCHS, RATE, SHRINK = 8, 0.3, 1e-4


@dataclass
class Sequence_:
    """Candidates (first token, token after the last) of a sequence of ``n`` tokens, sorted by
    end, the feature rows of each, and for training the type of each true one."""

    n: int
    spans: list[tuple[int, int]]
    features: np.ndarray  # (candidates, features per candidate)
    truth: dict[int, int]  # candidate → type


def scores(weights: np.ndarray, seq: Sequence_) -> np.ndarray:
    return weights[seq.features].sum(axis=1)


def best_cut(weights: np.ndarray, seq: Sequence_) -> list[tuple[int, int, float]]:
    """(candidate, type, how much better than leaving its tokens outside), left to right."""
    s = scores(weights, seq)
    kinds = s.argmax(axis=1)
    value, back = np.zeros(seq.n + 1), [None] * (seq.n + 1)
    at = 0
    for end in range(1, seq.n + 1):
        value[end] = value[end - 1]
        while at < len(seq.spans) and seq.spans[at][1] == end:
            total = value[seq.spans[at][0]] + s[at, kinds[at]]
            if total > value[end]:
                value[end], back[end] = total, at
            at += 1
    found, end = [], seq.n
    while end > 0:
        if back[end] is None:
            end -= 1
        else:
            c = back[end]
            found.append((c, int(kinds[c]), float(s[c, kinds[c]])))
            end = seq.spans[c][0]
    return found[::-1]


def expectations(weights: np.ndarray, seq: Sequence_) -> np.ndarray:
    """Probability of every candidate under every type."""
    s = scores(weights, seq)
    total = np.logaddexp.reduce(s, axis=1)
    ahead = np.zeros(seq.n + 1)
    at = 0
    for end in range(1, seq.n + 1):
        here = [ahead[end - 1]]
        while at < len(seq.spans) and seq.spans[at][1] == end:
            here.append(ahead[seq.spans[at][0]] + total[at])
            at += 1
        ahead[end] = np.logaddexp.reduce(here)
    after = np.zeros(seq.n + 1)
    by_start = sorted(range(len(seq.spans)), key=lambda c: -seq.spans[c][0])
    at = 0
    for start in range(seq.n - 1, -1, -1):
        here = [after[start + 1]]
        while at < len(by_start) and seq.spans[by_start[at]][0] == start:
            here.append(after[seq.spans[by_start[at]][1]] + total[by_start[at]])
            at += 1
        after[start] = np.logaddexp.reduce(here)
    starts, ends = np.array(seq.spans).T
    return np.exp(ahead[starts][:, None] + s + after[ends][:, None] - ahead[seq.n])


def fit(sequences: Sequence[Sequence_], rows: int, types: int, seed: int = 5) -> np.ndarray:
    """Feature weights (rows, types) by stochastic ascent of the likelihood."""
    rng = np.random.default_rng(seed)
    weights, seen = np.zeros((rows, types)), np.full((rows, types), 1e-6)
    usable = [s for s in sequences if s.spans]
    for _ in range(EPOCHS):
        for i in rng.permutation(len(usable)):
            seq = usable[i]
            step = -expectations(weights, seq)
            for c, kind in seq.truth.items():
                step[c, kind] += 1
            flat = seq.features.ravel()
            g = np.repeat(step, seq.features.shape[1], axis=0)
            used, place = np.unique(flat, return_inverse=True)
            total = np.zeros((len(used), types))
            np.add.at(total, place, g)
            total -= SHRINK * weights[used]
            seen[used] += total * total
            weights[used] += RATE * total / np.sqrt(seen[used])
    return weights
