"""A linear-chain conditional random field with two labels over binary features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Model:
    """Weights: a pair per feature, one table of label pairs per kind of edge, and the start."""

    features: dict[str, int]
    state: np.ndarray  # (features, 2)
    edge: np.ndarray  # (kinds, 2, 2)
    start: np.ndarray  # (2,)

    def scores(self, sequence: list[list[str]]) -> np.ndarray:
        known = self.features
        out = np.zeros((len(sequence), 2))
        for i, names in enumerate(sequence):
            out[i] = self.state[[known[n] for n in names if n in known]].sum(axis=0)
        return out

    def decode(self, sequence: list[list[str]], kinds: list[int]) -> list[int]:
        """The most probable labels (Viterbi); kinds[i] is the edge into place i."""
        if not sequence:
            return []
        scores = self.scores(sequence).tolist()
        edge = self.edge.tolist()
        a, b = (self.start + scores[0]).tolist()
        back = []
        for (x, y), kind in zip(scores[1:], kinds[1:], strict=True):
            (aa, ab), (ba, bb) = edge[kind]
            into_a, into_b = a + aa >= b + ba, a + ab >= b + bb
            back.append((0 if into_a else 1, 0 if into_b else 1))
            a, b = max(a + aa, b + ba) + x, max(a + ab, b + bb) + y
        labels = [0 if a >= b else 1]
        for pair in reversed(back):
            labels.append(pair[labels[-1]])
        return labels[::-1]


def fit(
    sequences: list[list[list[str]]],
    kinds: list[list[int]],
    labels: list[list[int]],
    n_kinds: int,
    rounds: int = 150,
    rate: float = 0.1,
    decay: float = 1e-4,
) -> Model:
    """Maximum likelihood by forward-backward gradients and Adam, all sequences at once."""
    names = sorted({n for s in sequences for f in s for n in f})
    index = {n: i for i, n in enumerate(names)}
    n, longest = len(sequences), max(map(len, sequences))
    x = np.zeros((n, longest, len(names)), np.float32)
    y = np.zeros((n, longest), np.int64)
    kind = np.zeros((n, longest), np.int64)
    real = np.zeros((n, longest), bool)
    for i, (s, k, lab) in enumerate(zip(sequences, kinds, labels, strict=True)):
        real[i, : len(s)], kind[i, : len(s)], y[i, : len(s)] = True, k, lab
        for j, f in enumerate(s):
            x[i, j, [index[name] for name in f]] = 1
    sizes = [(len(names), 2), (n_kinds, 2, 2), (2,)]
    weights = [np.zeros(s) for s in sizes]
    moments = [(np.zeros(s), np.zeros(s)) for s in sizes]
    for step in range(1, rounds + 1):
        gradients = _gradients(x, y, kind, real, *weights)
        for w, g, (m, v) in zip(weights, gradients, moments, strict=True):
            g = g / n - decay * w
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(index, *weights)


def _gradients(x, y, kind, real, state, edge, start):
    """What was seen less what the model expects, for each weight."""
    n, longest = y.shape
    rows = np.arange(n)
    scores = x @ state.astype(np.float32)
    alpha = np.zeros((n, longest, 2))
    alpha[:, 0] = start + scores[:, 0]
    for t in range(1, longest):
        moved = alpha[:, t - 1, :, None] + edge[kind[:, t]]
        new = np.logaddexp(moved[:, 0], moved[:, 1]) + scores[:, t]
        alpha[:, t] = np.where(real[:, t, None], new, alpha[:, t - 1])
    total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    beta = np.zeros((n, longest, 2))
    pairs = np.zeros((n, longest, 2, 2))
    for t in range(longest - 1, 0, -1):
        ahead = edge[kind[:, t]] + (scores[:, t] + beta[:, t])[:, None, :]
        here = real[:, t]
        pairs[here, t] = np.exp(alpha[here, t - 1, :, None] + ahead[here] - total[here, None, None])
        beta[:, t - 1] = np.where(here[:, None], np.logaddexp(ahead[..., 0], ahead[..., 1]), 0)
    single = np.exp(alpha + beta - total[:, None, None]) * real[..., None]
    seen = np.zeros_like(single)
    seen[rows[:, None], np.arange(longest)[None, :], y] = 1
    seen *= real[..., None]
    difference = (seen - single).astype(np.float32)
    g_state = np.tensordot(x, difference, axes=((0, 1), (0, 1)))
    g_edge = np.zeros_like(edge)
    steps = real[:, 1:]
    np.add.at(g_edge, (kind[:, 1:][steps], y[:, :-1][steps], y[:, 1:][steps]), 1)
    np.subtract.at(g_edge, kind[:, 1:][steps], pairs[:, 1:][steps])
    return g_state, g_edge, difference[:, 0].sum(axis=0)
