"""Linear-chain conditional random fields with two labels, in numpy.

Training maximises the conditional likelihood of whole label sequences by gradient
steps (forward-backward over all sequences at once, position by position); decoding is exact
Viterbi over all sequences of a block at once, one step per position.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  #: features by label
    transition: np.ndarray  #: from label, to label
    start: np.ndarray


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(features: list[np.ndarray], labels: list[np.ndarray], steps: int = 80, rate: float = 0.15, penalty: float = 1e-3, begin: Model | None = None) -> Model:
    """Fits a model to whole sequences, from zero or from ``begin``; time and memory grow with the number of rows."""
    some = sorted((i for i, y in enumerate(labels) if len(y)), key=lambda i: -len(labels[i]))
    d = features[0].shape[1] if features else 1
    w, tr, st = (m.copy() for m in (begin.weights, begin.transition, begin.start)) if begin else (np.zeros((d, 2)), np.zeros((2, 2)), np.zeros(2))
    if not some:
        return Model(w, tr, st)
    x, y = np.concatenate([features[i] for i in some]).astype(np.float64), np.concatenate([labels[i] for i in some])
    size = np.array([len(labels[i]) for i in some])
    first, n, total = np.cumsum(size) - size, len(some), len(y)
    # rows by position: the longest sequences come first, so those that go on are a prefix
    active = [int(k) for k in np.searchsorted(-size, -np.arange(size[0]), "left")]
    rows = [first[:k] + t for t, k in enumerate(active)]
    later = np.setdiff1d(np.arange(total), first, assume_unique=True)
    hot = np.eye(2)[y]
    want_w, want_t, want_s = x.T @ hot, hot[later - 1].T @ hot[later], hot[first].sum(axis=0)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, tr, st)]
    for step in range(1, steps + 1):
        e = x @ w
        forward, backward = np.empty((total, 2)), np.zeros((total, 2))
        forward[rows[0]] = e[rows[0]] + st
        for t in range(1, len(rows)):
            forward[rows[t]] = _logsum(forward[rows[t] - 1][:, :, None] + tr, 1) + e[rows[t]]
        for t in range(len(rows) - 1, 0, -1):
            backward[rows[t] - 1] = _logsum(tr + (e[rows[t]] + backward[rows[t]])[:, None, :], 2)
        norm = np.repeat(_logsum(forward[first + size - 1], 1), size)
        node = np.exp(forward + backward - norm[:, None])
        pair = np.exp(forward[later - 1][:, :, None] + tr + (e[later] + backward[later])[:, None, :] - norm[later][:, None, None])
        grads = (x.T @ node - want_w) / total + penalty * w, (pair.sum(axis=0) - want_t) / total + penalty * tr, (node[first].sum(axis=0) - want_s) / n + penalty * st
        for p, g, (m, v) in zip((w, tr, st), grads, state, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(w, tr, st)


def viterbi(model: Model, features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The likeliest labels of all rows of ``features``; sequence i has rows offsets[i] to offsets[i + 1]."""
    return best_path(features @ model.weights, model.transition, model.start, offsets)


def best_path(e: np.ndarray, transition: np.ndarray, start: np.ndarray, offsets: np.ndarray, last: np.ndarray | None = None) -> np.ndarray:
    """The highest-scoring labels for emission scores ``e`` (rows by labels), smaller labels first on ties.

    ``start`` holds for all sequences or has a row for each; ``last`` has the label that each must end in, or -1.
    """
    out = np.zeros(len(e), np.int64)
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    order = order[size[order] > 0]
    if not order.size:
        return out
    first, size = offsets[:-1][order], size[order]
    longest = int(size[0])
    score = e[first] + (start[order] if start.ndim == 2 else start)
    back = np.zeros(e.shape, np.int8)
    active = np.searchsorted(-size, -np.arange(longest), "left")  # sequences longer than t
    for t in range(1, longest):
        k = int(active[t])
        through = score[:k, :, None] + transition
        best = through.argmax(axis=1)
        rows = first[:k] + t
        back[rows] = best
        score[:k] = np.take_along_axis(through, best[:, None, :], axis=1)[:, 0] + e[rows]
    label = score.argmax(axis=1)
    if last is not None:
        label = np.where(last[order] >= 0, last[order], label)
    for t in range(longest - 1, -1, -1):
        k = int(active[t])
        rows = first[:k] + t
        out[rows] = label[:k]
        label[:k] = back[rows, label[:k]]
    return out
