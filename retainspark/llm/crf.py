"""Linear-chain conditional random fields in numpy, over many sequences at once.

A batch is a matrix of label scores (one row per item, sequences one after the
other) and the sequences' lengths.  All sequences advance together, one item a
step, longest first, so the cost of a step is shared by the batch.
"""

from __future__ import annotations

import numpy as np


class Batch:
    """Rows of the items at each step, for sequences of the given lengths."""

    def __init__(self, lengths: np.ndarray):
        lengths = np.asarray(lengths, dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        self.first = starts[order]
        self.lengths = lengths[order]
        self.total = int(lengths.sum())
        steps = int(self.lengths[0]) if len(order) else 0
        self.active = np.searchsorted(-self.lengths, -np.arange(1, steps + 1), side="right").tolist()


def marginals(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray,
              transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Label probabilities of every item (forward-backward), the expected number
    of each transition, and the batch's log partition."""
    b = Batch(lengths)
    peak = scores.max(axis=1, keepdims=True)
    e = np.exp(scores - peak)
    t = np.exp(transition)
    alpha, scale = np.empty_like(e), np.ones(len(e))
    for k, n in enumerate(b.active):
        at = b.first[:n] + k
        a = (alpha[at - 1] @ t if k else np.exp(start)) * e[at]
        scale[at] = z = a.sum(axis=1)
        alpha[at] = a / z[:, None]
    prob, pairs = np.empty_like(e), np.zeros_like(t)
    beta = np.ones((b.active[0] if b.active else 0, e.shape[1]))
    for k in range(len(b.active) - 1, -1, -1):
        n = b.active[k]
        more = b.active[k + 1] if k + 1 < len(b.active) else 0
        if more:
            after = b.first[:more] + k + 1
            right = e[after] * beta[:more] / scale[after][:, None]
            pairs += t * (alpha[after - 1].T @ right)
            beta[:more] = right @ t.T
        prob[b.first[:n] + k] = alpha[b.first[:n] + k] * beta[:n]
    return prob, pairs, float(np.log(scale).sum() + peak.sum())


def viterbi(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """The best label sequence of every sequence; of equal ones the smaller labels."""
    b = Batch(lengths)
    best, back = np.empty_like(scores), np.zeros(scores.shape, dtype=np.int8)
    for k, n in enumerate(b.active):
        at = b.first[:n] + k
        if k:
            via = best[at - 1][:, :, None] + transition
            back[at] = via.argmax(axis=1)
            best[at] = via.max(axis=1) + scores[at]
        else:
            best[at] = start + scores[at]
    labels = np.zeros(len(scores), dtype=np.int8)
    for k in range(len(b.active) - 1, -1, -1):
        n = b.active[k]
        more = b.active[k + 1] if k + 1 < len(b.active) else 0
        at = b.first[:n] + k
        labels[at[more:]] = best[at[more:]].argmax(axis=1)
        labels[at[:more]] = back[at[:more] + 1, labels[at[:more] + 1]]
    return labels


def train(items: list[np.ndarray], gold: np.ndarray, lengths: np.ndarray, features: int, labels: int,
          epochs: int = 12, batch: int = 256, rate: float = 0.2, decay: float = 1e-6, seed: int = 7,
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(weights, start, transition)`` of the maximum-likelihood model, by
    AdaGrad on batches of sequences.

    ``items`` holds each item's active (binary) feature numbers, ``gold`` its
    label.  The sample is bounded by the caller; nothing here is distributed."""
    rng = np.random.default_rng(seed)
    lengths = np.asarray(lengths)
    starts = np.cumsum(lengths) - lengths
    sizes = np.array([len(x) for x in items])
    offsets = np.cumsum(sizes) - sizes
    flat = np.concatenate(items) if items else np.empty(0, np.int64)
    w, s, t = np.zeros((features, labels)), np.zeros(labels), np.zeros((labels, labels))
    gw, gs, gt = np.full_like(w, 1e-8), np.full_like(s, 1e-8), np.full_like(t, 1e-8)
    eye = np.eye(labels)
    filled = np.flatnonzero(lengths > 0)
    for _ in range(epochs):
        rng.shuffle(filled)
        for lo in range(0, len(filled), batch):
            seqs = filled[lo:lo + batch]
            n = lengths[seqs]
            rows = np.repeat(starts[seqs] - np.cumsum(n) + n, n) + np.arange(n.sum())
            k = sizes[rows]
            owner = np.repeat(np.arange(len(rows)), k)
            active = flat[np.repeat(offsets[rows] - np.cumsum(k) + k, k) + np.arange(k.sum())]
            cols = [np.bincount(owner, weights=w[active, y], minlength=len(rows)) for y in range(labels)]
            prob, pairs, _ = marginals(np.stack(cols, axis=1), n, s, t)
            y = gold[rows]
            g = eye[y] - prob
            inner = np.ones(len(rows), dtype=bool)
            heads = np.cumsum(n) - n
            inner[heads] = False
            seen = np.zeros_like(t)
            np.add.at(seen, (y[np.flatnonzero(inner) - 1], y[inner]), 1)
            used, where = np.unique(active, return_inverse=True)
            grad = np.stack([np.bincount(where, weights=g[owner, c], minlength=len(used)) for c in range(labels)], axis=1)
            grad = grad / len(seqs) - decay * w[used]
            gw[used] += grad ** 2
            w[used] += rate * grad / np.sqrt(gw[used])
            gradient = (seen - pairs) / len(seqs)
            gt += gradient ** 2
            t += rate * gradient / np.sqrt(gt)
            gradient = g[heads].mean(axis=0)
            gs += gradient ** 2
            s += rate * gradient / np.sqrt(gs)
    return w, s, t
