"""A linear-chain conditional random field over dense features, in flat arrays of many chains."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def steps(begins: np.ndarray) -> list[np.ndarray]:
    """For each place t the elements that are the t-th of their chain."""
    lengths = np.diff(begins)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = begins[:-1][order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # chains longer than t
    return [starts[:n] + t for t, n in enumerate(active.tolist())]


def forward_backward(scores: np.ndarray, trans: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log forward and backward sums of each element and label, and each chain's log partition sum."""
    at = steps(begins)
    alpha, beta = scores.copy(), np.zeros_like(scores)
    for idx in at[1:]:
        alpha[idx] += log_sum(alpha[idx - 1][:, :, None] + trans, axis=1)
    for idx in reversed(at[1:]):
        beta[idx - 1] = log_sum((scores[idx] + beta[idx])[:, None, :] + trans, axis=2)
    full = np.diff(begins) > 0
    total = np.zeros(len(begins) - 1)
    total[full] = log_sum(alpha[begins[1:][full] - 1], axis=1)
    return alpha, beta, total


def viterbi(scores: np.ndarray, trans: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The best label of each element; the smaller label on ties."""
    at = steps(begins)
    best, back = scores.copy(), np.zeros(scores.shape, np.int64)
    for idx in at[1:]:
        through = best[idx - 1][:, :, None] + trans
        back[idx] = through.argmax(axis=1)
        best[idx] += through.max(axis=1)
    labels = best.argmax(axis=1)
    last = np.zeros(len(scores), bool)
    last[begins[1:][np.diff(begins) > 0] - 1] = True
    for idx in reversed(at[1:]):
        labels[idx - 1] = back[idx, labels[idx]]  # the elements after them are settled
    return labels


@dataclass
class Crf:
    """Weights of standardized features and of label pairs."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # features and a constant, by label
    trans: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]

    def marginals(self, x: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The probability of each label of each element."""
        alpha, beta, total = forward_backward(self.scores(x), self.trans, begins)
        return np.exp(alpha + beta - np.repeat(total, np.diff(begins))[:, None])

    def decode(self, x: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return viterbi(self.scores(x), self.trans, begins)


def fit(x: np.ndarray, y: np.ndarray, begins: np.ndarray, labels: int = 2, decay: float = 1e-3, rounds: int = 250, rate: float = 0.1) -> Crf:
    """Maximum likelihood with quadratic decay, by full-batch Adam; chains weigh by their elements."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    n = max(1, len(x))
    inner = np.ones(len(x), bool)
    inner[begins[:-1][np.diff(begins) > 0]] = False
    follows = np.flatnonzero(inner)
    one_hot = np.eye(labels)[y]
    seen = one_hot[follows - 1].T @ one_hot[follows]
    params = [np.zeros((z.shape[1], labels)), np.zeros((labels, labels))]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        w, trans = params
        scores = z @ w
        alpha, beta, total = forward_backward(scores, trans, begins)
        total = np.repeat(total, np.diff(begins))
        p = np.exp(alpha + beta - total[:, None])
        pairs = np.exp(
            alpha[follows - 1][:, :, None] + trans + (scores[follows] + beta[follows])[:, None, :] - total[follows][:, None, None]
        ).sum(axis=0)
        grads = [z.T @ (p - one_hot) / n + decay * w, (pairs - seen) / n + decay * trans]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            params[i] = params[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Crf(mean, scale, params[0], params[1])
