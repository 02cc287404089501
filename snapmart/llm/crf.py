"""Linear-chain conditional random fields with two labels, over many sequences laid end to end."""

from typing import NamedTuple

import numpy as np


class Chain(NamedTuple):
    """Label 1 scores ``features @ weights + bias`` above label 0; ``change[i, j]`` scores label j after i, ``start[j]`` label j at first."""

    weights: np.ndarray
    bias: float
    change: np.ndarray
    start: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def _messages(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised products of a row vector with the matrices [[a, b], [c, d]], after each of them.

    The sequence is cut into about as many pieces as each has steps. All pieces' products advance together, a short pass
    links them, and a second pass gives the vectors: 3 sqrt(n) vector steps instead of n.
    """
    n = len(a)
    steps = int(np.sqrt(n)) + 1
    pieces = -(-n // steps)

    def folded(x: np.ndarray, fill: float) -> np.ndarray:
        return np.concatenate([x, np.full(pieces * steps - n, fill)]).reshape(pieces, steps).T.copy()

    a, b, c, d = folded(a, 1.0), folded(b, 0.0), folded(c, 0.0), folded(d, 1.0)
    p, q, r, s = np.ones(pieces), np.zeros(pieces), np.zeros(pieces), np.ones(pieces)
    for t in range(steps):
        p, q, r, s = p * a[t] + q * c[t], p * b[t] + q * d[t], r * a[t] + s * c[t], r * b[t] + s * d[t]
        total = p + q + r + s
        p, q, r, s = p / total, q / total, r / total, s / total
    x, y = np.empty(pieces), np.empty(pieces)
    u, v = 0.5, 0.5
    for k in range(pieces):
        x[k], y[k] = u, v
        u, v = u * p[k] + v * r[k], u * q[k] + v * s[k]
        u, v = u / (u + v), v / (u + v)
    out = np.empty((2, steps, pieces))
    for t in range(steps):
        x, y = x * a[t] + y * c[t], x * b[t] + y * d[t]
        total = x + y
        x, y = x / total, y / total
        out[0, t], out[1, t] = x, y
    return out[0].T.ravel()[:n], out[1].T.ravel()[:n]


def _matrices(score: np.ndarray, first: np.ndarray, change: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    """Potentials of (label before, label here); those of a sequence's first place don't depend on what is before it."""
    top = np.maximum(score, 0.0)
    here = np.exp(-top), np.exp(score - top)
    return [np.where(first, np.exp(start[j]), np.exp(change[i, j])) * here[j] for i in (0, 1) for j in (0, 1)]


def forward_backward(score: np.ndarray, first: np.ndarray, change: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of label 1, and of each (label before, label here), n x 4, which hold nothing at first places."""
    if not len(score):
        return np.empty(0), np.empty((0, 4))
    m = _matrices(score, first, change, start)
    f0, f1 = _messages(*m)
    # Backward: the same products from the end, with the matrices of the next places turned over.
    nxt = [np.append(x[1:], 1.0)[::-1] for x in (m[0], m[2], m[1], m[3])]
    b0, b1 = (x[::-1] for x in _messages(*nxt))
    p = f1 * b1 / (f0 * b0 + f1 * b1)
    before0, before1 = np.append(0.5, f0[:-1]), np.append(0.5, f1[:-1])
    pairs = np.stack([before0 * m[0] * b0, before0 * m[1] * b1, before1 * m[2] * b0, before1 * m[3] * b1], axis=1)
    return p, pairs / pairs.sum(axis=1, keepdims=True)


def scores(chain: Chain, features: np.ndarray) -> np.ndarray:
    return ((features - chain.mean) / chain.scale) @ chain.weights + chain.bias


def marginals(chain: Chain, features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probability of label 1 at each place."""
    return forward_backward(scores(chain, features), first, chain.change, chain.start)[0]


def fit(features: np.ndarray, labels: np.ndarray, first: np.ndarray, penalty: float = 1e-3, steps: int = 200, rate: float = 0.1) -> Chain:
    """Penalised maximum likelihood by Adam steps on the full gradient: what was seen less what forward-backward expects."""
    n, width = features.shape
    mean, scale = (features.mean(axis=0), features.std(axis=0)) if n else (np.zeros(width), np.ones(width))
    scale = np.where(scale > 1e-9, scale, 1.0)
    x, y = (features - mean) / scale, labels.astype(float)
    later = ~first
    code = 2 * np.append(0, labels[:-1]).astype(int) + labels.astype(int) if n else np.empty(0, int)
    seen = np.bincount(code[later], minlength=4)
    begun = np.bincount(labels[first].astype(int), minlength=2)
    w = np.zeros(width + 7)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1 if n else 1):
        change, start = w[width + 1:width + 5].reshape(2, 2), w[width + 5:]
        p, pairs = forward_backward(x @ w[:width] + w[width], first, change, start)
        p1 = p[first]
        up = np.concatenate([(y - p) @ x, [np.sum(y - p)], seen - pairs[later].sum(axis=0), begun - [np.sum(1 - p1), np.sum(p1)]]) / n - penalty * w
        m, v = 0.9 * m + 0.1 * up, 0.999 * v + 0.001 * up * up
        w = w + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Chain(w[:width], float(w[width]), w[width + 1:width + 5].reshape(2, 2), w[width + 5:], mean, scale)


def logistic(features: np.ndarray, labels: np.ndarray, penalty: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weights and, last, the constant of a penalised logistic regression, by Newton steps."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    for _ in range(steps if len(x) else 0):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - labels) / len(x) + penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(x) + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))
