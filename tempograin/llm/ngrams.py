"""Hashed character and word n-grams of a batch of texts, with numpy."""

from __future__ import annotations

import numpy as np

from .common import LOWER, SPACES, mix64, word_hashes, word_spans


def char_grams(data: np.ndarray, n: int, bits: int, ends: np.ndarray) -> np.ndarray:
    """The bucket, from 1, of the n bytes that start at each position; 0 where
    they would pass the end of the text, which ``ends`` gives for each byte."""
    code = np.zeros(len(data), dtype=np.uint64)
    for i in range(min(n, len(data))):
        code[: len(data) - i] = code[: len(data) - i] * np.uint64(257) + data[i:]
    out = (mix64(code + np.uint64(n << 56)) >> np.uint64(64 - bits)).astype(np.int32)
    out[out == 0] = 1
    out[np.arange(n, len(data) + n) > ends] = 0
    return out


def word_grams(data: np.ndarray, n: int, bits: int, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of the runs of n words inside a text, and the byte at which
    each starts. ``texts``: where the texts start."""
    starts, ends = word_spans(~SPACES[data])
    words = word_hashes(data, starts, ends)
    code = words[: max(0, len(words) - n + 1)].copy()
    for i in range(1, n):
        code = code * np.uint64(0xD6E8FEB86659FD93) + words[i : i + len(code)]
    of = np.searchsorted(texts, starts, side="right")
    inside = of[: len(code)] == of[n - 1 :]
    return (mix64(code[inside] + np.uint64(n)) >> np.uint64(64 - bits)).astype(np.int32), starts[: len(code)][inside]


def lowered(data: np.ndarray) -> np.ndarray:
    return LOWER[data]


def fit_logistic(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, n_cols: int, l2: float, steps: int = 120) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on sparse rows, by accelerated
    gradient steps with a step size from the largest row."""
    n = len(y)
    squares = np.bincount(rows, values * values, minlength=n) + 1
    # Power iteration for the norm of X'X / n.
    v = np.random.default_rng(0).standard_normal(n_cols)
    norm = 1.0
    for _ in range(12):
        v = np.bincount(cols, values * np.bincount(rows, values * v[cols], minlength=n)[rows], minlength=n_cols)
        norm = float(np.linalg.norm(v)) or 1.0
        v /= norm
    rate = 1.0 / (0.25 * max(norm, float(squares.max())) / n + 0.25 + l2)
    w, b, pw, pb, t = np.zeros(n_cols), 0.0, np.zeros(n_cols), 0.0, 1.0
    zw, zb = w, b
    for _ in range(steps):
        p = sigmoid(np.bincount(rows, values * zw[cols], minlength=n) + zb)
        g = (p - y) / n
        w, b = zw - rate * (np.bincount(cols, values * g[rows], minlength=n_cols) + l2 * zw), zb - rate * float(g.sum())
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        zw, zb = w + (t - 1) / nt * (w - pw), b + (t - 1) / nt * (b - pb)
        pw, pb, t = w, b, nt
    return w, b


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit_platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b of sigmoid(a x + b), with Platt's smoothed targets, by Newton steps."""
    pos, neg = float(y.sum()), float(len(y) - y.sum())
    target = np.where(y > 0.5, (pos + 1) / (pos + 2), 1 / (neg + 2))
    mean, std = (float(x.mean()), float(x.std()) or 1.0) if len(x) else (0.0, 1.0)
    z = (x - mean) / std
    a, b = 0.0, float(np.log((pos + 1) / (neg + 1)))
    for _ in range(60):
        p = sigmoid(a * z + b)
        g, h = p - target, p * (1 - p) + 1e-9
        grad = np.array([(g * z).sum() + 1e-3 * a, g.sum()])
        hess = np.array([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        size = max(1.0, float(np.abs(step).max()) / 2.0)
        a, b = a - step[0] / size, b - step[1] / size
    return a / std, b - a * mean / std
