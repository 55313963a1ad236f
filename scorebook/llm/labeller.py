"""A bidirectional LSTM in numpy that labels every element of a sequence with document-wide context."""

from __future__ import annotations

import numpy as np


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _flip(x: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Each row's first lens[i] steps in reverse; padding stays behind them."""
    t = np.arange(x.shape[1])
    at = np.where(t < lens[:, None], lens[:, None] - 1 - t, t)
    return np.take_along_axis(x, at.reshape(at.shape + (1,) * (x.ndim - 2)), 1)


def _forward(x, p):
    """Hidden states (batch, time, hidden) and what the backward pass needs."""
    wx, wh, b = p
    n, steps, _ = x.shape
    size = wh.shape[0]
    pre = x @ wx + b
    h, c = np.zeros((n, size), x.dtype), np.zeros((n, size), x.dtype)
    hs, kept = np.empty((n, steps, size), x.dtype), []
    for t in range(steps):
        z = pre[:, t] + h @ wh
        gates = _sigmoid(z[:, :3 * size])
        i, f, o = gates[:, :size], gates[:, size:2 * size], gates[:, 2 * size:]
        g = np.tanh(z[:, 3 * size:])
        c_new = f * c + i * g
        tc = np.tanh(c_new)
        kept.append((h, c, i, f, o, g, tc))
        h, c = o * tc, c_new
        hs[:, t] = h
    return hs, kept


def _backward(x, p, kept, dhs):
    wx, wh, _ = p
    n, steps, _ = x.shape
    size = wh.shape[0]
    dz_all = np.empty((n, steps, 4 * size), x.dtype)
    dwh = np.zeros_like(wh)
    dh, dc = np.zeros((n, size), x.dtype), np.zeros((n, size), x.dtype)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, tc = kept[t]
        dh = dh + dhs[:, t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        dwh += h.T @ dz
        dz_all[:, t] = dz
        dh, dc = dz @ wh.T, dc * f
    flat = dz_all.reshape(-1, 4 * size)
    return [x.reshape(-1, x.shape[2]).T @ flat, dwh, flat.sum(0)]


class Labeller:
    """Parameters: (input, recurrent, bias) of each direction, output weights and bias."""

    def __init__(self, inputs: int, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        one = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = []
        for _ in range(2):
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden:2 * hidden] = 1  # remember at first
            self.p += [one(inputs, 4 * hidden), one(hidden, 4 * hidden), bias]
        self.p += [one(2 * hidden, 1)[:, 0], np.zeros(1, np.float32)]

    def _logits(self, x, lens):
        back = _flip(x, lens)
        hf, kf = _forward(x, self.p[0:3])
        hb, kb = _forward(back, self.p[3:6])
        both = np.concatenate([hf, _flip(hb, lens)], 2)
        return both @ self.p[6] + self.p[7], both, (back, kf, kb)

    def step(self, x, lens, y):
        """Loss and gradients of one padded batch."""
        logits, both, (back, kf, kb) = self._logits(x, lens)
        real = (np.arange(x.shape[1]) < lens[:, None]).astype(np.float32)
        p = _sigmoid(logits)
        loss = -(real * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / real.sum()
        d = (real * (p - y) / real.sum()).astype(np.float32)
        dboth = d[:, :, None] * self.p[6]
        half = dboth.shape[2] // 2
        grads = _backward(x, self.p[0:3], kf, dboth[:, :, :half])
        grads += _backward(back, self.p[3:6], kb, _flip(dboth[:, :, half:], lens))
        return loss, [*grads, np.einsum("nt,nth->h", d, both), np.array([d.sum()], np.float32)]

    def fit(self, xs: list[np.ndarray], ys: list[np.ndarray], epochs: int = 8, batch: int = 32, rate: float = 0.01,
            seed: int = 11) -> float:
        """Adam, its rate falling evenly, over batches of sequences of like length; returns the last epoch's mean loss."""
        rng = np.random.default_rng(seed)
        m, v = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p]
        order, t, mean = np.argsort([len(x) for x in xs], kind="stable"), 0, 0.0
        groups = [order[i:i + batch] for i in range(0, len(order), batch)]
        for epoch in range(epochs):
            pace = rate * (1 - epoch / epochs)  # falls evenly
            losses = []
            for g in rng.permutation(len(groups)):
                x, lens = padded([xs[i] for i in groups[g]])
                y = np.zeros(x.shape[:2], np.float32)
                for r, i in enumerate(groups[g]):
                    y[r, :len(ys[i])] = ys[i]
                loss, grads = self.step(x, lens, y)
                losses.append(loss)
                t += 1
                norm = max(1.0, float(np.sqrt(sum((q * q).sum() for q in grads))))
                for k, q in enumerate(grads):
                    q = q / norm
                    m[k] = 0.9 * m[k] + 0.1 * q
                    v[k] = 0.99 * v[k] + 0.01 * q * q
                    self.p[k] = (self.p[k] - pace * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)
                                 ).astype(np.float32)
            mean = float(np.mean(losses))
        return mean

    def predict(self, xs: list[np.ndarray], cells: int = 20000) -> list[np.ndarray]:
        """Probability of each element; sequences of like length go together, about `cells` elements at a time."""
        out: list = [None] * len(xs)
        order = np.argsort([len(x) for x in xs], kind="stable")
        a = 0
        while a < len(order):
            b = a + 1
            while b < len(order) and (b - a + 1) * len(xs[order[b]]) <= cells:
                b += 1
            x, lens = padded([xs[i] for i in order[a:b]])
            p = _sigmoid(self._logits(x, lens)[0])
            for r, i in enumerate(order[a:b]):
                out[i] = p[r, :lens[r]]
            a = b
        return out


def padded(xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lens = np.array([len(x) for x in xs], np.int64)
    out = np.zeros((len(xs), max(1, int(lens.max())), xs[0].shape[1]), np.float32)
    for r, x in enumerate(xs):
        out[r, :len(x)] = x
    return out, lens
