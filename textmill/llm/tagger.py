"""A character tagger in numpy: bidirectional LSTM with a linear-chain CRF on top.

Works on batches of equally long windows of symbol numbers. Training is plain back-propagation with Adam; decoding gives
the best label sequence (Viterbi) and the marginal probability of each label on it.
"""

from __future__ import annotations

import numpy as np

Parameters = dict[str, np.ndarray]
DIRECTIONS = ("f", "b")


def new_parameters(symbols: int, labels: int, width: int, hidden: int, seed: int) -> Parameters:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p: Parameters = {"embed": draw(symbols, width) * 2}
    for d in DIRECTIONS:
        p[f"x{d}"], p[f"h{d}"] = draw(width, 4 * hidden), draw(hidden, 4 * hidden)
        p[f"c{d}"] = np.zeros(4 * hidden, np.float32)
        p[f"c{d}"][hidden : 2 * hidden] = 1  # remember at first
    p["out"], p["bias"] = draw(2 * hidden, labels), np.zeros(labels, np.float32)
    p["move"], p["start"] = np.zeros((labels, labels), np.float32), np.zeros(labels, np.float32)
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(p: Parameters, d: str, x: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (time, batch, hidden) for inputs in the direction's own order."""
    steps, batch, _ = x.shape
    n = p[f"h{d}"].shape[0]
    h = c = np.zeros((batch, n), np.float32)
    inputs = x @ p[f"x{d}"] + p[f"c{d}"]
    out, cache = np.empty((steps, batch, n), np.float32), []
    for t in range(steps):
        gates = inputs[t] + h @ p[f"h{d}"]
        ifo = _sigmoid(gates[:, : 3 * n])
        i, f, o = ifo[:, :n], ifo[:, n : 2 * n], ifo[:, 2 * n :]
        g = np.tanh(gates[:, 3 * n :])
        before = (h, c)
        c = f * c + i * g
        tanh_c = np.tanh(c)
        h = o * tanh_c
        out[t] = h
        cache.append((before, i, f, o, g, tanh_c))
    return out, cache


def _lstm_back(p: Parameters, d: str, x: np.ndarray, cache: list, above: np.ndarray, grad: Parameters) -> np.ndarray:
    steps, batch, n = above.shape
    dgates = np.empty((steps, batch, 4 * n), np.float32)
    dh = dc = np.zeros((batch, n), np.float32)
    for t in range(steps - 1, -1, -1):
        (h, c), i, f, o, g, tanh_c = cache[t]
        dh = dh + above[t]
        dc = dc + dh * o * (1 - tanh_c**2)
        dgates[t] = np.concatenate(
            [dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tanh_c * o * (1 - o), dc * i * (1 - g**2)], axis=1
        )
        dc = dc * f
        dh = dgates[t] @ p[f"h{d}"].T
    states = np.stack([each[0][0] for each in cache])
    flat = dgates.reshape(-1, 4 * n)
    grad[f"x{d}"] = x.reshape(-1, x.shape[2]).T @ flat
    grad[f"h{d}"] = states.reshape(-1, n).T @ flat
    grad[f"c{d}"] = flat.sum(0)
    return dgates @ p[f"x{d}"].T


def _scores(p: Parameters, symbols: np.ndarray) -> tuple[np.ndarray, tuple]:
    x = p["embed"][symbols.T]
    forward, cache_f = _lstm(p, "f", x)
    backward, cache_b = _lstm(p, "b", x[::-1])
    both = np.concatenate([forward, backward[::-1]], axis=2)
    return both @ p["out"] + p["bias"], (x, both, cache_f, cache_b)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def _forward_backward(p: Parameters, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log forward and backward sums and the log partition for emissions (time, batch, label)."""
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = p["start"] + e[0]
    for t in range(1, len(e)):
        alpha[t] = e[t] + _log_sum(alpha[t - 1][:, :, None] + p["move"], 1)
    for t in range(len(e) - 2, -1, -1):
        beta[t] = _log_sum(p["move"] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    return alpha, beta, _log_sum(alpha[-1], 1)


def loss_and_gradient(p: Parameters, symbols: np.ndarray, gold: np.ndarray) -> tuple[float, Parameters]:
    """Mean negative log likelihood of the label sequences and its gradient."""
    e, (x, both, cache_f, cache_b) = _scores(p, symbols)
    alpha, beta, total = _forward_backward(p, e)
    batch, labels, gold = e.shape[1], e.shape[2], gold.T
    one = np.eye(labels, dtype=np.float32)[gold]
    path = (e * one).sum((0, 2)) + p["start"][gold[0]] + p["move"][gold[:-1], gold[1:]].sum(0)
    marginal = np.exp(alpha + beta - total[None, :, None])
    de = (marginal - one) / batch
    grad: Parameters = {"start": de[0].sum(0), "bias": de.sum((0, 1))}
    pairs = np.exp(
        alpha[:-1][:, :, :, None] + p["move"] + (e[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None]
    ).sum((0, 1))
    seen = np.zeros_like(pairs)
    np.add.at(seen, (gold[:-1].ravel(), gold[1:].ravel()), 1)
    grad["move"] = (pairs - seen) / batch
    grad["out"] = both.reshape(-1, both.shape[2]).T @ de.reshape(-1, labels)
    dboth = de @ p["out"].T
    n = dboth.shape[2] // 2
    dx = _lstm_back(p, "f", x, cache_f, dboth[:, :, :n], grad)
    dx = dx + _lstm_back(p, "b", x[::-1], cache_b, dboth[::-1, :, n:], grad)[::-1]
    grad["embed"] = np.zeros_like(p["embed"])
    np.add.at(grad["embed"], symbols.T, dx)
    return float((total - path).mean()), grad


def train(
    symbols: np.ndarray,
    gold: np.ndarray,
    shape: tuple[int, int, int, int],
    epochs: int,
    batch: int = 64,
    rate: float = 0.01,
    seed: int = 1,
) -> Parameters:
    """Parameters fitted to windows (row, time) and their labels; ``shape`` is (symbols, labels, width, hidden)."""
    p, rng = new_parameters(*shape, seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(symbols))
        now = rate * (1 - epoch / epochs) + rate / 20
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            _, grad = loss_and_gradient(p, symbols[rows], gold[rows])
            step += 1
            norm = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                p[k] = (p[k] - now * change).astype(np.float32)
    return p


def decode(p: Parameters, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best label of each place and its marginal probability, both (row, time)."""
    e, _ = _scores(p, symbols)
    alpha, beta, total = _forward_backward(p, e)
    marginal = np.exp(alpha + beta - total[None, :, None])
    best, back = p["start"] + e[0], []
    for t in range(1, len(e)):
        options = best[:, :, None] + p["move"]
        back.append(options.argmax(1))
        best = options.max(1) + e[t]
    labels = np.empty(e.shape[:2], np.int64)
    labels[-1] = best.argmax(1)
    for t in range(len(e) - 2, -1, -1):
        labels[t] = np.take_along_axis(back[t], labels[t + 1][:, None], 1)[:, 0]
    sure = np.take_along_axis(marginal, labels[:, :, None], 2)[:, :, 0]
    return labels.T, np.minimum(sure.T, 1)  # a sum of rounded numbers may pass it
