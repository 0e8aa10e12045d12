"""A character-level bidirectional LSTM with CRF transitions, in numpy.

``train`` fits it by Adam on windows of characters with a tag for each; ``decode`` gives
the best tag sequence of many windows at once. Arrays are (time, batch, ...).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Params = dict[str, np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def init(symbols: int, hidden: int, tags: int, rng: np.random.Generator) -> Params:
    p: Params = {}
    for d in "fb":
        p[f"x{d}"] = rng.normal(0, 0.3, (symbols, 4 * hidden))  # what each symbol adds to the gates
        p[f"h{d}"] = rng.normal(0, hidden**-0.5, (hidden, 4 * hidden))
        p[f"b{d}"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        p[f"o{d}"] = rng.normal(0, hidden**-0.5, (hidden, tags))
    p["step"] = rng.normal(0, 0.1, (tags, tags))  # CRF score of a tag after another
    p["first"] = np.zeros(tags)
    return {k: v.astype(np.float32) for k, v in p.items()}


def run_lstm(p: Params, d: str, chars: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """Hidden states of one direction; ``keep`` also returns what the way back needs."""
    steps, batch = chars.shape
    hidden = len(p[f"h{d}"])
    h = np.zeros((batch, hidden), np.float32)
    c = np.zeros_like(h)
    out = np.empty((steps, batch, hidden), np.float32)
    kept: list = [None] * steps
    table, recurrent = p[f"x{d}"] + p[f"b{d}"], p[f"h{d}"]
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        z = table[chars[t]] + h @ recurrent
        gates = sigmoid(z[:, :3 * hidden])
        i, f, o = gates[:, :hidden], gates[:, hidden:2 * hidden], gates[:, 2 * hidden:]
        g = np.tanh(z[:, 3 * hidden:])
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        if keep:
            kept[t] = (h, before, i, f, o, g, squashed)
        h = o * squashed
        out[t] = h
    return out, kept


def back_lstm(p: Params, d: str, chars: np.ndarray, kept: list, d_out: np.ndarray, grads: Params) -> None:
    steps, batch = chars.shape
    recurrent = p[f"h{d}"]
    hidden = len(recurrent)
    d_h = np.zeros((batch, hidden), np.float32)
    d_c = np.zeros_like(d_h)
    d_z = np.empty((steps, batch, 4 * hidden), np.float32)
    d_recurrent = np.zeros_like(recurrent)
    for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
        h, before, i, f, o, g, squashed = kept[t]
        d_h = d_h + d_out[t]
        d_c = d_c + d_h * o * (1 - squashed**2)
        z = d_z[t]
        z[:, :hidden] = d_c * g * i * (1 - i)
        z[:, hidden:2 * hidden] = d_c * before * f * (1 - f)
        z[:, 2 * hidden:3 * hidden] = d_h * squashed * o * (1 - o)
        z[:, 3 * hidden:] = d_c * i * (1 - g**2)
        d_recurrent += h.T @ z
        d_h, d_c = z @ recurrent.T, d_c * f
    flat, seen = d_z.reshape(-1, 4 * hidden), chars.reshape(-1)
    d_table = np.zeros_like(p[f"x{d}"])
    order = np.argsort(seen, kind="stable")
    symbols, first = np.unique(seen[order], return_index=True)
    d_table[symbols] = np.add.reduceat(flat[order], first, axis=0)
    grads[f"x{d}"], grads[f"h{d}"], grads[f"b{d}"] = d_table, d_recurrent, flat.sum(0)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_loss(p: Params, unary: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Mean negative log likelihood, and its gradients by unary, step and first."""
    steps, batch, k = unary.shape
    step = p["step"]
    ahead = np.empty_like(unary)
    ahead[0] = unary[0] + p["first"]
    for t in range(1, steps):
        ahead[t] = unary[t] + _log_sum(ahead[t - 1][:, :, None] + step[None], 1)
    behind = np.zeros_like(unary)
    for t in range(steps - 2, -1, -1):
        behind[t] = _log_sum(step[None] + (unary[t + 1] + behind[t + 1])[:, None, :], 2)
    total = _log_sum(ahead[-1], 1)
    one = np.eye(k, dtype=np.float32)[tags]
    d_unary = np.exp(ahead + behind - total[None, :, None]) - one
    pairs = np.exp(ahead[:-1, :, :, None] + step + (unary[1:] + behind[1:])[:, :, None, :] - total[None, :, None, None])
    d_step = pairs.sum((0, 1)) - np.einsum("tbi,tbj->ij", one[:-1], one[1:])
    gold = (unary * one).sum((0, 2)) + p["first"][tags[0]] + step[tags[:-1], tags[1:]].sum(0)
    return float((total - gold).mean()), d_unary / batch, d_step / batch, d_unary[0].sum(0) / batch


@dataclass(frozen=True)
class Training:
    hidden: int = 20
    steps: int = 260
    batch: int = 64
    rate: float = 0.02
    seed: int = 5


def train(chars: np.ndarray, tags: np.ndarray, symbols: int, n_tags: int, how: Training = Training()) -> Params:
    """Fit on windows (count, time) of symbol numbers and tag numbers."""
    rng = np.random.default_rng(how.seed)
    p = init(symbols, how.hidden, n_tags, rng)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for n in range(1, how.steps + 1):
        pick = rng.integers(0, len(chars), how.batch)
        x, y = chars[pick].T, tags[pick].T
        sides = {d: run_lstm(p, d, x, keep=True) for d in "fb"}
        unary = sum(sides[d][0] @ p[f"o{d}"] for d in "fb")
        _, d_unary, d_step, d_first = crf_loss(p, unary, y)
        grads: Params = {"step": d_step, "first": d_first}
        for d in "fb":
            out, kept = sides[d]
            grads[f"o{d}"] = np.einsum("tbh,tbk->hk", out, d_unary)
            back_lstm(p, d, x, kept, d_unary @ p[f"o{d}"].T, grads)
        norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
        rate = how.rate * min(1.0, 4 * (1 - (n - 1) / how.steps))
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g**2
            p[k] = (p[k] - rate * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-6)
                    ).astype(np.float32)
    return p


def decode(p: Params, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tags (time, batch) by Viterbi, and the unary scores (time, batch, tag)."""
    unary = sum(run_lstm(p, d, chars)[0] @ p[f"o{d}"] for d in "fb")
    steps, batch, k = unary.shape
    score = unary[0] + p["first"]
    came = np.empty((steps, batch, k), np.int8)
    for t in range(1, steps):
        ways = score[:, :, None] + p["step"][None]
        came[t] = ways.argmax(1)
        score = unary[t] + ways.max(1)
    tags = np.empty((steps, batch), np.int64)
    tags[-1] = score.argmax(1)
    for t in range(steps - 1, 0, -1):
        tags[t - 1] = came[t][np.arange(batch), tags[t]]
    return tags, unary
