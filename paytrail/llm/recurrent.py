"""A bidirectional LSTM that labels the items of sequences, in numpy.

An item is a set of path buckets and a bag of word buckets, each summed up from
its own embedding table, and a few numbers.  Sequences of a batch are padded on the
right; a padded step keeps the state as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .fm import segment_sums, sigmoid

NUMBERS = 8


@dataclass
class Items:
    """Items of several sequences, end to end; bags are bucket arrays with limits for each item."""

    paths: np.ndarray
    path_limits: np.ndarray
    words: np.ndarray
    word_limits: np.ndarray
    numbers: np.ndarray  # items x NUMBERS
    lengths: np.ndarray  # of the sequences


def new_weights(path_buckets: int, word_buckets: int, seed: int = 11, dims: tuple[int, int, int] = (16, 8, 24)) -> dict[str, np.ndarray]:
    pick = np.random.default_rng(seed)
    d_path, d_word, hidden = dims
    d = d_path + d_word + NUMBERS
    made = {"path": pick.normal(0, 0.3, (path_buckets, d_path)), "word": pick.normal(0, 0.1, (word_buckets, d_word)), "skip": pick.normal(0, 0.1, d), "bias": np.zeros(1)}
    for side in ("ahead", "back"):
        gates = np.zeros(4 * hidden)
        gates[hidden : 2 * hidden] = 1  # what is known is kept at first
        made |= {f"{side}_in": pick.normal(0, d**-0.5, (d, 4 * hidden)), f"{side}_state": pick.normal(0, hidden**-0.5, (hidden, 4 * hidden)), f"{side}_gates": gates, f"{side}_out": pick.normal(0, hidden**-0.5, hidden)}
    return {k: v.astype(np.float32) for k, v in made.items()}


def _bags(table: np.ndarray, buckets: np.ndarray, limits: np.ndarray, power: float) -> tuple[np.ndarray, np.ndarray]:
    scale = (1 / np.maximum(np.diff(limits), 1) ** power).astype(np.float32)[:, None]
    out = np.zeros((len(limits) - 1, table.shape[1]), np.float32)
    # In stretches, so that a long document's words are never held as vectors at once.
    at = 0
    while at < len(out):
        stop = max(at + 1, int(np.searchsorted(limits, limits[at] + (1 << 18), side="right")) - 1)
        out[at:stop] = segment_sums(table[buckets[limits[at] : limits[stop]]], limits[at : stop + 1] - limits[at])
        at = stop
    return out * scale, scale


def inputs(w: dict, items: Items) -> tuple[np.ndarray, tuple]:
    path, path_scale = _bags(w["path"], items.paths, items.path_limits, 0.5)
    word, word_scale = _bags(w["word"], items.words, items.word_limits, 1.0)
    return np.concatenate((path, word, items.numbers.astype(np.float32)), axis=1), (path_scale, word_scale)


def _run(w: dict, side: str, x: np.ndarray, alive: np.ndarray, keep: bool):
    """States of one direction over x (steps, sequences, d), and what the way back needs."""
    steps, n, _ = x.shape
    hidden = w[f"{side}_state"].shape[0]
    h, c = np.zeros((n, hidden), np.float32), np.zeros((n, hidden), np.float32)
    out, held = np.zeros((steps, n, hidden), np.float32), []
    for t in range(steps) if side == "ahead" else range(steps - 1, -1, -1):
        z = x[t] @ w[f"{side}_in"] + h @ w[f"{side}_state"] + w[f"{side}_gates"]
        gate = sigmoid(z[:, : 3 * hidden])
        i, f, o, g = gate[:, :hidden], gate[:, hidden : 2 * hidden], gate[:, 2 * hidden :], np.tanh(z[:, 3 * hidden :])
        m = alive[t][:, None]
        new = f * c + i * g
        wide = np.tanh(new)
        if keep:
            held.append((t, h, c, i, f, o, g, wide))
        h, c = np.where(m, o * wide, h), np.where(m, new, c)
        out[t] = h
    return out, held


def _pad(x: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = int(lengths.max())
    alive = np.arange(steps)[:, None] < lengths[None, :]
    padded = np.zeros((len(lengths), steps, x.shape[1]), np.float32)
    padded[alive.T] = x
    return padded.transpose(1, 0, 2), alive, padded


def margins(w: dict, items: Items, cells: int = 1 << 15) -> np.ndarray:
    """The log odds of label 1 for each item; sequences of like length are run together, about cells items at once."""
    x, _ = inputs(w, items)
    limits = np.concatenate(([0], np.cumsum(items.lengths)))
    out = np.zeros(len(x), np.float32)
    order = np.argsort(-items.lengths, kind="stable")
    at = 0
    while at < len(order) and items.lengths[order[at]]:
        own = order[at : at + max(1, cells // int(items.lengths[order[at]]))]
        own = own[items.lengths[own] > 0]
        lengths = items.lengths[own]
        where = np.concatenate([np.arange(limits[s], limits[s + 1]) for s in own])
        padded, alive, _ = _pad(x[where], lengths)
        score = sum(_run(w, side, padded, alive, False)[0] @ w[f"{side}_out"] for side in ("ahead", "back"))
        out[where] = score.T[alive.T] + x[where] @ w["skip"] + w["bias"][0]
        at += len(own)
    return out


def gradients(w: dict, items: Items, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """The mean loss of a batch, and its gradient for every weight."""
    x, (path_scale, word_scale) = inputs(w, items)
    padded, alive, _ = _pad(x, items.lengths)
    runs = {side: _run(w, side, padded, alive, True) for side in ("ahead", "back")}
    margin = sum(runs[s][0] @ w[f"{s}_out"] for s in runs).T[alive.T] + x @ w["skip"] + w["bias"][0]
    p = sigmoid(margin)
    n = len(labels)
    loss = float(-np.mean(labels * np.log(p + 1e-7) + (1 - labels) * np.log(1 - p + 1e-7)))
    gap = ((p - labels) / n).astype(np.float32)
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    grad["bias"][0], grad["skip"] = gap.sum(), x.T @ gap
    d_out = np.zeros(alive.T.shape, np.float32)
    d_out[alive.T] = gap
    d_x = np.zeros_like(padded)
    for side, (out, held) in runs.items():
        state, w_in = w[f"{side}_state"], w[f"{side}_in"]
        grad[f"{side}_out"] = np.einsum("tnh,nt->h", out, d_out)
        d_h, d_c = np.zeros_like(out[0]), np.zeros_like(out[0])
        for t, h, c, i, f, o, g, wide in reversed(held):
            d_h = d_h + d_out[:, t][:, None] * w[f"{side}_out"]
            m = alive[t][:, None]
            own_h, own_c = np.where(m, d_h, 0), np.where(m, d_c, 0)
            d_new = own_c + own_h * o * (1 - wide * wide)
            d_z = np.concatenate((d_new * g * i * (1 - i), d_new * c * f * (1 - f), own_h * wide * o * (1 - o), d_new * i * (1 - g * g)), axis=1)
            grad[f"{side}_in"] += padded[t].T @ d_z
            grad[f"{side}_state"] += h.T @ d_z
            grad[f"{side}_gates"] += d_z.sum(axis=0)
            d_x[t] += d_z @ w_in.T
            d_h, d_c = np.where(m, 0, d_h) + d_z @ state.T, np.where(m, d_new * f, d_c)
    d_items = d_x.transpose(1, 0, 2)[alive.T] + gap[:, None] * w["skip"]
    d_path = w["path"].shape[1]
    for name, part, scale, buckets, limits in (("path", d_items[:, :d_path], path_scale, items.paths, items.path_limits), ("word", d_items[:, d_path : d_path + w["word"].shape[1]], word_scale, items.words, items.word_limits)):
        np.add.at(grad[name], buckets, np.repeat(part * scale, np.diff(limits), axis=0))
    return loss, grad


class Adam:
    def __init__(self, w: dict, rate: float):
        self.w, self.rate, self.n = w, rate, 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))

    def step(self, grad: dict) -> None:
        self.n += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grad.values())))
        shrink = min(1.0, 1 / max(norm, 1e-9))
        for k, g in grad.items():
            g = g * shrink
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.99 * self.v[k] + 0.01 * g * g
            self.w[k] -= self.rate * (self.m[k] / (1 - 0.9**self.n)) / (np.sqrt(self.v[k] / (1 - 0.99**self.n)) + 1e-6)
